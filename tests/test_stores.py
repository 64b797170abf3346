from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom.stores import ConcurrentUpdate, IndexPersonaStore, SnapshotPersonaStore
from tagloom.stores.hadoop import scratch_folder, shared_folder

BATCH = "userId string, tagsId string"


def batch(spark, rows):
    return spark.createDataFrame(rows, BATCH)


def content(store):
    rows = [tuple(r) for r in store.read_tags_id().collect()]
    assert len({u for u, _ in rows}) == len(rows)
    return dict(rows)


def test_upsert(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    assert store.read().collect() == [] and store.read().dtypes == [("userId", "string"), ("tags", "array<string>")]
    assert store.upsert(batch(spark, [("1", "5"), ("2", "5,5"), ("4", "1")])) == 1
    assert store.upsert(batch(spark, [("2", "6"), ("3", "7"), ("4", None)])) == 2
    assert content(store) == {"1": "5", "2": "6", "3": "7", "4": None}


def test_merge_upsert(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    store.upsert(batch(spark, [("1", "5"), ("2", "5,5"), ("4", "1,1")]))
    new = batch(spark, [("2", "10"), ("2", "9"), ("3", "7"), ("4", None), ("5", None)])
    store.merge_upsert(new)
    after = {"1": "5", "2": "5,9,10", "3": "7", "4": "1,1", "5": None}
    assert content(store) == after
    store.merge_upsert(new)
    assert content(store) == after


def test_reader_of_an_older_snapshot_is_not_disturbed(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    store.upsert(batch(spark, [("1", "5")]))
    old = store.read_tags_id()
    store.upsert(batch(spark, [("1", "6")]))
    assert [tuple(r) for r in old.collect()] == [("1", "5")]
    # A new store object, as in a later session, sees the newest snapshot.
    assert content(SnapshotPersonaStore(spark, str(tmp_path / "p"))) == {"1": "6"}


def test_old_snapshots_are_pruned(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), keep=2)
    for n in range(4):
        store.upsert(batch(spark, [("1", str(n))]))
    assert store.versions() == [3, 4]
    assert len(list((tmp_path / "p" / "snapshots").iterdir())) == 2
    assert content(store) == {"1": "3"}


def test_concurrent_writer_loses(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "p")
    slow, fast = SnapshotPersonaStore(spark, root), SnapshotPersonaStore(spark, root)
    slow.upsert(batch(spark, [("1", "5")]))
    seen = slow.versions()
    fast.upsert(batch(spark, [("1", "6")]))
    real = slow.versions
    answers = iter([seen])
    monkeypatch.setattr(slow, "versions", lambda: next(answers, None) or real())
    with pytest.raises(ConcurrentUpdate):
        slow.upsert(batch(spark, [("1", "7")]))
    assert content(fast) == {"1": "6"}
    assert len(list((tmp_path / "p" / "snapshots").iterdir())) == 2


def test_failed_write_leaves_the_store_alone(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    store.upsert(batch(spark, [("1", "5")]))
    with pytest.raises(Exception, match="no userId"):
        store.merge_upsert(batch(spark, [("2", "6"), (None, "7")]))
    assert content(store) == {"1": "5"}
    assert spark.sql("SHOW TABLES").filter("tableName LIKE 'persona%'").count() == 0
    store.upsert(batch(spark, [("2", "6")]))
    assert content(store) == {"1": "5", "2": "6"}


def test_update_does_not_shuffle_the_stored_side(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    ids = spark.range(5000).select(F.col("id").cast("string").alias("userId"), F.lit("1").alias("tagsId"))
    store.upsert(ids)
    [snapshot] = (tmp_path / "p" / "snapshots").iterdir()
    assert len([f for f in snapshot.iterdir() if f.name.endswith(".parquet")]) == 8
    plans = []
    write = store._write
    store._write = lambda rows, *rest: (plans.append(rows), write(rows, *rest))[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        store.merge_upsert(ids.withColumn("tagsId", F.lit("2")))
        plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The batch was staged in the store's buckets, so that nothing is left to shuffle.
    assert "Exchange" not in plan
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert "Python" not in plan
    assert store.read().filter("cast(tags as string) = '[1, 2]'").count() == 5000


def bucket_files(folder):
    return sorted(int(f.name.split("_")[-1].split(".")[0]) for f in folder.iterdir() if f.name.endswith(".parquet"))


def test_update_writes_and_reads_the_batch_buckets_only(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), buckets=16)
    store.upsert(batch(spark, [(str(i), "1") for i in range(1000)]))
    one = batch(spark, [("7", "2")])
    [bucket] = store._touched(one, 16)
    opened = []
    read = store._open
    store._open = lambda commit, only=None: opened.append(read(commit, only)) or opened[-1]
    store.merge_upsert(one)
    assert {int(f.split("_")[-1].split(".")[0]) for f in opened[0].inputFiles()} == {bucket}
    first, second = sorted((tmp_path / "p" / "snapshots").iterdir())
    assert set(bucket_files(second)) == {bucket} and set(bucket_files(first)) == set(range(16))
    # The old file of that bucket is still there for earlier readers, but not read any more.
    assert content(store) == {str(i): "1,2" if i == 7 else "1" for i in range(1000)}
    assert len(store.read().inputFiles()) == 16
    opened.clear()
    assert [tuple(r) for r in store.merged(batch(spark, [("7", "5"), ("7", "1")])).collect()] == [("7", "1,2,5")]
    assert {int(f.split("_")[-1].split(".")[0]) for f in opened[0].inputFiles()} == {bucket}


def test_many_small_updates_are_folded(spark, tmp_path, monkeypatch):
    from tagloom.stores import buckets

    monkeypatch.setattr(buckets, "MOST_FOLDERS", 3)
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), buckets=16)
    wanted = {str(i): "0" for i in range(100)}
    store.upsert(batch(spark, list(wanted.items())))
    for n in range(1, 9):
        store.upsert(batch(spark, [(str(n), str(n))]))
        wanted[str(n)] = str(n)
        assert len(store._current()["folders"]) <= 3
    assert content(store) == wanted
    assert store.upsert(batch(spark, [])) == 10 and content(store) == wanted


def test_reader_outlives_three_updates(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    store.upsert(batch(spark, [(str(i), "1") for i in range(20)]))
    frame = store.read_tags_id()
    for n in range(3):
        store.upsert(batch(spark, [(str(i), str(n + 2)) for i in range(20)]))
    assert {r["tagsId"] for r in frame.collect()} == {"1"}
    # Once versions are too old, they go with all folders that no younger one needs.
    short = SnapshotPersonaStore(spark, str(tmp_path / "p"), keep_hours=0.0)
    short.upsert(batch(spark, [(str(i), "9") for i in range(20)]))
    assert short.versions() == [5] and len(list((tmp_path / "p" / "snapshots").iterdir())) == 1


def test_leased_version_stays(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), keep=1)
    with store.reading() as nothing:
        assert nothing.count() == 0
    store.upsert(batch(spark, [("1", "1")]))
    with store.reading() as frame:
        for n in range(3):
            store.upsert(batch(spark, [("1", str(n + 2))]))
        assert store.versions() == [1, 4]
        assert [r["tags"] for r in frame.collect()] == [["1"]]
    store.upsert(batch(spark, [("1", "8")]))
    assert store.versions() == [5]
    with store.reading(hours=-1.0):
        store.upsert(batch(spark, [("1", "9")]))
        assert store.versions() == [6]


def test_commits_of_one_folder_are_read(spark, tmp_path):
    import json

    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), buckets=4)
    store.upsert(batch(spark, [(str(i), "1") for i in range(30)]))
    path = tmp_path / "p" / "commits" / "000000001.json"
    [folder] = json.loads(path.read_text())["folders"]
    path.write_text(json.dumps({"folder": folder, "buckets": 4}))
    (tmp_path / "p" / "commits" / ".000000001.json.crc").unlink(missing_ok=True)
    store.merge_upsert(batch(spark, [("3", "2")]))
    assert content(store) == {str(i): "1,2" if i == 3 else "1" for i in range(30)}


def test_bucket_count_may_differ_from_shuffle_partitions(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), buckets=3)
    store.upsert(batch(spark, [(str(i), "1") for i in range(50)]))
    store.merge_upsert(batch(spark, [(str(i), "2") for i in range(25, 75)]))
    expected = {str(i): "1" if i < 25 else "1,2" if i < 50 else "2" for i in range(75)}
    assert content(store) == expected
    for snapshot in (tmp_path / "p" / "snapshots").iterdir():
        assert len([f for f in snapshot.iterdir() if f.name.endswith(".parquet")]) <= 3


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second and first.startswith(shared_folder(spark))


def test_shared_folder_must_be_set_on_a_cluster(spark):
    class Conf:
        def get(self, name, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_index_store_options(spark, monkeypatch):
    seen = {}

    class Writer:
        def mode(self, mode):
            seen["mode"] = mode
            return self

        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def save(self):
            seen["saved"] = True

    class Batch:
        write = Writer()

    IndexPersonaStore(spark, "h:9200", "\tpersona/_doc").upsert(Batch())
    assert seen == {
        "mode": "append",
        "format": "es",
        "es.nodes": "h:9200",
        "es.resource": "persona/_doc",
        "es.index.auto.create": "true",
        "es.write.operation": "upsert",
        "es.mapping.id": "userId",
        "saved": True,
    }


def test_index_store_merges_only_the_batch(spark, monkeypatch):
    store = IndexPersonaStore(spark, "h", "persona/_doc")
    monkeypatch.setattr(store, "read_tags_id", lambda: batch(spark, [("1", "5"), ("9", "1")]))
    written = []
    monkeypatch.setattr(store, "upsert", written.append)
    lists = spark.createDataFrame([("1", ["6"]), ("2", None)], "userId string, tags array<string>")
    store.merge_upsert_lists(lists)
    assert sorted(map(tuple, written[0].collect())) == [("1", "5,6"), ("2", None)]


def test_unreadable_newest_commit_is_passed_over(spark, tmp_path):
    from tagloom.stores.persona import SnapshotPersonaStore

    store = SnapshotPersonaStore(spark, str(tmp_path / "persona"), buckets=3)
    one = spark.createDataFrame([("1", "5"), ("2", "7")], "userId string, tagsId string")
    store.upsert(one)
    (tmp_path / "persona" / "commits" / "000000002.json").write_text("")
    assert {r["userId"]: r["tagsId"] for r in store.read_tags_id().collect()} == {"1": "5", "2": "7"}
    assert store.merge_upsert(spark.createDataFrame([("1", "4")], "userId string, tagsId string")) == 3
    assert {r["userId"]: r["tagsId"] for r in store.read_tags_id().collect()} == {"1": "4,5", "2": "7"}
    store.rebucket(5)
    assert store.read().count() == 2


def test_scratch_of_a_run_is_freed(spark, tmp_path):
    from tagloom.stores.hadoop import scratch_folder, scratch_scope

    before = spark.conf.get("spark.checkpoint.dir")
    import os

    folders = set(os.listdir(before)) if os.path.isdir(before) else set()
    try:
        with scratch_scope(spark):
            inside = scratch_folder(spark)
            assert os.path.isdir(inside)
            raise RuntimeError
    except RuntimeError:
        pass
    assert set(os.listdir(before)) == folders


def test_profiles_grow_with_the_orders(spark, tmp_path):
    from tagloom.operators.profiles import order_profile
    from tagloom.stores import OrderProfileStore

    orders = spark.range(3000).select(
        F.when(F.col("id") % 97 > 0, (F.col("id") % 53).cast("string")).alias("memberid"),
        F.col("id").alias("ordersn"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("p"), (F.col("id") % 5).cast("string"))).alias("paymentcode"),
        (F.col("id") % 100).cast("string").alias("finishtime"),
        (F.col("id") / 7).alias("orderamount"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3).alias("couponcodevalue"),
    )
    store = OrderProfileStore(spark, str(tmp_path / "o"), buckets=16)
    assert store.profile().count() == 0
    for part in range(3):
        store.add(orders.filter(F.col("ordersn") % 3 == part))
    one = store.add(orders.filter("memberid = '7'").limit(0))
    assert one == 4
    wanted = sorted(map(tuple, order_profile(orders).collect()), key=repr)
    assert sorted(map(tuple, store.profile().select(*order_profile(orders).columns).collect()), key=repr) == wanted
    [bucket] = store._touched(orders.filter("memberid = '7'").select(F.col("memberid").alias("userId")), 16)
    store.add(orders.filter("memberid = '7'").limit(5))
    newest = max((tmp_path / "o" / "snapshots").iterdir())
    assert set(bucket_files(newest)) == {bucket}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_buckets_in_several_folders_are_grouped_and_joined(spark, tmp_path, adaptive):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"), buckets=16)
    store.upsert(batch(spark, [(str(i), "1") for i in range(1000)]))
    store.upsert(batch(spark, [(str(i), "2") for i in range(3)]))
    rows = store.read()
    others = spark.range(1000).select(F.col("id").cast("string").alias("userId"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        twice = rows.unionByName(rows).groupBy("userId").count()
        assert twice.count() == 1000 and twice.filter("count <> 2").count() == 0
        assert rows.groupBy("userId").count().count() == 1000
        joined = rows.join(others, "userId", "full")
        assert joined.count() == 1000 and joined.filter("x IS NULL OR tags IS NULL").count() == 0
        assert rows.select("userId").join(others, "userId").count() == 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
