from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import (
    assign_cluster_tags,
    assign_clusters,
    fit_clusters,
    nearest_centre,
    rank_clusters,
)
from tagloom.operators.clusters import NothingToCluster
from tagloom.sources import TagValues
from tagloom.stores import ConcurrentUpdate, ModelStore

COLUMNS = ["r", "f", "m"]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = [(str(i), *(rng.randrange(6) for _ in COLUMNS)) for i in range(3000)]
    return spark.createDataFrame(rows, "userId string, r int, f int, m int")


def test_rank_clusters():
    assert rank_clusters([[3.0], [9.0], [4.0, 5.0], [1.0]]) == [1, 2, 0, 3]


def test_assign_cluster_tags(spark):
    placed = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "userId string, predict int")
    tags = TagValues.local(spark, [(40, "z"), (38, "x"), (39, "x")])
    tagged = assign_cluster_tags(placed, [[3.0], [9.0], [9.0], [1.0]], tags)
    assert {r["userId"]: r["tagsId"] for r in tagged.collect()} == {"a": "40", "b": "38", "c": "39", "d": None}


def test_more_tags_than_clusters(spark):
    placed = spark.createDataFrame([("a", 0)], "userId string, predict int")
    tags = TagValues.local(spark, [(38, ""), (39, "")])
    assert assign_cluster_tags(placed, [[1.0]], tags).first()["tagsId"] == "38"


def test_nearest_centre_agrees_with_the_model(spark, points):
    model = fit_clusters(points, COLUMNS, k=7, seed=11)
    both = nearest_centre(assign_clusters(points, COLUMNS, model), COLUMNS, model.clusterCenters(), "near")
    assert both.filter("predict <> near").count() == 0
    assert both.select("predict").distinct().count() == len(model.clusterCenters()) == 7


def test_nearest_centre_ties_and_single(spark):
    frame = spark.createDataFrame([(1,), (5,)], "x int")
    assert [r["c"] for r in nearest_centre(frame, ["x"], [[2.0], [0.0], [9.0]], "c").collect()] == [0, 0]
    assert [r["c"] for r in nearest_centre(frame, ["x"], [[2.0]], "c").collect()] == [0, 0]


def test_fit_does_not_depend_on_partitioning(spark, points):
    fits = [
        fit_clusters(frame, COLUMNS, k=7, seed=11).clusterCenters()
        for frame in (points, points.repartition(13), points.orderBy(F.desc("m")).coalesce(1))
    ]
    assert [[list(c) for c in centres] for centres in fits[1:]] == [[list(c) for c in fits[0]]] * 2


def test_fit_over_several_tasks_is_laid_out_by_value(spark, points):
    fits = [
        [list(c) for c in fit_clusters(frame, COLUMNS, k=5, seed=2, partitions=3).clusterCenters()]
        for frame in (points, points.repartition(9))
    ]
    assert fits[0] == fits[1]


def test_merged_points_weigh_as_much_as_the_rows(spark):
    rows = [(0.0,)] * 30 + [(1.0,)] * 10 + [(100.0,)] * 5
    centres = fit_clusters(spark.createDataFrame(rows, "x double"), ["x"], k=2, seed=1).clusterCenters()
    assert sorted(float(c[0]) for c in centres) == pytest.approx([0.25, 100.0])


def test_fewer_points_than_clusters(spark):
    frame = spark.createDataFrame([(1.0,), (5.0,), (5.0,)], "x double")
    model = fit_clusters(frame, ["x"], k=5, seed=1)
    assert sorted(float(c[0]) for c in model.clusterCenters()) == [1.0, 5.0]


def test_nothing_to_cluster(spark):
    with pytest.raises(NothingToCluster):
        fit_clusters(spark.createDataFrame([], "x double"), ["x"], k=2, seed=1)


def test_model_store(spark, points, tmp_path):
    models = ModelStore(spark, str(tmp_path / "models"))
    assert not models.exists("rfm")
    first = models.fit_or_load("rfm", lambda: fit_clusters(points, COLUMNS, k=3, seed=1))
    again = models.fit_or_load("rfm", lambda: pytest.fail("must load"))
    assert [list(c) for c in first.clusterCenters()] == [list(c) for c in again.clusterCenters()]
    assert [p.name for p in (tmp_path / "models").iterdir()] == ["rfm"]


def test_model_store_keeps_the_first_of_two_fits(spark, points, tmp_path):
    models = ModelStore(spark, str(tmp_path))

    def fit():
        models.fit_or_load("m", lambda: fit_clusters(points, COLUMNS, k=2, seed=1))
        return fit_clusters(points, COLUMNS, k=3, seed=1)

    assert len(models.fit_or_load("m", fit).clusterCenters()) == 2


def test_model_versions(spark, points, tmp_path):
    models = ModelStore(spark, str(tmp_path))
    for k in (2, 3, 4):
        models.refit("m", lambda: fit_clusters(points, COLUMNS, k=k, seed=1))
    assert models.versions("m") == [1, 2, 3] and models.latest("other") is None
    assert [len(models.load("m", v).clusterCenters()) for v in (1, 2, 3, None)] == [2, 3, 4, 4]
    models.drop_before("m", 9)
    assert models.versions("m") == [3] and len(models.load("m").clusterCenters()) == 4
    assert len([p for p in (tmp_path / "m").iterdir() if p.name.startswith("model-")]) == 1
    with pytest.raises(LookupError):
        models.load("m", 1)


def test_the_slower_of_two_model_writers_is_told(spark, points, tmp_path):
    mine, other = ModelStore(spark, str(tmp_path)), ModelStore(spark, str(tmp_path))
    model = fit_clusters(points, COLUMNS, k=2, seed=1)
    assert mine.save("m", model, None) == 1

    def slow():
        other.refit("m", lambda: fit_clusters(points, COLUMNS, k=3, seed=1))
        return model

    with pytest.raises(ConcurrentUpdate):
        mine.refit("m", slow)
    with pytest.raises(ConcurrentUpdate):
        mine.save("m", model, 1)
    assert mine.versions("m") == [1, 2] and len(mine.load("m").clusterCenters()) == 3
    folders = [p for p in (tmp_path / "m").iterdir() if p.name.startswith("model-")]
    assert len(folders) == 2


def test_a_model_saved_without_versions_is_version_0(spark, points, tmp_path):
    fit_clusters(points, COLUMNS, k=2, seed=1).write().save(str(tmp_path / "m"))
    models = ModelStore(spark, str(tmp_path))
    assert models.versions("m") == [0]
    assert len(models.fit_or_load("m", lambda: pytest.fail("must load")).clusterCenters()) == 2
    models.refit("m", lambda: fit_clusters(points, COLUMNS, k=3, seed=1))
    assert models.versions("m") == [0, 1] and len(models.load("m").clusterCenters()) == 3
