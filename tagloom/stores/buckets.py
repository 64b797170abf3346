"""Tables keyed by one column that are updated bucket by bucket."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.stores.hadoop import FileSystem, delete_folder, scratch_folder

# An update that would leave more folders of live buckets than this writes all buckets anew.
MOST_FOLDERS = 16
KEEP_HOURS = 24.0

# Rows of an update from (batch, stored), both bucketed by the key; stored is None when there
# is no version yet.
Combine = Callable[[DataFrame, DataFrame | None], DataFrame]


class ConcurrentUpdate(RuntimeError):
    """Another writer committed a version since this update began."""


class BucketStore:
    """A table of ``schema`` in parquet files bucketed by ``key``.

    A version is a numbered commit file that names, for each bucket, the folder its rows lie
    in. An update reads and writes only the buckets that its batch has keys of, in a new
    folder; the other buckets stay where they are. So an update costs what its batch touches,
    and neither side is shuffled: the batch is staged in the same buckets. Once live buckets
    are spread over more than ``MOST_FOLDERS`` folders, an update rewrites all of them.

    Readers use the highest commit, so they never see half a write, and of two writers that
    started from one commit only the first succeeds.

    A version stays readable for ``keep_hours`` after another has replaced it, and as long as
    a ``reading`` lease on it holds. With ``keep``, only the last so many versions and leased
    ones stay, however young the others are. A folder goes when no version needs it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        key: str = "userId",
        buckets: int | None = None,
        keep: int | None = None,
        keep_hours: float = KEEP_HOURS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.keep = keep and max(1, keep)
        self.keep_hours = keep_hours
        self._fs = FileSystem(spark, self.root)
        self._new_buckets = buckets

    # Commits.

    @property
    def _commit_folder(self) -> str:
        return f"{self.root}/commits"

    @property
    def _lease_folder(self) -> str:
        return f"{self.root}/leases"

    def versions(self) -> list[int]:
        names = self._fs.names(self._commit_folder)
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]

    def _json(self, path: str) -> dict | None:
        """What a small file says; None for one that is gone or was left unreadable."""
        if not self._fs.exists(path):
            return None
        try:
            return json.loads(self._fs.read_text(path))
        except ValueError:
            return None

    def _commit(self, version: int) -> dict | None:
        commit = self._json(f"{self._commit_folder}/{version:09d}.json")
        if commit and "folder" in commit:  # one folder with all buckets
            commit["folders"] = {commit["folder"]: list(range(commit["buckets"]))}
        return commit

    def _current(self) -> dict | None:
        """The newest commit that can be read."""
        for version in reversed(self.versions()):
            if commit := self._commit(version):
                return commit | {"version": version}
        return None

    # Reading.

    def read(self) -> DataFrame:
        """The rows of the current version; empty when nothing is stored yet."""
        commit = self._current()
        return self._open(commit) if commit else self._empty()

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    @contextmanager
    def reading(self, hours: float = KEEP_HOURS) -> Iterator[DataFrame]:
        """The current version, kept readable until the end of the block, or for ``hours``
        should this session die in it."""
        commit = self._current()
        if commit is None:
            yield self._empty()
            return
        lease = f"{self._lease_folder}/{uuid.uuid4().hex}.json"
        self._fs.create_text(lease, json.dumps({"version": commit["version"], "until": time.time() + hours * 3600}))
        try:
            # Opened only now, when no writer may delete it any more.
            if self._commit(commit["version"]) is None:
                raise ConcurrentUpdate(f"version {commit['version']} was deleted before it could be leased")
            yield self._open(commit)
        finally:
            self._fs.delete(lease)

    def read_buckets_of(self, batch: DataFrame) -> DataFrame:
        """The stored rows in the buckets that ``batch`` has keys of; a superset of the rows
        with its keys."""
        commit = self._current()
        if commit is None:
            return self._empty()
        return self._open(commit, self._touched(batch, commit["buckets"]))

    def bucket(self, buckets: int) -> Column:
        """The bucket that Spark's writer puts a row into."""
        return F.pmod(F.hash(self.key), F.lit(buckets))

    def _touched(self, batch: DataFrame, buckets: int) -> list[int]:
        """Bucket numbers, at most ``buckets`` of them."""
        return sorted(r[0] for r in batch.select(self.bucket(buckets)).distinct().collect())

    def _open(self, commit: dict, only: Collection[int] | None = None) -> DataFrame:
        """Some buckets of a version, or all, as bucketed relations side by side."""
        wanted = set(range(commit["buckets"]) if only is None else only)
        parts = [
            self._bucketed(f"{self.root}/{folder}", commit["buckets"], sorted(wanted.intersection(own)))
            for folder, own in sorted(commit["folders"].items())
            if wanted.intersection(own)
        ]
        return reduce(DataFrame.unionByName, map(self._by_row, parts)) if parts else self._empty()

    def _by_row(self, part: DataFrame) -> DataFrame:
        """The same rows past a filter that all pass. Spark plans a union of equally bucketed
        relations as bucketed itself, but would run one of plain columnar scans end to end."""
        return part.filter(self.bucket(1 << 30) >= 0)

    def _bucketed(self, location: str, buckets: int, only: list[int]) -> DataFrame:
        """The named buckets of a folder.

        Spark learns of buckets only through a table, so the folder is registered for the
        moment it takes to resolve it. The table is external: dropping it leaves the files.
        """
        name, escaped = self._table_name(), location.replace("'", "\\'")
        options = ""
        if len(only) < buckets:
            # Spark's file names end in the bucket number.
            options = "OPTIONS (pathGlobFilter '*_{" + ",".join(f"{b:05d}" for b in only) + "}.*')"
        self.spark.sql(
            f"CREATE TABLE {name} ({self.schema}) USING parquet {options} CLUSTERED BY ({self.key}) "
            f"SORTED BY ({self.key}) INTO {buckets} BUCKETS LOCATION '{escaped}'"
        )
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return table

    def _casts(self) -> list[Column]:
        """The columns of the schema, by name, in its types."""
        fields = self._empty().schema.fields
        return [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields]

    @staticmethod
    def _table_name() -> str:
        return f"bucket_store_{uuid.uuid4().hex}"

    # Writing.

    def update(self, batch: DataFrame, combine: Combine, dealt: bool = True) -> int:
        """Write ``combine(batch, stored)`` for the buckets that ``batch`` has keys of.

        ``combine`` gets the stored rows of these buckets and must give all rows they are to
        hold from now on, with keys of these buckets only. A batch that comes from a grouping
        by the key is ``dealt`` by it already, if there are as many buckets as shuffle
        partitions; any other is shuffled first, so that each bucket is one file."""
        versions, commit = self.versions(), self._current()
        version = (versions[-1] if versions else 0) + 1
        if commit is None:
            buckets = self._new_buckets or self._shuffle_partitions()
            if not dealt or buckets != self._shuffle_partitions():
                batch = batch.repartition(buckets, self.key)
            return self._write(combine(batch, None), version, buckets, {})
        buckets = commit["buckets"]
        if not dealt or buckets != self._shuffle_partitions():
            batch = batch.repartition(buckets, self.key)
        staging = scratch_folder(self.spark)
        try:
            self._write_bucketed(batch, f"{staging}/batch", buckets)
            staged = self._by_row(self._staged(f"{staging}/batch", buckets, batch.schema))
            touched = self._touched(staged, buckets)
            kept = self._without(commit["folders"], touched)
            if len(kept) >= MOST_FOLDERS:
                touched, kept = list(range(buckets)), {}
            rows = combine(staged, self._open(commit, touched))
            return self._write(rows, version, buckets, kept, touched)
        finally:
            delete_folder(self.spark, staging)

    def _staged(self, location: str, buckets: int, schema) -> DataFrame:
        stored, self.schema = self.schema, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        try:
            return self._bucketed(location, buckets, list(range(buckets)))
        finally:
            self.schema = stored

    @staticmethod
    def _without(folders: dict[str, list[int]], touched: Collection[int]) -> dict[str, list[int]]:
        """Where the buckets that are not touched lie."""
        kept = {folder: sorted(set(own).difference(touched)) for folder, own in folders.items()}
        return {folder: own for folder, own in kept.items() if own}

    def rebucket(self, buckets: int) -> int:
        """Write the current version anew with another number of buckets; moves it all."""
        versions = self.versions()
        rows = self.read().repartition(buckets, self.key)
        return self._write(rows, versions[-1] + 1 if versions else 1, buckets, {})

    def _shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write_bucketed(self, rows: DataFrame, location: str, buckets: int) -> None:
        name = self._table_name()
        (
            rows.write.format("parquet")
            .bucketBy(buckets, self.key)
            .sortBy(self.key)
            .option("path", location)
            .saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")

    def _write(
        self,
        rows: DataFrame,
        version: int,
        buckets: int,
        kept: dict[str, list[int]],
        touched: Collection[int] | None = None,
    ) -> int:
        folder = f"snapshots/{version:09d}-{uuid.uuid4().hex}"
        folders = dict(kept)
        if touched is None or touched:
            self._write_bucketed(rows, f"{self.root}/{folder}", buckets)
            names = (n for n in self._fs.names(f"{self.root}/{folder}") if n.startswith("part-"))
            # Buckets without rows have no file.
            folders[folder] = sorted({int(n.rsplit("_", 1)[1].split(".")[0]) for n in names})
        commit = {"buckets": buckets, "folders": folders, "at": time.time()}
        try:
            self._fs.create_text(f"{self._commit_folder}/{version:09d}.json", json.dumps(commit))
        except Exception as error:
            if version in self.versions():
                self._fs.delete(f"{self.root}/{folder}")
                raise ConcurrentUpdate(f"version {version} was committed by another writer") from error
            raise
        self._prune()
        return version

    # Retention.

    def _leased(self) -> set[int]:
        now, found = time.time(), set()
        for name in self._fs.names(self._lease_folder):
            if name[0] == ".":
                continue
            path = f"{self._lease_folder}/{name}"
            lease = self._json(path)
            if lease and lease["until"] > now:
                found.add(lease["version"])
            elif lease:
                self._fs.delete(path)
        return found

    def _prune(self) -> None:
        """Delete the versions that nobody may read any more, data before commit file."""
        versions, leased = self.versions(), self._leased()
        commits = {v: self._commit(v) for v in versions}
        if self.keep:
            old = versions[: -self.keep]
        else:
            limit = time.time() - self.keep_hours * 3600
            # A version is as old as the one that replaced it; unknown ages count as young.
            old = [v for v, after in zip(versions, versions[1:]) if ((commits[after] or {}).get("at") or limit) < limit]
        gone = [v for v in old if v not in leased]
        needed = {f for v, c in commits.items() if c and v not in gone for f in c["folders"]}
        for version in gone:
            for folder in (commits[version] or {}).get("folders", {}):
                if folder not in needed:
                    self._fs.delete(f"{self.root}/{folder}")
            self._fs.delete(f"{self._commit_folder}/{version:09d}.json")
