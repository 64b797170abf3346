"""The persona table: one row per user with the ids of all tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.tags import merge_tag_lists, to_tags_id
from tagloom.operators.merge import as_tag_lists, merge_with_store, one_row_per_user
from tagloom.sources.spec import SEARCH_INDEX, search_index_options
from tagloom.stores.buckets import KEEP_HOURS, BucketStore
from tagloom.stores.buckets import ConcurrentUpdate as ConcurrentUpdate

SCHEMA = "userId string, tags array<string>"


def checked_batch(batch: DataFrame) -> DataFrame:
    """Fail the write when a row has no user id, since it could not be keyed."""
    no_key = F.raise_error(F.lit("a persona row has no userId"))
    tags = F.when(F.col("userId").isNull(), no_key).otherwise(F.col("tags"))
    return batch.select("userId", tags.alias("tags"))


class SnapshotPersonaStore(BucketStore):
    """Persona table as immutable parquet files, bucketed by user id.

    An update reads and writes only the buckets of the batch's users; see ``BucketStore``
    for versions, concurrent writers, and how long readers may go on.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int | None = None,
        keep: int | None = None,
        keep_hours: float = KEEP_HOURS,
    ):
        super().__init__(spark, root, SCHEMA, "userId", buckets, keep, keep_hours)

    def read_tags_id(self) -> DataFrame:
        """The current rows with tags as comma-separated text, ``(userId, tagsId)``."""
        return self.read().select("userId", to_tags_id(F.col("tags")).alias("tagsId"))

    def upsert(self, new: DataFrame) -> int:
        """Replace the tags of the users in ``new(userId, tagsId)``; keep everyone else."""
        return self._update(one_row_per_user(as_tag_lists(new)), lambda fresh, stored: fresh)

    def merge_upsert(self, new: DataFrame) -> int:
        """``merge_with_store`` followed by ``upsert``, in one join."""
        return self.merge_upsert_lists(one_row_per_user(as_tag_lists(new)))

    def merge_upsert_lists(self, batch: DataFrame) -> int:
        """``merge_upsert`` for ``(userId, tags)`` with one row per user."""
        return self._update(batch, merge_tag_lists)

    def merged(self, new: DataFrame) -> DataFrame:
        """``merge_with_store`` of ``new(userId, tagsId)`` with this store, written nowhere.

        Only the buckets of the batch's users are read."""
        return merge_with_store(new, self.read_buckets_of(new.select(F.col("userId").cast("string"))).select(
            "userId", to_tags_id(F.col("tags")).alias("tagsId")
        ))

    def _update(self, batch: DataFrame, tags: Callable[[Column, Column], Column]) -> int:
        def combine(batch: DataFrame, stored: DataFrame | None) -> DataFrame:
            if stored is None:
                return batch
            fresh = batch.select("userId", F.col("tags").alias("__new"), F.lit(True).alias("__in"))
            both = fresh.join(stored.withColumnRenamed("tags", "__old"), "userId", "full")
            merged = F.when(F.col("__in"), tags(F.col("__new"), F.col("__old")))
            return both.select("userId", merged.otherwise(F.col("__old")).alias("tags"))

        return self.update(checked_batch(batch), combine)


# Write options of the search-index connector.
INDEX_UPSERT_OPTIONS = {
    "es.index.auto.create": "true",
    "es.write.operation": "upsert",
    "es.mapping.id": "userId",
}


class IndexPersonaStore:
    """Persona documents in a search index, keyed by user id; needs its Spark connector."""

    def __init__(self, spark: SparkSession, nodes: str, resource: str):
        self.spark = spark
        self.nodes = nodes
        self.resource = resource.strip()

    def read_tags_id(self) -> DataFrame:
        options = search_index_options(self.nodes, self.resource, "userId, tagsId")
        return self.spark.read.format(SEARCH_INDEX).options(**options).load()

    def upsert(self, new: DataFrame) -> None:
        options = {"es.nodes": self.nodes, "es.resource": self.resource, **INDEX_UPSERT_OPTIONS}
        new.write.mode("append").format(SEARCH_INDEX).options(**options).save()

    def merge_upsert(self, new: DataFrame) -> None:
        self.upsert(merge_with_store(new, self.read_tags_id()))

    def merge_upsert_lists(self, batch: DataFrame) -> None:
        self.merge_upsert(batch.select("userId", to_tags_id(F.col("tags")).alias("tagsId")))
