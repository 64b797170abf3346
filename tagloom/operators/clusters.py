"""K-means over user features, and the tags of ranked clusters."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sources.rules import TagValues, local_frame

FEATURE = "feature"
PREDICT = "predict"
FIT_PARTITIONS = 8

Centres = Sequence[Sequence[float]]


class NothingToCluster(ValueError):
    """The feature frame has no rows."""


def assemble(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the ``feature`` vector; a null feature raises."""
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURE).transform(frame)


def fit_clusters(
    frame: DataFrame,
    columns: Sequence[str],
    k: int,
    seed: int,
    partitions: int = FIT_PARTITIONS,
) -> KMeansModel:
    """Fit k-means with MLlib defaults, apart from ``k`` and ``seed``.

    Equal points are merged into one weighted point first: the objective is the same, and
    score vectors shrink from one row per user to a few hundred rows. Points are then laid
    out by value over ``partitions`` tasks, whatever their number, so the fit does not depend on
    how the input was partitioned; at scale name as many tasks as there are cores.
    """
    columns = list(columns)
    points = frame.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if points.isEmpty():
            raise NothingToCluster(f"no rows to cluster on {columns}")
        laid_out = points.repartition(partitions, *columns).sortWithinPartitions(*columns)
        training = assemble(laid_out, columns)
        training = training.select(FEATURE, "weight").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return KMeans(
                k=k, seed=seed, featuresCol=FEATURE, predictionCol=PREDICT, weightCol="weight"
            ).fit(training)
        finally:
            training.unpersist()
    finally:
        points.unpersist()


def assign_clusters(frame: DataFrame, columns: Sequence[str], model: KMeansModel) -> DataFrame:
    """Add ``predict``, the cluster of each row."""
    return model.transform(assemble(frame, columns)).drop(FEATURE)


def nearest_centre(
    frame: DataFrame, columns: Sequence[str], centres: Centres, out: str = PREDICT
) -> DataFrame:
    """Add the index of the closest of ``centres``; the lowest index wins a tie.

    The centres become literals of one projection, so there is no join.
    """
    candidates = []
    for cluster, centre in enumerate(centres):
        gaps = [f"(`{c}` - {float(at)!r}D)" for c, at in zip(columns, centre, strict=True)]
        distance = " + ".join(f"{gap} * {gap}" for gap in gaps)
        candidates.append(f"named_struct('distance', {distance}, 'cluster', {cluster})")
    best = candidates[0] if len(candidates) == 1 else f"least({', '.join(candidates)})"
    return frame.withColumn(out, F.expr(f"({best}).cluster"))


def rank_clusters(centres: Centres) -> list[int]:
    """Cluster indexes by the sum of their centre, highest first, lowest index on a tie."""
    sums = [float(sum(centre)) for centre in centres]
    return sorted(range(len(sums)), key=lambda cluster: (-sums[cluster], cluster))


def cluster_tags(
    spark: SparkSession, ranking: Sequence[int], values: TagValues, out: str = "tagsId"
) -> DataFrame:
    """``(predict, tag)``: the n-th best cluster gets the tag with the n-th lowest id.

    Clusters beyond the last tag are absent. Both sides have at most k rows.
    """
    best_first = values.frame.orderBy("id").limit(len(ranking)).collect()
    pairs = [(cluster, str(row["id"])) for cluster, row in zip(ranking, best_first)]
    return local_frame(spark, pairs, (PREDICT, pa.int32()), (out, pa.string()))


def assign_cluster_tags(
    frame: DataFrame, centres: Centres, values: TagValues, out: str = "tagsId"
) -> DataFrame:
    """Add the tag of each row's ``predict`` cluster, null for a cluster without a tag."""
    tags = cluster_tags(frame.sparkSession, rank_clusters(centres), values, out)
    return frame.join(F.broadcast(tags), PREDICT, "left")
