"""Connected components of an edge table, kept on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


# Edges that one task contracts by itself.
TASK_EDGES = 500_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as ``(a, b)`` with b the smallest node that they join a to, and
    different from it; a bounded number of edges at a time."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        both = np.concatenate(held)
        nodes, ends = np.unique(both, return_inverse=True)
        one, two = ends.reshape(both.shape).T
        label, before = np.arange(len(nodes)), None
        while before is None or (label != before).any():
            before = label.copy()
            low = np.minimum(label[one], label[two])
            np.minimum.at(label, one, low)
            np.minimum.at(label, two, low)
            label = label[label]
        moved = label != np.arange(len(nodes))
        columns = [pa.array(nodes[moved]), pa.array(nodes[label[moved]])]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("a", "b")], axis=1))
        size += len(held[-1])
        if size > 2 * TASK_EDGES:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``(a, b)`` edges; the component is its
    smallest node.

    Each task first contracts up to ``TASK_EDGES`` edges; if these are all, that is the result.
    Else alternating star contractions follow: each step points neighbours at the smallest node seen
    by their centre, which halves paths, so a chain of n nodes takes about log n steps.
    Every step is a minimum per node, combined before the shuffle, and a join back; edges
    are written between steps, so nothing is recomputed after a loss.
    """
    edges = scratch.write(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    n = edges.count()
    tasks = -(-n // TASK_EDGES)
    if tasks:
        edges = scratch.write(edges.coalesce(tasks).mapInArrow(_contracted, "a long, b long"))
    if tasks <= 1:
        return _members(edges)
    before = None
    while (now := _state(edges)) != before:
        before = now
        near = _both_ways(edges)
        lowest = near.groupBy("a").agg(F.min("b").alias("low"))
        lowest = lowest.select("a", F.least("a", "low").alias("low"))
        # Larger neighbours of each node move to its smallest neighbour.
        large = near.filter(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = scratch.write(large)
        # Smaller neighbours, and the node itself, move to the smallest one.
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = scratch.write(
            moved.filter(F.col("a") != F.col("b"))
            .unionByName(lowest.select("a", F.col("low").alias("b")))
            .distinct()
        )
    return _members(edges)


def _members(edges: DataFrame) -> DataFrame:
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
