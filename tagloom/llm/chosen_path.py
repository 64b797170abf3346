"""Near-duplicate detection by a chosen-path set similarity join.

A document is the set of its distinct word shingles. MinHash turns a set into a row of
coordinates, and two sets agree in one with a probability equal to their similarity. A tree
sends each document down a path: the node picks a coordinate, the document's value in it
picks the child. Paths end at nodes that are small enough to be compared exhaustively.
Independent trees repeat this until a linked pair is missed with negligible probability.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.tables import Scratch, brief_scratch, digest, or_empty, whole_row

COORDINATES = 64
# Agreeing coordinates of a pair worth an exact comparison, when a sketch has four bits of
# each: a pair at similarity 0.8 has 52 of 64 on average and fewer than 35 with a
# probability under 1e-6.
LEAST_AGREEING = 35
TREES = 20
LEVELS = 5
SMALL_NODE = 1024
# Sets compared at once, and shingles of theirs held at once, in an exact comparison.
BLOCK, COLUMNS = 512, 8192
SEED = 0x5EED_0000_0002

_MIX = np.random.default_rng(SEED).integers(1, 2**63, size=(2, COORDINATES), dtype=np.uint64)
_XOR, _ODD = _MIX[0][:, None], (_MIX[1] | np.uint64(1))[:, None]
_STEP = 1 << 14
PACKED_BYTES = COORDINATES // 2


def _scramble(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one."""
    words = text.lower().split()  # on bytes both are ASCII only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    joined = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        joined = _scramble(joined + hashes[i : len(hashes) - span + 1 + i])
    return np.unique(joined)


def minima(shingles: np.ndarray) -> np.ndarray:
    lowest = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _STEP):
        np.minimum(lowest, ((shingles[at : at + _STEP] ^ _XOR) * _ODD).min(axis=1), out=lowest)
    return _scramble(lowest)


def packed(low: np.ndarray) -> bytes:
    """Four bits of each coordinate, two coordinates in a byte."""
    bits = (low & np.uint64(15)).astype(np.uint8)
    return (bits[::2] | bits[1::2] << 4).tobytes()


def unpacked(sketches: np.ndarray) -> np.ndarray:
    """A byte for each coordinate, for rows of packed sketches."""
    return np.stack([sketches & 15, sketches >> 4], axis=2).reshape(len(sketches), COORDINATES)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, values, sketches = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                if not len(shingles):
                    keys.append(None), values.append(None), sketches.append(None)
                    continue
                low = minima(shingles)
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                values.append((low >> np.uint64(48)).astype("<u2").tobytes())
                sketches.append(packed(low))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_id"),
                    pa.array(sizes, pa.int64()),
                    *[pa.array(x, pa.binary()) for x in (keys, values, sketches)],
                ],
                names=["doc_id", "text_id", "n", "key", "low", "sketch"],
            )

    return run


def _shingled(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width).view(np.int64) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["rep", "shingles"]
            )

    return run


def _by_node(batches: Iterator[pa.RecordBatch], read) -> Iterator[dict[str, np.ndarray]]:
    """Whole nodes of rows that come sorted by node, as columns."""
    rest = None
    for batch in batches:
        table = read(batch)
        if rest is not None:
            table = {c: np.concatenate([rest[c], table[c]]) for c in table}
        if not len(table["node"]):
            continue
        ends = int(np.searchsorted(table["node"], table["node"][-1]))  # the last node may go on
        rest = {c: v[ends:] for c, v in table.items()}
        if ends:
            yield {c: v[:ends] for c, v in table.items()}
    if rest is not None:
        yield rest


def _plain(batch: pa.RecordBatch, names) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


class _Nodes:
    """Exhaustive comparison of the rows of small nodes by their sketches.

    Rows come sorted by (node, n). The rows at distance 1, 2, ... are compared for all nodes
    at once; a row drops out when its node ends or its partners get too large to be similar.
    Pairs of one component are left out. A pair is promising when its sketches are alike.

    Out come the promising pairs ``(a, b)``; of a node that has more of them than rows only a
    maximal spanning forest, and a row ``(origin, null)`` that says so. With ``pending`` out
    come instead the rows that are in a promising pair, ``(node, rep, component)``, so that
    the rows that come out are never more than those that go in.
    """

    def __init__(self, percent: int, pending: bool = False):
        self.percent, self.pending = percent, pending

    @staticmethod
    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        sketch = batch.column("sketch").to_pylist()
        sketch = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(sketch), PACKED_BYTES)
        return _plain(batch, ("node", "origin", "rep", "n", "component")) | {"sketch": unpacked(sketch)}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_node(batches, self.read):
            left, right, alike = self.promising(rows)
            if self.pending:
                some = np.unique(np.r_[left, right])
                columns = [pa.array(rows[c][some]) for c in ("node", "rep", "component")]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "rep", "component"])
            else:
                yield self.pairs(rows, left, right, alike)

    def promising(self, rows: dict[str, np.ndarray]):
        node, n, component, sketch = (rows[c] for c in ("node", "n", "component", "sketch"))
        none = np.empty(0, np.int64)
        left, right, alike = [none], [none], [none]
        at, shift = np.arange(len(node)), 0
        while len(at):
            shift += 1
            at = at[at + shift < len(node)]
            to = at + shift
            at = at[(node[at] == node[to]) & (100 * n[at] >= self.percent * n[to])]
            apart = at[component[at] != component[at + shift]]
            for part in np.array_split(apart, len(apart) // 100_000 + 1):
                agree = (sketch[part] == sketch[part + shift]).sum(axis=1)
                found = agree >= LEAST_AGREEING
                left.append(part[found]), right.append(part[found] + shift), alike.append(agree[found])
        return map(np.concatenate, (left, right, alike))

    def pairs(self, rows, left, right, alike) -> pa.RecordBatch:
        node, rep = rows["node"], rows["rep"]
        order = np.lexsort((rep[right], rep[left], -alike, node[left]))
        left, right = left[order], right[order]
        cuts = np.flatnonzero(np.diff(node[left])) + 1
        keep, again = [np.empty(0, np.int64)], []
        for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(left)]):
            ours = np.arange(low, high)
            if high - low > len(np.unique(np.r_[left[ours], right[ours]])):
                ours = ours[self.forest(left[ours], right[ours])]
                again.append(left[low])
            keep.append(ours)
        keep, more = np.concatenate(keep), rows["origin"][np.array(again, np.int64)]
        a = np.concatenate([rep[left[keep]], more])
        b = pa.array(np.concatenate([rep[right[keep]], more]), mask=np.arange(len(a)) >= len(keep))
        return pa.RecordBatch.from_arrays([pa.array(a), b], names=["a", "b"])

    @staticmethod
    def forest(left, right) -> np.ndarray:
        """Of pairs in descending order, those that join two trees."""
        top: dict[int, int] = {}

        def root(x):
            while (up := top.get(x, x)) != x:
                top[x] = top.get(up, up)
                x = up
            return x

        joins = []
        for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
            if (ra := root(a)) != (rb := root(b)):
                top[rb] = ra
                joins.append(i)
        return np.array(joins, np.int64)


class _Exact:
    """Exact comparison, inside each node, of the full sets of its rows.

    Rows come sorted by node. Of the links found between different components a spanning
    forest comes out, at most one row for each row that goes in."""

    def __init__(self, percent: int):
        self.percent = percent

    @staticmethod
    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        sets = batch.column("shingles")
        flat, offsets = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
        shingles = np.empty(len(sets), object)
        for i in range(len(sets)):
            shingles[i] = flat[offsets[i] : offsets[i + 1]]
        return _plain(batch, ("node", "rep", "component")) | {"shingles": shingles}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_node(batches, self.read):
            cuts = np.flatnonzero(np.diff(rows["node"])) + 1
            found = []
            for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(rows["node"])]):
                found += self.links(*(rows[c][low:high] for c in ("rep", "component", "shingles")))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def links(self, rep, component, sets) -> list[tuple[int, int]]:
        n = np.array([len(s) for s in sets])
        _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # What stands in one set only is in no intersection.
        shared = times > 1
        dense = np.cumsum(shared) - 1
        row = np.repeat(np.arange(len(sets)), n)[shared[number]]
        column = dense[number[shared[number]]]
        width = int(shared.sum())
        _, root = np.unique(component, return_inverse=True)
        found = []
        for i in range(0, len(sets), BLOCK):
            for j in range(i, len(sets), BLOCK):
                common = self.common(row, column, width, i, j, len(sets))
                sizes = n[i : i + BLOCK, None] + n[None, j : j + BLOCK]
                alike = 100 * common >= self.percent * (sizes - common)
                for x in range(len(alike)):
                    near = j + np.flatnonzero(alike[x])
                    near = near[root[near] != root[i + x]]
                    for r in np.unique(root[near]).tolist():
                        y = near[root[near] == r]
                        if len(y):
                            found.append((int(rep[i + x]), int(rep[y[0]])))
                            root[root == r] = root[i + x]
        return found

    @staticmethod
    def common(row, column, width: int, i: int, j: int, rows: int) -> np.ndarray:
        """Sizes of the intersections of two blocks of sets; sums are exact in 24 bits."""
        high, wide = min(BLOCK, rows - i), min(BLOCK, rows - j)
        total = np.zeros((high, wide), np.int64)
        in_i, in_j = (row >= i) & (row < i + high), (row >= j) & (row < j + wide)
        for start in range(0, width, COLUMNS):
            within = (column >= start) & (column < start + COLUMNS)
            one, two = (np.zeros((k, min(COLUMNS, width - start)), np.float32) for k in (high, wide))
            one[row[within & in_i] - i, column[within & in_i] - start] = 1
            two[row[within & in_j] - j, column[within & in_j] - start] = 1
            total += (one @ two.T).astype(np.int64)
        return total


def _node_rows(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    return rows.select(*columns).repartition("node").sortWithinPartitions(*order)


NODE_ROW = ["node", "origin", "rep", "n", "component", "sketch"]


class ChosenPathJoin:
    """Links between the distinct sets of one collection, and the components they form."""

    def __init__(self, width: int, percent: int, trees: int = TREES, levels: int = LEVELS, small_node: int = SMALL_NODE):
        if percent < 80:
            raise ValueError("the number of trees and the sketch are set for similarities of 0.8 and more")
        self.width, self.percent, self.trees, self.levels, self.small_node = width, percent, trees, levels, small_node

    def components(self, docs: DataFrame, join_ids: bool = True) -> DataFrame:
        """``(doc_id, text_id, n, component, first)``, a row for each row of ``docs``.

        ``component`` is the smallest doc_id of the component; null where there is no set or
        no doc_id. ``first`` is the smallest ``(doc_id, text_id)`` of it. With ``join_ids``
        rows of one doc_id are in one component whatever their texts."""
        scratch = Scratch(docs)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))
        sets = scratch.write(
            texts.select("doc_id", digest(F.col("text")).alias("text_id"), "text").mapInArrow(
                _sketches(self.width), "doc_id long, text_id binary, n long, key binary, low binary, sketch binary"
            )
        )
        known = F.col("doc_id").isNotNull() & F.col("key").isNotNull()
        # Equal sets become one; the partial minimum keeps a large group of copies to a row per task.
        reps = scratch.write(
            sets.filter(known)
            .groupBy("key", "n", "low", "sketch")
            .agg(F.min(F.struct("doc_id", "text_id")).alias("first"))
            .withColumn("rep", F.monotonically_increasing_id())
        )
        links = self._links(texts, reps, scratch)
        if join_ids:
            links = links.unionByName(self._same_ids(sets.filter(known), reps, scratch))
        joined = components(links, scratch).withColumnRenamed("node", "rep")
        of_rep = scratch.write(
            reps.select("key", "rep", "first").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        )
        least = of_rep.groupBy("component").agg(F.min("first").alias("first"))
        of_key = of_rep.select("key", "component").join(least, "component").select("key", "first")
        return sets.select("doc_id", "text_id", "n", F.when(known, F.col("key")).alias("key")).join(of_key, "key", "left").select(
            "doc_id", "text_id", "n", F.col("first.doc_id").alias("component"), "first"
        )

    @staticmethod
    def _same_ids(sets: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
        """Links between the sets of the rows that share a doc_id."""
        several = (
            sets.groupBy("doc_id")
            .agg(F.min("key").alias("least"), F.max("key").alias("most"))
            .filter("least <> most")
            .select("doc_id", "least")
        )
        several = scratch.write(several)
        pairs = sets.select("doc_id", "key").join(several, "doc_id").filter("key <> least").select("key", "least").distinct()
        of_key = reps.select("key", "rep")
        one, two = (of_key.select(F.col("key").alias(c), F.col("rep").alias(end)) for c, end in (("key", "a"), ("least", "b")))
        return scratch.write(pairs.join(one, "key").join(two, "least").select("a", "b"))

    def _links(self, texts: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
        """Links that connect what is connected: all of sparse nodes, spanning ones of others.

        First the promising pairs of sparse nodes and a forest of those of dense ones are
        confirmed. What is left are the rows of dense nodes, and of nodes dealt into parts,
        that are in a promising pair with another component: their full sets meet in the node
        and are compared exactly there, all with all."""
        with brief_scratch(texts) as brief:
            members = brief.write(self._members(reps, brief))
            rows = _node_rows(members.withColumn("component", F.col("rep")), NODE_ROW, ["node", "n", "rep"])
            found = brief.write(rows.mapInArrow(_Nodes(self.percent), "a long, b long"))
            pairs = found.filter(F.col("b").isNotNull())
            pairs = brief.write(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
            links = self._confirmed(texts, reps, pairs, scratch)
            dense = found.filter(F.col("b").isNull()).select(F.col("a").alias("origin"))
            dense = brief.write(dense.unionByName(members.filter("parts > 1").select("origin")).distinct())
            if dense.isEmpty():
                return links
            rows = self._across(members, dense, components(links, brief), brief)
            rows = _node_rows(rows, NODE_ROW, ["node", "n", "rep"])
            left = brief.write(rows.mapInArrow(_Nodes(self.percent, pending=True), "node long, rep long, component long"))
            sets = brief.write(self._sets(texts, reps, left.select("rep").distinct(), brief))
            rows = _node_rows(left.join(sets, "rep"), ["node", "rep", "component", "shingles"], ["node", "rep"])
            return links.unionByName(scratch.write(rows.mapInArrow(_Exact(self.percent), "a long, b long").distinct()))

    def _sets(self, texts: DataFrame, reps: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
        """``(rep, shingles)``: the full sets of some representatives."""
        at = reps.join(wanted, "rep", "left_semi").select("rep", F.col("first.doc_id").alias("doc_id"), "first.text_id")
        found = texts.join(scratch.small_side(at), "doc_id").filter(digest(F.col("text")) == F.col("text_id"))
        # Rows equal in doc_id and text have equal sets.
        sets = found.select("rep", "text").mapInArrow(_shingled(self.width), "rep long, shingles array<long>")
        return sets.groupBy("rep").agg(F.any_value("shingles").alias("shingles"))

    def _members(self, reps: DataFrame, scratch: Scratch) -> DataFrame:
        """Each set once per tree, with the node where its path ends.

        A node is large while it holds more than ``small_node`` sets. A node still large at
        the last level is dealt into ``parts``; ``origin`` is the node before that.
        """
        rows = reps.select("rep", "n", "low", "sketch", F.explode(F.sequence(F.lit(1), F.lit(self.trees))).alias("tree"))
        path = F.xxhash64(F.lit(SEED), F.col("tree"))
        for level in range(1, self.levels + 1):
            coordinate = F.pmod(path, F.lit(COORDINATES)).cast("int")
            rows = rows.withColumn(f"k{level}", F.xxhash64(path, F.substring(F.col("low"), coordinate * 2 + 1, F.lit(2))))
            path = F.col(f"k{level}")
        rows, ends = rows.drop("low"), []

        def ended(rows: DataFrame, key: str, parts):
            origin, part = F.col(key), F.pmod(F.xxhash64("rep", "tree"), parts)
            node = F.when(parts > 1, F.xxhash64(origin, part)).otherwise(origin)
            return rows.select(node.alias("node"), origin.alias("origin"), "rep", "n", "sketch", parts.alias("parts"))

        # Only the rows of large nodes go on to the next level.
        for level in range(1, self.levels + 1):
            key, one = f"k{level}", F.lit(1).cast("long")
            large = rows.groupBy(key).agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") > self.small_node)
            large = scratch.small_side(large)
            if large.isEmpty():
                ends.append(ended(rows, key, one))
                break
            if level == self.levels:
                parts = F.coalesce(F.ceil(F.col("sets") / self.small_node), one)
                ends.append(ended(rows.join(large, key, "left"), key, parts))
                break
            ends.append(ended(rows.join(large, key, "left_anti"), key, one))
            rows = scratch.write(rows.join(large, key, "left_semi"))
        return reduce(DataFrame.unionByName, ends)

    def _across(self, members: DataFrame, unfinished: DataFrame, joined: DataFrame, scratch: Scratch) -> DataFrame:
        """The rows of unfinished nodes that hold more than one component.

        In a node dealt into parts, every set outside its most frequent component meets all
        parts; sets of that component need not meet each other any more.
        """
        again = scratch.write(
            members.join(unfinished, "origin", "left_semi")
            .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep"))
        )
        most = scratch.small_side(
            again.groupBy("origin", "component")
            .agg(F.count(F.lit(1)).alias("sets"))
            .groupBy("origin")
            .agg(F.max(F.struct("sets", "component"))["component"].alias("most"), F.count(F.lit(1)).alias("kinds"))
            .filter("kinds > 1")
        )
        every_part = F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.xxhash64(F.col("origin"), p)
        )
        nodes = F.when((F.col("parts") > 1) & (F.col("component") != F.col("most")), every_part).otherwise(F.array("node"))
        return again.join(most, "origin").withColumn("node", F.explode(nodes))

    def _confirmed(self, texts: DataFrame, reps: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
        """Pairs whose full sets are similar enough, written; the sets go at once."""
        with brief_scratch(texts) as brief:
            ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
            sets = brief.write(self._sets(texts, reps, ends, brief))
            one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
            two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
            common = F.size(F.array_intersect("of_a", "of_b"))
            either = F.size("of_a") + F.size("of_b") - common
            linked = pairs.join(one, "a").join(two, "b").filter(100 * common >= self.percent * either)
            return scratch.write(linked.select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for each row of ``docs``.

    Two documents are linked when 100 * intersection >= ``percent`` * union of their
    ``width``-word shingles (A-Z lower-cased, ASCII white space). ``component_id`` is the
    smallest doc_id reachable over links, ``kept`` marks that document.

    Candidates come from the chosen-path join, and each link is confirmed on the full shingle
    sets. All trees draw on the same 64 minima, so a pair at the threshold whose paths part
    is missed with a probability of 3.1e-5, 5.2e-4 or 3.3e-3 where nodes are small enough at
    level 3, 4 or 5 only, and less the more similar it is; other links of its component may
    join it all the same.

    A null or empty text has no shingles and is linked with nothing; so is a row without a
    doc_id, whose component is null and which is not kept. A text of fewer words than
    ``width`` is one shingle. Rows that share a doc_id are one node, linked as any of their
    texts is. Other columns are ignored. An empty table gives an empty result.
    """
    found = ChosenPathJoin(width, percent).components(docs)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(False)).alias("kept"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document left of each group of near-duplicates.

    It is the one with the smallest doc_id, and of rows that share it the one with the least
    digest of its text. Rows are told apart by doc_id and text: unrelated texts under one
    doc_id stay, and of rows equal in both one stays. Rows without words are near no other
    row. Rows without a doc_id stay.
    """
    found = ChosenPathJoin(width, percent).components(docs, join_ids=False)
    own = F.struct("doc_id", "text_id")
    kept = found.filter(F.col("first").isNull() | (F.col("first") == own)).filter("doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_id").alias("kept_text")).distinct()
    rows = docs.select(
        whole_row(docs), F.col("doc_id").cast("long").alias("own_id"), digest(or_empty(F.col("text"))).alias("own_text")
    )
    same = (F.col("own_id") == F.col("kept_id")) & (F.col("own_text") == F.col("kept_text"))
    known = rows.join(kept, same, "left_semi").dropDuplicates(["own_id", "own_text"]).select("row.*")
    return known.unionByName(docs.filter("doc_id IS NULL"))
