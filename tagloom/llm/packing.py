"""Best-fit packing of token pieces into sequences of one capacity, by linear grouping.

Pieces of one length are alike, so the plan is made on the histogram of lengths, which has
at most ``capacity`` rows however many documents there are. Only piece ranks within a
length, which are worked out on the executors, tie the plan to documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, or_empty
from tagloom.llm.tokens import encoder, vocabulary_path, with_end

CAPACITY = 4096
GROUPS = 64
SMALL_SHARES = (2, 3, 4)  # lengths up to capacity / 2, 3 or 4 are small; the best plan counts
RANKED_TOGETHER = 10_000

Run = tuple[int, list]  # so many sequences alike, and what each holds


class BestFit:
    """Best fit over runs of sequences that hold the same."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self._by_room: dict[int, list[Run]] = defaultdict(list)
        self._rooms: list[int] = []

    def add(self, times: int, content: list, used: int) -> None:
        room = self.capacity - used
        if not self._by_room[room]:
            insort(self._rooms, room)
        self._by_room[room].append((times, content))

    def place(self, item, size: int, count: int) -> None:
        """``count`` items, each into the sequence with the least room that still takes it."""
        while count and (at := bisect_left(self._rooms, size)) < len(self._rooms):
            room = self._rooms[at]
            times, content = self._by_room[room].pop()
            if not self._by_room[room]:
                self._rooms.pop(at)
            placed = min(times, count)
            if placed < times:
                self.add(times - placed, content, self.capacity - room)
            self.add(placed, [*content, item], self.capacity - room + size)
            count -= placed
        each = self.capacity // size
        if count >= each:
            self.add(count // each, [item] * each, size * each)
        if count % each:
            self.add(1, [item] * (count % each), size * (count % each))

    def runs(self) -> list[Run]:
        return [run for room in self._rooms for run in self._by_room[room]]


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is taken in the most worthy filling of one sequence."""
    best = np.zeros(capacity + 1)
    picks = []
    while True:
        more, pick = best.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            if worth[i] > 0:
                taken = best[: capacity + 1 - size] + worth[i]
                better = taken > more[size:] + 1e-12
                more[size:][better] = taken[better]
                pick[size:][better] = i
        if (pick < 0).all():
            break
        best = more
        picks.append(pick)
    counts, room = np.zeros(len(sizes), int), capacity
    for pick in reversed(picks):
        if (i := pick[room]) >= 0:
            counts[i] += 1
            room -= sizes[i]
    return counts


def few_size_patterns(sizes: list[int], demand: list[int], capacity: int) -> list[Run]:
    """Configurations for a few sizes: the linear relaxation by column generation, rounded
    down, and best fit decreasing for the handful of items that rounding leaves. A
    configuration lists indexes of ``sizes``."""
    size, need, k = np.array(sizes), np.array(demand, float), len(sizes)
    columns = np.diag((capacity // size).astype(float))
    cost = np.ones(k)
    for _ in range(50 * k):
        inverse = np.linalg.inv(columns)
        price = cost @ inverse
        if price.min() < -1e-9:  # one item too many is better here: a surplus column
            entering, its_cost = -np.eye(k)[price.argmin()], 0.0
        else:
            entering, its_cost = _best_pattern(size, price, capacity).astype(float), 1.0
            if price @ entering <= 1 + 1e-9:
                break
        times, moves = inverse @ need, inverse @ entering
        ratio = np.where(moves > 1e-9, times / np.where(moves > 1e-9, moves, 1), np.inf)
        leaving = ratio.argmin()
        if not np.isfinite(ratio[leaving]):
            break
        columns[:, leaving], cost[leaving] = entering, its_cost
    times = np.linalg.inv(columns) @ need
    runs, left = [], need.astype(np.int64)
    for j in range(k):
        whole = int(times[j] + 1e-6) if cost[j] else 0
        pattern = columns[:, j].astype(int)
        if whole > 0:
            runs.append((whole, [i for i in range(k) for _ in range(pattern[i])]))
            left -= whole * pattern
    rest = BestFit(capacity)
    for i in np.argsort(-size, kind="stable"):
        if left[i] > 0:
            rest.place(int(i), int(size[i]), int(left[i]))
    return runs + rest.runs()


def _take(queue: list[list[int]], count: int) -> list[tuple[int, int]]:
    """The next ``count`` items of a queue of [length, count], fewer at its end."""
    taken = []
    while count and queue:
        length, there = queue[-1]
        n = min(count, there)
        taken.append((length, n))
        count -= n
        queue[-1][1] -= n
        if not queue[-1][1]:
            queue.pop()
    return taken


def _substituted(runs: list[Run], queues: list[list[list[int]]]) -> Iterator[Run]:
    """Runs of actual lengths for runs of groups."""
    for times, groups in runs:
        slots = [_take(queues[g], times) for g in groups]
        ends = sorted({int(e) for slot in slots for e in np.cumsum([n for _, n in slot])})
        at = [(iter(slot), [None, 0]) for slot in slots]
        begin = 0
        for end in ends:
            content = []
            for items, state in at:
                if state[1] <= begin:
                    length, n = next(items, (None, times + 1))
                    state[0], state[1] = length, state[1] + n
                if state[0] is not None:
                    content.append(state[0])
            yield end - begin, content
            begin = end


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Sequences as runs ``(times, lengths)`` that hold each length as often as it occurs:
    the fewest that linear grouping finds for a few bounds between large and small."""
    plans = (grouped_plan(histogram, capacity, groups, capacity // share) for share in SMALL_SHARES)
    return min(plans, key=lambda runs: sum(times for times, _ in runs))


def grouped_plan(histogram: dict[int, int], capacity: int, groups: int, small: int) -> list[Run]:
    packed = BestFit(capacity)
    lengths = sorted((n for n in histogram if histogram[n]), reverse=True)
    large = [n for n in lengths if small < n < capacity]
    total = sum(histogram[n] for n in large)
    queues: list[list[list[int]]] = []
    room = 0
    for length in large:  # linear grouping: equal numbers of pieces, longest first
        count = histogram[length]
        while count:
            if not room:
                queues.append([])
                room = -(-total // groups)
            n = min(room, count)
            queues[-1].append([length, n])
            room -= n
            count -= n
    if queues:
        sizes = [q[0][0] for q in queues]
        counts = [sum(n for _, n in q) for q in queues]
        patterns = few_size_patterns(sizes, counts, capacity)
        for q in queues:
            q.reverse()
        for times, content in _substituted(patterns, queues):
            packed.add(times, content, sum(content))
    if capacity in histogram and histogram[capacity]:
        packed.add(histogram[capacity], [capacity], capacity)
    for length in lengths:
        if length <= small and length < capacity:
            packed.place(length, length, histogram[length])
    return packed.runs()


def _places(runs: list[Run]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each length, where its pieces go by rank: (length, first rank, sequence of the
    first, offset), sorted."""
    rows, seen, first = [], defaultdict(int), 0
    for times, content in runs:
        offset = 0
        for length in content:
            rows.append((length, seen[length], first, offset))
            seen[length] += times
            offset += length
        first += times
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows))) if rows else (np.empty(0, np.int64),) * 4


def _cut(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = with_end(encode(text)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.tolist()) if with_ids else row)
            columns = list(zip(*rows)) or [()] * (6 if with_ids else 5)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)])

    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: token ids with an end id, cut
    only where a document is longer than ``capacity``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))
    return texts.mapInArrow(_cut(path or vocabulary_path(), capacity, with_ids), schema)


def _placed(places: tuple[np.ndarray, ...]):
    length, rank, sequence, offset = places
    wide = np.int64(1) << np.int64(47)  # ranks stay below
    key = length * wide + rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("rank").to_numpy()
            at = np.searchsorted(key, batch.column("length").to_numpy() * wide + own, side="right") - 1
            batch = batch.drop_columns(["rank"])
            columns = [*batch.columns, pa.array(sequence[at] + own - rank[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs``, with its ``sequence_id`` and ``offset``.

    Large lengths, over some share of the capacity, are sorted into ``GROUPS`` groups of equal cardinality and rounded up to
    the largest of their group; configurations of these few sizes are optimised; actual
    pieces, which are no longer than their group's size, take the places; small pieces then
    go where they fit best.

    A null text counts as empty and has the end id alone. Rows without a doc_id, and
    repeated rows, are packed like any other. Other columns are ignored. An empty table
    gives an empty result.

    Lengths that very many pieces share, as full pieces do, are ranked in buckets, so no
    task numbers more than about ``RANKED_TOGETHER`` pieces.
    """
    scratch = Scratch(docs)
    cut = scratch.write(pieces(docs, capacity, path, with_ids))
    buckets = cut.count() // RANKED_TOGETHER + 1
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = scratch.write(cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("there")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("there").alias("n")).collect()}
    before = F.sum("there").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    order = W.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = cut.withColumn("own", F.row_number().over(order) - 1).join(offsets, ["length", "bucket"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = ranked.select(*names, (F.col("own") + F.col("before")).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids array<long>, " * with_ids
    return ranked.mapInArrow(_placed(_places(plan(histogram, capacity))), schema + "sequence_id long, offset long")


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``(sequence_id, doc_ids, ids)``: the token ids of each sequence, at most ``capacity``."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        pack(docs, capacity, path, with_ids=True)
        .groupBy("sequence_id")
        .agg(held.alias("held"))
        .select("sequence_id", F.col("held.doc_id").alias("doc_ids"), F.flatten("held.ids").alias("ids"))
    )
