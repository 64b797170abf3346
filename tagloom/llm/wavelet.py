"""Token ids as wavelet matrices: bit-planes with rank support, one shard per row of a file.

Plane by plane, from the highest bit, ids are stably parted into those with a 0 and those
with a 1. Planes and sampled counts of ones are all that is stored; single ids, counts and
places of an id come from them without unpacking the shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, or_empty
from tagloom.llm.tokens import encoder, vocabulary_path, with_end

PLANES = 16
SAMPLE = 64  # bytes of a plane between sampled counts
SHARD_TOKENS = 1 << 20

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """``planes[b]`` has the packed bits of plane ``b`` from the highest, ``ones[b]`` the ones
    before every ``SAMPLE`` bytes of it, ``zeros[b]`` its zeros."""

    def __init__(self, n: int, planes: list[np.ndarray], ones: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.ones, self.zeros = n, planes, ones, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        planes, ones, zeros, now = [], [], [], np.asarray(ids, np.uint16)
        for bit in range(PLANES - 1, -1, -1):
            set_ = (now & np.uint16(1 << bit)).astype(bool)
            packed = np.packbits(set_)
            starts = np.arange(0, len(packed), SAMPLE)
            counts = np.add.reduceat(_ONES[packed], starts, dtype=np.int64) if len(packed) else np.empty(0, np.int64)
            planes.append(packed)
            ones.append(np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32))
            # By places, which takes half the time of a mask.
            now = np.concatenate([now.take(np.flatnonzero(~set_)), now.take(np.flatnonzero(set_))])
            zeros.append(int(len(now) - ones[-1][-1]))
        return cls(len(now), planes, ones, zeros)

    def _rank(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        byte, rest = divmod(i, 8)
        block = byte // SAMPLE
        total = int(self.ones[plane][block]) + int(_ONES[self.planes[plane][block * SAMPLE : byte]].sum())
        return total + (int(_ONES[self.planes[plane][byte] >> (8 - rest)]) if rest else 0)

    def access(self, i: int) -> int:
        value = 0
        for b in range(PLANES):
            bit = self.planes[b][i // 8] >> (7 - i % 8) & 1
            before = self._rank(b, i)
            value = value << 1 | int(bit)
            i = self.zeros[b] + before if bit else i - before
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for b in range(PLANES):
            before, until = self._rank(b, low), self._rank(b, high)
            if token >> (PLANES - 1 - b) & 1:
                low, high = self.zeros[b] + before, self.zeros[b] + until
            else:
                low, high = low - before, high - until
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` in ids [low, high)."""
        first, last = self._range(token, low, self.n if high is None else high)
        return last - first

    def select(self, token: int, k: int) -> int:
        """Where ``token`` occurs for the ``k``-th time, from 0; -1 if it doesn't."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            return -1
        at = low + k
        for b in range(PLANES - 1, -1, -1):
            one = token >> (PLANES - 1 - b) & 1
            wanted = at - self.zeros[b] if one else at
            low, high = 0, self.n - 1  # the place of the wanted-th such bit
            while low < high:
                middle = (low + high) // 2
                ones = self._rank(b, middle + 1)
                if (ones if one else middle + 1 - ones) > wanted:
                    high = middle
                else:
                    low = middle + 1
            at = low
        return at

    def ids(self) -> np.ndarray:
        """All ids, from the last plane up."""
        now = np.zeros(self.n, np.uint16)
        for b in range(PLANES - 1, -1, -1):
            set_ = np.unpackbits(self.planes[b], count=self.n).view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~set_)] = now[: self.zeros[b]]
            up[np.flatnonzero(set_)] = now[self.zeros[b] :] | np.uint16(1 << (PLANES - 1 - b))
            now = up
        return now


SCHEMA = (
    "part int, shard int, tokens long, doc_ids array<bigint>, lengths array<bigint>, "
    "planes array<binary>, ones array<binary>, zeros array<bigint>"
)


def _row(matrix: WaveletMatrix, part: int, shard: int, doc_ids: list, lengths: list[int]) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int32()),
        pa.array([shard], pa.int32()),
        pa.array([matrix.n], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int64())),
        pa.array([[p.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
        pa.array([[o.tobytes() for o in matrix.ones]], pa.list_(pa.binary())),
        pa.array([matrix.zeros], pa.list_(pa.int64())),
    ]
    names = ["part", "shard", "tokens", "doc_ids", "lengths", "planes", "ones", "zeros"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def stored_matrix(tokens: int, planes: list[bytes], ones: list[bytes], zeros: list[int]) -> WaveletMatrix:
    """The matrix of a file's row."""
    return WaveletMatrix(
        tokens, [np.frombuffer(p, np.uint8) for p in planes], [np.frombuffer(o, np.uint32) for o in ones], list(zeros)
    )


def _encoded(path: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, shard = encoder(path).ids, TaskContext.get().partitionId(), 0
        held, doc_ids, tokens = [], [], 0
        for batch in batches:
            texts = batch.column("text")
            for at, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                held.append(with_end(encode(texts[at].as_py())))
                doc_ids.append(doc_id)
                tokens += len(held[-1])
                if tokens >= shard_tokens:
                    yield _row(WaveletMatrix.build(np.concatenate(held)), part, shard, doc_ids, [len(h) for h in held])
                    held, doc_ids, tokens, shard = [], [], 0, shard + 1
        if held:
            yield _row(WaveletMatrix.build(np.concatenate(held)), part, shard, doc_ids, [len(h) for h in held])

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all documents, each with an end id, in ascending doc_id order.

    Parts are ranges of doc_id; a part's shards follow each other in its file. A shard ends
    with the document that brings it to ``shard_tokens`` ids. Rows without a doc_id come
    first, repeated rows one after the other by text; a null text has the end id alone.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(_encoded(path or vocabulary_path(), shard_tokens), SCHEMA)
    encoded.write.option("compression", "zstd").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = stored_matrix(row["tokens"], row["planes"], row["ones"], row["zeros"]).ids().astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            sums = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths)]
            starts = row["before"] + ends - lengths
            columns = [pa.array(c, pa.int64()) for c in (row["doc_ids"], starts, lengths, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of a written folder."""
    shards = spark.read.schema(SCHEMA).parquet(folder)
    sizes = shards.select("part", "shard", "tokens")
    of_part = sizes.groupBy("part").agg(F.sum("tokens").alias("held"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    of_part = of_part.select("part", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("first"))
    within = W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    begins = sizes.select("part", "shard", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("later")).join(of_part, "part")
    begins = begins.select("part", "shard", (F.col("first") + F.col("later")).alias("before"))
    # One narrow row per shard, against the planes of a million ids.
    begins = Scratch(shards).small_side(begins)
    return shards.join(begins, ["part", "shard"]).mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents to token files in a scratch folder and read them back.

    An empty table gives an empty result; other columns are ignored.
    """
    folder = f"{Scratch(docs).folder}/{uuid.uuid4().hex}"
    write_tokens(docs, folder, path)
    return read_tokens(docs.sparkSession, folder)
