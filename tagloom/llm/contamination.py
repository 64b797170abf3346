"""Benchmark decontamination: training text that repeats a passage of a test item.

The windows of ten words of all items go to the workers as a broadcast hash set. Words are
numbered by the items' own vocabulary, so a document's words outside it rule out most
windows at once; what is left is looked up by its exact word numbers, so that a hit is the
window itself and never a hash that collides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, or_empty, whole_row

WINDOW = 10
# Item words in one broadcast set; a larger benchmark is dealt over several, scanned in turn.
BLOCK_WORDS = 2_000_000
# Long items are cut into pieces of this many windows, so that blocks come out alike.
PIECE = 1000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# A-Z to a-z, and all that is no word to a space.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if _WORD.fullmatch(bytes([c])) else 32 for c in range(256)
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SPANS, _ITEMS = "array<struct<start: bigint, end: bigint>>", "array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class WindowSet:
    """The windows of some items, by exact word numbers: ``{length: {window: item ids}}``."""

    def __init__(self, pieces, window: int):
        self.numbers = _Numbers()
        self.by_length: dict[int, dict[bytes, list[str]]] = {}
        for item, words in pieces:
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32)
            length = min(window, len(ids))
            windows = self.by_length.setdefault(length, {})
            for i in range(len(ids) - length + 1):
                items = windows.setdefault(ids[i : i + length].tobytes(), [])
                if item not in items[-1:]:
                    items.append(item)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans of the windows that occur, and the items they belong to."""
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        ends = np.flatnonzero(np.diff(np.r_[0, ids > 0, 0].astype(np.int8)))
        spans, items = [], set()
        for low, high in ends.reshape(-1, 2).tolist():  # runs of words that items have
            for length, windows in self.by_length.items():
                for i in range(low, high - length + 1):
                    found = windows.get(ids[i : i + length].tobytes())
                    if found:
                        spans.append((i, i + length))
                        items.update(found)
        return spans, items


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _pieces(window: int):
    """Items as pieces of their words that share ``window`` - 1 words with the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pieces, sizes = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                for i in range(0, max(1, len(words) - window + 1) if words else 0, PIECE):
                    part = words[i : i + PIECE + window - 1]
                    ids.append(item), pieces.append(b" ".join(part)), sizes.append(len(part))
            columns = [pa.array(ids, pa.string()), pa.array(pieces, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "size"])

    return run


def _scan(shared):
    """Add what one block of items hits to ``spans`` and ``items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        for batch in batches:
            spans, items, counts = (batch.column(c).to_pylist() for c in ("spans", "items", "n_words"))
            for i, text in enumerate(batch.column("own_text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                counts[i] = len(words)
                hit, of = windows.scan(words)
                if hit:
                    old = [(s["start"], s["end"]) for s in spans[i]]
                    spans[i] = [{"start": a, "end": b} for a, b in united(old + hit)]
                    items[i] = sorted(of.union(items[i]))
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns["spans"] = pa.array(spans, pa.list_(_SPAN))
            columns["items"] = pa.array(items, pa.list_(pa.string()))
            columns["n_words"] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """``(row, own_text, n_words, spans, items)``: spans of hit words, by word number."""
    scratch = Scratch(docs)
    items = benchmark.select(
        or_empty(F.col("item_id")).alias("item_id"), or_empty(F.col("text")).alias("text")
    ).distinct()
    pieces = scratch.write(
        items.mapInArrow(_pieces(window), "item_id string, words binary, size long").withColumn(
            "deal", F.xxhash64("item_id", "words")
        )
    )
    total = pieces.agg(F.sum("size")).first()[0] or 0
    blocks = total // block_words + 1
    found = docs.select(
        whole_row(docs),
        or_empty(F.col("text")).alias("own_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast(_ITEMS).alias("items"),
    )
    for block in range(blocks):
        # One block's words at a time, of a size set by ``block_words``.
        rows = pieces.filter(F.pmod("deal", F.lit(blocks)) == block).orderBy("item_id", "words").collect()
        windows = WindowSet(((r["item_id"], bytes(r["words"]).split()) for r in rows), window)
        found = found.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(windows)), found.schema)
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """What of each row of ``docs`` repeats an item of ``benchmark(item_id, text)``.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z
    lower-cased. Each ``window`` consecutive words of an item are a window; an item of
    fewer words is one window, an item without words has none. A document's word is hit
    when it lies in any occurrence of a window.

    Returns the columns of ``docs`` (except those named as the new ones) and ``n_words``,
    ``n_hit``, ``items`` (ids of the items with an occurring window, sorted as text) and
    ``spans`` (the hit stretches, ``start`` and ``end`` as 0-based word numbers, end
    exclusive; stretches that adjoin are one). A null text has no words. Repeated rows each
    count, rows without a doc_id stay, equal items with several ids are all named, and an
    item without an id counts under the empty id. An empty benchmark hits nothing; an empty
    table gives an empty result.

    Nothing is shuffled but the items. A benchmark beyond ``block_words`` words is dealt
    into blocks that are broadcast and scanned one after the other, with the same result.
    """
    found = _scanned(docs, benchmark, window, block_words)
    new = ("n_words", "n_hit", "items", "spans")
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return found.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in new],
        "n_words",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_hit"),
        "items",
        "spans",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which nothing is hit; see ``contamination``."""
    found = _scanned(docs, benchmark, window, BLOCK_WORDS).filter(F.size("spans") == 0)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("own_text").cast(pa.binary()).to_pylist()
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            if spans:
                at = [m.span() for m in _WORD.finditer(texts[i])]
                cuts = [(at[s["start"]][0], at[s["end"] - 1][1]) for s in spans]
                begins = [0, *[end for _, end in cuts]]
                ends = [*[start for start, _ in cuts], len(texts[i])]
                texts[i] = b"".join(texts[i][a:b] for a, b in zip(begins, ends))
        columns = {c: batch.column(c) for c in batch.schema.names}
        columns["own_text"] = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def without_contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit stretch cut from its text, from its first word to its last;
    rows without one are unchanged, null texts included. See ``contamination``."""
    found = _scanned(docs, benchmark, window, BLOCK_WORDS)
    cut = found.mapInArrow(_cut, found.schema)
    text = F.when(F.size("spans") > 0, F.col("own_text")).otherwise(F.col("row.text"))
    return cut.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, a row for each row
    of ``docs``; see ``contamination`` for odd rows."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
