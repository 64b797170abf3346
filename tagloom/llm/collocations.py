"""Phrase collocation mining: phrases of two to four words that are commoner than their parts.

Words that are common enough are numbered; n-grams of their numbers are counted in counting
quotient filters, one per task and bucket, which are merged bucket by bucket. Pairs come
first; longer phrases are counted only where each pair in them is common, as a bitmap of
fixed size tells. A wrong bit in it costs a counter and changes no result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.quotient import Packing, QuotientFilters, merged, scrambled
from tagloom.llm.tables import Scratch, brief_scratch, or_empty

LONGEST = 4
LEAST = 30
INSIDE_PERCENT = 80
TOP = 2000
NO_LANG = "und"
# Words counted, and entries of filters held, in one task before they are handed on.
HELD_WORDS, HELD_ENTRIES = 300_000, 1_000_000
# Numbered words that are broadcast; a larger vocabulary is joined.
BROADCAST_WORDS = 1_000_000
# Each task deals its n-grams into 2**BUCKET filters, so that filters grow with the input
# and not with its square. A corpus with more than BUCKET_WORDS words to each of them is
# dealt once more, into 2**BUCKET finer ones each, and so on.
BUCKET, BUCKET_WORDS = 9, 1 << 24
# Bits of the bitmap of common pairs.
BITMAP = 1 << 26
# A language's best phrases are looked for in this many parts first.
PARTS = 64

_BREAK = b"."
# A-Z to a-z, every mark that ends a piece to a full stop, tab to space.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else ord(_BREAK) if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c
    for c in range(256)
)
_NUMBERS = ["w1", "w2", "w3", "w4"]


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with a full stop between pieces."""
    return [w for w in text.translate(_NORMAL).replace(_BREAK, b" . ").split(b" ") if w]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, word, n)``; a null word stands for all words."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def out() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items() if word != _BREAK]
        rows += [(lang, None, sum(n for word, n in c.items() if word != _BREAK)) for lang, c in counts.items()]
        counts.clear()
        langs, words, ns = zip(*rows)
        words = pa.array(words, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), words, pa.array(ns, pa.int64())], names=["lang", "word", "n"])

    for batch in batches:
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            counts[lang].update(tokens(text))
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield out()
    if counts:
        yield out()


def _number_texts(shared):
    """A text as the numbers of its words, with 0 for a word or mark that no phrase spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
                words, known = tokens(text), shared.value.get(lang, none)
                ids = np.fromiter((known.get(w, 0) for w in words), np.int32, len(words))
                ids = ids[(ids > 0) | np.r_[False, ids[:-1] > 0][: len(ids)]]
                if len(ids) > 1:
                    rows.append(ids)
            yield _lists(rows)

    return run


def _lists(rows: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *rows])
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["ids"])


def _split_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, pieces = [], []
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            for piece in text.translate(_NORMAL).split(_BREAK):
                words = [w for w in piece.split(b" ") if w]
                if len(words) > 1:
                    langs.append(lang), pieces.append(words)
        columns = [pa.array(langs, pa.string()), pa.array(pieces, pa.list_(pa.binary())).cast(pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "words"])


def _numbered_by_join(texts: DataFrame, words: DataFrame, scratch: Scratch) -> DataFrame:
    """The same as ``_number_texts``, a row per piece, for a vocabulary of any size."""
    pieces = texts.mapInArrow(_split_pieces, "lang string, words array<string>")
    pieces = scratch.write(pieces.withColumn("piece", F.monotonically_increasing_id()))
    places = pieces.select("piece", "lang", F.posexplode("words").alias("place", "word"))
    known = places.join(words.select("lang", "word", "number"), ["lang", "word"], "left").select(
        "piece", F.struct("place", F.coalesce("number", F.lit(0)).cast("int").alias("number")).alias("at")
    )
    in_order = F.array_sort(F.collect_list("at"))
    return known.groupBy("piece").agg(in_order.alias("at")).select(F.transform("at", lambda x: x["number"]).alias("ids"))


def numbered_words(texts: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(lang, word, n, number)`` of words found at least ``least`` times in their language,
    and ``(lang, n)``: all words of a language. Numbers start at 1 and have gaps."""
    counts = texts.mapInArrow(_count_words, "lang string, word string, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    kept = scratch.write(
        counts.filter((F.col("n") >= least) | F.col("word").isNull()).withColumn("at", F.monotonically_increasing_id())
    )
    # Rows of a task are counted from 0 in the low 33 bits.
    row, task = F.col("at").bitwiseAND((1 << 33) - 1), F.shiftright("at", 33)
    stride = (kept.agg(F.max(row)).first()[0] or 0) + 1
    words = kept.filter("word IS NOT NULL").select("lang", "word", "n", (task * stride + row + 1).alias("number"))
    return words, kept.filter("word IS NULL").select("lang", "n")


def numbered_texts(texts: DataFrame, words: DataFrame, scratch: Scratch, most: int = BROADCAST_WORDS) -> DataFrame:
    """``(ids)``: texts, or pieces of them, as word numbers."""
    if words.count() > most:
        return scratch.write(_numbered_by_join(texts, words, scratch))
    known: dict[str, dict[bytes, int]] = defaultdict(dict)
    for r in words.select("lang", "word", "number").collect():
        known[r["lang"]][r["word"].encode()] = r["number"]
    shared = texts.sparkSession.sparkContext.broadcast(dict(known))
    return scratch.write(texts.mapInArrow(_number_texts(shared), "ids array<int>"))


def _bits(pairs: np.ndarray) -> np.ndarray:
    return (scrambled(pairs, 1) & np.uint64(BITMAP - 1)).astype(np.int64)


class _Counting:
    """Counts the n-grams of a task's texts; gives filters ``(bucket, filter)``.

    Without ``common`` it counts pairs, with it phrases of three and four words of which
    each pair is common."""

    def __init__(self, filters: QuotientFilters, common=None):
        self.filters, self.common = filters, common

    def ngrams(self, ids: np.ndarray):
        packing, there = self.filters.packing, ids > 0
        pair = packing.pairs(ids[:-1], ids[1:])
        both = there[:-1] & there[1:]
        if self.common is None:
            pair, count = np.unique(pair[both], return_counts=True)
            yield pair, np.zeros(len(pair), np.uint64), count
            return
        bits = _bits(pair)
        both &= self.common.value[bits >> 3] >> (bits & 7).astype(np.uint8) & 1 > 0
        three = np.flatnonzero(both[:-1] & both[1:])
        yield pair[three], packing.pairs(ids[three + 2], np.zeros(len(three))), np.ones(len(three), np.int64)
        four = np.flatnonzero(both[:-2] & both[1:-1] & both[2:])
        yield pair[four], pair[four + 2], np.ones(len(four), np.int64)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("ids")
            flat, sizes = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False)
            # A zero after each text, and enough of them to look ahead at the end.
            flat = np.r_[np.insert(flat, np.cumsum(sizes), 0), 0, 0, 0]
            for part in self.ngrams(flat):
                held.append(merged([(*self.filters.packing.permuted(*part[:2]), part[2])]))
                size += len(held[-1][0])
            if size > HELD_ENTRIES:
                yield self.out(merged(held))
                held, size = [], 0
        if size:
            yield self.out(merged(held))

    def out(self, entries) -> pa.RecordBatch:
        return _dealt(self.filters, entries)


def _dealt(filters: QuotientFilters, entries) -> pa.RecordBatch:
    buckets = filters.split(entries[0])
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    data = [filters.write(*(x[a:b] for x in entries)) for a, b in zip(first, np.r_[first[1:], len(buckets)])]
    return pa.RecordBatch.from_arrays([pa.array(buckets[first]), pa.array(data, pa.binary())], names=["bucket", "filter"])


class _Dealing:
    """Filters dealt into finer ones, for rows sorted by bucket."""

    def __init__(self, filters: QuotientFilters, finer: QuotientFilters):
        self.filters, self.finer = filters, finer

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size = None, [], 0
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("filter").to_pylist()):
                if held and (bucket != current or size > HELD_ENTRIES):
                    yield _dealt(self.finer, merged(held))
                    held, size = [], 0
                current = bucket
                held.append(self.filters.read(bucket, data))
                size += len(held[-1][0])
        if held:
            yield _dealt(self.finer, merged(held))


class _Merging:
    """Merges the filters of each bucket, for rows sorted by bucket, and gives the n-grams
    found at least ``least`` times as ``(w1, w2, w3, w4, a, bit)``."""

    def __init__(self, filters: QuotientFilters, least: int):
        self.filters, self.least = filters, least

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size = None, [], 0
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("filter").to_pylist()):
                if bucket != current:
                    if held:
                        yield self.out(merged(held))
                    current, held, size = bucket, [], 0
                held.append(self.filters.read(bucket, data))
                size += len(held[-1][0])
                if size > HELD_ENTRIES and size > 2 * len(held[0][0]):
                    held = [merged(held)]
                    size = len(held[0][0])
        if held:
            yield self.out(merged(held))

    def out(self, entries) -> pa.RecordBatch:
        high, low, count = (x[entries[2] >= self.least] for x in entries)
        high, low = self.filters.packing.restored(high, low)
        columns = [*self.filters.packing.words(high), *self.filters.packing.words(low), count, _bits(high)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=[*_NUMBERS, "a", "bit"])


def _levels(packing: Packing, total: int) -> list[QuotientFilters]:
    """Filters of ever finer buckets, the last of which are small enough to merge."""
    levels = [QuotientFilters(packing, BUCKET)]
    while total >> levels[-1].bucket > BUCKET_WORDS and levels[-1].rest > BUCKET:
        levels.append(QuotientFilters(packing, levels[-1].bucket + BUCKET))
    return levels


def _counted(ids: DataFrame, levels: list[QuotientFilters], least: int, scratch: Scratch, common=None) -> DataFrame:
    parts = ids.mapInArrow(_Counting(levels[0], common), "bucket long, filter binary")
    for filters, finer in zip(levels, levels[1:]):
        # A coarse bucket is large; its rows are spread by what they hold as well.
        spread = parts.withColumn("part", F.pmod(F.crc32("filter"), F.lit(PARTS))).repartition("bucket", "part")
        parts = spread.drop("part").sortWithinPartitions("bucket").mapInArrow(_Dealing(filters, finer), "bucket long, filter binary")
    whole = parts.repartition("bucket").sortWithinPartitions("bucket")
    return scratch.write(whole.mapInArrow(_Merging(levels[-1], least), "w1 long, w2 long, w3 long, w4 long, a long, bit long"))


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """Bits of the common pairs, ``BITMAP`` of them whatever the table's size."""
    place = F.col("bit") + 1
    parts = pairs.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bitmap = np.zeros(BITMAP // 8, np.uint8)
    for r in parts.collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        start = (r["part"] - 1) * len(part)
        bitmap[start : start + len(part)] = part[: len(bitmap) - start]
    return bitmap


def frequent_ngrams(ids: DataFrame, packing: Packing, total: int, least: int, scratch: Scratch) -> DataFrame:
    """``(w1, w2, w3, w4, a)``: n-grams of two to four words found at least ``least`` times,
    as word numbers with 0 for no word."""
    levels = _levels(packing, total)
    pairs = _counted(ids, levels, least, scratch)
    common = ids.sparkSession.sparkContext.broadcast(_bitmap(pairs))
    longer = _counted(ids, levels, least, scratch, common)
    return pairs.unionByName(longer).drop("bit")


def _part(columns: list[str]):
    """A phrase key: a struct of four numbers."""
    columns = [F.col(c) for c in columns] + [F.lit(0).cast("long")] * (LONGEST - len(columns))
    return F.struct(*[c.alias(n) for c, n in zip(columns, _NUMBERS)])


def scored(phrases: DataFrame, every: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``l``, ``r`` and ``score`` of the lowest-scoring cut to ``(key, size, a)``; the
    parts' counts come from ``every`` phrase and word."""
    counts = every.select("key", "a").unionByName(
        words.select(F.struct("number", *[F.lit(0).cast("long")] * 3).cast(phrases.schema["key"].dataType).alias("key"), F.col("n").alias("a"))
    )
    parts = phrases.select("key", "size", "a", "key.*")
    cuts = [
        F.when(F.col("size") == n, F.struct(F.lit(k).alias("k"), _part(_NUMBERS[:k]).alias("left"), _part(_NUMBERS[k:n]).alias("right")))
        for n in range(2, LONGEST + 1)
        for k in range(1, n)
    ]
    parts = parts.select("key", "size", "a", F.explode(F.array_compact(F.array(*cuts))).alias("cut")).select("key", "size", "a", "cut.*")
    first, rest = (counts.select(F.col("key").alias(side), F.col("a").alias(n)) for side, n in (("left", "l"), ("right", "r")))
    # Products may pass 64 bits; decimals are exact.
    product = F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    both = parts.join(first, "left").join(rest, "right").withColumn("product", product).withColumn("lr", (F.col("l") + F.col("r")).cast("decimal(20,0)"))
    best = F.min(F.struct(F.expr("product div lr").alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("key", "size", "a").agg(best).select("key", "size", "a", "best.l", "best.r", "best.score")


def not_inside(phrases: DataFrame, percent: int) -> DataFrame:
    """``phrases(key, size, a, ...)`` without those whose words lie inside a longer phrase with
    at least ``percent`` of their count."""
    parts = [
        F.when(F.col("size") == n, _part(_NUMBERS[i : i + m]))
        for n in range(3, LONGEST + 1)
        for m in range(2, n)
        for i in range(n - m + 1)
    ]
    inner = phrases.filter("size > 2").select(F.col("a"), "size", "key.*")
    longest = inner.select("a", F.explode(F.array_compact(F.array(*parts))).alias("key")).groupBy("key").agg(F.max("a").alias("of_longer"))
    return phrases.join(longest, "key", "left").filter(F.expr(f"of_longer IS NULL OR 100 * of_longer < {percent} * a")).drop("of_longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, percent: int = INSIDE_PERCENT, most_words: int = BROADCAST_WORDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` collocations.

    A text (null: empty) is lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends,
    and those into words at spaces and tabs. Counts are over all texts of a language (null:
    ``und``). A candidate is a phrase of two to four words found ``a`` >= ``least`` times;
    cut in two parts found ``l`` and ``r`` times it scores floor(2000000 * a / (l + r)), at
    the cut that scores lowest, the earlier one of equals. A candidate inside a longer one
    with at least ``percent`` of its count goes. ``n`` is the number of the language's words.
    Order: score and ``a`` descending, then phrase.

    Repeated rows count each time; doc_id and other columns are ignored. A language without
    candidates has no row, and so has an empty table. All counts are exact and of all texts:
    a candidate's words are all found ``least`` times, which alone leaves words out. Fewer than
    2**31 words may be that common.

    What a task holds is bounded. Filters are dealt by permuted keys, which evens out
    frequent words, and an n-gram is one entry per task and filter however often it occurs.
    """
    scratch = Scratch(docs)
    with brief_scratch(docs) as brief:
        texts = docs.select(
            F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), or_empty(F.col("text")).alias("text")
        )
        words, totals = numbered_words(texts, least, scratch)
        ids = numbered_texts(texts, words, brief, most_words)
        highest = words.agg(F.max("number")).first()[0] or 0
        total = totals.agg(F.sum("n")).first()[0] or 0
        found = frequent_ngrams(ids, Packing(highest), total, least, brief)
        size = reduce(lambda a, b: a + b, [(F.col(c) > 0).cast("int") for c in _NUMBERS])
        found = scratch.write(found.select(_part(_NUMBERS).alias("key"), size.alias("size"), "a"))
    kept = scored(not_inside(found, percent), found, words)
    return _best(kept, words, totals, top)


def _best(phrases: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    first = words.select(F.col("number").alias("w1"), "lang", F.col("word").alias("word1"))
    placed = phrases.select("key", "a", "l", "r", "score", "key.*").join(first, "w1")
    order = [F.col("score").desc(), F.col("a").desc()]
    # All that may be among the first by score and count; texts are needed for these only.
    # They are looked for in parts of a language, then among what is left.
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    for within in (["lang", "part"], ["lang"]):
        placed = placed.withColumn("rank", F.rank().over(W.partitionBy(*within).orderBy(*order))).filter(F.col("rank") <= top)
    for i in range(2, LONGEST + 1):
        more = words.select(F.col("number").alias(f"w{i}"), F.col("word").alias(f"word{i}"))
        placed = placed.join(more, f"w{i}", "left")
    placed = placed.withColumn("phrase", F.concat_ws(" ", *[f"word{i}" for i in range(1, LONGEST + 1)]))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase"))
    placed = placed.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return placed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
