"""A quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turns, one feature at a time, on binned features; what a
feature's trees add up to is a lookup table over its bins. The pairs that still explain most
get tables over two features. A score is the sum of a row's table entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import or_empty

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "bars",
    "stops",
    "other_bytes",
    "distinct_words",
    "repeated_words",
    "top_word",
    "capitalised",
    "marked_words",
    "line_length",
    "shouting_lines",
    "marked_lines",
    "distinct_lines",
)
FIT_ROWS = 20_000  # labelled rows the model is fitted on, at most
THRESHOLD = 0.3

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True
_MARKS = b"!#$%&*|<>{}~^"


def features(text: str) -> list[float]:
    """Every feature is defined for any text; those over nothing are 0."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(count[65:91].sum() + count[97:123].sum() + count[128:].sum()))
    size = len(raw)
    kinds = Counter(words)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    first = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    last = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    shouting = sum(map(bytes.isupper, lines))
    bare = sum(len(line) - len(line.translate(None, _MARKS)) > 0.04 * len(line) for line in lines)
    return [
        float(np.log1p(n)),
        (size - int(count[32]) - int(count[10])) / n,
        float(count[_UPPER].sum()) / letters,
        float(count[_DIGIT].sum()) / size,
        float(count[_SYMBOL].sum()) / size,
        float(count[124]) / n,
        float(count[46] + count[44]) / n,
        float(count[128:].sum()) / size,
        len(kinds) / n**0.8,
        repeated / n,
        kinds.most_common(1)[0][1] / n,
        float(_UPPER[first].mean()),
        float(_SYMBOL[last].mean()),
        float(np.log1p(n / len(lines))),
        shouting / len(lines),
        bare / len(lines),
        len(set(lines)) / len(lines),
    ]


@dataclass(frozen=True)
class Gam:
    """Bin edges and log-odds per bin of each feature, and tables for pairs of features."""

    intercept: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    coarse: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            total += table[a, np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _cut(gain_g: np.ndarray, gain_h: np.ndarray, low: int, high: int, ridge: float):
    g, h = np.cumsum(gain_g[low:high]), np.cumsum(gain_h[low:high])
    left = g[:-1] ** 2 / (h[:-1] + ridge)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
    gain = left + right - g[-1] ** 2 / (h[-1] + ridge)
    return (float(gain.max()), low + 1 + int(gain.argmax())) if len(gain) else (0.0, -1)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Best-first tree over the bins of one feature, as a value per bin."""
    ends = [0, len(g)]
    while len(ends) <= leaves:
        gain, at = max(_cut(g, h, a, b, ridge) for a, b in zip(ends, ends[1:]))
        if at < 0 or gain < 1e-9:
            break
        ends = sorted([*ends, at])
    out = np.zeros(len(g))
    for a, b in zip(ends, ends[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _crossed_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Best four rectangles from one cut in each of two features."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c):
        a = c[:-1, :-1]
        b, d, t = c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1]
        return a, b, d, t - a - b - d

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gain = sum(x**2 / (y + ridge) for x, y in zip(quarters(cg), quarters(ch)))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + ridge)
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + ridge)), out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    pair_rounds: int = 60,
    n_pairs: int = 6,
    bins: int = 64,
    coarse_bins: int = 12,
    leaves: int = 4,
    rate: float = 0.1,
    ridge: float = 2.0,
) -> Gam:
    """Cyclic boosting of the log loss; features take equal turns in a fixed order."""
    x, y = np.asarray(x, float).reshape(-1, len(FEATURES)), np.asarray(y, float)
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    k = len(FEATURES)
    edges = tuple(_edges(x[:, j], bins) if len(y) else np.empty(0) for j in range(k))
    coarse = tuple(_edges(x[:, j], coarse_bins) if len(y) else np.empty(0) for j in range(k))
    tables = tuple(np.zeros(len(e) + 1) for e in edges)
    if len(np.unique(y)) < 2:  # nothing to tell apart
        return Gam(intercept, edges, tables, coarse, ())
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    wide = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    total = np.full(len(y), intercept)

    def slopes(cell: np.ndarray, cells: int):
        p = 1 / (1 + np.exp(-total))
        return np.bincount(cell, y - p, cells), np.bincount(cell, p * (1 - p), cells)

    for _ in range(rounds):
        for j in range(k):
            g, h = slopes(fine[j], len(tables[j]))
            step = rate * _shallow_tree(g, h, leaves, ridge)
            tables[j][:] += step
            total += step[fine[j]]

    def crossed(i, j):
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        g, h = slopes(wide[i] * shape[1] + wide[j], shape[0] * shape[1])
        return _crossed_tree(g.reshape(shape), h.reshape(shape), ridge)

    gains = sorted(((crossed(i, j)[0], i, j) for i in range(k) for j in range(i + 1, k)), reverse=True)
    pairs = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, table in pairs:
            step = rate * crossed(i, j)[1]
            table += step
            total += step[wide[i], wide[j]]
    return Gam(intercept, edges, tables, coarse, tuple(pairs))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))],
            names=["doc_id", "quality", "x"],
        )


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Gam:
    """Fit on at most ``rows`` labelled documents, the first by a hash of doc_id; only their
    features come to the driver. Held-out documents are never among them. Of rows that share
    a doc_id the one with the least features counts."""
    marks = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality").cast("int")).alias("quality"))
    )
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    measured = sample.mapInArrow(_measured, "doc_id long, quality int, x array<double>")
    # One row for each chosen doc_id, however often it is repeated.
    found = measured.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    found = sorted((r["doc_id"], r["quality"], *r["x"]) for r in found)
    return fit([r[2:] for r in found], [r[1] for r in found])


def score_quality(docs: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` and ``score``, ``predicted``; columns of these names are
    overwritten.

    The score, from 0 to 1, is that of the whole text; a null text counts as empty, whose
    features are all 0. ``predicted`` is 1 from ``threshold`` on. Equal texts score alike,
    and no other column is an input. An empty table gives an empty result; without labels
    of both kinds every text gets the same score.
    """

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series(model.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))))

    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    score = scored(or_empty(F.col("text")))
    return docs.select(*own, score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject."""
    columns = docs.columns
    row = docs.withColumn("row", F.struct(*[F.col(f"`{c}`") for c in columns])).select("row", F.col("text"))
    kept = score_quality(row, fit_quality(docs, labels)).filter("predicted = 1")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
