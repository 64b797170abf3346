"""Exact top-k search by BM25: an inverted index per shard with block-max pruning."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, or_empty

K1, B = 1.2, 0.75
SHARD, SHARD_CHARS = 4096, 1 << 23  # documents and characters of a shard; a longer text is a shard of its own
SORTED, SORTED_CHARS = 8192, 1 << 25  # documents and characters that are sorted before they are cut into shards
BLOCK, MOST = 256, 0.6  # documents; where a larger part of the queries reach a block, all in one product are faster
HEAVY, LONG = 2048, 32  # so many terms at most, in over a LONGth of a shard's documents, are kept as rows of a matrix
WORTH = 400  # a heavy term is added up pair by pair where they are fewer than this part of its cells
ALIKE = 3  # of a query's commonest words, which queries scored together share where they can
NEAR = 2  # of a document's commonest words, by which the documents of a shard are ordered
QUERIES_AT_ONCE = 4096
BLOCK_WORDS = 1 << 22  # words of the queries that are broadcast together
LIGHT_AT_ONCE = 1 << 16  # pairs of a query and a document with a light term in common, added up together
GROWTH, LEVELS = 4, 20  # each round of shards is so many times as large as all before it; levels of shards
DIGITS = 6  # scores that agree to so many decimals are ties
MARGIN = 10.0**-DIGITS
HASH_SEED = 42


class Batch:
    """Queries that are scored together: a vocabulary with idf weights, and for each query its
    ``places`` in it, laid end to end. ``asks`` has the queries of each term, from ``starts`` on."""

    def __init__(self, asked: np.ndarray, sizes: np.ndarray, terms: np.ndarray, dfs: np.ndarray, n: int):
        self.asked = asked
        self.terms, first, places = np.unique(terms, return_index=True, return_inverse=True)
        df = dfs[first].astype(np.float64)
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        self.places = places.astype(np.int32)
        self.edges = np.append(0, np.cumsum(sizes))
        self.asks = self.query[np.argsort(self.places, kind="stable")].astype(np.min_scalar_type(len(asked)))
        self.sizes = np.bincount(self.places, minlength=len(self.terms)).astype(np.int32)
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)

    @property
    def query(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.asked), dtype=np.int32), np.diff(self.edges))

    @property
    def lists(self) -> pa.Array:
        """``asks`` as a value of bytes for each term: Arrow copies such values as a whole."""
        edges = np.append(self.starts, len(self.asks)).astype(np.int32) * np.int32(self.asks.itemsize)
        return pa.Array.from_buffers(pa.binary(), len(self.terms), [None, pa.py_buffer(edges), pa.py_buffer(self.asks)])


class Hits:
    """The ``k`` best documents so far of each query of a batch, ties to the smaller id.
    ``least`` is the score that a further document must reach, to begin with that of the
    ``k``-th best among documents searched before."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.query, self.doc_id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, query: np.ndarray, doc_id: np.ndarray, score: np.ndarray) -> None:
        query, doc_id = np.append(self.query, query), np.append(self.doc_id, doc_id)
        score = np.append(self.score, np.round(score, DIGITS))
        order = np.lexsort((doc_id, -score, query))
        query, doc_id, score = query[order], doc_id[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.k - 1
        self.least[query[last]] = np.maximum(self.least[query[last]], score[last])
        self.query, self.doc_id, self.score = query[rank < self.k], doc_id[rank < self.k], score[rank < self.k]


class Space:
    """Arrays that are used again from shard to shard: memory that the system must first hand
    out costs more than the sums that are put there. What they hold is undefined."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def array(self, name: str, shape: tuple[int, int], dtype: type) -> np.ndarray:
        size = shape[0] * shape[1]
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, dtype)
        return self.held[name][:size].reshape(shape)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of runs that begin at ``starts``, laid end to end."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return at


class Terms:
    """Sorted hashes, found by their leading bits."""

    def __init__(self, terms: np.ndarray):
        bits = max(len(terms).bit_length() + 1, 1)
        self.shift, self.n, self.terms = np.uint64(64 - bits), len(terms), np.append(terms, np.iinfo(np.uint64).max)
        sizes = np.bincount((terms >> self.shift).view(np.int64), minlength=1 << bits)
        self.first, self.most = (np.cumsum(sizes) - sizes).astype(np.int32), int(sizes.max(initial=0))

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each of the sorted ``terms``, or -1."""
        at = self.first[(terms >> self.shift).view(np.int64)]
        for _ in range(self.most):
            at += self.terms[at] < terms
        return np.where((self.terms[at] == terms) & (at < self.n), at, -1)


class ShardIndex:
    """Postings of one shard, laid by document. ``impact`` is a posting's BM25 score without
    the term's idf. Terms that many documents have are heavy: their impacts, rounded, also
    stand in ``dense``, a row for each, and ``highest`` has the largest of each ``BLOCK``
    documents. Documents from ``len(ids)`` on have no id and are no hits."""

    def __init__(self, ids, terms, starts, docs, counts, lengths, average: float):
        self.ids, self.terms = ids, Terms(terms)
        self.norm = K1 * (1 - B + B * lengths / average)
        impact = counts * (K1 + 1) / (counts + self.norm[docs])
        self.sizes = np.diff(starts)
        heavy = np.flatnonzero(self.sizes > len(lengths) / LONG)
        heavy = heavy[np.argsort(-self.sizes[heavy], kind="stable")][:HEAVY]
        self.row = np.full(len(terms), -1)
        self.row[heavy] = np.arange(len(heavy))
        self.blocks = -(-len(lengths) // BLOCK)
        self.dense = np.zeros((len(heavy), self.blocks * BLOCK), np.float32)
        own = _spread(starts[heavy], self.sizes[heavy])
        self.dense[np.repeat(np.arange(len(heavy)), self.sizes[heavy]), docs[own]] = impact[own]
        self.highest = self.dense.reshape(len(heavy), self.blocks, BLOCK).max(axis=2)
        by_doc = np.argsort(docs.astype(np.uint16), kind="stable")
        self.term = np.repeat(np.arange(len(terms), dtype=np.int32), self.sizes)[by_doc]
        self.impact = impact[by_doc]
        self.edges = np.append(0, np.cumsum(np.bincount(docs, minlength=len(lengths))))
        self.by_id = np.argsort(ids, kind="stable")

    def search(self, batch: Batch, hits: Hits, space: Space) -> None:
        """Add this shard's hits. Documents with the id of a query are no hits for it.

        Blocks are visited from the longest documents to the shortest, since long ones share
        more with a query. In a block the light terms are added up first. Where the largest of
        these sums and the heavy terms' largest impacts in the block reach the k-th score of
        the documents before, heavy terms are added too, in single precision. What reaches that
        score then, raised by the largest error that such a sum can have, is scored in double.
        """
        queries, at = len(batch.asked), self.terms.find(batch.terms)
        here = np.flatnonzero(at >= 0)
        sizes, row = self.sizes[at[here]].astype(np.int64), self.row[at[here]]
        heavy = (row >= 0) & (batch.sizes[here] * sizes > queries * len(self.norm) / WORTH)
        used, of_heavy = row[heavy], here[heavy]
        weights = space.array("weights", (queries, len(used)), np.float32)
        weights.fill(0)
        asks = batch.sizes[of_heavy]
        own = np.repeat(np.arange(len(used)), asks)
        weights[batch.asks[_spread(batch.starts[of_heavy], asks)], own] = batch.idf[of_heavy][own]
        place = np.full(len(self.row), -1, np.int32)
        place[at[here]] = here
        places = place.take(self.term)
        is_light = np.ones(len(batch.terms) + 1, bool)
        is_light[of_heavy] = is_light[-1] = False
        light = np.flatnonzero(is_light[places])
        runs = np.searchsorted(light, self.edges)
        of_run = places[light]
        shares = batch.idf.take(places) * self.impact
        light = batch.lists, batch.asks.dtype, of_run, batch.sizes[of_run], shares[light]
        slack = (len(used) + 12) * 2.0**-23  # twice the relative error of a sum of so many products
        own = self._own(batch)
        least, new = (hits.least - 2 * MARGIN) * (1 - 2 * slack), np.isneginf(hits.least)
        bounds = self.highest[used].T @ weights.T
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for block in np.argsort(-np.add.reduceat(self.norm[: len(self.ids)], np.arange(0, len(self.ids), BLOCK))):
            start = block * BLOCK
            scores = space.array("scores", (min(BLOCK, len(self.ids) - start), queries), np.float32)
            _add_light(runs[start : start + len(scores) + 1], *light, scores)
            for doc, query in own:
                if start <= doc < start + len(scores):
                    scores[doc - start, query] = -np.inf
            bound = (scores.max(axis=0) + bounds[block]) * (1 + slack)
            reached = np.flatnonzero(bound >= np.maximum(least, np.finfo(np.float32).tiny))
            if not len(reached):
                continue
            part = slice(start, start + len(scores))
            rows = space.array("rows", (len(used), len(scores)), np.float32)
            np.copyto(rows, self.dense[used, part])
            if len(reached) > MOST * queries:
                reached, of_query = np.arange(queries), weights
            else:
                of_query, scores = weights[reached], scores[:, reached]
            most = space.array("most", scores.shape, np.float32)
            np.matmul(rows.T, of_query.T, out=most)
            most += scores
            most *= 1 + slack
            if new.any() and len(scores) >= hits.k:
                ask = np.flatnonzero(new[reached])
                kth = np.partition(most[:, ask].T, len(scores) - hits.k, axis=1)[:, len(scores) - hits.k]
                kth = kth.astype(np.float64) * (1 - 3 * slack) - 2 * MARGIN
                least[reached[ask]] = np.maximum(least[reached[ask]], kth)
            enough = np.maximum(least[reached], np.finfo(np.float32).tiny).astype(np.float32)
            doc, query = np.divmod(np.flatnonzero(most >= enough * np.float32(1 - 2.0**-22)), len(reached))
            found.append((reached[query], doc + start, most[doc, query]))
        query, doc, score = map(np.concatenate, zip(*found))
        query, doc = _likely(query, doc, score * (1 - 3 * slack) - 2 * MARGIN, score, hits.k)
        score = self._exact(batch, places, shares, query, doc)
        good = score >= hits.least[query] - 2 * MARGIN
        hits.add(query[good], self.ids[doc[good]], score[good])

    def _own(self, batch: Batch) -> list[tuple[int, int]]:
        """Documents and the queries whose id they have."""
        first, last = (np.searchsorted(self.ids[self.by_id], batch.asked, side) for side in ("left", "right"))
        return [(doc, q) for q in np.flatnonzero(last > first) for doc in self.by_id[first[q] : last[q]].tolist()]

    def _exact(self, batch: Batch, places, shares, query: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The scores of pairs of a query and a document. The postings have their terms'
        ``places`` in the batch and ``shares``, which are their impacts times idf."""
        out, asks = np.empty(len(query)), np.zeros(len(batch.terms) + 1, bool)  # at -1: not asked
        order = np.argsort(query, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(query[order], prepend=-1)), len(query))
        for start, end in zip(edges[:-1], edges[1:]):
            q = query[order[start]]
            terms = batch.places[batch.edges[q] : batch.edges[q + 1]]
            asks[terms] = True
            for pair in order[start:end].tolist():
                own = slice(self.edges[doc[pair]], self.edges[doc[pair] + 1])
                out[pair] = shares[own][asks[places[own]]].sum()
            asks[terms] = False
        return out


def _add_light(runs: np.ndarray, lists: pa.Array, kind: np.dtype, terms, sizes, shares, out: np.ndarray) -> None:
    """The scores of documents by light terms, a line for each. A document's runs are its
    terms, each with its list of queries and a share of their scores."""
    cut = np.append(0, np.cumsum(sizes[runs[0] : runs[-1]]))[runs - runs[0]]
    start = 0
    while start < len(out):
        end = max(start + 1, int(np.searchsorted(cut, cut[start] + LIGHT_AT_ONCE, "right")) - 1)
        own, n = slice(runs[start], runs[end]), int(cut[end] - cut[start])
        query = np.frombuffer(lists.take(pa.array(terms[own])).buffers()[2], kind, n) if n else np.empty(0, kind)
        scores = np.repeat(shares[own], sizes[own])
        to = 0
        for doc in range(start, end):  # a line at a time stays in the nearest cache
            begin, to = to, int(cut[doc + 1] - cut[start])
            out[doc] = np.bincount(query[begin:to], scores[begin:to], out.shape[1])
        start = end


def _likely(query, doc, low, high, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs whose highest score reaches the ``k``-th of the query's lowest ones."""
    order = np.lexsort((-low, query))
    query, doc, low, high = query[order], doc[order], low[order], high[order]
    first, last = np.searchsorted(query, query), np.searchsorted(query, query, "right")
    least = np.where(last - first >= k, low[np.minimum(first + k, last) - 1], -np.inf)
    return query[high >= least], doc[high >= least]


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        return self.setdefault(word, len(self))


def _numbered(texts: Iterable[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The hashes of all words, and the numbers of each text's words."""
    number, own = _Numbers(), []
    for text in texts:
        words = text.encode("utf-8", "replace").lower().split()
        own.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
    return np.fromiter((xxhash.xxh64_intdigest(w, HASH_SEED) for w in number), np.uint64, len(number)), own


def _near(own: list[np.ndarray]) -> np.ndarray:
    """An order of texts by their commonest words and then by length, so that shards and blocks
    have texts of one language or kind and of one length, and their bounds stay low.
    ``own`` has the numbers of each text's words."""
    lengths, words = np.array([len(w) for w in own], np.int64), np.concatenate([np.empty(0, np.int32), *own])
    count = np.bincount(words, minlength=1)
    rank = np.empty(len(count), np.int32)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    left = rank[words]
    filled = np.flatnonzero(lengths)
    starts, keys = (np.cumsum(lengths) - lengths)[filled], []
    for _ in range(NEAR if len(filled) else 0):
        most = np.full(len(lengths), len(count), np.int32)
        most[filled] = np.minimum.reduceat(left, starts)
        keys.append(most)
        left[left == np.repeat(most, lengths)] = len(count)
    return np.lexsort([lengths, *keys[::-1]])


def postings(hashes: np.ndarray, own: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Terms, starts, docs, counts and lengths of a shard's index, of texts whose words are
    numbered: word ``i`` has the hash ``hashes[i]``."""
    lengths, words = np.array([len(w) for w in own], np.int32), np.concatenate([np.empty(0, np.int32), *own])
    there = np.zeros(len(hashes), bool)
    there[words] = True
    there = np.flatnonzero(there)
    terms, of_word = np.unique(hashes[there], return_inverse=True)
    rank = np.zeros(len(hashes), np.int32)
    rank[there] = of_word
    width = max(len(lengths), 1)
    places = rank[words] * np.int64(width)
    places += np.repeat(np.arange(len(lengths)), lengths)
    places.sort()
    first = np.flatnonzero(np.diff(places, prepend=-1))
    counts, places = np.diff(first, append=len(places)), places[first]
    starts = np.searchsorted(places, np.arange(len(terms) + 1) * width).astype(np.int32)
    return terms, starts, (places % width).astype(np.int32), counts.astype(np.int32), lengths


INDEX = (
    "n long, n_words long, level int, ids binary, terms binary, starts binary, docs binary, counts binary, lengths binary"
)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; most shards need one."""
    return counts.astype(np.min_scalar_type(counts.max(initial=0))).tobytes()


def _widened(counts: bytes | pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(counts, f"u{memoryview(counts).nbytes // n}").astype(np.int32)


def _index_row(rows: list[tuple], hashes: np.ndarray | None = None) -> pd.DataFrame:
    """The index of ``(doc_id, text)`` rows, or of ``(doc_id, words)`` whose words are numbered."""
    rows = sorted(rows, key=lambda row: row[0] is None)  # those without an id come last
    ids = np.array([doc_id for doc_id, _ in rows if doc_id is not None], np.int64)
    own = [text for _, text in rows]
    if hashes is None:
        hashes, own = _numbered(own)
    terms, starts, docs, counts, lengths = postings(hashes, own)
    lot, level = xxhash.xxh64_intdigest(ids.tobytes(), HASH_SEED), 0
    while level < LEVELS and lot % GROWTH == 0:
        lot, level = lot // GROWTH, level + 1
    values = {
        "n": len(rows),
        "n_words": int(lengths.sum()),
        "level": np.int32(level),
        "ids": ids.tobytes(),
        "terms": terms.tobytes(),
        "starts": starts.tobytes(),
        "docs": docs.astype(np.uint16).tobytes(),
        "counts": _narrow(counts),
        "lengths": lengths.tobytes(),
    }
    return pd.DataFrame({name: [value] for name, value in values.items()})


def _shards(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
    chars = [len(text) for text in texts]
    hashes, own = _numbered(texts)
    texts.clear()
    rows, size = [], 0
    for at in _near(own).tolist():
        if rows and (len(rows) == SHARD or size + chars[at] > SHARD_CHARS):
            yield pa.RecordBatch.from_pandas(_index_row(rows, hashes), preserve_index=False)
            rows, size = [], 0
        rows.append((ids[at], own[at]))
        size += chars[at]
    yield pa.RecordBatch.from_pandas(_index_row(rows, hashes), preserve_index=False)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            if ids and (len(ids) == SORTED or chars + len(text) > SORTED_CHARS):
                yield from _shards(ids, texts)
                ids, texts, chars = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            chars += len(text)
    if ids:
        yield from _shards(ids, texts)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            terms, starts = np.frombuffer(row.terms, np.int64), np.frombuffer(row.starts, np.int32)
            yield pd.DataFrame({"h": terms, "df": np.diff(starts)})


def _asked(every: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, docs = np.frombuffer(row.ids, np.int64), np.frombuffer(row.docs, np.uint16)
                asks = np.zeros(row.n, bool)
                asks[: len(ids)] = ids % every == 0
                at = np.flatnonzero(asks[docs])
                term = np.searchsorted(np.frombuffer(row.starts, np.int32), at, "right") - 1
                words = pd.DataFrame({"query_id": ids[docs[at]], "h": np.frombuffer(row.terms, np.int64)[term]})
                yield words.drop_duplicates()  # one id may have many rows

    return run


def _searched(block, least, k: int, average: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, space = [], Space()
        for shards in batches:
            found = found or [(batch, Hits(k, bound)) for batch, bound in zip(block.value, least.value)]
            columns = [shards[name] for name in ("ids", "terms", "starts", "docs", "counts", "lengths")]
            for i in range(shards.num_rows):
                ids, terms, starts, docs, counts, lengths = (column[i].as_buffer() for column in columns)
                if not terms.size or not ids.size:
                    continue  # no word, or no document that can be a hit
                docs = np.frombuffer(docs, np.uint16)
                shard = ShardIndex(
                    np.frombuffer(ids, np.int64),
                    np.frombuffer(terms, np.uint64),
                    np.frombuffer(starts, np.int32),
                    docs,
                    _widened(counts, len(docs)),
                    np.frombuffer(lengths, np.int32),
                    average,
                )
                for batch, hits in found:
                    shard.search(batch, hits, space)
        for batch, hits in found:
            columns = [pa.array(column) for column in (batch.asked[hits.query], hits.doc_id, hits.score)]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "doc_id", "score"])

    return run


def _alike(starts: np.ndarray, sizes: np.ndarray, terms: np.ndarray, dfs: np.ndarray) -> np.ndarray:
    """An order of queries by their commonest words, so that those of one language or kind
    of text are neighbours and have few heavy terms between them."""
    keys, left = [], dfs.astype(np.int64) + 1
    for _ in range(ALIKE if len(starts) else 0):
        most = np.maximum.reduceat(left, starts)
        at = np.flatnonzero(left == np.repeat(most, sizes))
        at = at[np.searchsorted(at, starts)]
        keys.append(np.where(most > 0, terms[at], 0))
        left[at] = 0
    return np.lexsort(keys[::-1]) if keys else np.empty(0, np.int64)


def _batches(block: pa.Table, n: int) -> list[Batch]:
    asked = block["query_id"].to_numpy()
    sizes = block["terms"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
    terms, dfs = (block[c].combine_chunks().flatten().to_numpy() for c in ("terms", "dfs"))
    starts = np.cumsum(sizes) - sizes
    order = _alike(starts, sizes, terms, dfs)
    asked, starts, sizes = asked[order], starts[order], sizes[order]
    ends = np.append(0, np.cumsum(sizes))
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    terms, dfs = terms[at], dfs[at]
    batches = []
    for at in range(0, len(asked), QUERIES_AT_ONCE):
        to = min(at + QUERIES_AT_ONCE, len(asked))
        own = slice(ends[at], ends[to])
        batches.append(Batch(asked[at:to], sizes[at:to], terms[own].view(np.uint64), dfs[own], n))
    return batches


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _bounds(best: DataFrame, batches: list[Batch], k: int) -> list[np.ndarray]:
    """The k-th score of each query of the batches, if it has so many hits."""
    last = best.filter(F.col("rank") == k).select("query_id", "score").toArrow().sort_by("query_id")
    ids, scores = np.append(last["query_id"].to_numpy(), 0), np.append(last["score"].to_numpy(), 0.0)
    bounds = []
    for batch in batches:
        at = np.searchsorted(ids[:-1], batch.asked)
        there = (ids[at] == batch.asked) & (at < len(ids) - 1)
        bounds.append(np.where(there, scores[at], -np.inf))
    return bounds


def search(docs: DataFrame, every: int = 20, k: int = 10) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the ``k`` best other documents by BM25 for each
    document whose doc_id is divisible by ``every``.

    A query is made of all distinct words of the whole text. Words are split at ASCII white
    space, with A-Z lower-cased, and told apart by 64-bit hashes. Scores use the numbers of
    documents and words and the document frequencies of the whole table, and are exact; those
    that agree to six decimals are ties, which go to the smaller doc_id. Documents without
    any query word are no hits.

    Null texts count as empty; rows without a doc_id count in the statistics but are neither
    queries nor hits. Rows with the query's doc_id are no hits for it; of other repeated rows
    each is one, and a repeated query asks once, with the words of all its rows. Other
    columns are ignored. An empty table gives an empty result.

    Shards are cut from ``SORTED`` consecutive rows at most, ordered by kind of text and length,
    so texts are not shuffled. Their indexes are written once, and give the document
    frequencies and the queries' words too. The queries
    are broadcast in blocks of about ``BLOCK_WORDS`` words. A block visits the shards in
    rounds, each ``GROWTH`` times as large as all before it, and takes the k-th scores found
    along as bounds, so that a task gives few hits that others beat. What is shuffled grows
    about in proportion to the table, the scoring with its square, since every query visits
    every shard.
    """
    spark, scratch = docs.sparkSession, Scratch(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))
    # Compressed, a column of a file is one page of many MB, for which each reader and writer
    # takes buffers outside the heap; the narrow columns are hardly larger without.
    index = scratch.write(texts.mapInArrow(_indexed, INDEX), compression="none")
    n, words = index.agg(F.sum("n"), F.sum("n_words")).first()
    average = max((words or 0) / max(n or 0, 1), 1e-9)
    frequency = (
        index.select("terms", "starts")
        .mapInPandas(_frequencies, "h long, df int")
        .groupBy("h")
        .agg(F.sum("df").alias("df"))
        .filter(F.col("df") >= 2)  # a word of a single row finds nothing
    )
    asked = index.select("n", "ids", "terms", "starts", "docs").mapInPandas(_asked(every), "query_id long, h long")
    asked = asked.join(frequency, "h").groupBy("query_id", "h").agg(F.first("df").alias("df"))
    queries = asked.groupBy("query_id").agg(F.collect_list(F.struct("h", "df")).alias("q"), F.count("h").alias("words"))
    queries = scratch.write(queries.select("query_id", "words", F.col("q.h").alias("terms"), F.col("q.df").alias("dfs")))
    blocks = (queries.agg(F.sum("words")).first()[0] or 0) // BLOCK_WORDS + 1
    shards, rounds = index.count(), 1
    while shards > 2 * GROWTH**rounds and rounds <= LEVELS:
        rounds += 1
    results = []
    for number in range(blocks):
        own = F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number
        batches = _batches(queries.filter(own).select("query_id", "terms", "dfs").toArrow(), n or 0)
        block = spark.sparkContext.broadcast(batches)
        bounds, best = [np.full(len(batch.asked), -np.inf) for batch in batches], None
        for level in reversed(range(rounds)):
            of_round = F.col("level") >= level if level == rounds - 1 else F.col("level") == level
            least = spark.sparkContext.broadcast(bounds)
            run = _searched(block, least, k, average)
            hits = index.filter(of_round).mapInArrow(run, "query_id long, doc_id long, score double")
            best = scratch.write(_best(hits if best is None else best.drop("rank").unionByName(hits), k))
            bounds = _bounds(best, batches, k) if level else bounds
            least.unpersist()
        block.unpersist()
        results.append(best.select("query_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionAll, results)
