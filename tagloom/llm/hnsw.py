"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Vectors get one more component that makes all lengths equal, which turns the largest inner
product into the nearest neighbour. Searches and insertions run in step for many vectors at
a time, on flat neighbour arrays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch

LINKS = 16  # per vector and level; twice as many on the lowest
WIDTH = 80  # of the beam when building
SEARCH_WIDTH = 320  # recall at 20 on full shards of 64 numbers: 0.99 with clusters, 0.96 without any structure
SHARD = 8192
TOGETHER = 256
COPIED = 2048  # vectors copied together
DIVERSE_AT_ONCE = 512
STEPS = 40  # that a beam would take at least, if all it finds first were the best
QUERIES_PER_TASK = 4096


def _products(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of ``left[i]`` and ``right[j]``, few at a time, so that copies stay in the cache."""
    out = np.empty(len(i), np.float32)
    for at in range(0, len(i), COPIED):
        own = slice(at, at + COPIED)
        out[own] = np.vecdot(left.take(i[own], axis=0), right.take(j[own], axis=0))
    return out


class Graph:
    """Levels of links over one shard's vectors. ``links[l]`` has a row of neighbour numbers
    for each vector of level ``l``, -1 where there are fewer; a vector's number is its place
    in the insertion order, in which those of higher levels come first."""

    def __init__(self, vectors: np.ndarray, extra: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links
        self.full = np.concatenate([vectors, extra[:, None]], axis=1).astype(np.float32)

    @classmethod
    def build(cls, vectors: np.ndarray, longest: float, seed: int = 0) -> tuple["Graph", np.ndarray]:
        """The graph, and the order that its vectors are in."""
        n = len(vectors)
        draws = np.random.default_rng(seed).random(n)
        level = (-np.log(1 - draws) / np.log(LINKS)).astype(int)
        order = np.lexsort((np.arange(n), -level))
        vectors, level = vectors[order].astype(np.float32), level[order]
        length = (vectors.astype(np.float64) ** 2).sum(axis=1)
        graph = cls(vectors, np.sqrt(np.maximum(longest - length, 0)), [])
        for at in range(int(level.max(initial=0)), -1, -1):
            graph._add_level(int((level >= at).sum()), 2 * LINKS if at == 0 else LINKS)
        graph.links.reverse()
        return graph, order

    def _add_level(self, n: int, width: int) -> None:
        links = np.full((n, width), -1, np.int32)
        upper, self.links = self.links, [*self.links, links]  # from the top while building
        done = min(n, 1)
        while done < n:
            new = np.arange(done, min(n, done + min(TOGETHER, done)))
            target = self.full[new]
            entry = np.zeros(len(new), np.int64)
            for above in upper:
                entry = self._beam(above, self.full, target, entry, 4)[0][:, 0]
            found, _ = self._beam(links, self.full, target, np.minimum(entry, done - 1), WIDTH)
            mates = target @ target.T
            np.fill_diagonal(mates, -np.inf)
            near = np.argsort(-mates, axis=1, kind="stable")[:, : min(LINKS, len(new) - 1)]
            chosen = self._diverse(new, np.concatenate([found, new[near]], axis=1), width)
            links[new] = chosen
            self._link_back(links, new, chosen)
            done = int(new[-1]) + 1

    def _diverse(self, points: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
        """For each point up to ``width`` candidates: those nearer to it than to any chosen
        before, then the nearest of the others."""
        if len(points) > DIVERSE_AT_ONCE:
            parts = range(0, len(points), DIVERSE_AT_ONCE)
            part = [slice(at, at + DIVERSE_AT_ONCE) for at in parts]
            return np.concatenate([self._diverse(points[own], candidates[own], width) for own in part])
        near = _products(self.full, np.repeat(points, candidates.shape[1]), self.full, candidates.ravel())
        near = near.reshape(candidates.shape)
        near[(candidates < 0) | (candidates == points[:, None])] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")[:, : 2 * WIDTH]
        candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
        vectors = self.full[candidates]
        among = np.matmul(vectors, vectors.transpose(0, 2, 1))
        usable, kept = near > -np.inf, np.zeros(near.shape, bool)
        blocked = np.full(near.shape, -np.inf, np.float32)  # the nearest chosen one, for each
        many = np.zeros(len(near), int)
        for c in range(near.shape[1]):
            take = usable[:, c] & (near[:, c] > blocked[:, c]) & (many < width)
            kept[:, c] = take
            many += take
            blocked = np.where(take[:, None], np.maximum(blocked, among[:, c]), blocked)
        first = np.argsort(np.where(usable, ~kept, 2), axis=1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(usable, first, 1), np.take_along_axis(candidates, first, 1), -1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out.astype(np.int32)

    def _link_back(self, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
        to, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
        to, source = to[to >= 0], source[to >= 0]
        points = np.unique(to)
        old = links[points]
        ends = np.concatenate([np.repeat(points, old.shape[1])[old.ravel() >= 0], to])
        others = np.concatenate([old.ravel()[old.ravel() >= 0], source])
        pairs = np.sort(ends * np.int64(len(links)) + others)
        ends, others = np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], len(links))
        near = _products(self.full, ends, self.full, others)
        order = np.lexsort((-near, ends))
        ends, others = ends[order], others[order]
        first = np.searchsorted(ends, points)
        rank = np.arange(len(ends)) - first[np.searchsorted(points, ends)]
        room = int(min(rank.max(initial=0) + 1, 2 * WIDTH))
        table = np.full((len(points), room), -1, np.int64)
        fits = rank < room
        table[np.searchsorted(points, ends[fits]), rank[fits]] = others[fits]
        links[points] = self._diverse(points, table, links.shape[1])

    @staticmethod
    def _beam(links, vectors, targets, entry, width) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best reached from ``entry`` for each target, best first; -1 where
        there are fewer. Each step follows the links of the best few open ones together."""
        b, n = len(targets), len(links)
        few = -(-width // STEPS)
        every = np.arange(b)
        seen = np.zeros(b * n, bool)
        seen[every * n + entry] = True
        turn = np.empty(b * n, np.int32)  # read only where it was just written
        ids = np.full((b, width), -1, np.int64)
        near = np.full((b, width), -np.inf, np.float32)
        open_ = np.zeros((b, width), bool)
        ids[:, 0], near[:, 0], open_[:, 0] = entry, np.einsum("bd,bd->b", targets, vectors[entry]), True
        rows = every
        while True:
            rows = rows[open_[rows].any(axis=1)]
            if not len(rows):
                order = np.argsort(-near, axis=1, kind="stable")
                return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
            best = np.where(open_[rows], -near[rows], np.inf)
            at = np.argpartition(best, few - 1, axis=1)[:, :few]
            row, at = np.repeat(rows, few), at.ravel()
            row, at = row[open_[row, at]], at[open_[row, at]]
            open_[row, at] = False
            next_ = links[ids[row, at]].astype(np.int64)
            cell = (next_ + row[:, None] * n)[next_ >= 0]
            cell = cell[~seen[cell]]
            turn[cell] = np.arange(len(cell), dtype=np.int32)
            cell = cell[turn[cell] == np.arange(len(cell))]  # each once
            seen[cell] = True
            row, next_ = cell // n, cell % n
            gained = _products(targets, row, vectors, next_)
            better = gained > near.min(axis=1)[row]
            row, next_, gained = row[better], next_[better], gained[better]
            if not len(row):
                continue
            order = np.argsort(row, kind="stable")
            row, next_, gained = row[order], next_[order], gained[order]
            to, first, count = np.unique(row, return_index=True, return_counts=True)
            place = np.repeat(np.arange(len(to)), count), width + np.arange(len(row)) - np.repeat(first, count)
            room = (len(to), int(count.max()))
            all_near = np.concatenate([near[to], np.full(room, -np.inf, np.float32)], axis=1)
            all_ids = np.concatenate([ids[to], np.full(room, -1)], axis=1)
            all_open = np.concatenate([open_[to], np.zeros(room, bool)], axis=1)
            all_near[place], all_ids[place], all_open[place] = gained, next_, True
            top = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            ids[to] = np.take_along_axis(all_ids, top, 1)
            near[to] = np.take_along_axis(all_near, top, 1)
            open_[to] = np.take_along_axis(all_open, top, 1)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Numbers of the ``width`` best found for each query, best first."""
        if not len(self.vectors):
            return np.full((len(queries), width), -1, np.int64)
        out = []
        for part in np.array_split(queries.astype(np.float32), len(queries) // TOGETHER + 1):
            entry = np.zeros(len(part), np.int64)
            for links in self.links[:0:-1]:
                entry = self._beam(links, self.vectors, part, entry, 4)[0][:, 0]
            out.append(self._beam(self.links[0], self.vectors, part, entry, width)[0])
        return np.concatenate(out)


def _built(longest: float):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("vec_id")
        vectors = np.stack([np.asarray(v, np.float32) for v in shard["embedding"]])
        graph, order = Graph.build(vectors, longest, int(shard["shard"].iloc[0]))
        ids = [list(map(int, shard["ids"].iloc[i])) for i in order]
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "shard": [int(shard["shard"].iloc[0])],
                "vectors": [graph.vectors.tobytes()],
                "links": [[links.tobytes() for links in graph.links]],
                "ids": [ids],
            }
        )

    return run


def _searched(k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(index) and len(queries):
            stored = index.iloc[0]
            dim = int(stored["dim"])
            vectors = np.frombuffer(stored["vectors"], np.float32).reshape(-1, dim)
            links = [
                np.frombuffer(flat, np.int32).reshape(-1, (1 if level else 2) * LINKS)
                for level, flat in enumerate(stored["links"])
            ]
            graph = Graph(vectors, np.zeros(len(vectors)), links)
            wanted = np.stack([np.asarray(v, np.float32) for v in queries["embedding"]])
            found = graph.search(wanted, max(SEARCH_WIDTH, 2 * (k + 1)))
            for query_id, query, hits in zip(queries["query_id"], wanted.astype(np.float64), found):
                hits = hits[hits >= 0]
                scores = np.einsum("ij,j->i", vectors[hits].astype(np.float64), query)
                own = []
                for at in np.argsort(-scores, kind="stable"):
                    score = float(scores[at])
                    if len(own) >= k and -score > own[k - 1][0]:
                        break  # neither this one nor those after it are among the best
                    own += [(-score, int(i)) for i in stored["ids"][hits[at]] if i != query_id]
                rows += [(query_id, i, -s) for s, i in sorted(own)[:k]]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return run


def nearest(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products found for each
    vector whose vec_id is divisible by ``every``, among all others; ties to smaller vec_id.

    Null and zero vectors, those with null or non-finite components, and rows without a
    vec_id take no part. A query only meets vectors of its own dimension. Of rows with a
    query's vec_id none is a candidate for it. Repeated rows of a candidate count once.
    Other columns are ignored. An empty table gives an empty result.

    Equal vectors are one node of a graph, with their ``k`` + 1 smallest ids, so a vector
    that a third of the rows share neither fills a shard nor hides others. Every row is
    indexed. Shards hold about ``SHARD`` vectors and are built and searched in one task each;
    queries come to a shard in parts of about ``QUERIES_PER_TASK``.
    """
    scratch = Scratch(table)
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<float>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0))
    order = W.partitionBy("embedding").orderBy("vec_id")
    some = rows.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    nodes = scratch.write(
        some.groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.size("embedding").alias("dim"), F.col("ids")[0].alias("vec_id"), "embedding", "ids")
    )
    square = F.aggregate("embedding", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    sizes = scratch.small_side(
        nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("shards"), F.max(square).alias("longest"))
    )
    longest = sizes.agg(F.max("longest")).first()[0] or 0.0
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards"))
    index = scratch.write(
        dealt.select("dim", "shard", "vec_id", "embedding", "ids")
        .groupBy("dim", "shard")
        .applyInPandas(_built(longest), "dim int, shard long, vectors binary, links array<binary>, ids array<array<bigint>>")
    )
    queries = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    queries = scratch.write(queries.select(F.col("vec_id").alias("query_id"), F.size("embedding").alias("dim"), "embedding"))
    parts = queries.count() // QUERIES_PER_TASK + 1
    asked = (
        queries.join(sizes, "dim")
        .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .select("dim", "shard", "part", "query_id", "embedding")
    )
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    key = ["dim", "shard", "part"]
    found = (
        copies.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_searched(k), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
