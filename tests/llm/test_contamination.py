"""Decontamination against plain loops."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tagloom.llm.contamination import (
    contamination,
    contamination_digest,
    without_contaminated,
    without_contaminated_spans,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words int, spans string, row int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        words, hit, ids = WORD.findall(lower(text)), set(), set()
        for item_id, item in items:
            own = WORD.findall(lower(item))
            m = min(window, len(own))
            windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
            for i in range(len(words) - m + 1):
                if m and tuple(words[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    ids.add(str("" if item_id is None else item_id))
        joined = ",".join(sorted(ids))
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return out


def tables(spark, docs, items):
    frame = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in docs], DOCS)
    return frame, spark.createDataFrame(items, "item_id long, text string")


def sample(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "É", "x1", "Z", "日本"]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(12)]
    items += [(None, "only here Now"), (3, None), (4, "..."), (5, items[0][1]), (12, "rare")]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(60)]
    docs += [(None, "only HERE now, and more"), (7, None), (8, ""), (9, "rare " * 5000 + "end"), (9, docs[3][1]), (9, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("block_words", [2_000_000, 10])
def test_against_loops(spark, block_words):
    docs, items = sample(1)
    frame, benchmark = tables(spark, docs, items)
    found = contamination(frame, benchmark, 4, block_words).collect()
    got = [
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["n_hit"] > 0)
        for r in found
    ]
    assert sorted(got, key=repr) == sorted(brute(docs, items, 4), key=repr)
    assert [c for c in found[0].asDict()] == ["doc_id", "text", "row", "n_words", "n_hit", "items", "spans"]


def test_digest_and_long_items(spark):
    long_item = " ".join(f"w{i}" for i in range(2500))
    docs = [(1, "start " + " ".join(f"W{i}" for i in range(995, 1030)) + " end"), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9")]
    frame, benchmark = tables(spark, docs, [(1, long_item)])
    rows = contamination_digest(frame, benchmark).collect()
    assert sorted(map(tuple, rows)) == brute(docs, [(1, long_item)], 10)
    assert rows[0]["n_hit"] == 35


def test_removal(spark):
    docs = [(1, "Keep. The Secret; text (here) and on"), (2, "nothing"), (3, None), (1, "the secret text here")]
    frame, benchmark = tables(spark, docs, [(1, "the secret text here")])
    kept = without_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, "nothing"), (3, None)]
    cut = without_contaminated_spans(frame, benchmark)
    assert cut.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=repr) == sorted(
        [(1, "Keep. ) and on"), (2, "nothing"), (3, None), (1, "")], key=repr
    )


def test_empty_tables(spark):
    frame, benchmark = tables(spark, [], [(1, "a")])
    assert contamination_digest(frame, benchmark).count() == 0
    frame, benchmark = tables(spark, [(1, "a")], [])
    assert contamination_digest(frame, benchmark).first()["contaminated"] is False
    assert without_contaminated(frame, benchmark).count() == 1
