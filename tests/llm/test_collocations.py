"""Collocations against plain counting, and the filters' round trip."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tagloom.llm import collocations as module
from tagloom.llm.collocations import collocations
from tagloom.llm.quotient import Packing, QuotientFilters, merged

DOCS = "doc_id long, text string, lang string, n long, word string, a string"


def brute(rows, least, top, percent):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                counts.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    candidates = {g: a for g, a in counts.items() if a >= least and len(g) > 2}
    out = []
    for lang in totals:
        own = []
        for g, a in candidates.items():
            if g[0] != lang:
                continue
            words = g[1:]
            longer = [
                b for h, b in candidates.items()
                if h[0] == lang and len(h) > len(g) and any(h[i : i + len(words)] == words for i in range(1, len(h)))
            ]
            if any(100 * b >= percent * a for b in longer):
                continue
            cuts = [(2_000_000 * a // (counts[lang, *words[:k]] + counts[lang, *words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            own.append((-score, -a, " ".join(words).encode(), counts[lang, *words[:k]], counts[lang, *words[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(own)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "w", "x") for i, (t, lang) in enumerate(rows)], DOCS)


def sample(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "É", "\x1c", "a_b", "日本", "x"] + [f"rare{i}" for i in range(40)]
    weights = [12, 5, 9, 6, 6, 6, 4, 2, 3, 3, 3] + [0.2] * 40
    rows = []
    for _ in range(400):
        parts = [rng.choice(["new york city hall of", " ".join(rng.choices(words, weights, k=rng.randrange(0, 12)))]) for _ in range(4)]
        rows.append((rng.choice([" ", ", ", ".\n", "\t"]).join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "de"), ("one", None), ("big " * 20_000, "en"), rows[0], rows[0]]


@pytest.mark.parametrize("most_words", [1_000_000, 0])
def test_against_counting(spark, most_words):
    rows = sample(1)
    found = collocations(frame(spark, rows), 10, 40, 80, most_words)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows, 10, 40, 80) and len({r[0] for r in got}) == 3


def test_filters_dealt_twice(spark, monkeypatch):
    monkeypatch.setattr(module, "BUCKET_WORDS", 4)
    assert len(module._levels(Packing(60), 27_000)) == 2
    rows = sample(2)
    assert sorted(map(tuple, collocations(frame(spark, rows), 10, 40, 80).collect())) == brute(rows, 10, 40, 80)


def test_empty(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [(None, None), ("few words", "en")])).count() == 0


@pytest.mark.parametrize("highest", [5, 70_000, 2**31 - 1])
def test_filters_keep_all(highest):
    rng, packing = np.random.default_rng(highest), Packing(highest)
    words = rng.integers(0, highest + 1, size=(4, 5000))
    high, low = packing.pairs(words[0], words[1]), packing.pairs(words[2], words[3])
    count = rng.integers(1, 2**40, 5000)
    entries = merged([(*packing.permuted(high, low), count)])
    filters = QuotientFilters(packing, 5)
    buckets = filters.split(entries[0])
    back = []
    for bucket in np.unique(buckets):
        own = [x[buckets == bucket] for x in entries]
        again = filters.read(int(bucket), filters.write(*own))
        assert all((a == b).all() for a, b in zip(own, again))
        back.append(merged([again, again]))
    found = merged(back)
    assert (found[2] == 2 * entries[2]).all()
    high_back, low_back = packing.restored(found[0], found[1])
    wanted = Counter()
    for key, c in zip(zip(high.tolist(), low.tolist()), count.tolist()):
        wanted[key] += 2 * c
    assert dict(zip(zip(high_back.tolist(), low_back.tolist()), found[2].tolist())) == wanted
    assert all((np.r_[packing.words(high)[i]] == words[i]).all() for i in range(2))


def test_empty_filter():
    filters = QuotientFilters(Packing(1), 3)
    none = np.empty(0, np.uint64)
    assert [len(x) for x in filters.read(0, filters.write(none, none, none.astype(np.int64)))] == [0, 0, 0]
