"""Corpus operators on small tables: odd rows, ties, repeats, and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tagloom.llm import packing
from tagloom.llm import search as search_module
from tagloom.llm.chosen_path import ChosenPathJoin, near_duplicates, one_of_each, packed, unpacked
from tagloom.llm.components import components
from tagloom.llm.disclosure import personal_data, sanitised
from tagloom.llm.gam import fit, good_documents, quality_scores
from tagloom.llm.hnsw import SEARCH_WIDTH, SHARD, Graph, nearest
from tagloom.llm.lines import dedup_lines, without_shared_lines
from tagloom.llm.mixing import Target, mix
from tagloom.llm.search import search
from tagloom.llm.tables import Scratch
from tagloom.llm.tokens import WordEncoder, encoder, vocabulary_path
from tagloom.llm.tool_calls import Field, link_calls
from tagloom.llm.wavelet import WaveletMatrix, token_files

DOCS = "doc_id long, text string, source string, n_chars long, lang string, row int, hash string, component int"


def docs(spark, rows):
    """Documents with extra columns named as the operators' working columns are."""
    full = [(i, t, s, len(t or ""), "en", 1, "h", 2) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [
    (None, "alone without an id", "a"),
    (1, None, "a"),
    (2, "", None),
    (3, "one", "b"),
    (4, " \n\t ", "b"),
    (5, "word " * 30_000, "b"),
    (6, "same text of a few words here", "c"),
    (6, "same text of a few words here", "c"),
    (7, "Same TEXT of a few words here", "c"),
]

OPERATORS = {
    "pii": personal_data,
    "sanitised": sanitised,
    "near": near_duplicates,
    "kept": one_of_each,
    "mix": lambda d: mix(d, Target(entropy=0.9)),
    "lines": dedup_lines,
    "tokens": token_files,
    "pack": packing.pack,
    "search": search,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_odd_tables(spark, name):
    assert OPERATORS[name](docs(spark, [])).count() == 0
    rows = OPERATORS[name](docs(spark, ODD)).collect()
    if name not in ("search", "mix", "pack", "kept"):
        assert len(rows) == len(ODD)


def test_spans_and_disclosing_words(spark):
    rows = [(i, f"call Zebulon at zeb@corp.example or +1 (555) 010-{1000 + i}x", "a") for i in range(4)]
    rows += [(10 + i, f"other words about nothing in particular {i}", "a") for i in range(40)]
    rows.append((99, "4111 1111 1111 1111 and 10.0.0.256 and 10.0.0.255", "a"))
    found = {r["doc_id"]: r for r in personal_data(docs(spark, rows)).collect()}
    text = rows[0][1]
    at = text.index("Zebulon")
    assert f"remove:{at}:{at + 7}" in found[0]["spans"].split(",")
    assert (found[0]["n_email"], found[0]["n_phone"], found[99]["n_card"], found[99]["n_ip"]) == (1, 1, 1, 1)
    assert found[10]["spans"] == "" and found[10]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs(spark, rows)).collect()}
    assert "Zebulon" not in clean[0] and "[email]" in clean[0] and clean[10] == rows[4][1]


def test_disclosing_words_are_marked_in_every_text(spark):
    rows = [(i, f"Bo Zebulon {i} zeb@corp.example {'1 ' * 200} Quill", "a") for i in range(3)]
    rows += [(5, "so ZEBULON called, and Bo with Quill", "a"), (6, "corp of another example", "a")]
    rows += [(10 + i, f"so and of with another word {i}", "a") for i in range(40)]
    found = {r["doc_id"]: r["spans"] for r in personal_data(docs(spark, rows)).collect()}
    # Zebulon is in four of 45 texts, three of them with the address: ln(45 / 4) / ln(45 / 3) = 0.894.
    assert found[5] == "generalise:3:10,generalise:23:25,generalise:31:36"
    at = rows[0][1].index("Quill")
    assert found[0] == f"generalise:0:2,generalise:3:10,email:13:29,generalise:{at}:{at + 5}"
    assert found[6] == "" and found[10] == ""
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs(spark, rows)).collect()}
    assert clean[5] == "so [word] called, and [word] with [word]" and clean[6] == rows[4][1]


def test_spans_against_a_plain_reading(spark):
    """Base spans and marked words of texts with rare entities, worked out pair by pair."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "klmnprst" for b in ("a", "e", "io", "Ū", "ß")] + ["ΟΔΟΣ", "İs", "𝒜b", "Zoë"]
    texts = []
    for i in range(90):
        words = rng.choices(vocabulary, [1 / (1 + j) for j in range(len(vocabulary))], k=rng.randrange(0, 40))
        if i % 5 == 0:
            entity = rng.choice(["a.b@c.example", f"u{i}@c.example", "10.1.2.3", "+1 (555) 010-2000"])
            words.insert(rng.randrange(len(words) + 1), entity)
            words.insert(rng.randrange(len(words) + 1), {"10.1.2.3": "Ödön", "a.b@c.example": "İs"}.get(entity, f"Only{chr(97 + i // 5)}"))
        texts.append(" ".join(words).replace(" ta ", ". Ta-"))
    texts += [texts[0]] * 3 + [" ".join(f"z{i}@d.example" for i in range(60)) + " Solo", None, "", "only" * 5000]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(None, texts[5], "a")]
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }  # no card in these texts

    def base(text):
        return sorted((m.start(), list(plain).index(k), k, m.end(), m[0]) for k, p in plain.items() for m in re.finditer(p, text))

    def words(text):
        return [(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}+", text)]

    read = [(i, t or "") for i, t, _ in rows]
    spans = [base(t) for _, t in read]
    entities = [{(s[2], re.sub("[^0-9]", "", s[4]) if s[2] == "phone" else s[4].lower()) for s in b} for b in spans]
    clear = [
        {w for a, b, w in words(t) if not any(a <= s[3] and b >= s[0] for s in spans[i] if s[2] == "email")}
        for i, (_, t) in enumerate(read)
    ]
    n, kinds = len(read), {}
    for e in set().union(*entities):
        of_e = [i for i in range(n) if e in entities[i]]
        for w in set().union(*(clear[i] for i in of_e)):
            of_w = [i for i in range(n) if w in clear[i]]
            both = [i for i in of_e if w in clear[i]]
            often = len({read[i][1] for i in both}) >= 3
            share = np.log(len(both) * n / (len(of_e) * len(of_w))) / np.log(n / len(of_e))
            if share >= 0.8 and (often or len(both) == len(of_w)):
                kinds[w] = max(kinds.get(w, ""), "remove" if often and share >= 0.95 else "generalise")
    want = []
    for i, (doc_id, text) in enumerate(read):
        extra = [
            (a, 9, kinds[w], b) for a, b, w in words(text)
            if w in kinds and all(b <= s[0] or a >= s[3] for s in spans[i])
        ]
        every = sorted([s[:4] for s in spans[i]] + extra)
        want.append((doc_id, ",".join(f"{k}:{a}:{b}" for a, _, k, b in every)))
    got = [(r["doc_id"], r["spans"]) for r in personal_data(docs(spark, rows)).collect()]
    order = lambda pair: (pair[0] is None, pair[0] or 0)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum("generalise" in s for _, s in got) > 1 and sum("remove" in s for _, s in got) > 1


def jaccard(a, b, width):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    x, y = grams(a), grams(b)
    return bool(x and y) and 100 * len(x & y) >= 80 * len(x | y)


def brute_components(rows, width):
    low = {i: i for i, _ in rows}
    links = [(i, j) for i, s in rows for j, t in rows if i < j and jaccard(s, t, width)]
    for _ in rows:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    return low


@pytest.mark.parametrize("small_node", [1024, 8])
def test_near_duplicates_against_all_pairs(spark, small_node):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(rng.choice([1, 2, 6, 20])):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(60)] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    join = ChosenPathJoin(2, 80, small_node=small_node)
    found = {r["doc_id"]: r["component"] for r in join.components(frame).collect()}
    assert found == brute_components(rows, 2)


def test_packed_sketches_round_trip():
    low = np.random.default_rng(1).integers(0, 2**63, (3, 64), dtype=np.uint64)
    rows = np.frombuffer(b"".join(map(packed, low)), np.uint8).reshape(3, -1)
    assert rows.shape == (3, 32) and (unpacked(rows) == low % 16).all()
    assert unpacked(rows[:0]).shape == (0, 64)


def test_one_of_each_keeps_clean_documents(spark):
    kept = sorted(r["doc_id"] or -1 for r in one_of_each(docs(spark, ODD)).collect())
    assert kept == [-1, 1, 2, 3, 4, 5, 6]


def test_rows_of_one_doc_id_are_told_apart(spark):
    base = [f"w{i}" for i in range(40)]
    near = " ".join([*base[:39], "other"])
    rows = [(3, " ".join(base), "a"), (7, near, "a"), (7, "an unrelated text that has words of its own", "b")]
    rows += [(7, "an unrelated text that has words of its own", "c"), (9, "an unrelated text that has words of its own", "c")]
    kept = one_of_each(docs(spark, rows))
    assert sorted((r["doc_id"], r["text"][:4]) for r in kept.collect()) == [(3, "w0 w"), (7, "an u")]
    assert kept.columns == docs(spark, rows).columns
    # As documents they are one component, through either text of doc 7.
    found = near_duplicates(docs(spark, rows)).collect()
    assert {r["component_id"] for r in found} == {3} and len(found) == 5


def test_exact_comparison_in_blocks(monkeypatch):
    from tagloom.llm import chosen_path

    monkeypatch.setattr(chosen_path, "BLOCK", 7)
    monkeypatch.setattr(chosen_path, "COLUMNS", 16)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40)
    sets = [np.unique(np.r_[rng.permutation(base)[: 30 + k % 11], rng.integers(0, 2**63, k % 5)]) for k in range(30)]
    component = np.array([k % 9 if k < 12 else 100 + k for k in range(30)])
    found = chosen_path._Exact(80).links(np.arange(30), component, sets)
    low = component.copy()
    for a, b in found:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and low[a] != low[b]
        low[low == low[b]] = low[a]
    for a in range(30):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert low[a] == low[b] or 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(20, 40)] + [(5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in components(frame, Scratch(frame)).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(20, 40)]}}


def test_shared_lines_go_everywhere(spark):
    rows = [(i, f"own {i}\n  Shared LINE \n\nshared line", "a") for i in range(10)] + [(50, "rare\nrare", "a")]
    found = {r["doc_id"]: r for r in dedup_lines(docs(spark, rows)).collect()}
    assert found[3]["text"] == "own 3\n" and (found[3]["n_lines"], found[3]["n_dropped"]) == (4, 2)
    assert found[50]["text"] == "rare\nrare"
    cleaned = without_shared_lines(docs(spark, rows))
    assert cleaned.columns == docs(spark, rows).columns
    assert {r["n_chars"] for r in cleaned.filter("doc_id = 3").collect()} == {6}


def test_mixture_meets_its_limits(spark):
    rows = [(i, "x " * 9, "big") for i in range(90)] + [(100 + i, "y " * 9, "small") for i in range(10)]
    table = docs(spark, rows)
    times = Counter((r["source"], r["doc_id"]) for r in mix(table, Target(repeats=1.5, passes=None)).collect())
    assert {k for k, _ in times} == {"big", "small"} and len(times) == 100
    assert set(times.values()) <= {1, 2} and 14 <= sum(v for (s, _), v in times.items() if s == "small") <= 16
    even = mix(table, Target(entropy=1.0)).collect()
    tokens = Counter(r["source"] for r in even)
    assert abs(tokens["big"] - tokens["small"]) <= 2
    starts = sorted(r["start"] for r in even if r["source"] == "small" and r["pass"] == 0)
    assert starts == [10 * i for i in range(10)]


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 17))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    score = fit(x[:2000], y[:2000]).score(x[2000:])
    assert ((score >= 0.5) == y[2000:]).mean() > 0.93


def test_quality_without_labels_and_held_out_accuracy(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r["score"], 6) for r in quality_scores(docs(spark, ODD), none).collect()} == {0.5}
    folder = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_scores(table, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) >= 0.9 * len(scored)
    assert good_documents(table, labels).columns == table.columns


def test_calls_are_linked_ordered_and_checked(spark):
    calls = [
        (1, 1, None, "add", '{"b": 2, "a": "x"}'),
        (1, 2, 1, "add", '{"a": ""}'),
        (1, 3, 2, "other", "{}"),
        (1, 8, 9, "add", '{"a": "x"}'),
        (1, 9, 8, "add", "no json"),
        (None, 1, None, "add", None),
    ]
    calls = spark.createDataFrame(calls, "conv_id long, call_id long, after_id long, name string, arguments string")
    results = spark.createDataFrame([(1, 1, "z"), (1, 1, "q"), (2, 1, "lost")], "conv_id long, call_id long, content string")
    schemas = {"add": (Field("a"), Field("b", "BIGINT", required=False))}
    found = {(r["conv_id"], r["call_id"]): r for r in link_calls(calls, results, schemas).collect()}
    assert [found[1, i]["level"] for i in (1, 2, 3, 8, 9)] == [0, 1, 2, None, None]
    assert [found[1, i]["valid"] for i in (1, 2, 3, 8, 9)] == [True, False, False, True, False]
    assert found[1, 1]["message"] == '{"arguments":{"a":"x","b":2},"id":"1:1","name":"add","result":["q","z"]}'
    # A result that nobody called for is not lost.
    assert (found[2, 1]["linked"], found[2, 1]["valid"]) == (False, False)
    assert found[2, 1]["message"] == '{"id":"2:1","result":"lost"}' and len(found) == 7
    assert found[None, 1]["level"] is None and not found[None, 1]["linked"]


def test_words_encode_as_whole_texts_do():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(vocabulary_path()), encoder(vocabulary_path())
    rng = random.Random(1)
    parts = ["a", "B's", "É", "ß", "İ", "1", "²", "<|endoftext|>", "́", "한", "Σ", " ", "\n", "\x1c", "\x85", "\xa0", "，", "--", "😀"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(10)))
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_plain_texts_are_encoded_without_their_words(monkeypatch):
    """Words seldom come again with the same case and commas; their pieces do."""
    from tokenizers import Tokenizer

    monkeypatch.setattr("tagloom.llm.tokens.REMEMBERED", 20)
    whole, own = Tokenizer.from_file(vocabulary_path()), WordEncoder(vocabulary_path())
    rng = random.Random(2)
    plain = ["don't", "'LL", "'", "Été,", "ÿ", "ß1", "42", "<", "|", "a|>", " ", "\t", "\n", "\x0b", "\r", "--", "_", "the"]
    for _ in range(3000):
        text = "".join(rng.choices(plain, k=rng.randrange(12))).replace("<|", "")
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
        text += "<|endoftext|>“ \x85"[rng.randrange(14) :]
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    own = WordEncoder(vocabulary_path())
    monkeypatch.setattr(own._words, "_compute", None)
    assert own.ids("Stop, stop!  (STOP)\nÉtés").tolist() == whole.encode("Stop, stop!  (STOP)\nÉtés", add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    rows = [(i, t, "a") for i, t in [(5, "hello world"), (2, None), (9, "a b c" * 50)]]
    found = sorted(map(tuple, token_files(docs(spark, rows)).collect()))
    at = 0
    for (doc_id, start, n, crc), text in zip(found, ["", "hello world", "a b c" * 50]):
        ids = np.append(encoder(vocabulary_path()).ids(text), 1).astype("<u4")
        assert (start, n, crc) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += n


def test_wavelet_matrix_answers():
    ids = np.random.default_rng(0).zipf(1.3, 3000) % 49408
    matrix = WaveletMatrix.build(ids)
    assert (matrix.ids() == ids).all() and all(matrix.access(i) == ids[i] for i in range(0, 3000, 61))
    for token in (0, 1, 2, 40000):
        places = np.flatnonzero(ids == token)
        assert matrix.count(token, 10, 2000) == ((places >= 10) & (places < 2000)).sum()
        assert all(matrix.select(token, k) == (places[k] if k < len(places) else -1) for k in (0, 3, 500))


@pytest.mark.parametrize("spread", [6.4, 8.0])
def test_plan_holds_every_piece_and_no_more_than_best_fit(spread):
    lengths = np.clip(np.random.default_rng(2).lognormal(spread, 1.1, 4000).astype(int) + 1, 1, 4096)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    runs, held = packing.plan(histogram), Counter()
    for times, content in runs:
        assert sum(content) <= 4096
        for length in content:
            held[length] += times
    assert held == Counter(histogram)
    plain = packing.BestFit(4096)
    for length in sorted(histogram, reverse=True):
        plain.place(length, length, histogram[length])
    assert sum(t for t, _ in runs) <= sum(t for t, _ in plain.runs())


def test_pieces_fill_sequences_without_gaps(spark):
    rows = [(i, "word thing " * random.Random(i).randrange(1, 3000), "a") for i in range(60)] + [(60, None, "a")]
    found = packing.pack(docs(spark, rows)).collect()
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len({(r["doc_id"], r["piece"]) for r in found}) == len(found)


def test_search_against_scoring_everything(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 3) for _ in range(rng.randrange(40))), "a") for i in range(300)]
    words = {i: t.split() for i, t, _ in rows}
    df = Counter(w for ws in words.values() for w in set(ws))
    n, average = len(rows), sum(map(len, words.values())) / len(rows)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in search(docs(spark, rows), k=5).collect()}
    for q in range(0, 300, 20):
        terms = set(words[q])
        scores = []
        for i, ws in words.items():
            s = sum(
                np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * ws.count(t) * 2.2 / (ws.count(t) + 1.2 * (0.25 + 0.75 * len(ws) / average))
                for t in terms
            )
            if s and i != q:
                scores.append((-round(s, 6), i))
        want = {(q, r + 1): (i, -s) for r, (s, i) in enumerate(sorted(scores)[:5])}
        assert {k: v for k, v in got.items() if k[0] == q} == want


def test_search_asks_with_the_whole_text(spark):
    rng = random.Random(7)
    words = [f"v{i}" for i in range(260)]
    texts = {i: " ".join(rng.choices(words, [1 / (1 + j) for j in range(260)], k=rng.randrange(30, 200))) for i in range(200)}
    # Forty words in common, each in ten texts, but none of the query's rarest sixteen.
    shared, odd = [f"m{i}" for i in range(40)], [f"x{i}" for i in range(16)]
    texts[20] = " ".join(shared + odd)
    texts[201] = " ".join(shared)
    for i in range(8):
        texts[300 + i] = " ".join(shared + [f"z{i}{j}" for j in range(300)])
    texts[400] = " ".join(odd)
    split = {i: Counter(t.split()) for i, t in texts.items()}
    df = Counter(w for ws in split.values() for w in ws)
    n, average = len(texts), sum(sum(ws.values()) for ws in split.values()) / len(texts)
    found = search(docs(spark, [(i, t, "a") for i, t in texts.items()])).collect()
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found}
    want = {}
    for q in [i for i in texts if i % 20 == 0]:
        scores = []
        for i, ws in split.items():
            s = sum(
                np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * ws[t] * 2.2 / (ws[t] + 1.2 * (0.25 + 0.75 * sum(ws.values()) / average))
                for t in split[q] if t in ws
            )
            if s and i != q:
                scores.append((-round(s, 6), i))
        want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(sorted(scores)[:10])}
    assert got == want and got[20, 1][0] == 201


def test_search_over_many_shards_and_blocks(spark, monkeypatch):
    """The same hits from one shard and one block as from many, with rows that have no id."""
    rng = random.Random(11)
    words = [f"v{i}" for i in range(150)]
    rows = [
        (None if i % 9 == 0 else i % 180, " ".join(rng.choices(words, [1 / (1 + j) for j in range(150)], k=rng.randrange(60))), "a")
        for i in range(240)
    ]
    whole = sorted(map(tuple, search(docs(spark, rows).coalesce(1)).collect()))
    monkeypatch.setattr("tagloom.llm.search.BLOCK_WORDS", 40)
    parts = sorted(map(tuple, search(docs(spark, rows).repartition(12)).collect()))
    assert parts == whole and len(whole) > 50 and all(doc_id is not None for _, _, doc_id, _ in whole)


def test_search_keeps_counts_narrow_and_exact(spark):
    shard = search_module._index_row([(i, f"a b{i} c c") for i in range(300)]).iloc[0]
    assert len(shard["counts"]) == len(shard["docs"]) // 2 == 900
    for most in (1, 255, 256, 65_536):
        counts = np.array([1, most], np.int32)
        assert search_module._widened(search_module._narrow(counts), 2).tolist() == [1, most]
    rows = [(0, "a")] + [(i, "a " * n + f"w{i}") for i, n in enumerate((1, 300, 70_000), 1)]
    lengths = [len(t.split()) for _, t in rows]
    idf, average = np.log(1 + 0.5 / 4.5), sum(lengths) / 4
    scores = [n * 2.2 / (n + 1.2 * (0.25 + 0.75 * (n + 1) / average)) * idf for n in (1, 300, 70_000)]
    found = {r["doc_id"]: r["score"] for r in search(docs(spark, [(i, t, "a") for i, t in rows])).collect()}
    assert found == {i: round(s, 6) for i, s in enumerate(scores, 1)}


def test_search_scores_queries_of_one_kind_together(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(search_module, "QUERIES_AT_ONCE", 8)
    own = {}
    for i in range(32):
        kind = 1000 * (i % 2)
        own[i * 20] = {kind: 900, **{kind + int(t): int(t) for t in rng.choice(np.arange(2, 99), 12, replace=False)}}
    columns = [list(own), [list(q) for q in own.values()], [list(q.values()) for q in own.values()]]
    batches = search_module._batches(pa.table(columns, names=["query_id", "terms", "dfs"]), 5000)
    asked = [q for batch in batches for q in batch.asked.tolist()]
    assert len(batches) == 4 and sorted(asked) == list(own)
    for batch in batches:
        assert len(set(batch.terms // 1000)) == 1
        for i, q in enumerate(batch.asked.tolist()):
            places = batch.places[batch.query == i]
            assert sorted(batch.terms[places].tolist()) == sorted(own[q])
            for term, idf in zip(batch.terms[places].tolist(), batch.idf[places]):
                assert idf == np.log(1 + (5000 - own[q][term] + 0.5) / (own[q][term] + 0.5))


@pytest.mark.parametrize("worth, most", [(1, 0.4), (1600, 0.0), (1600, 1.0), (10**9, 0.0), (10**9, 1.0)])
def test_shards_give_the_same_hits_however_terms_are_added_up(monkeypatch, worth, most):
    monkeypatch.setattr(search_module, "WORTH", worth)
    monkeypatch.setattr(search_module, "MOST", most)
    rng = np.random.default_rng(9)
    chance = 1 / np.arange(1, 301)
    rows = [(i, " ".join(f"w{w}" for w in rng.choice(300, rng.integers(1, 400), p=chance / chance.sum()))) for i in range(500)]
    stored = search_module._index_row(rows).iloc[0]
    terms, starts = np.frombuffer(stored["terms"], np.uint64), np.frombuffer(stored["starts"], np.int32)
    docs, lengths = np.frombuffer(stored["docs"], np.uint16).astype(np.int32), np.frombuffer(stored["lengths"], np.int32)
    counts = search_module._widened(stored["counts"], len(docs))
    table, dfs = np.zeros((len(terms), 500)), np.diff(starts)
    table[np.repeat(np.arange(len(terms)), dfs), docs] = counts
    asked = np.arange(0, 500, 20)
    own = [np.flatnonzero(table[:, q]) for q in asked]
    every = np.concatenate(own)
    batch = search_module.Batch(asked, np.array([len(t) for t in own]), terms[every], dfs[every], 500)
    shard = search_module.ShardIndex(np.arange(500), terms, starts, docs, counts, lengths, lengths.mean())
    hits = search_module.Hits(10, np.full(len(asked), -np.inf))
    shard.search(batch, hits, search_module.Space())
    impact = table * 2.2 / (table + 1.2 * (0.25 + 0.75 * lengths / lengths.mean()))
    for i, q in enumerate(asked):
        score = np.round((np.log(1 + (500 - dfs[own[i]] + 0.5) / (dfs[own[i]] + 0.5))[:, None] * impact[own[i]]).sum(axis=0), 6)
        score[q] = -1
        best = np.lexsort((np.arange(500), -score))[:10]
        assert hits.doc_id[hits.query == i].tolist() == best.tolist()
        assert np.allclose(hits.score[hits.query == i], score[best], atol=2e-6)


def test_a_block_of_a_shard_has_texts_of_one_kind():
    """Texts of two kinds that alternate, some without words and some without an id."""
    texts = [f"{'the of' if i % 2 else 'der und'} x{i} y{i % 7}" if i % 50 else " " for i in range(600)]
    ids = [None if i % 10 == 3 else i for i in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["doc_id", "text"])
    (row,) = (row for out in search_module._indexed(iter([batch])) for row in out.to_pylist())
    found, terms = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["terms"], np.uint64)
    docs, starts = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["starts"], np.int32)
    counts, lengths = search_module._widened(row["counts"], len(docs)), np.frombuffer(row["lengths"], np.int32)
    assert sorted(found.tolist()) == [i for i in ids if i is not None] and row["n"] == len(lengths) == 600
    of_doc = [Counter() for _ in range(600)]
    for term, doc, count in zip(np.repeat(terms, np.diff(starts)), docs, counts):
        of_doc[doc][int(term)] += int(count)
    hashed = lambda text: Counter(search_module.xxhash.xxh64_intdigest(w, search_module.HASH_SEED) for w in text.encode().split())
    assert [of_doc[at] for at in range(len(found))] == [hashed(texts[i]) for i in found]
    assert [sum(c.values()) for c in of_doc] == lengths.tolist()
    kinds = [{i % 2 for i in found[at : at + search_module.BLOCK] if i % 50} for at in range(0, len(found), search_module.BLOCK)]
    assert sum(len(kind) > 1 for kind in kinds) <= 1


def test_shards_have_texts_of_one_kind_and_length(monkeypatch):
    """Consecutive texts are sorted before they are cut into shards."""
    monkeypatch.setattr(search_module, "SHARD", 50)
    texts = [f"{'the of' if i % 2 else 'der und'} x{i} " + "y " * (i % 4 // 2 * 100) for i in range(400)]
    ids = [None if i % 40 == 3 else i for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["doc_id", "text"])
    rows = [row for out in search_module._indexed(iter([batch])) for row in out.to_pylist()]
    found = [np.frombuffer(row["ids"], np.int64).tolist() for row in rows]
    assert sorted(i for own in found for i in own) == [i for i in ids if i is not None]
    assert [row["n"] for row in rows] == [50] * 8 and sum(row["n_words"] for row in rows) == 1200 + 200 * 100
    assert [len({i % 4 for i in own}) for own in found] == [1] * 8


@pytest.mark.parametrize("block, at_once, queries, bound", [(16, 40, 30, False), (16, 40, 30, True), (64, 1 << 16, 300, False), (64, 1 << 16, 300, True)])
def test_blocks_of_a_shard_give_the_best_documents(monkeypatch, block, at_once, queries, bound):
    """Two kinds of texts in many blocks, with rows of the queries' own ids, with and without bounds."""
    monkeypatch.setattr(search_module, "BLOCK", block)
    monkeypatch.setattr(search_module, "LIGHT_AT_ONCE", at_once)
    rng = np.random.default_rng(5)
    chance = 1 / np.arange(1, 401)
    rows = []
    for i in range(350):
        words = rng.choice(400, rng.integers(0, 120), p=chance / chance.sum())
        rows.append((i % 300, " ".join(f"{'ab'[i % 3 % 2]}{w}" for w in words)))
    (row,) = search_module._index_row(rows).to_dict("records")
    terms, starts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["starts"], np.int32)
    docs, lengths = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["lengths"], np.int32)
    counts, ids = np.frombuffer(row["counts"], np.uint8), np.frombuffer(row["ids"], np.int64)
    table, dfs = np.zeros((len(terms), 350)), np.diff(starts)
    table[np.repeat(np.arange(len(terms)), dfs), docs] = counts
    own = [np.flatnonzero(table[:, q]) for q in range(queries)]
    every = np.concatenate(own)
    batch = search_module.Batch(np.arange(queries), np.array([len(t) for t in own]), terms[every], dfs[every], 350)
    impact = table * 2.2 / (table + 1.2 * (0.25 + 0.75 * lengths / lengths.mean()))
    idf = np.log(1 + (350 - dfs + 0.5) / (dfs + 0.5))
    want = []
    for q, t in enumerate(own):
        score = np.round((idf[t][:, None] * impact[t]).sum(axis=0), 6)
        found = [(-s, i) for s, i in zip(score.tolist(), ids.tolist()) if s > 0 and i != q]
        want.append([(i, -s) for s, i in sorted(found)[:10]])
    least = np.array([w[9][1] if bound and len(w) == 10 else -np.inf for w in want])
    hits = search_module.Hits(10, least)
    shard = search_module.ShardIndex(ids, terms, starts, docs, counts, lengths, lengths.mean())
    shard.search(batch, hits, search_module.Space())
    for q, w in enumerate(want):
        mine = hits.query == q
        assert hits.doc_id[mine].tolist() == [i for i, _ in w]
        assert np.allclose(hits.score[mine], [s for _, s in w], atol=2e-6)


def test_search_finds_others_beside_many_rows_of_its_own(spark):
    rows = [(20, "a b c", "a")] * 15 + [(i, f"a b w{i}", "a") for i in range(1, 5)]
    found = sorted((r["rank"], r["doc_id"]) for r in search(docs(spark, rows)).collect())
    assert found == [(i, i) for i in range(1, 5)]


def test_nearest_with_odd_vectors_and_many_equal_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(100)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] * 8), (2080, [1.0, 2.0]), (None, [1.0] * 8)]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows[:500]}
    hits = 0
    for q in [i for i in vectors if i % 20 == 0]:
        want = sorted((-float(v @ vectors[q]), i) for i, v in vectors.items() if i != q)[:20]
        mine = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(mine) == 20
        hits += len({i for _, i in want} & set(mine))
    assert hits >= 0.98 * 20 * len([i for i in vectors if i % 20 == 0])
    assert not {r["query_id"] for r in found} & {2000, 2020, 2040, 2060, 2080}


class CountedReads(np.ndarray):
    reads = 0

    def __getitem__(self, key):
        CountedReads.reads += 1
        return np.asarray(self)[key]


def test_a_beam_follows_the_links_of_several_at_a_time():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(2000, 16)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph, _ = Graph.build(vectors, 1.0)
    graph.links[0] = graph.links[0].view(CountedReads)
    CountedReads.reads = 0
    asked = graph.vectors[::40]
    found = graph.search(asked, SEARCH_WIDTH)
    assert 0 < CountedReads.reads < SEARCH_WIDTH / 2
    near = asked @ graph.vectors.T
    assert all(len(set(row)) == SEARCH_WIDTH and row.min() >= 0 for row in found)
    for own, row in zip(near, found):
        assert (np.diff(own[row]) <= 1e-6).all()
    best = np.argsort(-near, axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(best, found)]) >= 19.8


@pytest.mark.parametrize("kind", ["clusters", "plain"])
def test_recall_of_nearest_on_two_full_shards(spark, kind):
    rng = np.random.default_rng(11)
    n, k = 2 * SHARD, 20
    vectors = rng.normal(size=(n, 64))
    if kind == "clusters":
        vectors = (vectors + 2 * rng.normal(size=(50, 64))[rng.integers(0, 50, n)]) * rng.lognormal(0, 0.5, (n, 1))
    vectors = vectors.astype(np.float32)
    # Few vectors ask, and all may be found.
    ids = np.arange(n) * 20 + (np.arange(n) % 128 != 0)
    table = spark.createDataFrame(list(zip(ids.tolist(), vectors.tolist())), "vec_id long, embedding array<float>")
    found = {}
    for r in nearest(table.repartition(8)).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    exact, hits = vectors.astype(np.float64), 0
    asked = np.flatnonzero(ids % 20 == 0)
    for block in np.array_split(asked, 8):
        scores = exact[block] @ exact.T
        scores[np.arange(len(block)), block] = -np.inf
        for q, own in zip(block, scores):
            best = np.argsort(-own, kind="stable")[:k]
            hits += len(set(ids[best].tolist()) & set(found[ids[q]]))
            assert all(abs(own[(i - i % 20) // 20] - s) < 1e-9 * max(1, abs(s)) for i, s in found[ids[q]].items())
    assert len(found) == len(asked) == 128 and hits / (k * len(asked)) >= 0.93
