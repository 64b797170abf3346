"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from tagloom.llm import repair
from tagloom.llm.repair import repair_digest, repaired_conversations

SCHEMA = "conv_id long, turn long, role string, text string, fault int, audit string"
SPACE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def broken(rows):
    """The rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def answer(rows):
    seen, faults, counts = set(), [], [0, 0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit, out = search(rows, faults)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts[1:], illegal, cost, audit, digest)


def search(rows, faults):
    """Cheapest edits, least text first: Dijkstra over (row, shape so far)."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, shape, out = heapq.heappop(heap)
        if (i, shape) in done:
            continue
        done.add((i, shape))
        if i == len(rows) and shape in ("", "a"):
            return cost, audit, out

        def go(more, edit, j, initial, turn):
            after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((shape, initial))
            if after:
                heapq.heappush(heap, (cost + more, audit + edit, j, after, (*out, turn)))

        for role in ("user", "assistant"):
            go(5, "I", i, role[0], (role, ""))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, shape, out))
            if faults[i] not in (1, 2):
                extra = 5 if faults[i] == 3 else 0
                go(extra, "K", i + 1, own[:1], (own, text))
                for role in ("user", "assistant"):
                    go(1 + extra, "R", i + 1, role[0], (role, text))


def sample(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", None, "Well. ", "Long " * 400 + ".", "é…", "same. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randrange(1, longest)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(texts) if rng.random() < 0.5 else f"t{turn}."))
    return rows


@pytest.mark.parametrize(("seed", "conversations", "longest", "chunk"), [(1, 300, 9, 64), (2, 12, 60, 64), (3, 20, 40, 4), (4, 3, 400, 64)])
def test_digest_against_search(spark, monkeypatch, seed, conversations, longest, chunk):
    rows = sample(seed, conversations, longest)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    # Chunks are set on the workers, so small ones are tested without Spark.
    wanted = {conv: answer(broken(own)) for conv, own in groups.items()}
    if chunk == 64:
        found = repair_digest(frame(spark, rows)).collect()
        assert {r[0]: tuple(r)[1:] for r in found} == wanted and len(found) == len(wanted)
        return
    monkeypatch.setattr(repair, "CHUNK", chunk)
    for conv, own in groups.items():
        run, seen = repair._Conversation(conv), set()
        for turn, role, text in broken(own):
            bare = text.rstrip(SPACE)
            run.add(turn, role, text, 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        assert run.result()[1:] == wanted[conv]


def test_empty_table_and_dropped_conversation(spark):
    assert repair_digest(frame(spark, [])).count() == 0
    assert repaired_conversations(frame(spark, [])).count() == 0
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair_digest(frame(spark, [(conv, 0, "user", "Hi.")])).first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(spark):
    rows = [r for r in sample(5, 60, 12)]
    found = defaultdict(list)
    for r in sorted(repaired_conversations(frame(spark, rows)).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["place"])):
        found[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair_digest(frame(spark, rows), damage=False).collect()}
    assert len(digests) == 61
    for conv, digest in digests.items():
        assert hashlib.sha256("\n".join(found[conv]).encode()).hexdigest() == digest


def test_conversation_ids_of_text(spark):
    rows = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Ho.")], "conv_id string, turn int, role string, text string")
    assert repair_digest(rows, damage=False).first()["audit"] == "KK"
