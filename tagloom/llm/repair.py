"""Conversation structure repair as a shortest path over a lattice of edits.

A conversation's rows are the layers of a lattice, the states of a well-formed dialogue its
nodes, edits its arcs with whole-number costs. Bertsekas' auction algorithm grows a path
from the origin: the end node takes the arc that is cheapest at the prices of what lies
ahead, or, where its own price is too low for that, raises it and gives the node up. At the
end prices are a dual solution: an arc is on a cheapest path only if it is tight, that is
if its cost is just the difference of the prices, and the least audit text is read off the
tight arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import ASCII_SPACE, digest

# Rows that are repaired together; a longer conversation is a chain of such chunks.
CHUNK = 64
KEEP, REROLE, DELETE, INSERT, UNDELETED = 0, 1, 2, 5, 5
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES, START, SYSTEM, USER, ASSISTANT = 4, 0, 1, 2, 3
NEVER = float("inf")
# By state, the state an added or renamed turn leads to: user first, then in turns.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_LEGAL = ("su", "ua", "au")


def lattice(rows: list[tuple], last: bool) -> list[list[tuple[str, int, int]]]:
    """The arcs ``(edit, cost, node)`` of each node, for rows ``(role, text, fault)``.

    Node 4 * i + state lies before row i. Turns may be added before each row, and after the
    last one of the conversation, where an end node follows."""
    arcs: list[list[tuple[str, int, int]]] = []
    for i, (role, _, fault) in enumerate(rows):
        extra = UNDELETED if fault == TRUNCATED else 0
        for state in range(STATES):
            after = _NEXT[state]
            own = [("D", DELETE, STATES * (i + 1) + state), ("I", INSERT, STATES * i + after)]
            if fault not in (BLANK, DUPLICATE):
                kept = _KEPT.get((state, role[:1]))
                if kept is not None:
                    own.append(("K", KEEP + extra, STATES * (i + 1) + kept))
                own.append(("R", REROLE + extra, STATES * (i + 1) + after))
            arcs.append(own)
    n = len(rows)
    for state in range(STATES):
        own = []
        if last:
            own.append(("I", INSERT, STATES * n + _NEXT[state]))
            if state in (START, ASSISTANT):
                own.append(("", 0, STATES * (n + 1)))
        arcs.append(own)
    return arcs + ([[]] if last else [])


def auction(arcs, prices: list[float], origin: int, end: int) -> float:
    """The cost from ``origin`` to ``end``; raises ``prices`` until they prove it.

    Prices must not exceed any arc's cost plus the price ahead of it; nodes that cannot
    reach the end must be priced ``NEVER``. They may come from another origin's run."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        if prices[node] == NEVER:
            return NEVER
        ahead, best = min(((cost + prices[to], to) for _, cost, to in arcs[node]), default=(NEVER, -1))
        if prices[node] < ahead:  # contract
            prices[node] = ahead
            if len(path) > 1:
                path.pop()
        else:  # extend
            path.append(best)
    return prices[origin] - prices[end]


def least_tight_path(arcs, prices: list[float], origin: int, end: int) -> str:
    """The least text of edits, in ASCII order, over tight arcs from ``origin`` to ``end``."""
    dead: set[int] = set()
    path, edits, ways = [origin], [], []

    def tight(node: int):
        found = [(edit, to) for edit, cost, to in arcs[node] if prices[node] == cost + prices[to] != NEVER and to not in dead]
        return iter(sorted(found))

    ways.append(tight(origin))
    while path[-1] != end:
        step = next(((e, to) for e, to in ways[-1] if to not in dead), None)
        if step is None:  # tight, but not on the way to the end
            dead.add(path.pop())
            ways.pop(), edits.pop()
        else:
            edits.append(step[0]), path.append(step[1]), ways.append(tight(step[1]))
    return "".join(edits)


def cheapest(rows: list[tuple], last: bool, origins: list[int]) -> dict[tuple[int, int], tuple[int, str]]:
    """``{(state before, state after): (cost, edits)}`` of a chunk; after the last chunk of
    a conversation there is one end, with state 0."""
    arcs = lattice(rows, last)
    n, out = len(rows), {}
    for after in (START,) if last else range(STATES):
        end = STATES * (n + 1) if last else STATES * n + after
        prices: list[float] = [0.0] * len(arcs)
        if not last:
            for node in range(len(arcs)):
                # Nothing leads back to the start or to just after a system turn.
                before = node % STATES
                stuck = before > after if after in (START, SYSTEM) else False
                if stuck or (node >= STATES * n and node != end):
                    prices[node] = NEVER
        costs = {o: auction(arcs, prices, o, end) for o in origins}
        for o, cost in costs.items():
            if cost != NEVER:
                out[o, after] = (int(cost), least_tight_path(arcs, prices, o, end))
    return out


def repaired(rows: list[tuple], edits: str, state: int) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the rows after the edits."""
    left = iter(rows)
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            yield _ROLE[state], ""
            continue
        role, text, _ = next(left)
        if edit == "K":
            state = _KEPT[state, role[:1]]
            yield role, text
        elif edit == "R":
            state = _NEXT[state]
            yield _ROLE[state], text


class _Way:
    """A cheapest way from a conversation's start to a state; ``rank`` is its text's place
    among those to the other states."""

    def __init__(self, cost: int, rank: int, audit: list[str], sha, begun: bool):
        self.cost, self.rank, self.audit, self.sha, self.begun = cost, rank, audit, sha, begun

    def on(self, cost: int, edits: str, rows: list[tuple], state: int) -> _Way:
        sha, begun = self.sha.copy(), self.begun
        for role, text in repaired(rows, edits, state):
            sha.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        return _Way(cost, 0, [*self.audit, edits], sha, begun)


class _Conversation:
    """Takes one conversation's rows in order and holds at most a chunk of them."""

    def __init__(self, conv):
        self.conv, self.rows, self.ways = conv, [], {START: _Way(0, 0, [], hashlib.sha256(), False)}
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.faults[fault] += 1
        if self.before is not None and self.before[:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        self.before = role
        if len(self.rows) == CHUNK:
            self.advance(False)
        self.rows.append((role, text, fault))

    def advance(self, last: bool) -> None:
        steps = cheapest(self.rows, last, sorted(self.ways))
        ends: dict[int, tuple] = {}
        for (before, after), (cost, edits) in steps.items():
            way = self.ways[before]
            found = (way.cost + cost, way.rank, edits, before)
            if after not in ends or found < ends[after]:
                ends[after] = found
        ways = {}
        for rank, (after, (cost, _, edits, before)) in enumerate(sorted(ends.items(), key=lambda e: e[1][1:3])):
            ways[after] = self.ways[before].on(cost, edits, self.rows, before)
            ways[after].rank = rank
        self.ways, self.rows = ways, []

    def result(self) -> tuple:
        self.advance(True)
        way = self.ways[START]
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, way.cost, "".join(way.audit), way.sha.hexdigest())


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, for rows that come sorted by conversation."""
    current, done, kind = None, [], None

    def out() -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_RESULT])

    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, dropped, turn, role, text, fault in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "dropped", "turn", "role", "text", "fault"))
        ):
            if current is None or current.conv != conv:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(conv)
            if not dropped:
                current.add(turn, role, text, fault)
        if done:
            yield out()
    if current is not None:
        done.append(current.result())
        yield out()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text, dropped, copy)`` with faults put in by rule.

    The crc32 of ``conv_id:turn`` modulo 20 says how: 0 drops the row (it stays here, marked
    ``dropped``), 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it a user's.
    Nulls in the four columns count as one space, except that a turn stays null.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind, text = F.col("kind"), F.coalesce(F.col("text").cast("string"), space)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        text.alias("text"),
        (F.crc32(key) % 20).alias("kind"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _undamaged(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")],
        F.lit(False).alias("dropped"),
        F.lit(0).alias("copy"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: the first that holds of blank, duplicate (role and text earlier in the
    conversation) and truncated (no ``.!?`` at the end)."""
    bare: Column = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    same = W.partitionBy("conv_id", "dropped", "role", digest(F.col("text"))).orderBy("turn", "copy")
    return rows.withColumn("place", F.row_number().over(same)).select(
        *rows.columns,
        F.when(F.col("dropped"), NO_FAULT)
        .when(bare == "", BLANK)
        .when(F.col("place") > 1, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(NO_FAULT)
        .alias("fault"),
    )


def _result_schema(rows: DataFrame) -> str:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return f"conv_id {kind}, " + ", ".join(f"{c} {'string' if c in _RESULT[-2:] else 'long'}" for c in _RESULT)


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)`` for rows of ``with_faults``."""
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    return ordered.mapInArrow(_repairs, _result_schema(rows))


def repair_digest(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """What ails each conversation of ``(conv_id, turn, role, text)`` and its cheapest repair.

    Rows go by turn, nulls first; equal turns by role, then text, then copy. A row is kept
    (cost 0), given the role user or assistant (1) or deleted (2; blank and duplicate rows
    must be), and an empty user or assistant turn may be added anywhere (5); a truncated row
    that stays costs 5 more. What is left must read, by the roles' first letters, as
    ``(s?(ua)+)?``. Of the cheapest edits ``audit`` is the ASCII-least text.

    Every conv_id comes out once, null as one conversation; one whose rows are all dropped
    has zeros, an empty audit and the hash of nothing. Nulls count as one space, so a null
    text is blank and a null role must be renamed or deleted. Other columns are ignored. An
    empty table gives an empty result.

    Faults are found before a conversation's rows meet. Its rows then stream through one
    task in order, since the repaired text's SHA-256 has to read them in order, ``CHUNK`` rows
    at a time: memory does not grow with the conversation but for its audit.
    """
    return audits(with_faults(damaged(conversations) if damage else _undamaged(conversations)))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn, role, text, edit)``: the rows after the cheapest repair of
    ``repair_digest``. Added turns have a null ``turn``; deleted rows are left out."""
    rows = with_faults(_undamaged(conversations))
    in_order = W.partitionBy("conv_id").orderBy("turn", "role", "text", "copy")
    numbered = rows.select("conv_id", F.row_number().over(in_order).alias("number"), "turn", "role", "text")
    edits = audits(rows).select("conv_id", F.posexplode(F.split("audit", "")).alias("place", "edit")).filter("edit <> ''")
    in_text = W.partitionBy("conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    # An edit that adds nothing is about the row of its number.
    number = F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(in_text))
    edits = edits.withColumn("number", number)
    joined = edits.alias("e").join(
        numbered.alias("r"),
        F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("e.number") == F.col("r.number")),
        "left",
    )
    left = joined.filter("edit <> 'D'").select("e.conv_id", "place", "turn", "role", "text", "edit")
    # Kept roles are as they were; the others alternate, by the number of turns before them.
    first = F.first(F.when(F.col("edit") == "K", F.substring("role", 1, 1)).otherwise("u")).over(in_text)
    turn_number = F.row_number().over(W.partitionBy("conv_id").orderBy("place")) - F.when(first == "s", 1).otherwise(0)
    role = F.when(F.col("edit") == "K", F.col("role")).when(turn_number % 2 == 1, "user").otherwise("assistant")
    return left.select(
        "conv_id",
        F.row_number().over(W.partitionBy("conv_id").orderBy("place")).cast("long").alias("place"),
        "turn",
        role.alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "edit",
    )
