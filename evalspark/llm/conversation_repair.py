"""Repair of the turn structure of conversations by a shortest path (operator 13).

A conversation's role initials shall read ``(s?(ua)+)?``. The edits are Keep (cost 0), Rerole to
user or assistant (2), Delete (3; the only edit of blank and duplicate rows) and Insert of an
empty user or assistant row anywhere (2); a truncated row that stays adds 1. Among the cheapest
repairs the one with the smallest audit (initials of the edits in order) is taken.

The repair is an ordinary shortest path over a DAG with nodes (rows read, state of the pattern)
and scalar integer weights. Of a weight, the high digits are the cost; below lie ``SLOTS`` base-8
digits for every row, in row order, which hold the letters of the edits there (D < I < K < R, as
in ASCII; 0 pads the end). A row's letters are up to two inserts and then its own edit, so no row's
group is a prefix of another: comparing the digits compares the audits. Minimum of the sums is
thus the cheapest cost first and the least audit second, with no other rule.

How it runs: first occurrences of each (conversation, role, text) by an aggregate with map-side
combine, joined back (a hot group is split by AQE); rows then stream, sorted by conversation and
turn, through the path search, ``WINDOW`` rows at a time. Between windows the sums become their
cost and their rank among the states (which keeps their order), and rows whose edits all surviving
paths share are written out, so neither integers nor buffers grow with the conversation, and deleted
rows keep no text.

Defined cases: a null id, turn, role or text counts as one space in the hash that picks the damage,
a null role or text is one space from there on; rows with a null turn come first, rows of one turn are
ordered by role and text; rows with a null id form one conversation; the initial is the first
character of the role as it is; other columns are ignored; a conversation without rows after
damage has zeros, an empty audit and the hash of the empty string; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Inserts before a row and the row's own edit.
SLOTS = 3
BITS = 3
WINDOW = 256
DIGIT = {"": 0, "D": 1, "I": 2, "K": 3, "R": 4}
#: States of the pattern: nothing yet, after s, after u, after a. Only START and A may end.
START, S, U, A = range(4)
ENDS = (START, A)
ROLE_OF = {"u": "user", "a": "assistant"}
COST = {"K": 0, "R": 2, "D": 3, "I": 2}

FAULTS = ("", "blank", "duplicate", "truncated")


# --- damage and faults, with SQL functions -------------------------------------------------

def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """The damaged rows (conv_id, turn, role, text, gone); dropped rows stay as ``gone``."""
    pick = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), pick.alias("pick"), _or_space("role").alias("role"), _or_space("text").alias("text"))
    text = F.when(F.col("pick").isin(0, 1), F.lit("")).when(F.col("pick") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("pick") == 4, F.lit("user")).when(F.col("pick") == 0, F.lit("")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("pick") == 0).alias("gone"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("pick") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``: 1 blank, 2 duplicate, 3 truncated, 0 none. Equal rows of one turn are
    told apart later, where they are neighbours (see ``_rows``)."""
    word, ended = F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    key = F.md5(F.concat_ws("\x1f", F.length("role").cast("string"), "role", "text"))
    rows = rows.withColumn("same", F.when(~F.col("gone") & word, key))
    # Nulls sort first, so a null turn is the first one; a struct keeps it apart from no row at all.
    place = F.struct(F.coalesce("turn", F.lit(-(2**63)).cast("long")).alias("t"), F.col("turn").isNotNull().alias("has"))
    first = rows.filter(F.col("same").isNotNull()).groupBy(F.col("conv_id").alias("f_conv"), F.col("same").alias("f_same")).agg(
        F.min(place).alias("f_place"), F.max(place).alias("l_place")).filter(F.col("f_place") != F.col("l_place")).drop("l_place")
    rows = rows.join(first, rows["conv_id"].eqNullSafe(first["f_conv"]) & (rows["same"] == first["f_same"]), "left")
    repeated = F.col("f_place").isNotNull() & (place > F.col("f_place"))
    fault = F.when(F.col("gone"), 0).when(~word, 1).when(repeated, 2).when(~ended, 3).otherwise(0)
    return rows.select("conv_id", "turn", "role", F.col("text"), "gone", fault.cast("int").alias("fault"))


# --- the shortest path ----------------------------------------------------------------------

def _after(state: int, initial: str) -> int | None:
    """The state after a row with this initial, if the pattern allows it."""
    if initial == "u" and state != U:
        return U
    if initial == "a" and state == U:
        return A
    return S if initial == "s" and state == START else None


def _next_role(state: int) -> str:
    """The initial that an inserted or reroled row must have."""
    return "a" if state == U else "u"


def _digits(letters: str) -> int:
    """The letters in the slots of one row, zeros after the last."""
    return sum(DIGIT[letter] << (BITS * (SLOTS - 1 - i)) for i, letter in enumerate(letters))


def _edges(initial: str, fault: int) -> list[tuple[int, int, str, int, int]]:
    """(from, to, letters, their digits, cost) of everything that can be done at a row."""
    out = []
    for start in (START, S, U, A):
        state = start
        for inserts in range(SLOTS):
            before, cost = "I" * inserts, COST["I"] * inserts
            out.append((start, state, before + "D", cost + COST["D"]))
            if fault not in (1, 2):
                late = 1 if fault == 3 else 0
                kept = _after(state, initial)
                if kept is not None:
                    out.append((start, kept, before + "K", cost + late))
                out.append((start, _after(state, _next_role(state)), before + "R", cost + COST["R"] + late))
            state = _after(state, _next_role(state))
    return [(a, b, letters, _digits(letters), cost) for a, b, letters, cost in out]


def _tail_edges() -> list[tuple[int, int, str, int, int]]:
    """What may follow the last row: up to two inserts."""
    out = []
    for start in (START, S, U, A):
        state = start
        for inserts in range(SLOTS):
            out.append((start, state, "I" * inserts, _digits("I" * inserts), COST["I"] * inserts))
            state = _after(state, _next_role(state))
    return out


EDGES = {(i, f): _edges(i, f) for i in ("s", "u", "a", "") for f in range(4)}
TAIL = _tail_edges()
#: From any state, two inserts and a deletion make up for having been in any other one. So a
#: state that costs more than that above the cheapest lies on no cheapest path.
MAKE_UP = 2 * COST["I"] + COST["D"]
#: Bits of the rank that stands for all earlier windows.
RANK = 8


def _step(best: dict[int, int], edges: list, shift: int, high: int) -> tuple[dict[int, int], dict[int, tuple[int, str]]]:
    """The least sums after one more row (its digits stand ``shift`` bits up, costs ``high``
    bits), and for each state where its sum came from."""
    sums: dict[int, int] = {}
    came: dict[int, tuple[int, str]] = {}
    for a, b, letters, digits, cost in edges:
        if a in best:
            v = best[a] + (cost << high) + (digits << shift)
            if b not in sums or v < sums[b]:
                sums[b], came[b] = v, (a, letters)
    return sums, came


class _Path:
    """Streaming shortest path of one conversation."""

    def __init__(self):
        self.start = {START: 0}  # state -> sum at the start of the window: cost, then rank below
        self.windows: list[tuple[dict, list]] = []  # searched windows whose edits are open
        self.rows: list[tuple[str, str | None, int]] = []  # (role, text, fault) of the window
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.any = False
        self.cost = 0

    def add(self, role: str, text: str, fault: int) -> None:
        self.rows.append((role, None if fault in (1, 2) else text, fault))
        if len(self.rows) >= WINDOW:
            self._search(last=False)

    def finish(self) -> None:
        self._search(last=True)

    def _search(self, last: bool) -> None:
        """Search the rows of the window; sums are cost, rank of what lies before, digits."""
        n = len(self.rows)
        groups = n + 1 if last else n  # the inserts after the last row take one more group
        low = BITS * SLOTS * groups
        best = {s: v >> RANK << low + RANK | (v & (1 << RANK) - 1) << low for s, v in self.start.items()}
        back: list[dict[int, tuple[int, str]]] = []
        for i in range(groups):
            edges = TAIL if i == n else EDGES[self.rows[i][0][:1] if self.rows[i][0][:1] in ("s", "u", "a") else "", self.rows[i][2]]
            best, came = _step(best, edges, BITS * SLOTS * (groups - 1 - i), low + RANK)
            back.append(came)
        if last:
            v, s = min((best[s], s) for s in ENDS if s in best)
            best, self.cost = {s: v}, v >> low + RANK
        least = min(best.values()) >> low + RANK
        best = {s: v for s, v in best.items() if v >> low + RANK <= least + MAKE_UP}
        self.windows.append((back, self.rows))
        self.rows = []
        below = (1 << low + RANK) - 1
        order = {v: k for k, v in enumerate(sorted({v & below for v in best.values()}))}
        self.start = {s: (v >> low + RANK) << RANK | order[v & below] for s, v in best.items()}
        self._flush(set(best))

    def _flush(self, ends: set[int]) -> None:
        """Write the windows whose paths from all surviving states are one."""
        states, cut = ends, None
        for k in range(len(self.windows) - 1, -1, -1):
            if len(states) == 1:
                cut = k, next(iter(states))
                break
            for came in reversed(self.windows[k][0]):
                states = {came[s][0] for s in states}
        if cut is None:
            return
        k, state = cut
        steps: list[list[tuple[int, str]]] = []
        for back, _ in reversed(self.windows[:k + 1]):
            path = []
            for came in reversed(back):
                before, letters = came[state]
                path.append((before, letters))
                state = before
            steps.append(path[::-1])
        for (_, rows), path in zip(self.windows, reversed(steps)):
            for i, (before, letters) in enumerate(path):
                self._write(before, letters, rows[i] if i < len(rows) else None)
        self.windows = self.windows[k + 1:]

    def _write(self, state: int, letters: str, row) -> None:
        self.audit.append(letters)
        for letter in letters:
            if letter == "D":
                continue
            initial = row[0][:1] if letter == "K" else _next_role(state)
            role = row[0] if letter == "K" else ROLE_OF[initial]
            self.hash.update((("\n" if self.any else "") + f"{role}:{'' if letter == 'I' else row[1]}").encode())
            self.any = True
            state = _after(state, initial)


def repair(rows: list[tuple[str, str, int]]) -> tuple[int, str, str]:
    """(cost, audit, SHA-256 of the repaired rows) of rows (role, text, fault)."""
    path = _Path()
    for row in rows:
        path.add(*row)
    path.finish()
    return path.cost, "".join(path.audit), path.hash.hexdigest()


# --- streaming over sorted rows --------------------------------------------------------------

FIELDS = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}


class _Conversation:
    def __init__(self, key: int | None):
        self.key, self.path = key, _Path()
        self.counts, self.illegal = [0, 0, 0, 0], 0
        self.low = self.high = None
        self.turns = 0
        self.last: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        here = (turn, role, text)
        if fault in (0, 3) and self.last == here:
            fault = 2  # an equal row of the same turn stands right before
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = here
        self.counts[fault] += 1
        self.path.add(role, text, fault)

    def row(self) -> tuple:
        self.path.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, *self.counts[1:], self.illegal, self.path.cost, "".join(self.path.audit), self.path.hash.hexdigest())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(FIELDS)], names=[n for n, _ in FIELDS])

    state, done = None, []
    for part in (p for batch in batches for p, _, _ in C.slices(batch, "text", 1 << 22)):
        cols = [part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault")]
        for conv, turn, role, text, gone, fault in zip(*cols):
            if state is None or state.key != conv:
                if state is not None:
                    done.append(state.row())
                state = _Conversation(conv)
            if not gone:
                state.add(turn, role, text, fault)
        if len(done) >= 4096:
            yield batch_of(done)
            done = []
    if state is not None:
        done.append(state.row())
    if done:
        yield batch_of(done)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired rows of every conversation of rows
    (conv_id, turn, role, text, gone)."""
    C.prepare(rows.sparkSession)
    rows = with_faults(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_rows, SCHEMA)
