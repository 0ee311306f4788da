"""Secret scan with one combined deterministic automaton (operator 5).

The rules' regular expressions are compiled here: parse to a nondeterministic automaton,
subset construction over byte classes, Moore minimisation, transition arrays. Two automata
come out of the same compiler:

* the *search* automaton (all rules, at any position) passes once over the bytes of many
  texts and flags where some rule has completed a match;
* the *span* automaton (all rules in base form, anchored) then runs only in the flagged
  stretches and gives the exact spans, leftmost, longest and non-overlapping per rule.

The pass is vectorised over lanes. After a *reset byte* (every state of both automata falls
back to "nothing matched") no match can continue, so a text buffer is cut into lanes at reset
bytes without losing or splitting any match; stretches are bounded by reset bytes too.

A rule may have a *tail*, which lengthens its matches over later lines: an automaton of its own
runs from the match's end to the longest tail. It stops where nothing can follow, so text
behind one match is not read again for the next. ``private_key`` covers the key's body and END line this
way, and without an END line the full base64 lines below the BEGIN line.

Supported syntax: literals, ``[...]`` classes with ranges, ``(...|...)``, ``? * +``,
``{m}``, ``{m,}``, ``{m,n}``, escapes ``\\xHH \\. \\-`` etc. Patterns are over ASCII bytes;
other code points of a text never match.

Defined cases: null and empty texts have no spans; every row gives one row; offsets are
code points, end exclusive; matches of one rule never overlap, those of different rules may.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


@dataclass(frozen=True)
class Rule:
    """``base`` finds a match; it is kept when it is a whole match of ``keep``.

    ``search`` is the form in the combined automaton; it must match at the end of every
    kept match. The default is ``base``. Several counted runs in one automaton multiply its
    states, so only a rule without a selective start should count there. ``tail`` may match
    newlines; it must not match what starts another match of the rule."""

    kind: str
    base: str
    keep: str
    search: str = ""
    tail: str = ""


def _nocase(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORD = "(" + "|".join(_nocase(w) for w in ("password", "passwd", "secret", "token")) + "|" + _nocase("api") + "_?" + _nocase("key") + ")"
_KEY_END = "-----END ([A-Z]+ )*PRIVATE KEY-----"
#: A key's headers and base64 lines (also with line ends written as escapes) up to its END line,
#: or base64 lines alone.
_KEY_BODY = (r"([A-Za-z0-9+/=:,.\x20\x09\x0A\x0D\x5C]|-[A-Za-z0-9])*" + _KEY_END + r"|(\x0D?\x0A[A-Za-z0-9+/=]{40,})+")
_ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?"""

#: Fixed patterns. The first three are the base kinds; the others are public token formats.
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN + "[A-Za-z0-9+/_.=-]{12,}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{16,}", "[0-9a-f]{16,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", tail=_KEY_BODY),
)
BASE_KINDS = ("assign", "access", "hex")


# --- regular expression -> nondeterministic automaton ---------------------------------------

class _Nfa:
    """States with byte-set moves and empty moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1


class _Parser:
    """Recursive descent; each method returns a syntax tree node."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def parse(self):
        tree = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return ("or", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("seq", parts)

    def repeated(self):
        node = self.atom()
        while self.peek() in ("?", "*", "+", "{") and self.peek():
            c = self.peek()
            self.at += 1
            if c == "{":
                end = self.text.index("}", self.at)
                low, _, high = self.text[self.at:end].partition(",")
                bounded = "," not in self.text[self.at:end]
                self.at = end + 1
                node = ("repeat", node, int(low), int(low) if bounded else (int(high) if high else None))
            else:
                node = ("repeat", node, 1 if c == "+" else 0, 1 if c == "?" else None)
        return node

    def escape(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char(self) -> int:
        c = self.text[self.at]
        self.at += 1
        return self.escape() if c == "\\" else ord(c)

    def atom(self):
        c = self.peek()
        if c == "(":
            self.at += 1
            node = self.alternatives()
            if self.peek() != ")":
                raise ValueError(f"missing ) in {self.text!r}")
            self.at += 1
            return node
        if c == "[":
            self.at += 1
            negated = self.peek() == "^"
            self.at += negated
            chars: set[int] = set()
            while self.peek() != "]":
                low = self.char()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.at += 1
                    chars.update(range(low, self.char() + 1))
                else:
                    chars.add(low)
            self.at += 1
            return ("set", frozenset(set(range(128)) - chars if negated else chars))
        if c == ".":
            self.at += 1
            return ("set", frozenset(set(range(128)) - {10}))
        return ("set", frozenset({self.char()}))


def _build(nfa: _Nfa, tree, start: int) -> int:
    """Add a tree to the automaton from ``start``; returns its last state."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.moves[start].append((tree[1], end))
        return end
    if kind == "seq":
        for part in tree[1]:
            start = _build(nfa, part, start)
        return start
    if kind == "or":
        end = nfa.state()
        for option in tree[1]:
            first = nfa.state()
            nfa.empty[start].append(first)
            nfa.empty[_build(nfa, option, first)].append(end)
        return end
    _, node, low, high = tree
    for _ in range(low):
        start = _build(nfa, node, start)
    if high is None:
        loop = nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, node, loop)].append(loop)
        return loop
    end = nfa.state()
    nfa.empty[start].append(end)
    for _ in range(high - low):
        start = _build(nfa, node, start)
        nfa.empty[start].append(end)
    return end


# --- deterministic automaton -------------------------------------------------------------------

@dataclass
class Dfa:
    """``step[state * n_classes + classes[byte]]`` is the next state times n_classes;
    ``accept[state]`` has one bit per pattern; state 0 is the start."""

    classes: np.ndarray
    n_classes: int
    step: np.ndarray
    accept: np.ndarray

    @property
    def n_states(self) -> int:
        return len(self.accept)


def compile_dfa(patterns: list[str], anywhere: bool) -> Dfa:
    """Combined automaton of the patterns by subset construction and minimisation.

    ``anywhere``: matches may start at every position (the start stays active)."""
    nfa = _Nfa()
    start = nfa.state()
    finals: dict[int, int] = {}
    for k, p in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        finals[_build(nfa, _Parser(p).parse(), first)] = 1 << k

    sets = sorted({m[0] for moves in nfa.moves for m in moves}, key=sorted)
    classes, ids = np.zeros(256, dtype=np.int64), {}
    for b in range(256):
        classes[b] = ids.setdefault(tuple(b in s for s in sets), len(ids))
    member = {c: int(np.flatnonzero(classes == c)[0]) for c in range(len(ids))}

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    origin = closure([start])
    index, order, rows = {origin: 0}, [origin], []
    for here in order:
        row = []
        for c in range(len(ids)):
            b = member[c]
            there = {t for s in here for chars, t in nfa.moves[s] if b in chars}
            there = closure(there) | origin if anywhere else closure(there)
            if there not in index:
                index[there] = len(order)
                order.append(there)
            row.append(index[there])
        rows.append(row)
    step = np.array(rows, dtype=np.int64)
    accept = np.array([sum({finals[s] for s in states if s in finals}) for states in order], dtype=np.int64)

    # Moore: split blocks by accepted patterns, then by the blocks that their moves lead to
    block = np.unique(accept, return_inverse=True)[1]
    while True:
        key = np.concatenate([block[:, None], block[step]], axis=1)
        finer = np.unique(key, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    n = block.max() + 1
    first = np.array([int(np.flatnonzero(block == b)[0]) for b in range(n)])
    rank = np.empty(n, dtype=np.int64)  # new numbers: start first, accepting states last
    rank[np.lexsort((accept[first] > 0, np.arange(n) != block[0]))] = np.arange(n)
    rank_order = np.argsort(rank)
    small = rank[block[step[first]]][rank_order]
    return Dfa(classes, len(ids), (small * len(ids)).astype(np.int32).ravel(), accept[first][rank_order])


class Scanner:
    """Compiled rules; ``spans(texts)`` gives (kind index, start, end) in bytes."""

    LANES = 2048

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.search = compile_dfa([r.search or r.base for r in rules], anywhere=True)
        self.base = [compile_dfa([r.base], anywhere=False) for r in rules]
        self.keep = [compile_dfa([r.keep], anywhere=False) for r in rules]
        self.tails = {k: compile_dfa([r.tail], anywhere=False) for k, r in enumerate(rules) if r.tail}
        everywhere = compile_dfa([r.base for r in rules], anywhere=True)
        self.reset = np.ones(256, dtype=bool)
        for dfa in (self.search, everywhere):
            table = dfa.step.reshape(dfa.n_states, dfa.n_classes)
            self.reset &= (table == 0).all(axis=0)[dfa.classes]
        accepting = np.flatnonzero(self.search.accept)
        self.limit = np.int32(accepting.min() * self.search.n_classes) if len(accepting) else np.iinfo(np.int32).max
        self.first = [np.flatnonzero(d.step[:d.n_classes][d.classes] != self._dead(d)) for d in self.base]
        self.first = [frozenset(int(x) for x in f) for f in self.first]
        self.fast = []
        for d in [*self.base, *self.keep]:
            self.fast.append((d.classes.tolist(), d.step.tolist(), d.accept.tolist(), d.n_classes, self._dead(d)))

    @staticmethod
    def _dead(d: Dfa) -> int:
        """The state (times n_classes) from which nothing is accepted any more."""
        table = d.step.reshape(d.n_states, d.n_classes) // d.n_classes
        for s in range(d.n_states):
            if not d.accept[s] and (table[s] == s).all():
                return s * d.n_classes
        return -1

    def flagged(self, buf: np.ndarray) -> np.ndarray:
        """Positions whose byte completes or continues a match of some rule: one pass."""
        n = len(buf)
        if n == 0:
            return np.empty(0, dtype=np.int64)
        lanes = max(1, min(self.LANES, n // 64))
        resets = np.flatnonzero(self.reset[buf]) + 1
        cuts = np.arange(1, lanes) * (n // lanes)
        at = np.searchsorted(resets, cuts)
        cuts = resets[at[at < len(resets)]]
        bounds = np.unique(np.concatenate([[0], cuts, [n]]))
        lo, size = bounds[:-1], np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        lo, size = lo[order], size[order]
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")  # lanes longer than k
        symbols = self.search.classes.astype(np.int32)[buf]
        step, limit = self.search.step, self.limit
        state = np.zeros(len(lo), dtype=np.int32)
        hits = []
        for k in range(int(size[0])):
            m = int(alive[k])
            if m < len(state):
                state, lo = state[:m], lo[:m]
            state = step[state + symbols[lo + k]]
            hit = state >= limit
            if hit.any():
                hits.append(lo[hit] + k)
        return np.sort(np.concatenate(hits)) if hits else np.empty(0, dtype=np.int64)

    def spans_in(self, text: bytes) -> list[tuple[int, int, int]]:
        """Exact spans inside a stretch that no match crosses, by the anchored automata."""
        found = []
        for k, first in enumerate(self.first):
            classes, step, accept, n_classes, dead = self.fast[k]
            at, n = 0, len(text)
            while at < n:
                if text[at] not in first:
                    at += 1
                    continue
                state, end, i = 0, -1, at
                while i < n:
                    state = step[state + classes[text[i]]]
                    if state == dead:
                        break
                    i += 1
                    if accept[state // n_classes]:
                        end = i
                if end <= at:
                    at += 1
                    continue
                if self._whole(len(self.rules) + k, text, at, end):
                    found.append((k, at, end))
                at = end
        return found

    def _whole(self, which: int, text: bytes, at: int, end: int) -> bool:
        classes, step, accept, n_classes, dead = self.fast[which]
        state = 0
        for b in text[at:end]:
            state = step[state + classes[b]]
            if state == dead:
                return False
        return bool(accept[state // n_classes])

    def spans(self, buf: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, kind, start, end) over all rows of a buffer, in bytes from the row's start."""
        out = []
        hits = self.flagged(buf)
        if len(hits) == 0:
            return out
        # stretches: between reset bytes, and never beyond the row
        row = np.searchsorted(off, hits, side="right") - 1
        edges = np.union1d(np.flatnonzero(self.reset[buf]) + 1, off)
        at = np.searchsorted(edges, hits, side="right") - 1
        keep = np.concatenate([[True], at[1:] != at[:-1]])
        for r, e in zip(row[keep].tolist(), at[keep].tolist()):
            lo = int(edges[e])
            hi = int(edges[e + 1]) if e + 1 < len(edges) else len(buf)
            base = lo - int(off[r])
            stop = int(off[r + 1])
            out.extend((r, k, base + s, base + t if k not in self.tails else self._tail_end(k, buf, lo + t, stop) - int(off[r]))
                       for k, s, t in self.spans_in(buf[lo:hi].tobytes()))
        return out

    def _tail_end(self, k: int, buf: np.ndarray, at: int, stop: int) -> int:
        """End of the longest tail from ``at`` within the row."""
        d = self.tails[k]
        dead, state, end = self._dead(d), 0, at
        for lo in range(at, stop, 4096):
            for i, symbol in enumerate(d.classes[buf[lo:min(lo + 4096, stop)]].tolist(), lo):
                state = int(d.step[state + symbol])
                if state == dead:
                    return end
                if d.accept[state // d.n_classes]:
                    end = i + 1
        return end


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def _separated(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with one newline after each, so that no match runs from row to row."""
    n = len(off) - 1
    shifted = off + np.arange(n + 1)
    out = np.full(int(shifted[-1]), 10, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[shifted[1:] - 1] = False
    out[keep] = buf
    return out, shifted


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``carry`` columns of every document plus spans: array of (kind, start, end) in code
    points, ordered by start and then by the rules' order."""
    carry = ["doc_id"] if carry is None else carry
    fields = docs.select(*carry).schema
    if "\n" in "".join(r.base for r in rules):
        raise ValueError("rules must not match newlines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for rows, buf, off in C.slices(batch, "__text"):
                joined, bounds = _separated(buf, off)
                chars = np.zeros(len(joined) + 1, dtype=np.int64)
                np.cumsum((joined & 0xC0) != 0x80, out=chars[1:])
                spans: list[list[dict]] = [[] for _ in range(rows.num_rows)]
                for r, k, s, e in scan.spans(joined, bounds):
                    b = int(bounds[r])
                    spans[r].append({"kind": rules[k].kind, "start": int(chars[b + s] - chars[b]), "end": int(chars[b + e] - chars[b]), "k": k})
                for x in spans:
                    x.sort(key=lambda y: (y["start"], y["k"]))
                    for y in x:
                        del y["k"]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(spans, kind_type)], names=[*rows.schema.names[:-1], "spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", spans array<struct<kind:string,start:long,end:long>>"
    return docs.select(*carry, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def redact(text: str | None, spans: list, mark: str = "<{kind}>") -> str | None:
    """The text with every span replaced; overlapping spans become one mark."""
    if text is None or not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for s in spans:
        if merged and s[1] < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], s[2])
        else:
            merged.append([s[0], s[1], s[2]])
    for kind, start, end in merged:
        out += [text[at:start], mark.format(kind=kind)]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents, all columns and rows kept, with secrets replaced by ``<kind>``."""
    fields = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            for rows, buf, off in C.slices(batch, text_col):
                joined, bounds = _separated(buf, off)
                by_row: dict[int, list] = {}
                for r, k, s, e in scan.spans(joined, bounds):
                    by_row.setdefault(r, []).append((k, s, e))
                column = rows.column(at)
                if by_row:
                    texts = column.to_pylist()
                    for r, spans in by_row.items():
                        raw = texts[r].encode()
                        spans = sorted(spans, key=lambda x: (x[1], x[0]))
                        # spans are ASCII, so latin-1 keeps one character per byte
                        marked = [(rules[k].kind, s, e) for k, s, e in spans]
                        texts[r] = redact(raw.decode("latin-1"), marked).encode("latin-1").decode()
                    column = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays([column if i == at else c for i, c in enumerate(rows.columns)], schema=rows.schema)

    return docs.mapInArrow(run, fields)
