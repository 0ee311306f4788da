"""Chat formatting with a grammar round trip (operator 11).

A turn is rendered as ``### role: text</turn>`` and a newline. ``TurnParser`` is a deterministic
parser of that grammar: it reads a role up to the separator and a text up to the close mark.
Marks count as content where an odd run of backslashes stands in front (of a run of k, k // 2
are read as content); backslashes elsewhere are plain text.

Each turn is rendered as it is, parsed again and compared with its source. Where the parser
took content for a mark or an escape (or lost the frame), exactly those places are escaped, and
the turn is rendered and parsed anew, until the recovered turn equals its source. Most texts
are never altered. A rendered turn that reads back starts and ends in the parser's start state,
so a conversation is the concatenation of its turns and reads back as a whole.

``format_conversations`` gives the formatted text of each conversation with its loss spans
(the texts of assistant turns, in code points). Turns are rendered row by row before the only
shuffle; the assembly streams over sorted rows, and a conversation longer than ``part_chars``
comes in several parts of whole turns, so no conversation has to fit into memory.
``read_back`` parses that output alone.

Defined cases: a null role or text is the empty string; rows of a conversation are ordered by
turn, role and rendered text (nulls first), so ties and repeated rows have a defined place; rows with a
null id form one conversation; other columns are ignored, whatever their names; a conversation
without assistant turns has no loss spans; an empty table gives an empty result. Long texts are
handled in linear time: every round parses a turn once, and two rounds suffice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PART_CHARS = 1 << 20


@dataclass(frozen=True)
class ChatTemplate:
    """Marks of the template. No mark may hold a backslash, overlap itself or another mark, and
    only ``end`` may be empty; a text that such marks cannot frame raises an error."""

    opening: str = "### "
    separator: str = ": "
    closing: str = "</turn>"
    end: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)

    def render(self, role: str, text: str) -> str:
        return f"{self.opening}{role}{self.separator}{text}{self.closing}{self.end}"


class ParseError(ValueError):
    """The string is no sequence of turns."""


class TurnParser:
    """Deterministic parser: opening, role, separator, text, closing, end, repeated."""

    def __init__(self, template: ChatTemplate):
        self.template = template
        frame, role = (template.opening, template.closing), (template.opening, template.closing, template.separator)
        # A run of backslashes is taken once and whole, so long runs cost linear time.
        self.in_text = re.compile(r"(?<!\\)(\\*+)(%s)" % "|".join(map(re.escape, frame)))
        self.in_role = re.compile(r"(?<!\\)(\\*+)(%s)" % "|".join(map(re.escape, role)))

    def _field(self, s: str, at: int, marks: re.Pattern, stop: str) -> tuple[str, int, int]:
        """Content from ``at`` up to the first mark that is not escaped, which must be ``stop``:
        (content, end of its rendering, position after the mark)."""
        out, done = [], at
        for m in marks.finditer(s, at):
            slashes = len(m[1])
            out += [s[done:m.start()], "\\" * (slashes // 2)]
            if slashes % 2:
                out.append(m[2])
                done = m.end()
            elif m[2] == stop:
                return "".join(out), m.start(2), m.end()
            else:
                raise ParseError(f"mark {m[2]!r} inside a field at {m.start(2)}")
        raise ParseError(f"no {stop!r} after {at}")

    def turns(self, s: str) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, start, end) of every turn; the rendered text is s[start:end]."""
        t, at = self.template, 0
        while at < len(s):
            if not s.startswith(t.opening, at):
                raise ParseError(f"no {t.opening!r} at {at}")
            role, _, start = self._field(s, at + len(t.opening), self.in_role, t.separator)
            text, end, at = self._field(s, start, self.in_text, t.closing)
            if not s.startswith(t.end, at):
                raise ParseError(f"no {t.end!r} at {at}")
            at += len(t.end)
            yield role, text, start, end

    def unescape(self, body: str) -> str:
        """Content of a rendered text, for instance of a loss span."""
        return self._field(body + self.template.closing, 0, self.in_text, self.template.closing)[0]

    def conflicts(self, content: str, marks: re.Pattern, stop: str) -> list[tuple[int, int]]:
        """Places of the content that the parser would not read as they are: (backslashes in
        front, position) of marks, and of a run of backslashes that touches the closing mark."""
        found = [(len(m[1]), m.start(2)) for m in marks.finditer(content + stop)]
        return [x for x in found if x[1] < len(content) or x[0]]


def _escaped(content: str, places: list[tuple[int, int]]) -> str:
    """Backslashes doubled at the places, and one more in front of a mark of the content."""
    out, done = [], 0
    for slashes, at in places:
        out += [content[done:at], "\\" * (slashes + (at < len(content)))]
        done = at
    return "".join([*out, content[done:]])


def render_turn(role: str, text: str, parser: TurnParser) -> tuple[str, int]:
    """The rendering that reads back as exactly (role, text), and the rounds it took."""
    t = parser.template
    r, x, rounds = role, text, 1
    while True:
        s = t.render(r, x)
        try:
            read = [turn[:2] for turn in parser.turns(s)]
        except ParseError:
            read = []
        if read == [(role, text)]:
            return s, rounds
        if rounds > 1:
            raise ValueError("the marks of this template cannot be escaped")
        r = _escaped(role, parser.conflicts(role, parser.in_role, t.separator))
        x = _escaped(text, parser.conflicts(text, parser.in_text, t.closing))
        rounds += 1


def _rendered(batches: Iterator[pa.RecordBatch], template: ChatTemplate) -> Iterator[pa.RecordBatch]:
    parser = TurnParser(template)
    for batch in batches:
        for rows, _, _ in C.slices(batch, "text"):
            roles, texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
            pieces, rounds, loss = [], [], []
            for role, text in zip(roles, texts):
                role, text = role or "", text or ""
                s, n = render_turn(role, text, parser)
                pieces.append(s)
                rounds.append(n)
                _, _, start, end = next(parser.turns(s))
                loss.append((start, end) if role in template.loss_roles else (0, 0))
            yield pa.RecordBatch.from_arrays(
                [rows.column("conv_id"), rows.column("turn"), rows.column("role"), pa.array(pieces, pa.string()),
                 pa.array([a for a, _ in loss], pa.int64()), pa.array([b for _, b in loss], pa.int64()),
                 pa.array([role in template.loss_roles for role in roles], pa.bool_()), pa.array(rounds, pa.int32())],
                names=["conv_id", "turn", "role", "piece", "loss_start", "loss_end", "in_loss", "rounds"])


PART_SCHEMA = "conv_id long, part long, text string, loss array<struct<start:long,end:long>>, n_turns long, rounds int"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _parts(batches: Iterator[pa.RecordBatch], part_chars: int) -> Iterator[pa.RecordBatch]:
    """Join the sorted turns of each conversation into parts of about ``part_chars``."""
    fields = [("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss", _SPANS), ("n_turns", pa.int64()), ("rounds", pa.int32())]
    out: list[tuple] = []
    out_chars = 0
    key, part, pieces, size, loss, rounds, open_ = None, 0, [], 0, [], 0, False

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f[1]) for i, f in enumerate(fields)], names=[f[0] for f in fields])

    for rows in (part for batch in batches for part, _, _ in C.slices(batch, "piece", 1 << 22)):
        cols = [rows.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end", "in_loss", "rounds")]
        for conv, piece, a, b, in_loss, n in zip(*cols):
            if open_ and (conv != key or size >= part_chars):
                out.append((key, part, "".join(pieces), loss, len(pieces), rounds))
                out_chars += size
                part = part + 1 if conv == key else 0
                pieces, size, loss, rounds = [], 0, [], 0
                if out_chars >= part_chars:
                    yield batch_of(out)
                    out, out_chars = [], 0
            key, open_ = conv, True
            if in_loss:
                loss.append({"start": size + a, "end": size + b})
            pieces.append(piece)
            size += len(piece)
            rounds = max(rounds, n)
    if open_:
        out.append((key, part, "".join(pieces), loss, len(pieces), rounds))
    if out:
        yield batch_of(out)


def format_conversations(conversations: DataFrame, template: ChatTemplate = ChatTemplate(), part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, text, loss spans (within the part), n_turns, rounds of every conversation.

    The parts of a conversation stand in one partition, one after the other; a part holds whole
    turns and is closed once it has ``part_chars`` code points.
    """
    C.prepare(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = rows.mapInArrow(lambda it: _rendered(it, template),
                            "conv_id long, turn long, role string, piece string, loss_start long, loss_end long, in_loss boolean, rounds int")
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "piece")
    return turns.mapInArrow(lambda it: _parts(it, part_chars), PART_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Digest:
    """Running digests of the parts of one conversation."""

    def __init__(self, key: int | None):
        self.key, self.n, self.chars, self.loss_chars = key, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict], parser: TurnParser) -> None:
        for role, body, _, _ in parser.turns(text):
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n += 1
        for span in loss:
            content = parser.unescape(text[span["start"]:span["end"]])
            self.loss.update(content.encode())
            self.loss_chars += len(content)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch], template: ChatTemplate) -> Iterator[pa.RecordBatch]:
    parser, state, done = TurnParser(template), None, []
    names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):  # one part at a time is held as Python strings
            row = batch.slice(i, 1).select(["conv_id", "text", "loss"]).to_pylist()[0]
            if state is None or state.key != row["conv_id"]:
                if state is not None:
                    done.append(state.row())
                state = _Digest(row["conv_id"])
            state.add(row["text"] or "", row["loss"] or [], parser)
        if len(done) >= 4096:
            yield flush(done)
            done = []
    if state is not None:
        done.append(state.row())
    if done:
        yield flush(done)


def read_back(parts: DataFrame, template: ChatTemplate = ChatTemplate(), in_order: bool = False) -> DataFrame:
    """Turns and loss text recovered by the parser from formatted parts, as digests per
    conversation. ``in_order`` says that the parts stand as ``format_conversations`` returns
    them; parts from elsewhere (a table) are first brought together and sorted."""
    C.prepare(parts.sparkSession)
    parts = parts.select("conv_id", "part", "text", "loss")
    if not in_order:
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(lambda it: _read(it, template), DIGEST_SCHEMA)
