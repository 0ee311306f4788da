"""Entity-level precision / recall / F1 of tag sequences, lenient or by a strict scheme.

A scheme says of two neighbouring tags whether an entity starts at the second one (``start``),
goes on through it (``inside``) or has ended before it (``end``). Wherever ``inside`` is false
a run begins; an entity starts at the first start of its run and counts if the next run begins
with an end. (Only IOB1 can start one tag after its run, so two places are looked at.)

Tag lists (the usual input) are cut into entities inside their row, all lists of an Arrow batch at
once and in time proportional to their length; nothing is shuffled before the counts per type. Long rows
``(keys, item, pos, true, pred)`` serve sequences that no row can hold: positions are cut into
blocks of ``BLOCK``, the rows at a block's edges go to both blocks, and neighbours come from a
window inside the block. An entity that crosses an edge takes its start from the blocks before,
of which one row each is kept. Both tag columns are read in one pass, and an entity that both
have ends on the same row, so true positives need no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import long_from_wide, safe_ratio

#: Positions per block of a long sequence.
BLOCK = 1 << 16
ANY, SAME, DIFF = "any", "same", "diff"
_ALL = "IOBESLU"


def _prefix(tag: Column) -> Column:
    return F.substring(tag, 1, 1)


def _lenient_type(tag: Column) -> Column:
    rest = F.substr(tag, F.lit(2))
    t = F.element_at(F.split(rest, "-", 2), -1)
    return F.when((t.isNull()) | (t == ""), F.lit("_")).otherwise(t)


def _strict_type(tag: Column) -> Column:
    t = F.regexp_replace(F.substr(tag, F.lit(2)), "^-+|-+$", "")
    return F.when((t.isNull()) | (t == ""), F.lit("_")).otherwise(t)


def _in(value: str | None, letters: str) -> bool | None:
    return None if value is None else value in tuple(letters)


def _and(*xs: bool | None) -> bool | None:
    return False if False in xs else None if None in xs else True


def _or(*xs: bool | None) -> bool | None:
    return True if True in xs else None if None in xs else False


def _not(x: bool | None) -> bool | None:
    return None if x is None else not x


@dataclass(frozen=True)
class Scheme:
    """Patterns (previous prefixes, current prefixes, relation of the types)."""

    allowed: str
    start: tuple
    inside: tuple
    end: tuple

    def type_of(self, tag: Column) -> Column:
        return _strict_type(tag)

    def valid(self, tag: Column) -> Column:
        return F.coalesce(_prefix(tag).isin(*self.allowed), F.lit(False))

    def first_type(self) -> str:
        return "_"

    def type_in(self, tag: str) -> str:
        """``type_of`` of a value."""
        return tag[1:].strip("-") or "_"

    def knows(self, prefix: str | None) -> bool:
        return prefix in tuple(self.allowed)

    def flags_in(self, pp, pt, p, t) -> tuple:
        """``flags`` of values; null prefixes give null flags by the rules of SQL."""
        related = {ANY: True, SAME: pt == t, DIFF: pt != t}
        return tuple(_or(*[_and(_in(pp, a), _in(p, b), related[r]) for a, b, r in x]) for x in (self.start, self.inside, self.end))

    def flags(self, pp: Column, pt: Column, p: Column, t: Column) -> tuple[Column, Column, Column]:
        return tuple(self._any(x, pp, pt, p, t) for x in (self.start, self.inside, self.end))

    @staticmethod
    def _any(patterns: tuple, pp, pt, p, t) -> Column:
        out = F.lit(False)
        for before, now, relation in patterns:
            hit = pp.isin(*before) & p.isin(*now)
            out = out | (hit if relation == ANY else hit & ((pt == t) if relation == SAME else (pt != t)))
        return out


class Lenient(Scheme):
    """The default mode: whatever tags occur are cut as sensibly as possible."""

    def type_of(self, tag: Column) -> Column:
        return _lenient_type(tag)

    def valid(self, tag: Column) -> Column:
        return F.lit(True)

    def first_type(self) -> str:
        return ""

    def type_in(self, tag: str) -> str:
        return tag[1:].split("-", 1)[-1] or "_"

    def knows(self, prefix: str | None) -> bool:
        return True

    def flags_in(self, pp, pt, p, t) -> tuple:
        start = _or(_in(p, "BS"), _and(_in(pp, "ESO"), _in(p, "EI")), _and(_not(_in(p, "O.")), pt != t))
        end = _or(_in(pp, "ES"), _and(_in(pp, "BI"), _in(p, "BSO")), _and(_not(_in(pp, "O.")), pt != t))
        return start, _not(_or(start, end)), end

    def flags(self, pp, pt, p, t):
        start = ((p == "B") | (p == "S") | (pp.isin("E", "S", "O") & p.isin("E", "I")) | ((p != "O") & (p != ".") & (pt != t)))
        end = (pp.isin("E", "S") | (pp.isin("B", "I") & p.isin("B", "S", "O")) | ((pp != "O") & (pp != ".") & (pt != t)))
        return start, ~(start | end), end


# The schemes as the sequence-labelling library defines them.
SCHEMES = {
    "IOB1": Scheme("IOB",
                   start=(("O", "I", ANY), ("I", "I", DIFF), ("B", "I", ANY), ("I", "B", SAME), ("B", "B", SAME)),
                   inside=(("B", "I", SAME), ("I", "I", SAME)),
                   end=(("I", "I", DIFF), ("I", "O", ANY), ("I", "B", ANY), ("B", "O", ANY), ("B", "I", DIFF), ("B", "B", SAME))),
    "IOE1": Scheme("IOE",
                   start=(("O", "I", ANY), ("I", "I", DIFF), ("E", "I", ANY), ("E", "E", SAME)),
                   inside=(("I", "I", SAME), ("I", "E", SAME)),
                   end=(("I", "I", DIFF), ("I", "O", ANY), ("I", "E", DIFF), ("E", "I", SAME), ("E", "E", SAME))),
    "IOB2": Scheme("IOB",
                   start=((_ALL, "B", ANY),),
                   inside=(("B", "I", SAME), ("I", "I", SAME)),
                   end=(("I", "O", ANY), ("I", "I", DIFF), ("I", "B", ANY), ("B", "O", ANY), ("B", "I", DIFF), ("B", "B", ANY))),
    "IOE2": Scheme("IOE",
                   start=(("O", "I", ANY), ("O", "E", ANY), ("E", "I", ANY), ("E", "E", ANY), ("I", "I", DIFF), ("I", "E", DIFF)),
                   inside=(("I", "E", SAME), ("I", "I", SAME)),
                   end=(("E", _ALL, ANY),)),
    "IOBES": Scheme("IOBES",
                    start=((_ALL, "B", ANY), (_ALL, "S", ANY)),
                    inside=(("B", "I", SAME), ("B", "E", SAME), ("I", "I", SAME), ("I", "E", SAME)),
                    end=(("S", _ALL, ANY), ("E", _ALL, ANY))),
    "BILOU": Scheme("BILOU",
                    start=((_ALL, "B", ANY), (_ALL, "U", ANY)),
                    inside=(("B", "I", SAME), ("B", "L", SAME), ("I", "I", SAME), ("I", "L", SAME)),
                    end=(("U", _ALL, ANY), ("L", _ALL, ANY))),
}
LENIENT = Lenient("", (), (), ())


def scheme_of(mode: str, scheme: str | None) -> Scheme:
    """Strict mode takes effect together with a scheme only, as in the library."""
    if mode != "strict" or not scheme:
        return LENIENT
    if str(scheme).upper() not in SCHEMES:
        raise ValueError(f"unknown scheme {scheme!r}; known: {', '.join(SCHEMES)}")
    return SCHEMES[str(scheme).upper()]


# --- tag lists ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Cuts:
    """The entities of one side of an Arrow batch: row, first and last position (inclusive) and
    type of each, ordered by row and position; ``bad``: rows that are null or hold unknown tags."""

    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    type: np.ndarray
    bad: np.ndarray


def _cut(lists: pa.Array, scheme: Scheme, names: dict[str, int]) -> Cuts:
    """All lists laid end to end, an outside tag before and after each. What a pair of neighbours
    means is looked up once per distinct pair; types are numbered in ``names``."""
    n, size = len(lists), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    known = coded.dictionary.to_pylist()
    codes = pc.fill_null(coded.indices, len(known)).to_numpy(zero_copy_only=False)
    read = [*[(x[:1], scheme.type_in(x)) for x in known], (None, "_"), ("O", scheme.first_type()), ("O", "_")]
    stop = np.cumsum(size + 2)
    start = stop - size - 2
    line = np.full(int(stop[-1]) if n else 0, len(known) + 1)
    line[stop - 1] = len(known) + 2
    inner = np.ones(len(line), dtype=bool)
    inner[start] = inner[stop - 1] = False
    line[inner] = codes
    at, pairs = pd.factorize(line[:-1] * len(read) + line[1:])
    table = [scheme.flags_in(*read[x // len(read)], *read[x % len(read)]) for x in pairs.tolist()]
    # as in SQL, an unknown flag selects nothing: neither a start, an end nor a new run
    starts, runs, ends = (np.array([f[i] is want for f in table], dtype=bool)[at] for i, want in ((0, True), (1, False), (2, True)))
    runs[stop[:-1] - 1] = False  # from one list to the next
    run = np.flatnonzero(runs)
    row = np.repeat(np.arange(n), size + 2)[run]
    here, after = run[:-1], run[1:]
    # nothing follows the last run of a list; a run without a start is no entity
    late = ~starts[here] & (here + 1 < after) & starts[np.minimum(here + 1, after)]
    found = (row[:-1] == row[1:]) & ends[after] & (starts[here] | late)
    row, begin, after = row[:-1][found], (here + late)[found], after[found]
    bad = lists.is_null().to_numpy(zero_copy_only=False).copy()
    wrong = np.array([not scheme.knows(p) for p, _ in read[:-2]], dtype=bool)[codes]
    bad[np.repeat(np.arange(n), size)[wrong]] = True
    kind = np.array([names.setdefault(t, len(names)) for _, t in read])
    return Cuts(row, begin - start[row], after - 1 - start[row], kind[line[after]], bad)


def _lists(row: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def entities(tags: Column, scheme: Scheme = LENIENT) -> Column:
    """``begin:end:type`` of every entity of a tag list (end inclusive), in the row."""
    def cut(tags: pa.Array) -> pa.Array:
        names: dict[str, int] = {}
        c = _cut(tags, scheme, names)
        types = list(names)
        spans = [f"{b}:{e}:{types[t]}" for b, e, t in zip(c.begin.tolist(), c.end.tolist(), c.type.tolist())]
        return _lists(c.row, len(tags), pa.array(spans, pa.string()))

    return F.arrow_udf(cut, "array<string>")(tags.cast("array<string>"))


def _type_counts(true: Column, pred: Column) -> Column:
    """Per entity one struct (type, tp, n_true, n_pred) to be summed."""
    def count(tp, t, p):
        return lambda x: F.struct(F.element_at(F.split(x, ":", 3), 3).alias("type"), F.lit(tp).alias("tp"), F.lit(t).alias("n_true"), F.lit(p).alias("n_pred"))

    both = F.array_intersect(true, pred)
    return F.concat(F.transform(true, count(0, 1, 0)), F.transform(pred, count(0, 0, 1)), F.transform(both, count(1, 0, 0)))


_COUNTS = "array<struct<type:string,tp:int,n_true:int,n_pred:int>>"


def _list_counts(true: Column, pred: Column, scheme: Scheme) -> Column:
    """Struct (bad, counts) of a row: whether a list is null or holds tags the scheme does not
    know, and (type, tp, n_true, n_pred) of each type with an entity."""
    def count(true: pa.Array, pred: pa.Array) -> pa.Array:
        names: dict[str, int] = {}
        t, p = _cut(true, scheme, names), _cut(pred, scheme, names)
        # one entity at most ends at a place of a list
        longest = max(t.end.max(initial=0), p.end.max(initial=0)) + 1
        _, it, ip = np.intersect1d(t.row * longest + t.end, p.row * longest + p.end, assume_unique=True, return_indices=True)
        same = (t.begin[it] == p.begin[ip]) & (t.type[it] == p.type[ip])
        place, at = np.unique(np.concatenate([c.row * len(names) + c.type for c in (t, p)]), return_inverse=True)
        n_true, n_pred, tp = (np.bincount(x, minlength=len(place)) for x in (at[:len(t.row)], at[len(t.row):], at[it[same]]))
        types = pa.array(list(names), pa.string()).take(pa.array(place % len(names)))
        counts = pa.StructArray.from_arrays([types, *[pa.array(x, pa.int32()) for x in (tp, n_true, n_pred)]], ["type", "tp", "n_true", "n_pred"])
        return pa.StructArray.from_arrays([pa.array(t.bad | p.bad), _lists(place // len(names), len(true), counts)], ["bad", "counts"])

    return F.arrow_udf(count, f"struct<bad:boolean,counts:{_COUNTS}>")(true.cast("array<string>"), pred.cast("array<string>"))


def counts_of_lists(df: DataFrame, keys: Sequence[str], true_col: str, pred_col: str, scheme: Scheme = LENIENT) -> DataFrame:
    """(keys, type, tp, n_true, n_pred, bad) from one tag list per row and side; a key always has
    a row with a null type, whose ``bad`` says that a list holds tags the scheme does not know.
    These counts add up over parts of the data."""
    keys = list(keys)
    read = df.select(*keys, _list_counts(F.col(true_col), F.col(pred_col), scheme).alias("_c"))
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("type"), F.lit(0).alias("tp"), F.lit(0).alias("n_true"), F.lit(0).alias("n_pred")))
    rows = read.select(*keys, F.col("_c.bad").alias("bad"), F.inline(F.concat(nothing, F.col("_c.counts"))))
    return rows.groupBy(*keys, "type").agg(*[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")], F.max("bad").alias("bad"))


# --- long rows ------------------------------------------------------------------------------

def counts_of_rows(rows: DataFrame, keys: Sequence[str], item: str, pos: str, true_col: str, pred_col: str,
                   scheme: Scheme = LENIENT, block: int = BLOCK) -> DataFrame:
    """The same counts from rows (keys, item, pos, true, pred) with positions 0, 1, ..."""
    keys = list(keys)
    ids = [*keys, item]
    sides = {"t": true_col, "p": pred_col}
    own = F.floor(F.col("pos") / block)
    # the first rows of a block see the two rows before it, the last row the one after it
    to = F.array_distinct(F.array(own, F.floor((F.col("pos") + 2) / block), F.floor((F.col("pos") + 1) / block), F.greatest(F.floor((F.col("pos") - 1) / block), F.lit(0))))
    r = rows.select(*ids, F.col(pos).cast("long").alias("pos"), *[F.col(c).alias(s) for s, c in sides.items()])
    r = r.select("*", F.explode(to).alias("block"))
    w = Window.partitionBy(*ids, "block").orderBy("pos")
    before, after = F.lag("pos").over(w) == F.col("pos") - 1, F.lead("pos").over(w) == F.col("pos") + 1
    r = r.withColumns({f"{s}_{n}": F.when(F.coalesce(near, F.lit(False)), v) for s in sides for n, near, v in (
        ("prev", before, F.lag(s).over(w)), ("next", after, F.lead(s).over(w)))})
    columns = {}
    for s in sides:
        def read(c, missing):
            tag = F.coalesce(F.col(c), F.lit("O"))
            return _prefix(tag), F.when(F.col(c).isNull(), F.lit(missing)).otherwise(scheme.type_of(tag))

        here = read(s, "_")
        start, inside, _ = scheme.flags(*read(f"{s}_prev", scheme.first_type()), *here)
        _, goes_on, end = scheme.flags(*here, *read(f"{s}_next", "_"))
        columns |= {f"{s}_start": start, f"{s}_in": inside, f"{s}_end": ~goes_on & end, f"{s}_type": here[1]}
    r = r.withColumns(columns)
    late = {s: F.col(f"{s}_in") & F.col(f"{s}_start") & ~F.coalesce(F.lag(f"{s}_start").over(w), F.lit(False)) for s in sides}
    # what the latest run says: twice the position, plus one where an entity has started there
    r = r.withColumns({f"{s}_event": F.when(~F.col(f"{s}_in") | late[s], F.col("pos") * 2 + F.col(f"{s}_start").cast("int")) for s in sides})
    r = r.withColumns({"mine": F.floor(F.col("pos") / block) == F.col("block")})
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # (the rows copied from other blocks carry events of their own block, and none of this one)
    r = r.withColumns({f"{s}_begin": F.max(F.when(F.col("mine"), F.col(f"{s}_event"))).over(upto) for s in sides})
    mine = Window.partitionBy(*ids, "block", "mine")
    bad = F.lit(False)
    for s in sides:
        bad = bad | ~scheme.valid(F.coalesce(F.col(s), F.lit("")))
    r = r.withColumns({"closes": F.lead("pos").over(mine.orderBy("pos")).isNull(), "bad": F.max(bad).over(mine) if scheme.allowed else bad}).where("mine")
    r = r.where(F.col("closes") | F.col("t_end") | F.col("p_end"))
    # Ends without an event in their block, and the last row of each block, meet per sequence: a few rows a block.
    open_ = F.col("closes") | (F.col("t_end") & F.col("t_begin").isNull()) | (F.col("p_end") & F.col("p_begin").isNull())
    along = Window.partitionBy(*ids, F.when(open_, F.lit(-1)).otherwise(F.col("block"))).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumns({f"{s}_begin": F.coalesce(f"{s}_begin", F.max(f"{s}_begin").over(along)) for s in sides})
    real = {s: F.col(f"{s}_end") & F.coalesce(F.col(f"{s}_begin") % 2 == 1, F.lit(False)) for s in sides}
    span = {s: F.when(real[s], F.concat_ws(":", F.col(f"{s}_begin").cast("string"), F.lit("0"), F.col(f"{s}_type"))) for s in sides}
    lists = [F.filter(F.array(span[s]), lambda x: x.isNotNull()) for s in sides]
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("type"), F.lit(0).alias("tp"), F.lit(0).alias("n_true"), F.lit(0).alias("n_pred")))
    out = r.select(*keys, "bad", F.inline(F.concat(nothing, _type_counts(*lists))))
    return out.groupBy(*keys, "type").agg(*[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")], F.max("bad").alias("bad"))


def merge_counts(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys, "type").agg(*[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")], F.max("bad").alias("bad"))


# --- scores ---------------------------------------------------------------------------------

def scores_from_counts(counts: DataFrame, keys: Sequence[str], average_type: str = "micro avg") -> DataFrame:
    """Overall precision / recall / F1 (``micro avg``, ``macro avg`` or ``weighted avg``); an
    unknown average type or an unknown tag gives zeros plus an ``error`` entry."""
    keys = list(keys)
    per = counts.withColumns({"p": safe_ratio(F.col("tp"), F.col("n_pred")), "r": safe_ratio(F.col("tp"), F.col("n_true"))})
    per = per.withColumn("f", safe_ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    typed = F.col("type").isNotNull()
    known = average_type in ("micro avg", "macro avg", "weighted avg")
    if average_type == "micro avg":
        T, P, N = F.sum("tp"), F.sum("n_pred"), F.sum("n_true")
        aggs = [safe_ratio(T, P).alias("p"), safe_ratio(T, N).alias("r")]
    elif average_type == "macro avg":
        aggs = [F.avg(F.when(typed, F.col(x))).alias(x) for x in ("p", "r", "f")]
    elif average_type == "weighted avg":
        aggs = [safe_ratio(F.sum(F.col(x) * F.col("n_true")), F.sum("n_true")).alias(x) for x in ("p", "r", "f")]
    else:
        aggs = [F.lit(0.0).alias("p"), F.lit(0.0).alias("r"), F.lit(0.0).alias("f")]
    g = per.groupBy(*keys).agg(*aggs, F.max("bad").alias("bad"))
    if average_type == "micro avg":
        g = g.withColumn("f", safe_ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    failed = F.col("bad") if known else F.lit(True)
    g = g.select(*keys, failed.alias("bad"), *[F.when(failed, 0.0).otherwise(F.coalesce(x, F.lit(0.0))).alias(x) for x in ("p", "r", "f")])
    long = long_from_wide(g.withColumn("e", F.lit(None).cast("double")), [*keys, "bad"], [
        ("p", "sequence_labeling", "overall_precision"), ("r", "sequence_labeling", "overall_recall"),
        ("f", "sequence_labeling", "overall_f1"), ("e", "sequence_labeling", "error")])
    return long.where((F.col("sub_metric") != "error") | F.col("bad")).drop("bad")


def metric_sequence_labeling(rows: DataFrame, keys=("model", "task"), item="item_id", pos="pos",
                             true_tag="label", pred_tag="prediction", average_type="micro avg",
                             mode: str = "default", scheme: str | None = None) -> DataFrame:
    """M17 over long rows, or over tag lists if the tag columns are arrays."""
    s = scheme_of(mode, scheme)
    if dict(rows.dtypes)[true_tag].startswith("array"):
        counts = counts_of_lists(rows, keys, true_tag, pred_tag, s)
    else:
        counts = counts_of_rows(rows, keys, item, pos, true_tag, pred_tag, s)
    return scores_from_counts(counts, keys, average_type)


def from_arrays(df: DataFrame, keys: Sequence[str], item: str, true_col: str, pred_col: str) -> DataFrame:
    """Array-per-item input (the reference's format) -> long rows for the metric."""
    z = F.arrays_zip(F.col(true_col).alias("t"), F.col(pred_col).alias("p"))
    return df.select(*keys, item, F.posexplode(z).alias("pos", "z")).select(
        *keys, item, "pos", F.col("z.t").alias("label"), F.col("z.p").alias("prediction"))
