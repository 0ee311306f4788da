"""METEOR per pair (exact, stem, then optional synonym stage), averaged.

The alignment is greedy from the end of both token lists, stage by stage; the
per-pair work runs in an Arrow batch UDF and the mean is a Spark aggregate.
Stems are Porter's unless another ``stem`` function (or None) is given. No lexical
database is bundled: a table of synonyms, joined to the words of each pair, enables that stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.porter import stem as porter_stem
from ...functions.text import py_str, ws_split
from .base import agg_to_long


def _align(hyp, ref, key):
    """Greedy matching of (index, word) lists by ``key`` from the end; removes matches.
    Linear: the places of each key wait on a stack."""
    places: dict = {}
    for j, w in ref:
        places.setdefault(key(w), []).append(j)
    out = []
    for i, w in reversed(hyp):
        stack = places.get(key(w))
        if stack:
            out.append((i, stack.pop()))
    used_h, used_r = {i for i, _ in out}, {j for _, j in out}
    hyp[:] = [x for x in hyp if x[0] not in used_h]
    ref[:] = [x for x in ref if x[0] not in used_r]
    return out


def _chunks(matches) -> int:
    i, n = 0, 1
    while i < len(matches) - 1:
        if not (matches[i + 1][0] == matches[i][0] + 1 and matches[i + 1][1] == matches[i][1] + 1):
            n += 1
        i += 1
    return n


def _align_synonyms(h, r, synonyms) -> list:
    """From the end, each remaining hypothesis word takes the last remaining reference word that
    is a synonym of it or the word itself. The places of a word wait on a stack, so a word looks
    at the tops of its synonyms only."""
    places: dict = {}
    for j, w in r:
        places.setdefault(w, []).append(j)
    out = []
    for i, w in reversed(h):
        last = max((s for s in {w, *synonyms.get(w, ())} if places.get(s)), key=lambda s: places[s][-1], default=None)
        if last is not None:
            out.append((i, places[last].pop()))
    return out


def meteor_pair(hyp_tokens, ref_tokens, alpha=0.9, beta=3.0, gamma=0.5,
                stem: Callable[[str], str] | None = porter_stem, synonyms: dict | None = None) -> float:
    h = list(enumerate(t.lower() for t in hyp_tokens))
    r = list(enumerate(t.lower() for t in ref_tokens))
    hl, rl = len(h), len(r)
    matches = _align(h, r, lambda w: w)
    if stem is not None:
        matches += _align(h, r, stem)
    if synonyms:
        matches += _align_synonyms(h, r, synonyms)
    matches.sort(key=lambda m: m[0])
    m = len(matches)
    try:
        p, rc = m / hl, m / rl
        fmean = p * rc / (alpha * p + (1 - alpha) * rc)
        frag = _chunks(matches) / m
    except ZeroDivisionError:
        return 0.0
    return (1 - gamma * frag ** beta) * fmean


#: Column with a pair's synonym links, see ``with_synonyms``.
LINKS = "_synonyms"


def synonym_table(spark: SparkSession, synonyms: Mapping) -> DataFrame:
    """(word, synonym) rows of a mapping word -> words."""
    return spark.createDataFrame([(w, s) for w, words in synonyms.items() for s in words], "word string, synonym string")


def with_synonyms(df: DataFrame, keys, item: str, pred: str, label: str, table: DataFrame) -> DataFrame:
    """Adds ``LINKS``: the (word, synonym) pairs of ``table`` with the word in the prediction and
    the synonym in the label of the same row (lower case). ``item`` names the pair in its key.

    Words of all rows meet the table in two equi-joins (AQE broadcasts the table where its
    measured size is under the threshold); a row gets only links between its own words."""
    ids = [*keys, item]

    def words(c, name):
        # tokens as ``str.split`` finds them
        return df.select(*ids, F.explode(F.array_distinct(ws_split(F.lower(py_str(c))))).alias(name))

    def same(right, names, mark):
        renamed = right.select(*[F.col(k).alias(f"_{mark}{i}") for i, k in enumerate(names)], *[c for c in right.columns if c not in names])
        on = F.lit(True)
        for i, k in enumerate(names):
            on = on & F.col(k).eqNullSafe(F.col(f"_{mark}{i}"))
        return renamed, on

    pairs = table.select(F.lower("word").alias("_w"), F.lower("synonym").alias("_s")).distinct()
    found = words(pred, "_h").join(pairs, F.col("_h") == F.col("_w")).select(*ids, "_w", "_s")
    theirs, on = same(words(label, "_s"), [*ids, "_s"], "r")
    links = found.join(theirs, on).groupBy(*ids).agg(F.collect_list(F.struct(F.col("_w").alias("word"), F.col("_s").alias("synonym"))).alias(LINKS))
    links, on = same(links, ids, "i")
    return df.join(links, on, "left").drop(*[f"_i{i}" for i in range(len(ids))])


def meteor_scores(pred, label, alpha=0.9, beta=3.0, gamma=0.5, stem=porter_stem, links: str | None = None):
    """Score of each pair; ``links`` names the column of ``with_synonyms``."""
    def one(a, b, found) -> float | None:
        ht, rt = str(a).split(), str(b).split()
        if not ht:
            return 0.0
        synonyms: dict = {}
        for x in found if found is not None else ():
            synonyms.setdefault(x["word"], set()).add(x["synonym"])
        try:
            return meteor_pair(ht, rt, alpha, beta, gamma, stem, synonyms)
        except Exception:  # noqa: BLE001 - a failing pair is not counted
            return None

    texts = F.col(pred).cast("string"), F.col(label).cast("string")
    if links is None:
        @F.pandas_udf(T.DoubleType())
        def score(h: pd.Series, r: pd.Series) -> pd.Series:
            return pd.Series([one(a, b, None) for a, b in zip(h, r)], dtype="float64")

        return score(*texts)

    @F.pandas_udf(T.DoubleType())
    def score_with(h: pd.Series, r: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([one(a, b, x) for a, b, x in zip(h, r, found)], dtype="float64")

    return score_with(*texts, F.col(links))


def metric_meteor(df: DataFrame, keys=("model", "task"), pred="prediction", label="label", synonyms=None, item: str = "item_id", **opts) -> DataFrame:
    """M10. ``synonyms`` is a DataFrame (word, synonym) or a small mapping word -> words; with it
    rows need an ``item`` column that names the pair within its key."""
    if synonyms is None:
        score = meteor_scores(pred, label, **opts)
    else:
        table = synonyms if isinstance(synonyms, DataFrame) else synonym_table(df.sparkSession, synonyms)
        df = with_synonyms(df, list(keys), item, pred, label, table)
        score = meteor_scores(pred, label, links=LINKS, **opts)
    return agg_to_long(df, keys, [("meteor", "", F.coalesce(F.avg(score), F.lit(0.0)))])
