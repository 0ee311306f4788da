"""Per-row scores averaged per key: M9, M11, M12, M19-M21, M23, M25, M26.

All of these are one-pass: a Column per row and an ``avg``/``sum``, so a
suite fuses them into a single hash aggregation with map-side partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.text import col_of, let, ngrams, py_str, py_strip, ws_split
from .base import agg_to_long

INF = float("inf")


def _avg0(score: Column) -> Column:
    """Mean of non-null per-row scores; 0.0 when there are none."""
    return F.coalesce(F.avg(score), F.lit(0.0))


# M9 -------------------------------------------------------------------------------
def perplexity_expr(logp) -> Column:
    """``exp(-mean(logp))``; no rows, NaN or overflow give +inf."""
    mean = F.avg(col_of(logp).cast("double"))
    ppl = F.exp(-mean)
    return F.when(mean.isNull() | F.isnan(ppl) | (ppl == F.lit(INF)), F.lit(INF)).otherwise(ppl)


# M11 ------------------------------------------------------------------------------
def jaccard_score(pred, label, n: int = 1, normalize: bool = False) -> Column:
    p, l = py_str(pred), py_str(label)
    if normalize:
        p, l = F.lower(p), F.lower(l)
    gp, gl = F.array_distinct(ngrams(ws_split(p), n)), F.array_distinct(ngrams(ws_split(l), n))

    def score(a, b):
        inter, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
        return F.when(union > 0, inter / union).otherwise(F.lit(0.0))

    return let(gp, lambda a: let(gl, lambda b: score(a, b)))


# M12 ------------------------------------------------------------------------------
def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def vector_similarity(a, b, metric_type: str = "cosine") -> Column:
    """Per-row similarity of two embedding arrays (cast to double first)."""
    a = col_of(a).cast("array<double>")
    b = col_of(b).cast("array<double>")
    if metric_type == "cosine":
        den = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
        return F.when(den > 0, _dot(a, b) / den).otherwise(F.lit(0.0))
    if metric_type == "euclidean":
        d = F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))
        return 1.0 / (1.0 + d)
    if metric_type == "dot":
        return _dot(a, b)
    return F.lit(0.0)


# M19 / M20 / M21 --------------------------------------------------------------------
def factual_score(score, consistency_threshold: float | None = None) -> Column:
    s = col_of(score).cast("double")
    if consistency_threshold is None:
        return s
    return F.when(s.isNotNull(), (s >= F.lit(consistency_threshold)).cast("double"))


def toxicity_score(classes, target_label: str = "TOXICITY") -> Column:
    """Score of the entry whose label equals ``target_label`` (case-insensitive) in an
    ``array<struct<label, score>>``; null (skipped) when absent."""
    t = str(target_label).upper()
    hit = F.filter(col_of(classes), lambda x: F.upper(x["label"]) == F.lit(t))
    return F.try_element_at(hit, F.lit(1))["score"].cast("double")


# M23 ------------------------------------------------------------------------------
def novelty_score(creative, prompt, n: int = 2) -> Column:
    """Share of generated n-grams (lower-cased, set) absent from the prompt.

    Empty or too-short text scores 0.0 and counts; blank or null prompt gives 1.0.
    ``creative`` is the X9 struct; non-struct input is not scored."""
    text = col_of(creative)["cleaned_text"]
    pr = col_of(prompt)
    pg = F.array_distinct(ngrams(ws_split(F.lower(pr)), n))
    blank_prompt = pr.isNull() | (py_strip(pr) == "")

    def score(g):
        ratio = F.when(blank_prompt, F.lit(1.0)).otherwise(F.size(F.array_except(g, pg)) / F.size(g))
        return (
            F.when(col_of(creative).isNull(), F.lit(None).cast("double"))
            .when((F.coalesce(text, F.lit("")) == "") | (F.size(g) == 0), F.lit(0.0))
            .otherwise(ratio)
        )

    return let(F.array_distinct(ngrams(ws_split(F.lower(text)), n)), score)


# M25 / M26 ---------------------------------------------------------------------------
def _text_of(pred, is_struct: bool) -> Column:
    return col_of(pred)["cleaned_text"] if is_struct else col_of(pred)


def word_count(pred, is_struct: bool = False) -> Column:
    return F.size(ws_split(_text_of(pred, is_struct))).cast("double")


def keyword_hit(pred, keywords, is_struct: bool = False) -> Column:
    lo = F.lower(_text_of(pred, is_struct))
    kws = [str(k).lower() for k in (keywords or [])]
    if not kws:
        return F.lit(0.0)
    arr = F.array(*[F.lit(k) for k in kws])
    return F.when(F.coalesce(lo, F.lit("")) == "", F.lit(0.0)).otherwise(
        F.exists(arr, lambda k: F.instr(lo, k) > 0).cast("double"))


def is_struct_col(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StructType)


def metric_perplexity(df, keys=("model", "task"), pred="prediction", label="label"):
    return agg_to_long(df, keys, [("perplexity", "", perplexity_expr(pred))])


def metric_jaccard(df, keys=("model", "task"), pred="prediction", label="label", ngram=1, normalize=False):
    return agg_to_long(df, keys, [("jaccard", "", _avg0(jaccard_score(pred, label, ngram, normalize)))])


def metric_semantic_similarity(df, keys=("model", "task"), pred="prediction", label="label", metric_type="cosine"):
    return agg_to_long(df, keys, [("semantic_similarity", "", _avg0(vector_similarity(pred, label, metric_type)))])
