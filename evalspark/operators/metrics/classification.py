"""M1-M5: accuracy, precision / recall / F1, exact match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.postprocess import label_kind
from ...functions.text import ASCII_PUNCT, py_str, ws_collapse
from .base import agg_to_long, safe_ratio


def _families_match(df: DataFrame, pred: str, label: str) -> bool:
    kp, kl = label_kind(df, pred), label_kind(df, label)
    num = {"int", "float", "bool"}
    return kp == kl or (kp in num and kl in num)


def accuracy_expr(df: DataFrame, pred: str = "prediction", label: str = "label") -> Column:
    """M1: mean of Python ``pred == label`` (``1 == '1'`` is false, ``None == None`` true)."""
    p, l = F.col(pred), F.col(label)
    if _families_match(df, pred, label):
        hit = p.eqNullSafe(l)
    else:
        hit = p.isNull() & l.isNull()
    return F.coalesce(F.avg(hit.cast("double")), F.lit(0.0))


def exact_match_hit(
    pred, label, normalize: bool = False, ignore_case: bool = False, ignore_punct: bool = False
) -> Column:
    """M5 per row: ``str(pred) == str(label)`` after the optional normalisation."""
    p, l = py_str(pred), py_str(label)
    if normalize:
        if ignore_case:
            p, l = F.lower(p), F.lower(l)
        if ignore_punct:
            blank = ""
            p = ws_collapse(F.translate(p, ASCII_PUNCT, blank))
            l = ws_collapse(F.translate(l, ASCII_PUNCT, blank))
    return (p == l).cast("double")


def exact_match_expr(pred="prediction", label="label", **opts) -> Column:
    return F.coalesce(F.avg(exact_match_hit(F.col(pred) if isinstance(pred, str) else pred,
                                            F.col(label) if isinstance(label, str) else label, **opts)), F.lit(0.0))


def metric_accuracy(df: DataFrame, keys: Sequence[str] = ("model", "task"), pred="prediction", label="label") -> DataFrame:
    return agg_to_long(df, keys, [("accuracy", "", accuracy_expr(df, pred, label))])


def metric_exact_match(df: DataFrame, keys=("model", "task"), pred="prediction", label="label", **opts) -> DataFrame:
    return agg_to_long(df, keys, [("exact_match", "", exact_match_expr(pred, label, **opts))])


# --- M2-M4 -------------------------------------------------------------------------

def _class_key(df: DataFrame, c: str) -> Column:
    kind = label_kind(df, c)
    if kind in ("int", "float", "bool"):
        return F.col(c).cast("double").cast("string")
    return F.col(c).cast("string")


def confusion_counts(df: DataFrame, keys: Sequence[str], pred: str, label: str) -> DataFrame:
    """Per (key, class) tp / fp / fn. The first aggregation is on (key, label, pred),
    so the heavy stage combines map-side and the rest is tiny (classes x keys)."""
    lk, pk = _class_key(df, label), _class_key(df, pred)
    pairs = df.groupBy(*keys, lk.alias("_l"), pk.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    return confusion_from_pairs(pairs, keys)


def confusion_from_pairs(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-class tp / fp / fn from (keys, _l, _p, _n) pair counts (class keys as text)."""
    same = F.col("_l").eqNullSafe(F.col("_p"))
    z = F.lit(0).cast("long")
    rows = pairs.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("_l").alias("cls"), F.when(same, F.col("_n")).otherwise(z).alias("tp"),
                         z.alias("fp"), F.when(same, z).otherwise(F.col("_n")).alias("fn")),
                F.struct(F.col("_p").alias("cls"), z.alias("tp"),
                         F.when(same, z).otherwise(F.col("_n")).alias("fp"), z.alias("fn")),
            )
        ),
    )
    return rows.groupBy(*keys, "cls").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))


def prf_scores(
    df: DataFrame,
    keys: Sequence[str] = ("model", "task"),
    pred: str = "prediction",
    label: str = "label",
    which: Sequence[str] = ("precision", "recall", "f1"),
    average: str = "weighted",
    zero_division: float = 0.0,
) -> DataFrame:
    """M2-M4 with sklearn's averaging rules; errors (binary on more than two classes
    or on text classes, mixed types) give 0.0 as in the reference."""
    keys = list(keys)
    if not comparable(df, pred, label, average):
        return prf_zeros(df, keys, which)
    return prf_from_confusion(confusion_counts(df, keys, pred, label), keys, which, average, zero_division, both_numeric(df, pred, label))


NAMES = {"precision": "precision", "recall": "recall", "f1": "f1_score"}


def comparable(df: DataFrame, pred: str, label: str, average: str) -> bool:
    """Whether the columns are of one kind and the average is known."""
    return _families_match(df, pred, label) and average in ("weighted", "macro", "micro", "binary")


def both_numeric(df: DataFrame, pred: str, label: str) -> bool:
    return all(label_kind(df, c) in ("int", "float", "bool") for c in (pred, label))


def prf_zeros(df: DataFrame, keys: Sequence[str], which: Sequence[str]) -> DataFrame:
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return base.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(NAMES[w]).alias("metric"), F.lit("").alias("sub_metric"), F.lit(0.0).alias("score")) for w in which])))


def prf_from_confusion(cc: DataFrame, keys: Sequence[str], which=("precision", "recall", "f1"), average: str = "weighted",
                       zero_division: float = 0.0, numeric: bool = True) -> DataFrame:
    """Averaged precision / recall / F1 from a per-class (tp, fp, fn) table."""
    keys = list(keys)
    zd = F.lit(float(zero_division))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per = cc.select(
        *keys, "cls", tp, fp, fn,
        safe_ratio(tp, tp + fp, zero_division).alias("precision"),
        safe_ratio(tp, tp + fn, zero_division).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn, zero_division).alias("f1"),
        (tp + fn).alias("support"),
    )
    aggs = []
    for w in which:
        x = F.col(w)
        if average == "macro":
            e = F.avg(x)
        elif average == "weighted":
            e = safe_ratio(F.sum(x * F.col("support")), F.sum("support"), zero_division)
        elif average == "micro":
            T, P, N = F.sum("tp"), F.sum("fp"), F.sum("fn")
            e = {"precision": safe_ratio(T, T + P, zero_division), "recall": safe_ratio(T, T + N, zero_division),
                 "f1": safe_ratio(2 * T, 2 * T + P + N, zero_division)}[w]
        else:  # binary, positive class 1
            n_cls = F.count(F.lit(1))
            has1 = F.max((F.col("cls") == "1.0").cast("int")) == 1
            v1 = F.coalesce(F.max(F.when(F.col("cls") == "1.0", x)), zd)
            e = F.when(F.lit(not numeric) | (n_cls > 2) | ((n_cls == 2) & ~has1), F.lit(0.0)).otherwise(v1)
        aggs.append((NAMES[w], "", e))
    return agg_to_long(per, keys, aggs)


def metric_precision(df, keys=("model", "task"), pred="prediction", label="label", average="weighted", zero_division=0.0):
    return prf_scores(df, keys, pred, label, ("precision",), average, zero_division)


def metric_recall(df, keys=("model", "task"), pred="prediction", label="label", average="weighted", zero_division=0.0):
    return prf_scores(df, keys, pred, label, ("recall",), average, zero_division)


def metric_f1(df, keys=("model", "task"), pred="prediction", label="label", average="weighted", zero_division=0.0):
    return prf_scores(df, keys, pred, label, ("f1",), average, zero_division)
