"""Corpus-level metrics: M13 distinct-n, M14 word entropy, M15 / M16 correlation.

Distinct-n and entropy need a global distinct / count per n-gram: one read,
one shuffle keyed by (keys, n, gram) after a map-side partial count, then a
tiny per-key aggregation that also gives the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.postprocess import label_kind, py_float
from ...functions.text import ngrams, py_str, ws_split
from .base import long_from_wide


def ngram_states(df: DataFrame, keys, pred="prediction", ns: Sequence[int] = (1, 2)) -> DataFrame:
    """Counts (keys, n, g, c) of all n-grams: one read, all sizes in one explode. A row without
    any leaves a null that counts nothing, so every key appears. Counts of parts add up."""
    toks = df.select(*keys, ws_split(py_str(pred)).alias("_t"))
    per_n = F.array(*[F.struct(F.lit(n).alias("n"), ngrams("_t", n).alias("gs")) for n in ns])
    grams = toks.select(*keys, F.explode(per_n).alias("x")).select(*keys, "x.n", F.explode_outer("x.gs").alias("g"))
    return grams.groupBy(*keys, "n", "g").agg(F.count("g").alias("c"))


def merge_ngram_states(states: DataFrame, keys) -> DataFrame:
    return states.groupBy(*keys, "n", "g").agg(F.sum("c").alias("c"))


def distinct_from_states(counts: DataFrame, keys) -> DataFrame:
    out = counts.groupBy(*keys, "n").agg(F.count("g").alias("uniq"), F.sum("c").alias("total"))
    return out.select(
        *keys, F.lit("distinct_ngram").alias("metric"), F.concat(F.lit("distinct_"), F.col("n").cast("string")).alias("sub_metric"),
        F.when(F.col("total") > 0, F.col("uniq") / F.col("total")).otherwise(F.lit(0.0)).alias("score"))


def metric_distinct_ngram(df: DataFrame, keys=("model", "task"), pred="prediction", label="label",
                          ngrams_list: Sequence[int] = (1, 2)) -> DataFrame:
    return distinct_from_states(ngram_states(df, list(keys), pred, ngrams_list), list(keys))


def entropy_states(df: DataFrame, keys, pred="prediction") -> DataFrame:
    """Word counts (keys, w, c); keys without a word keep one null row, so that they appear with 0."""
    words = df.select(*keys, F.explode_outer(ws_split(py_str(pred))).alias("w"))
    return words.groupBy(*keys, "w").agg(F.count("w").alias("c"))


def merge_entropy_states(states: DataFrame, keys) -> DataFrame:
    return states.groupBy(*keys, "w").agg(F.sum("c").alias("c"))


def entropy_from_states(counts: DataFrame, keys) -> DataFrame:
    per = counts.groupBy(*keys).agg(F.sum("c").alias("N"), F.sum(F.when(F.col("c") > 0, F.col("c") * F.log2("c"))).alias("S"))
    h = F.when(F.col("N") > 0, F.log2("N") - F.col("S") / F.col("N")).otherwise(F.lit(0.0))
    return per.select(*keys, F.lit("word_entropy").alias("metric"), F.lit("").alias("sub_metric"), F.coalesce(h, F.lit(0.0)).alias("score"))


def metric_word_entropy(df: DataFrame, keys=("model", "task"), pred="prediction", label="label") -> DataFrame:
    """Shannon entropy (bits) of the corpus word distribution per key."""
    return entropy_from_states(entropy_states(df, list(keys), pred), list(keys))


def pearson_aggs(x, y, bad, prefix: str = "") -> list:
    """Numerically stable population moments."""
    return [F.count(F.lit(1)).alias(f"{prefix}n"), F.max(bad.cast("int")).alias(f"{prefix}bad"),
            F.covar_pop(x, y).alias(f"{prefix}cxy"), F.stddev_pop(x).alias(f"{prefix}sx"), F.stddev_pop(y).alias(f"{prefix}sy")]


def pearson_score(agg: DataFrame, keys, prefix: str = "") -> DataFrame:
    """Pearson r per key from the moments; fewer than two points, any non-numeric value, or zero
    variance give 0.0."""
    n, bad, cxy, sx, sy = (F.col(f"{prefix}{c}") for c in ("n", "bad", "cxy", "sx", "sy"))
    den = sx * sy
    r = F.when((n < 2) | (bad == 1) | den.isNull() | (den == 0), F.lit(0.0)).otherwise(cxy / den)
    r = F.when(F.isnan(r), F.lit(0.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return agg.select(*keys, r.alias("r"))


def pearson_from(df: DataFrame, keys, x, y, bad) -> DataFrame:
    return pearson_score(df.groupBy(*keys).agg(*pearson_aggs(x, y, bad)), keys)


def numeric_pair(df: DataFrame, pred: str, label: str):
    x = py_float(F.col(pred), label_kind(df, pred))
    y = py_float(F.col(label), label_kind(df, label))
    return x, y, x.isNull() | y.isNull()


def metric_pearson(df: DataFrame, keys=("model", "task"), pred="prediction", label="label") -> DataFrame:
    keys = list(keys)
    x, y, bad = numeric_pair(df, pred, label)
    r = pearson_from(df.select(*keys, x.alias("x"), y.alias("y"), bad.alias("bad")), keys, F.col("x"), F.col("y"), F.col("bad"))
    return long_from_wide(r, keys, [("r", "pearson", "")])


def spearman_states(df: DataFrame, keys, pred="prediction", label="label") -> DataFrame:
    """Distinct (key, x, y) with their count and whether a value is not numeric."""
    x, y, bad = numeric_pair(df, pred, label)
    return df.select(*keys, x.alias("x"), y.alias("y"), bad.cast("int").alias("bad")).groupBy(*keys, "x", "y").agg(
        F.count(F.lit(1)).alias("c"), F.max("bad").alias("bad"))


def merge_spearman_states(states: DataFrame, keys) -> DataFrame:
    return states.groupBy(*keys, "x", "y").agg(F.sum("c").alias("c"), F.max("bad").alias("bad"))


def spearman_from_states(pairs: DataFrame, keys, like: DataFrame | None = None) -> DataFrame:
    """Pearson on average ranks. ``like`` are the rows (keys, x, y) that the pairs come from, if
    they can be read anew.

    Pairs are placed once by x and once by y, in range buckets over (keys, value, other value), so
    that one frequent value spreads over many. A bucket knows a pair's rank up to a constant: how
    many rows come before the bucket and, for its first and its last value, how many equal ones
    other buckets hold. The constants follow from the sums per pair of buckets, a small table; no
    rank is joined back to the pairs. Ranks are taken as 2 * rank - 1 - n, whose mean is 0."""
    from ..ranking import range_buckets

    keys = list(keys)
    d = pairs
    for v, other in (("x", "y"), ("y", "x")):
        d = range_buckets(d, keys, [v, other], like=like).withColumnRenamed("_bkt", f"b{v}")
    for v in ("x", "y"):
        here = Window.partitionBy(*keys, f"b{v}").orderBy(v)
        upto = F.sum("c").over(here.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        size = F.sum("c").over(here.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        tie = F.sum("c").over(Window.partitionBy(*keys, f"b{v}", v))
        d = d.withColumns({"_up": upto, "_size": size, "_tie": tie})
        d = d.withColumns({f"first{v}": F.col("_up") == F.col("_tie"), f"last{v}": F.col("_up") == F.col("_size")})
        inside = F.col("_up") * 2 - F.col("_tie") - F.col("_size")  # 0 for the ends: their rank is a constant
        d = d.withColumn(f"r{v}", F.when(F.col(f"first{v}") | F.col(f"last{v}"), 0).otherwise(inside).cast("double")).drop("_up", "_size", "_tie")
    part = {v: [f"b{v}", f"first{v}", f"last{v}"] for v in ("x", "y")}
    n, rx, ry = F.col("c"), F.col("rx"), F.col("ry")
    sums = {"n": n, "sx": n * rx, "sy": n * ry, "sxx": n * rx * rx, "syy": n * ry * ry, "sxy": n * rx * ry}
    small = d.groupBy(*keys, *part["x"], *part["y"]).agg(
        F.max("bad").alias("bad"), F.max("x").alias("x"), F.max("y").alias("y"), *[F.sum(e).alias(a) for a, e in sums.items()])

    for v in ("x", "y"):
        first, last = F.col(f"first{v}"), F.col(f"last{v}")
        before = Window.partitionBy(*keys).orderBy(f"b{v}").rangeBetween(Window.unboundedPreceding, -1)
        small = small.withColumns({"_off": F.coalesce(F.sum("n").over(before), F.lit(0)), "_all": F.sum("n").over(Window.partitionBy(*keys)),
                                   "_size": F.sum("n").over(Window.partitionBy(*keys, f"b{v}")), "_tie": F.sum("n").over(Window.partitionBy(*keys, *part[v]))})
        low = F.when(first, F.col("_off")).otherwise(F.col("_off") + F.col("_size") - F.col("_tie"))  # rows that are smaller, and
        high = F.when(last, F.col("_off") + F.col("_size")).otherwise(F.col("_off") + F.col("_tie"))  # not greater, as far as the bucket knows
        equal = Window.partitionBy(*keys, first | last, v)
        small = small.withColumns({"_low": F.min(low).over(equal), "_high": F.max(high).over(equal)})
        at = F.when(first | last, F.col("_low") + F.col("_high")).otherwise(F.col("_off") * 2 + F.col("_size")) - F.col("_all")
        small = small.withColumn(f"a{v}", at.cast("double")).drop("_off", "_all", "_size", "_tie", "_low", "_high")
    n, ax, ay = F.col("n"), F.col("ax"), F.col("ay")
    j = small.groupBy(*keys).agg(
        F.max("bad").alias("anybad"), F.sum("n").alias("n"),
        F.sum(F.col("sxx") + ax * F.col("sx") * 2 + n * ax * ax).alias("vx"), F.sum(F.col("syy") + ay * F.col("sy") * 2 + n * ay * ay).alias("vy"),
        F.sum(F.col("sxy") + ax * F.col("sy") + ay * F.col("sx") + n * ax * ay).alias("cov"))
    den = F.sqrt(F.col("vx")) * F.sqrt(F.col("vy"))
    nameless = F.lit(False)  # a key that holds a null scores 0
    for k in keys:
        nameless = nameless | F.col(k).isNull()
    r = F.col("cov") / den
    r = F.when((F.col("anybad") == 1) | (F.col("n") < 2) | nameless | den.isNull() | F.isnan(den) | (den == 0), F.lit(0.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return long_from_wide(j.select(*keys, r.alias("r")), keys, [("r", "spearman", "")])


def metric_spearman(df: DataFrame, keys=("model", "task"), pred="prediction", label="label") -> DataFrame:
    x, y, _ = numeric_pair(df, pred, label)
    return spearman_from_states(spearman_states(df, list(keys), pred, label), keys, df.select(*keys, x.alias("x"), y.alias("y")))
