"""Greedy token-embedding match (the BERTScore formula) on given token vectors.

Token vectors are ``array<array<double>>`` columns; per pair, every prediction
token takes its best cosine over the label tokens (precision) and vice versa
(recall), all in native higher-order functions; means per key are one agg.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.text import let
from .base import agg_to_long


def _unit(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return let(norm, lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values))


def _weighted(values: Column, weights: Column) -> Column:
    """Mean of the values by weight; weights that vanish give 0.0, no values give null."""
    total = F.aggregate(weights, F.lit(0.0), lambda s, w: s + w)
    products = F.aggregate(F.zip_with(values, weights, lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(values) > 0, F.when(total > 0, products / total).otherwise(F.lit(0.0)))


def token_match(pred, label, pred_weights=None, label_weights=None) -> Column:
    """struct(p, r, f) per pair: vectors are normalised once, the similarity matrix is built
    once, its row maxima give the precision and its column maxima the recall. With weights (one
    per token) the means are weighted."""
    p = F.col(pred).cast("array<array<double>>") if isinstance(pred, str) else pred
    l = F.col(label).cast("array<array<double>>") if isinstance(label, str) else label

    def mean(values, weights):
        return _mean(values) if weights is None else let(values, lambda v: _weighted(v, F.col(weights)))

    def build(pv, lv):
        matrix = F.transform(pv, lambda a: F.transform(lv, lambda b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)))
        return let(matrix, measures(lv))

    def measures(lv):
        def of(m):
            low = F.transform(lv, lambda b: F.lit(-2.0))
            P = mean(F.transform(m, lambda row: F.array_max(row)), pred_weights)
            R = mean(F.aggregate(m, low, lambda acc, row: F.zip_with(acc, row, lambda x, y: F.greatest(x, y))), label_weights)
            return F.struct(P.alias("p"), R.alias("r"))
        return of

    unit = lambda c: F.transform(c, _unit)
    pr = let(unit(p), lambda pv: let(unit(l), lambda lv: build(pv, lv)))

    def with_f(s):
        P, R = s["p"], s["r"]
        return F.struct(P.alias("p"), R.alias("r"), F.when(P + R > 0, 2 * P * R / (P + R)).otherwise(F.lit(0.0)).alias("f"))

    return let(pr, with_f)


def idf_table(df: DataFrame, keys, tokens: str) -> DataFrame:
    """(keys, token, idf) with idf = ln((N + 1) / (df + 1)) over the N token lists of a key, and a
    row with a null token for the tokens that no list holds (df = 0). One aggregate with
    map-side combine; a null list counts as a list without tokens."""
    keys = list(keys)
    # each list brings its distinct tokens and one null, which counts the lists
    seen = df.select(*keys, F.explode(F.array_distinct(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(F.col(tokens).cast("array<string>"), F.array().cast("array<string>"))))).alias("token"))
    counts = seen.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("c"))
    lists = counts.where(F.col("token").isNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("c").alias("n"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    found = F.when(F.col("token").isNull(), 0).otherwise(F.col("c"))
    return counts.join(lists, same).select(*keys, "token", F.log((F.col("n") + 1) / (found + 1)).alias("idf"))


def with_idf(df: DataFrame, keys, item: str, pred_tokens: str, label_tokens: str) -> DataFrame:
    """Adds ``_wp`` and ``_wl``: the idf of every prediction and label token, in order. Document
    frequencies come from the label tokens. ``item`` names the pair within its key.

    Tokens join the weight table by a shuffle (AQE broadcasts it where its measured size is under
    the threshold) and come back as one list per pair; the vectors stay where they are."""
    keys = list(keys)
    ids = [*keys, item]
    table = idf_table(df, keys, label_tokens)
    empty = F.array().cast("array<string>")

    def listed(side, c):
        return F.transform(F.coalesce(F.col(c).cast("array<string>"), empty), lambda t, i: F.struct(F.lit(side).alias("side"), i.alias("i"), t.alias("token")))

    tokens = df.select(*ids, F.explode(F.concat(listed(0, pred_tokens), listed(1, label_tokens))).alias("t")).select(*ids, "t.side", "t.i", "t.token")

    def on(right: DataFrame, names, mark):
        renamed = right.select(*[F.col(k).alias(f"_{mark}{i}") for i, k in enumerate(names)], *[c for c in right.columns if c not in names])
        same = F.lit(True)
        for i, k in enumerate(names):
            same = same & F.col(k).eqNullSafe(F.col(f"_{mark}{i}"))
        return renamed, same

    known, same = on(table.where(F.col("token").isNotNull()), [*keys, "token"], "t")
    tokens = tokens.join(known, same, "left").select(*ids, "side", "i", "idf")
    unknown, same = on(table.where(F.col("token").isNull()).drop("token").withColumnRenamed("idf", "none"), keys, "u")
    tokens = tokens.join(unknown, same, "left").select(*ids, F.struct("side", "i", F.coalesce("idf", "none").alias("w")).alias("x"))
    lists = tokens.groupBy(*ids).agg(F.sort_array(F.collect_list("x")).alias("_x"))
    right, same = on(lists, ids, "p")
    j = df.join(right, same, "left").drop(*[f"_p{i}" for i in range(len(ids))])

    def side(k):
        xs = F.coalesce(F.col("_x"), F.array().cast("array<struct<side:int,i:int,w:double>>"))
        return F.transform(F.filter(xs, lambda x: x["side"] == k), lambda x: x["w"])

    return j.withColumns({"_wp": side(0), "_wl": side(1)}).drop("_x")


def metric_token_match(df: DataFrame, keys=("model", "task"), pred="prediction", label="label", idf: bool = False,
                       pred_tokens: str = "prediction_tokens", label_tokens: str = "label_tokens", item: str = "item_id") -> DataFrame:
    """The match is projected once per pair, then averaged. With ``idf`` the tokens count by
    their inverse document frequency among the labels of the key; their identities stand beside
    the vectors (``pred_tokens``, ``label_tokens``)."""
    keys = list(keys)
    if idf:
        df = with_idf(df.select(*keys, item, pred, label, pred_tokens, label_tokens), keys, item, pred_tokens, label_tokens)
        match = token_match(pred, label, "_wp", "_wl")
    else:
        match = token_match(pred, label)
    return agg_to_long(df.select(*keys, match.alias("s")), keys, match_entries("s"))


def match_entries(column: str) -> list:
    """(metric, sub_metric, aggregate) of projected matches."""
    return [("bertscore", f"bertscore_{k}", F.coalesce(F.avg(f"{column}.{c}"), F.lit(0.0))) for k, c in (("precision", "p"), ("recall", "r"), ("f1", "f"))]
