"""Metric queries (M1-M26) over the base views, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import postprocess as X
from ..operators.evaluate import evaluate_suite
from ..operators.metrics import classification as C
from ..operators.metrics import scored as S
from ..operators.metrics.base import agg_to_long
from . import sqlfrag as Q
from . import views as V
from .catalog import finish, query

LONG = "model, task, metric, sub_metric, round(score, 6) AS score"


def _suite(df, metrics, **kw):
    return finish(evaluate_suite(df, metrics, persist=False, **kw))


# M1 -----------------------------------------------------------------------------------
@query("metric_accuracy", f"""
SELECT model, task, 'accuracy' AS metric, '' AS sub_metric,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS score
FROM ({V.SQL_CLF}) GROUP BY ALL""")
def metric_accuracy(spark, sf):
    return finish(C.metric_accuracy(V.clf(spark, sf)))


# M2-M4 ------------------------------------------------------------------------------------
def _prf_query(name, metric, average, col):
    @query(name, f"""
WITH src AS ({V.SQL_CLF}), {Q.prf('src', average)}
SELECT model, task, '{metric}' AS metric, '' AS sub_metric, round({col}, 6) AS score FROM prf""")
    def run(spark, sf):
        return finish(C.prf_scores(V.clf(spark, sf), which=(col if col != "f1_score" else "f1",), average=average))
    return run


_prf_query("metric_precision", "precision", "weighted", "precision")
_prf_query("metric_recall", "recall", "macro", "recall")
_prf_query("metric_f1", "f1_score", "binary", "f1_score")
_prf_query("metric_f1_micro", "f1_score", "micro", "f1_score")


# M5 -------------------------------------------------------------------------------------
EM_PRED = "CASE WHEN label = 1 THEN upper(task) || '!' ELSE task || ' x' END"


@query("metric_exact_match", f"""
WITH s AS (SELECT model, task, {EM_PRED} AS prediction, task AS label FROM ({V.SQL_CLF}))
SELECT model, task, 'exact_match' AS metric, 'plain' AS sub_metric,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS score FROM s GROUP BY ALL
UNION ALL
SELECT model, task, 'exact_match', 'normalized',
       round(avg(CASE WHEN regexp_replace({Q.strip("translate(lower(prediction), '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '')")}, '\\s+', ' ', 'g')
                      = regexp_replace({Q.strip("translate(lower(label), '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '')")}, '\\s+', ' ', 'g')
                 THEN 1.0 ELSE 0.0 END), 6) FROM s GROUP BY ALL""")
def metric_exact_match(spark, sf):
    d = V.clf(spark, sf)
    s = d.select("model", "task", F.when(F.col("label") == 1, F.concat(F.upper("task"), F.lit("!")))
                 .otherwise(F.concat("task", F.lit(" x"))).alias("prediction"), F.col("task").alias("label"))
    return finish(agg_to_long(s, ["model", "task"], [
        ("exact_match", "plain", C.exact_match_expr("prediction", "label")),
        ("exact_match", "normalized", C.exact_match_expr("prediction", "label", normalize=True, ignore_case=True, ignore_punct=True)),
    ]))


# M9 ---------------------------------------------------------------------------------------
@query("metric_perplexity", f"""
SELECT model, task, 'perplexity' AS metric, '' AS sub_metric, round(exp(-avg(prediction)), 6) AS score
FROM ({V.SQL_LP}) GROUP BY ALL""")
def metric_perplexity(spark, sf):
    return _suite(V.lp(spark, sf), ["perplexity"])


# M11 ---------------------------------------------------------------------------------------
def _jac_sql(n, lower):
    p = "lower(prediction)" if lower else "prediction"
    l = "lower(label)" if lower else "label"
    gp = f"list_distinct({Q.ngrams(Q.ws_split(p), n)})"
    gl = f"list_distinct({Q.ngrams(Q.ws_split(l), n)})"
    return (f"avg(CASE WHEN len(list_distinct(list_concat({gp}, {gl}))) > 0 THEN "
            f"len(list_filter({gp}, lambda g: list_contains({gl}, g))) / len(list_distinct(list_concat({gp}, {gl}))) ELSE 0.0 END)")


@query("metric_jaccard", f"""
SELECT model, task, 'jaccard' AS metric, 'n1_lower' AS sub_metric, round({_jac_sql(1, True)}, 6) AS score FROM ({V.SQL_PAIRS}) GROUP BY ALL
UNION ALL
SELECT model, task, 'jaccard', 'n2', round({_jac_sql(2, False)}, 6) FROM ({V.SQL_PAIRS}) GROUP BY ALL""")
def metric_jaccard(spark, sf):
    p = V.pairs(spark, sf)
    return finish(agg_to_long(p, ["model", "task"], [
        ("jaccard", "n1_lower", S._avg0(S.jaccard_score("prediction", "label", 1, True))),
        ("jaccard", "n2", S._avg0(S.jaccard_score("prediction", "label", 2, False))),
    ]))


# M12 ----------------------------------------------------------------------------------------
@query("metric_semantic_similarity", f"""
WITH v AS (SELECT model, task, CAST(prediction AS DOUBLE[]) AS a, CAST(label AS DOUBLE[]) AS b FROM ({V.SQL_VECS}))
SELECT model, task, 'semantic_similarity' AS metric, 'cosine' AS sub_metric,
       round(avg(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))), 6) AS score FROM v GROUP BY ALL
UNION ALL SELECT model, task, 'semantic_similarity', 'euclidean', round(avg(1.0 / (1.0 + list_distance(a, b))), 6) FROM v GROUP BY ALL
UNION ALL SELECT model, task, 'semantic_similarity', 'dot', round(avg(list_dot_product(a, b)), 6) FROM v GROUP BY ALL""")
def metric_semantic_similarity(spark, sf):
    v = V.vecs(spark, sf)
    return finish(agg_to_long(v, ["model", "task"], [
        ("semantic_similarity", t, S._avg0(S.vector_similarity("prediction", "label", t)))
        for t in ("cosine", "euclidean", "dot")]))


# M13 / M14 -------------------------------------------------------------------------------------
def _distinct_sql(n):
    g = Q.ngrams(Q.ws_split(Q.pystr("prediction")), n)
    return f"""
SELECT model, task, 'distinct_ngram' AS metric, 'distinct_{n}' AS sub_metric,
       round(CASE WHEN count(g) > 0 THEN count(DISTINCT g) / count(g) ELSE 0.0 END, 6) AS score
FROM (SELECT model, task, unnest({g}) AS g FROM ({V.SQL_PAIRS})) GROUP BY ALL"""


@query("metric_distinct_ngram", _distinct_sql(1) + " UNION ALL " + _distinct_sql(2))
def metric_distinct_ngram(spark, sf):
    return _suite(V.pairs(spark, sf), [{"name": "distinct_ngram", "options": {"ngrams": (1, 2)}}])


@query("metric_word_entropy", f"""
WITH w AS (SELECT model, task, unnest({Q.ws_split('prediction')}) AS w FROM ({V.SQL_PAIRS})),
c AS (SELECT model, task, w, count(*) AS c FROM w GROUP BY ALL),
t AS (SELECT model, task, sum(c) AS n FROM c GROUP BY ALL)
SELECT c.model, c.task, 'word_entropy' AS metric, '' AS sub_metric,
       round(-sum(c.c / t.n * log2(c.c / t.n)) + 0.0, 6) AS score
FROM c JOIN t USING (model, task) GROUP BY ALL""")
def metric_word_entropy(spark, sf):
    return _suite(V.pairs(spark, sf), ["word_entropy"])


# M15 / M16 ---------------------------------------------------------------------------------------
@query("metric_pearson", f"""
SELECT model, task, 'pearson' AS metric, '' AS sub_metric, round(corr(prediction, label), 6) AS score
FROM ({V.SQL_NUM}) GROUP BY ALL""")
def metric_pearson(spark, sf):
    return _suite(V.num(spark, sf), ["pearson"])


@query("metric_spearman", f"""
WITH r AS (SELECT model, task,
    rank() OVER (PARTITION BY model, task ORDER BY prediction) + (count(*) OVER (PARTITION BY model, task, prediction) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY model, task ORDER BY label) + (count(*) OVER (PARTITION BY model, task, label) - 1) / 2.0 AS ry
  FROM ({V.SQL_NUM}))
SELECT model, task, 'spearman' AS metric, '' AS sub_metric, round(corr(rx, ry), 6) AS score FROM r GROUP BY ALL""")
def metric_spearman(spark, sf):
    return _suite(V.num(spark, sf), ["spearman"])


# M19 / M20 / M21 -----------------------------------------------------------------------------------
FACT_SQL = f"""
  SELECT model, task, CASE WHEN label = 1 THEN n_chars / (n_chars + 1000.0) END AS qa_score,
         toxic * 0.9 + 0.05 AS tox FROM ({V.SQL_CLF})"""


def _fact_view(spark, sf):
    d = V.clf(spark, sf)
    return d.select(
        "model", "task", "prediction", "label",
        F.when(F.col("label") == 1, F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("qa_score"),
        F.when(F.col("label") == 1, F.array(
            F.struct(F.lit("Toxicity").alias("label"), (F.col("toxic") * 0.9 + 0.05).alias("score")),
            F.struct(F.lit("other").alias("label"), F.lit(0.5).alias("score"))))
        .otherwise(F.array(F.struct(F.lit("other").alias("label"), F.lit(0.5).alias("score")))).alias("toxicity_classes"),
        (F.col("n_chars") / 1000.0).alias("score"))


@query("metric_factual", f"""
SELECT model, task, 'factual_consistency' AS metric, 'raw' AS sub_metric, round(COALESCE(avg(qa_score), 0.0), 6) AS score FROM ({FACT_SQL}) GROUP BY ALL
UNION ALL
SELECT model, task, 'factual_consistency', 'threshold_0.5', round(COALESCE(avg(CASE WHEN qa_score IS NOT NULL THEN CAST(qa_score >= 0.5 AS DOUBLE) END), 0.0), 6)
FROM ({FACT_SQL}) GROUP BY ALL""")
def metric_factual(spark, sf):
    v = _fact_view(spark, sf)
    return finish(agg_to_long(v, ["model", "task"], [
        ("factual_consistency", "raw", S._avg0(S.factual_score("qa_score"))),
        ("factual_consistency", "threshold_0.5", S._avg0(S.factual_score("qa_score", 0.5)))]))


@query("metric_toxicity", f"""
SELECT model, task, 'toxicity' AS metric, 'toxicity' AS sub_metric,
       round(COALESCE(avg(CASE WHEN label = 1 THEN toxic * 0.9 + 0.05 END), 0.0), 6) AS score
FROM ({V.SQL_CLF}) GROUP BY ALL""")
def metric_toxicity(spark, sf):
    return _suite(_fact_view(spark, sf), [{"name": "toxicity", "options": {"target_label": "toxicity"}}])


@query("metric_score_avg", f"""
SELECT model, task, 'score_average' AS metric, '' AS sub_metric, round(avg(n_chars / 1000.0), 6) AS score
FROM ({V.SQL_CLF}) GROUP BY ALL""")
def metric_score_avg(spark, sf):
    return _suite(_fact_view(spark, sf), [{"name": "score_average", "options": {"score_col": "score"}}])


# M23 / M25 / M26 ----------------------------------------------------------------------------------------
def _creative_pairs(spark, sf):
    p = V.pairs(spark, sf)
    return X.apply_post(p, "creative").withColumn("label", F.col("prompt"))


NOV_G = f"list_distinct({Q.ngrams(Q.ws_split('lower(ct)'), 2)})"
NOV_P = f"list_distinct({Q.ngrams(Q.ws_split('lower(prompt)'), 2)})"


@query("metric_novelty", f"""
WITH c AS (SELECT model, task, prompt, {Q.creative_clean('prediction')} AS ct FROM ({V.SQL_PAIRS}))
SELECT model, task, 'novelty' AS metric, 'novelty_score_avg' AS sub_metric, round(avg(
  CASE WHEN ct = '' OR len({NOV_G}) = 0 THEN 0.0
       WHEN prompt IS NULL OR {Q.strip('prompt')} = '' THEN 1.0
       ELSE len(list_filter({NOV_G}, lambda g: NOT list_contains({NOV_P}, g))) / len({NOV_G}) END), 6) AS score
FROM c GROUP BY ALL""")
def metric_novelty(spark, sf):
    return _suite(_creative_pairs(spark, sf), ["novelty"])


@query("metric_avg_length", f"""
SELECT model, task, 'avg_prediction_length' AS metric, 'avg_prediction_length' AS sub_metric,
       round(avg(len({Q.ws_split(Q.creative_clean('prediction'))})), 6) AS score
FROM ({V.SQL_PAIRS}) GROUP BY ALL""")
def metric_avg_length(spark, sf):
    return _suite(_creative_pairs(spark, sf), ["avg_prediction_length"])


KEYWORDS = ["the", "und", "que", "zz"]


@query("metric_keyword", f"""
WITH k AS (SELECT model, task, CASE WHEN prediction IS NULL OR prediction = '' THEN 0.0
    WHEN list_bool_or(list_transform({KEYWORDS!r}, lambda kw: contains(lower(prediction), kw))) THEN 1.0 ELSE 0.0 END AS hit
  FROM ({V.SQL_PAIRS}))
SELECT model, task, 'keyword_match' AS metric, 'keyword_match_count' AS sub_metric, round(sum(hit), 6) AS score FROM k GROUP BY ALL
UNION ALL SELECT model, task, 'keyword_match', 'keyword_match_ratio', round(avg(hit), 6) FROM k GROUP BY ALL""")
def metric_keyword(spark, sf):
    return _suite(V.pairs(spark, sf), [{"name": "keyword_match", "options": {"keywords_to_match": KEYWORDS}}])
