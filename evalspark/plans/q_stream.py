"""Streaming queries (T1-T4) on the driver tables read as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import postprocess as X
from ..operators.metrics import scored as S
from ..operators.metrics.base import long_from_wide
from ..streaming import stream as T
from . import sqlfrag as Q
from . import views as V
from .catalog import ORACLES, SQL_MCQ, finish, query, sql_choice_label, sql_choice_letter
from .q_metrics import KEYWORDS, _distinct_sql
from .q_overlap import _bleu_sql


def _mcq_stream(spark, sf):
    li = T.stream_table(spark, sf, "lineitem")
    raw = li.select(
        F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("task"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.concat(F.lit("The answer is ("), F.char(F.lit(65) + F.col("l_linenumber") % 5), F.lit(")")).alias("prediction"),
        (F.col("l_partkey") % 4).alias("label"))
    return X.apply_post(raw, "mmlu")


@query("stream_transform", f"""
SELECT model, task, item_id, {sql_choice_letter('prediction')} AS prediction, {sql_choice_label('label')} AS label FROM ({SQL_MCQ})""")
def stream_transform(spark, sf):
    out = T.run_to_files(_mcq_stream(spark, sf), "stream-transform")
    return spark.read.parquet(out)


@query("stream_metrics", f"""
WITH s AS (SELECT model, task, {sql_choice_letter('prediction')} AS prediction, {sql_choice_label('label')} AS label FROM ({SQL_MCQ}))
SELECT model, task, 'accuracy' AS metric, '' AS sub_metric, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS score
FROM s GROUP BY ALL
UNION ALL
SELECT 'lm', event_type, 'perplexity', '', round(exp(-avg(-value / 100.0)), 6) FROM events GROUP BY ALL""")
def stream_metrics(spark, sf):
    acc = T.running_aggregate(_mcq_stream(spark, sf), ["model", "task"],
                              [F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")], "stream-acc")
    ev = T.stream_table(spark, sf, "events").select(F.lit("lm").alias("model"), F.col("event_type").alias("task"),
                                                    (-F.col("value") / 100.0).alias("logp"))
    ppl = T.running_aggregate(ev, ["model", "task"], [S.perplexity_expr("logp").alias("perplexity")], "stream-ppl")
    a = long_from_wide(acc, ["model", "task"], [("accuracy", "accuracy", "")])
    b = long_from_wide(ppl, ["model", "task"], [("perplexity", "perplexity", "")])
    return finish(a.unionByName(b))


SQL_CORPUS_COUNTS = f"""
WITH t AS MATERIALIZED (SELECT lang AS task, {Q.ws_split(Q.pystr("text"))} AS t FROM documents),
g AS (SELECT task, 1 AS n, unnest(t) AS g FROM t UNION ALL SELECT task, 2, unnest({Q.ngrams("t", 2)}) FROM t),
c AS (SELECT task, n, g, count(*) AS c FROM g GROUP BY ALL)"""


@query("stream_corpus_metrics", SQL_CORPUS_COUNTS + """
SELECT 'docs' AS model, task, 'distinct_ngram' AS metric, 'distinct_' || n AS sub_metric, round(count(*) / sum(c), 6) AS score FROM c GROUP BY task, n
UNION ALL
SELECT 'docs', task, 'word_entropy', '', round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 6) FROM c WHERE n = 1 GROUP BY task""")
def stream_corpus_metrics(spark, sf):
    docs = T.stream_table(spark, sf, "documents").select(F.lit("docs").alias("model"), F.col("lang").alias("task"), "text")
    counts = T.corpus_counts(docs, ["model", "task"], "text", [1, 2], "stream-corpus")
    keys = ["model", "task"]
    return finish(T.distinct_from_counts(counts, keys).unionByName(T.entropy_from_counts(counts, keys)))


def _dialogue_stream(spark, sf):
    """User turns as a stream, each joined with the static table of the turns that follow."""
    turns = V.table(spark, sf, "conversations")
    answers = turns.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction"))
    asked = T.stream_table(spark, sf, "conversations").where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("label"))
    return asked.join(answers, ["conv_id", "turn"]).select(
        F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")).alias("model"), F.lit("dialog").alias("task"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"), "prediction", "label")


@query("stream_bleu", _bleu_sql())
def stream_bleu(spark, sf):
    """T3 for M6 over dialogue pairs: the batch query's oracle applies."""
    return finish(T.stream_bleu(_dialogue_stream(spark, sf), ["model", "task"], "stream-bleu"))


@query("stream_take", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 100""")
def stream_take(spark, sf):
    li = T.stream_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return T.stream_take(li, 100, ["l_orderkey", "l_linenumber"], "stream-take")


@query("stream_pearson", """
SELECT 'lm' AS model, event_type AS task, round(corr(value, user_id), 6) AS score FROM events GROUP BY ALL""")
def stream_pearson(spark, sf):
    """T2 for M15: population moments as streaming state, the coefficient from the final ones."""
    ev = T.stream_table(spark, sf, "events").select(F.lit("lm").alias("model"), F.col("event_type").alias("task"), "value", "user_id")
    y = F.col("user_id").cast("double")
    aggs = [F.covar_pop("value", y).alias("cxy"), F.stddev_pop("value").alias("sx"), F.stddev_pop(y).alias("sy")]
    m = T.running_aggregate(ev, ["model", "task"], aggs, "stream-pearson")
    return finish(m.select("model", "task", (F.col("cxy") / (F.col("sx") * F.col("sy"))).alias("score")))


@query("stream_confusion", f"""
WITH src AS (SELECT model, task, {sql_choice_letter('prediction')} AS prediction, {sql_choice_label('label')} AS label FROM ({SQL_MCQ})),
{Q.prf('src', 'macro')}
SELECT model, task, 'precision' AS metric, '' AS sub_metric, round(precision, 6) AS score FROM prf
UNION ALL SELECT model, task, 'recall', '', round(recall, 6) FROM prf
UNION ALL SELECT model, task, 'f1_score', '', round(f1_score, 6) FROM prf""")
def stream_confusion(spark, sf):
    """T2 for M2-M4: the stream keeps (key, label, prediction) counts as Spark state;
    macro precision / recall / F1 follow from the final counts table."""
    from ..operators.metrics.classification import confusion_from_pairs, prf_from_confusion

    s = _mcq_stream(spark, sf).select("model", "task", F.col("label").alias("_l"), F.col("prediction").alias("_p"))
    pairs = T.running_aggregate(s, ["model", "task", "_l", "_p"], [F.count(F.lit(1)).alias("_n")], "stream-confusion")
    cc = confusion_from_pairs(pairs, ["model", "task"])
    return finish(prf_from_confusion(cc, ["model", "task"], ("precision", "recall", "f1"), "macro", 0.0, numeric=False))


# T2 as a suite -----------------------------------------------------------------------------------
_SUITE_TEXT = [{"name": "exact_match", "options": {"normalize": True, "ignore_case": True}}, {"name": "rouge", "options": {"metrics": ["rouge1", "rouge2"], "stats": ["f", "p", "r"]}},
               {"name": "jaccard", "options": {"normalize": True}}, "bleu", {"name": "distinct_ngram", "options": {"ngrams": (1, 2)}}, "word_entropy",
               {"name": "keyword_match", "options": {"keywords_to_match": KEYWORDS}}]


def _suite_sql() -> str:
    em = [f"regexp_replace({Q.strip(f'lower({c})')}, '\\s+', ' ', 'g')" for c in ("prediction", "label")]
    parts = [f"SELECT model, task, 'exact_match' AS metric, '' AS sub_metric, round(avg(CASE WHEN {em[0]} = {em[1]} THEN 1.0 ELSE 0.0 END), 6) AS score FROM ({V.SQL_PAIRS}) GROUP BY ALL",
             ORACLES["metric_jaccard"].split("UNION ALL")[0].replace("'n1_lower'", "''"), ORACLES["metric_rouge_n"], ORACLES["metric_bleu"], _distinct_sql(1), _distinct_sql(2),
             ORACLES["metric_word_entropy"], ORACLES["metric_novelty"], ORACLES["metric_avg_length"], ORACLES["metric_keyword"]]
    return " UNION ALL ".join(f"SELECT model, task, metric, sub_metric, score FROM ({p})" for p in parts)


@query("stream_suite", _suite_sql())
def stream_suite(spark, sf):
    """Lists of metrics over a stream of dialogue pairs: texts, and cleaned creative texts."""
    from ..streaming.suite import stream_suite as suite

    pairs = _dialogue_stream(spark, sf)
    creative = X.apply_post(pairs.withColumn("prompt", F.col("label")), "creative").withColumn("label", F.col("prompt"))
    text = suite(pairs, _SUITE_TEXT, name="suite-text")
    return finish(text.unionByName(suite(creative, ["novelty", "avg_prediction_length"], name="suite-creative")))
