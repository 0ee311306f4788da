"""Queries for reporting (O1-O6), result analytics (A1-A17) and batch progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analyze as A
from ..operators.evaluate import batch_plan, running_metrics
from ..session import shared_path
from ..sources import sinks as K
from . import views as V
from .catalog import finish, query

ML = f"({V.SQL_MLONG})"
WIDE_METRICS = ["accuracy", "length_max", "length_mean", "positive_rate", "toxic_share"]
WIDE_SQL = f"""
  SELECT model, task, {', '.join(f"max(CASE WHEN full_metric_name = '{m}' THEN score END) AS {m}" for m in WIDE_METRICS)}
  FROM {ML} GROUP BY ALL"""


@query("report_wide", f"SELECT model, task, {', '.join(f'round({m}, 6) AS {m}' for m in WIDE_METRICS)} FROM ({WIDE_SQL})")
def report_wide(spark, sf):
    return finish(A.report_wide(V.mlong(spark, sf), WIDE_METRICS))


@query("sink_csv", f"SELECT model, task, {', '.join(f'round({m}, 6) AS {m}' for m in WIDE_METRICS)} FROM ({WIDE_SQL})")
def sink_csv(spark, sf):
    path = shared_path(spark, "results-csv")
    K.write_csv(A.report_wide(V.mlong(spark, sf), WIDE_METRICS), path)
    schema = "model string, task string, " + ", ".join(f"{m} double" for m in WIDE_METRICS)
    return finish(spark.read.option("header", "true").schema(schema).csv(path))


@query("sink_parquet", f"SELECT model, task, metric, sub_metric, round(score, 6) AS score, full_metric_name FROM {ML}")
def sink_parquet(spark, sf):
    path = shared_path(spark, "results-parquet")
    K.write_parquet(V.mlong(spark, sf), path)
    return finish(spark.read.parquet(path))


SQL_LONG_AGAIN = f"SELECT model, task, metric, NULLIF(sub_metric, '') AS sub_metric, round(score, 6) AS score, full_metric_name FROM {ML}"


@query("sink_json", SQL_LONG_AGAIN)
def sink_json(spark, sf):
    """O4 written, then read back to long rows (A1)."""
    path = shared_path(spark, "results-json")
    K.write_json(V.mlong(spark, sf), path)
    return finish(A.results_long(spark.read.text(path), "value"))


@query("save_partitioned", f"SELECT model, task, metric, sub_metric, round(score, 6) AS score, full_metric_name FROM {ML}")
def save_partitioned(spark, sf):
    """E5: results saved per model; re-saving one model replaces only its partition."""
    path = shared_path(spark, "results-by-model")
    ml = V.mlong(spark, sf)
    K.write_parquet(ml, path, partition_by="model")
    K.write_parquet(ml.where(F.col("model") == "src0"), path, partition_by="model")  # re-save one model
    return finish(spark.read.parquet(path).select("model", "task", "metric", "sub_metric", "score", "full_metric_name"))


def _json_docs(spark, sf):
    docs = K.nested_json(V.mlong(spark, sf)).select("json")
    extra = spark.createDataFrame(
        [('{"broken_model": {"error": "Model failed entirely"}}',),
         ('{"src_err": {"en": {"error": "' + "x" * 150 + '", "accuracy": 0.5}, "fr": {"accuracy": 0.25}}}',)], "json string")
    return docs.unionByName(extra)


@query("results_long", SQL_LONG_AGAIN + """
UNION ALL SELECT 'src_err', 'en', 'processing_error', repeat('x', 150), NULL, 'processing_error_' || repeat('x', 150)
UNION ALL SELECT 'src_err', 'fr', 'accuracy', NULL, 0.25, 'accuracy'""")
def results_long(spark, sf):
    return finish(A.results_long(_json_docs(spark, sf)))


@query("report_json", f"""
SELECT model, task, NULL::VARCHAR AS result, round(max(CASE WHEN metric = 'accuracy' THEN score END), 6) AS accuracy,
       round(max(CASE WHEN metric = 'positive_rate' THEN score END), 6) AS positive_rate, NULL::VARCHAR AS error FROM {ML} GROUP BY ALL
UNION ALL SELECT 'broken_model', 'error', 'Model failed entirely', NULL, NULL, NULL
UNION ALL SELECT 'src_err', 'en', NULL, 0.5, NULL, repeat('x', 150)
UNION ALL SELECT 'src_err', 'fr', NULL, 0.25, NULL, NULL
UNION ALL SELECT 'no_tasks', NULL, 'skipped', NULL, NULL, NULL""")
def report_json(spark, sf):
    """O1 with error and scalar leaves."""
    docs = _json_docs(spark, sf).unionByName(spark.createDataFrame([('{"no_tasks": "skipped"}',)], "json string"))
    r = A.report_json(docs, ["accuracy", "positive_rate", "error"])
    return finish(r.withColumns({c: A.to_float(F.col(c)) for c in ("accuracy", "positive_rate")}))


@query("results_melt", f"""
WITH w AS ({WIDE_SQL})
{' UNION ALL '.join(f"SELECT model, task, '{m}' AS full_metric_name, round({m}, 6) AS score, '{m}' AS metric, NULL::VARCHAR AS sub_metric FROM w" for m in WIDE_METRICS)}""")
def results_melt(spark, sf):
    return finish(A.results_melt(A.report_wide(V.mlong(spark, sf), WIDE_METRICS)))


@query("results_dims", f"""
SELECT DISTINCT * FROM (SELECT 'model' AS dimension, model AS value FROM {ML} UNION ALL SELECT 'task', task FROM {ML}
UNION ALL SELECT 'full_metric_name', full_metric_name FROM {ML}) WHERE value IS NOT NULL AND value <> ''""")
def results_dims(spark, sf):
    return A.dims(V.mlong(spark, sf))


@query("results_filter", f"""
SELECT model, task, metric, sub_metric, round(score, 6) AS score, full_metric_name FROM {ML}
WHERE model IN ('src1', 'src2', 'src3') AND full_metric_name IN ('accuracy', 'length_mean')""")
def results_filter(spark, sf):
    return finish(A.filter_results(V.mlong(spark, sf), models=["src1", "src2", "src3"], tasks=[],
                                   metrics=["accuracy", "length_mean"]))


@query("compare_models", f"SELECT model, round(score, 6) AS score FROM {ML} WHERE task = 'en' AND full_metric_name = 'accuracy'")
def compare_models(spark, sf):
    return finish(A.compare_models(V.mlong(spark, sf), "en", "accuracy"))


@query("task_profile", f"SELECT task, round(score, 6) AS score FROM {ML} WHERE model = 'src3' AND full_metric_name = 'length_mean'")
def task_profile(spark, sf):
    return finish(A.task_profile(V.mlong(spark, sf), "src3", "length_mean"))


@query("metric_breakdown", f"SELECT full_metric_name, round(score, 6) AS score FROM {ML} WHERE model = 'src3' AND task = 'en'")
def metric_breakdown(spark, sf):
    return finish(A.metric_breakdown(V.mlong(spark, sf), "src3", "en"))


@query("common_metrics", f"""
SELECT full_metric_name FROM {ML} WHERE model = 'src1' INTERSECT SELECT full_metric_name FROM {ML} WHERE model = 'src4'""")
def common_metrics(spark, sf):
    return A.common_metrics(V.mlong(spark, sf), "src1", "src4")


@query("compare_two", f"""
SELECT full_metric_name, model, task, metric, sub_metric, round(score, 6) AS score FROM {ML}
WHERE model IN ('src1', 'src4') AND full_metric_name IN (
  SELECT full_metric_name FROM {ML} WHERE model = 'src1' INTERSECT SELECT full_metric_name FROM {ML} WHERE model = 'src4')""")
def compare_two(spark, sf):
    return finish(A.compare_two(V.mlong(spark, sf), "src1", "src4"))


@query("compare_two_metric", f"""
SELECT task, round(max(CASE WHEN model = 'src1' THEN score END), 6) AS score_a, round(max(CASE WHEN model = 'src4' THEN score END), 6) AS score_b,
       bool_or(model = 'src1') AS has_a, bool_or(model = 'src4') AS has_b
FROM {ML} WHERE full_metric_name = 'toxic_share' AND model IN ('src1', 'src4') GROUP BY task""")
def compare_two_metric(spark, sf):
    return finish(A.compare_two_metric(V.mlong(spark, sf), "src1", "src4", "toxic_share"))


HEAT_TASKS = ["de", "en", "es", "fr"]


@query("heatmap", f"""
SELECT model, {', '.join(f"round(avg(CASE WHEN task = '{t}' THEN score END), 6) AS {t}" for t in HEAT_TASKS)}
FROM {ML} WHERE full_metric_name = 'toxic_share' GROUP BY model""")
def heatmap(spark, sf):
    return finish(A.heatmap(V.mlong(spark, sf), "toxic_share", HEAT_TASKS))


@query("metric_across_tasks", f"""
SELECT model, task, round(score, 6) AS score FROM {ML} WHERE full_metric_name = 'positive_rate' AND score IS NOT NULL""")
def metric_across_tasks(spark, sf):
    return finish(A.metric_across_tasks(V.mlong(spark, sf), "positive_rate"))


@query("results_sorted", f"SELECT model, task, metric, sub_metric, round(score, 6) AS score, full_metric_name FROM {ML}")
def results_sorted(spark, sf):
    return finish(A.results_sorted(V.mlong(spark, sf)))


# =====================================================================================
# Running metrics and batch plans on the events stream table
# =====================================================================================
BATCH = 32


@query("batch_plan", f"""
SELECT model, task, count(*) AS n_items, CAST(ceil(count(*) / {BATCH}) AS BIGINT) AS n_batches,
       CAST(CASE WHEN count(*) % {BATCH} = 0 THEN {BATCH} ELSE count(*) % {BATCH} END AS BIGINT) AS last_batch_size
FROM ({V.SQL_LP}) GROUP BY ALL""")
def batch_plan_q(spark, sf):
    return batch_plan(V.lp(spark, sf), ["model", "task"], BATCH)


@query("running_metrics", f"""
WITH b AS (SELECT model, task, prediction,
    CAST(floor((row_number() OVER (PARTITION BY model, task ORDER BY ts, item_id) - 1) / {BATCH}) AS BIGINT) + 1 AS batch
  FROM ({V.SQL_LP})),
pb AS (SELECT model, task, batch, sum(prediction) AS s, count(*) AS n FROM b GROUP BY ALL),
r AS (SELECT model, task, batch, sum(s) OVER w AS s, sum(n) OVER w AS n FROM pb
      WINDOW w AS (PARTITION BY model, task ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT model, task, batch, round(exp(-(s / n)), 6) AS perplexity_so_far, CAST(n AS BIGINT) AS rows_so_far FROM r WHERE batch % 5 = 0""")
def running_metrics_q(spark, sf):
    d = V.lp(spark, sf)
    out = running_metrics(d, ["model", "task"], ["ts", "item_id"], BATCH, 5,
                          sums={"s": F.col("prediction"), "rows_so_far": F.lit(1)}, ratios={"mean_logp": ("s", "rows_so_far")})
    return finish(out.select("model", "task", "batch", F.exp(-F.col("mean_logp")).alias("perplexity_so_far"),
                             F.col("rows_so_far").cast("long").alias("rows_so_far")))
