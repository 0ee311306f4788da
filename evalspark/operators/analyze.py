"""Result analytics (A1, A5-A17) and reporting (O1) over the long result table
``(model, task, metric, sub_metric, score, full_metric_name)``. Results are
small (models x tasks x metrics); everything is plain relational work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_py_float, py_strip

LONG_COLS = ["model", "task", "metric", "sub_metric", "score", "full_metric_name"]


def full_metric_name(metric="metric", sub="sub_metric") -> Column:
    m, s = F.col(metric), F.col(sub)
    return F.when(s.isNotNull() & (s != ""), F.concat(m, F.lit("_"), s)).otherwise(m.cast("string"))


def to_float(raw: Column) -> Column:
    """``float(value)`` of a JSON scalar's text, null when Python would raise."""
    return F.when(is_py_float(raw), py_strip(raw).try_cast("double"))


def results_long(json_docs: DataFrame, col: str = "json", error_chars: int | None = None, keep_failed: bool = False) -> DataFrame:
    """A1: nested ``{model: {task: {metric: score | {sub: score}}}}`` documents -> long rows.
    Non-object levels are skipped; a task holding ``error`` becomes one ``processing_error`` row
    with the message (cut to ``error_chars`` for display, if given) and, unless ``keep_failed``,
    nothing else."""
    models = json_docs.select(F.explode(F.from_json(F.col(col), "map<string, string>")).alias("model", "mraw"))
    tasks = models.select("model", F.explode(F.from_json("mraw", "map<string, string>")).alias("task", "traw"))
    metrics = tasks.withColumn("m", F.from_json("traw", "map<string, string>")).where(F.col("m").isNotNull())
    err = metrics.where(F.col("m").getItem("error").isNotNull()).select(
        "model", "task", F.lit("processing_error").alias("metric"),
        (F.col("m").getItem("error") if error_chars is None else F.substring(F.col("m").getItem("error"), 1, error_chars)).alias("sub_metric"),
        F.lit(None).cast("double").alias("score"))
    ok = metrics if keep_failed else metrics.where(F.col("m").getItem("error").isNull())
    ok = ok.select("model", "task", F.explode("m").alias("metric", "vraw")).where(F.col("metric") != "error")
    sub = ok.withColumn("sm", F.from_json("vraw", "map<string, string>"))
    nested = sub.where(F.col("sm").isNotNull()).select(
        "model", "task", "metric", F.explode("sm").alias("sub_metric", "sraw")).select(
        "model", "task", "metric", "sub_metric", to_float(F.col("sraw")).alias("score"))
    scalar = sub.where(F.col("sm").isNull()).select(
        "model", "task", "metric", F.lit(None).cast("string").alias("sub_metric"), to_float(F.col("vraw")).alias("score"))
    out = err.unionByName(nested).unionByName(scalar)
    return out.withColumn("full_metric_name", full_metric_name())


def report_wide(long_df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """O1: one row per (model, task), one column per full metric name. The pivot
    values are given or read from the (small) distinct metric names."""
    if metrics is None:
        metrics = [r[0] for r in long_df.select("full_metric_name").distinct().orderBy("full_metric_name").collect()]
    return long_df.groupBy("model", "task").pivot("full_metric_name", list(metrics)).agg(F.first("score"))


def report_json(json_docs: DataFrame, metrics: Sequence[str] | None = None, col: str = "json") -> DataFrame:
    """O1 from nested documents: one row per (model, task) with a text column per metric (a
    nested metric stays JSON); a task or model that is no object (an error text, a number) has
    its text in ``result``. Metric names are given or read from the documents (few)."""
    models = json_docs.select(F.explode(F.from_json(F.col(col), "map<string, string>")).alias("model", "mraw"))
    models = models.withColumn("t", F.from_json("mraw", "map<string, string>"))
    tasks = models.select("model", "mraw", F.col("t").isNull().alias("leaf"), F.explode_outer("t").alias("task", "traw"))
    rows = tasks.where(F.col("leaf") | F.col("task").isNotNull()).withColumn("m", F.from_json("traw", "map<string, string>"))
    rows = rows.withColumn("result", F.when(F.col("leaf"), F.col("mraw")).when(F.col("m").isNull(), F.col("traw")))
    if metrics is None:
        metrics = [r[0] for r in rows.select(F.explode(F.map_keys("m")).alias("k")).distinct().orderBy("k").collect()]
    return rows.select("model", "task", "result", *[F.col("m").getItem(n).alias(n) for n in metrics])


def results_melt(wide: DataFrame, ids: Sequence[str] = ("model", "task")) -> DataFrame:
    """A5 + A6: wide -> long with numeric coercion; ``rouge_x`` / ``bert_score_x`` names
    split on the first ``_`` (the latter can never match: its head is ``bert``)."""
    ids = [c for c in ids if c in wide.columns]
    vals = [c for c in wide.columns if c not in ids]
    long = wide.select(*ids, *[F.col(c).cast("string").alias(c) for c in vals]).unpivot(
        ids, vals, "full_metric_name", "raw")
    head = F.split_part(F.col("full_metric_name"), F.lit("_"), F.lit(1))
    split = head.isin("rouge", "bert_score") & F.col("full_metric_name").contains("_")
    rest = F.substr(F.col("full_metric_name"), F.length(head) + 2)
    return long.select(*ids, "full_metric_name", to_float(F.col("raw")).alias("score"),
                       F.when(split, head).otherwise(F.col("full_metric_name")).alias("metric"),
                       F.when(split, rest).alias("sub_metric"))


def dims(long_df: DataFrame) -> DataFrame:
    """Distinct sorted model / task / metric names (nulls and blanks removed)."""
    parts = [long_df.select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in
             ("model", "task", "full_metric_name")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.where(F.col("value").isNotNull() & (F.col("value") != "")).distinct().orderBy("dimension", "value")


def filter_results(long_df: DataFrame, models=None, tasks=None, metrics=None) -> DataFrame:
    """Filter by selected sets; an empty selection means no filter."""
    out = long_df
    for col, sel in (("model", models), ("task", tasks), ("full_metric_name", metrics)):
        if sel:
            out = out.where(F.col(col).isin(list(sel)))
    return out


def compare_models(long_df: DataFrame, task: str, metric: str) -> DataFrame:
    """Every model's score for one task and metric, best first."""
    return long_df.where((F.col("task") == task) & (F.col("full_metric_name") == metric)) \
        .select("model", "score").orderBy(F.desc_nulls_last("score"), "model")


def task_profile(long_df: DataFrame, model: str, metric: str) -> DataFrame:
    """A10: one model's score on every task for one metric."""
    return long_df.where((F.col("model") == model) & (F.col("full_metric_name") == metric)) \
        .select("task", "score").orderBy(F.desc_nulls_last("score"), "task")


def metric_breakdown(long_df: DataFrame, model: str, task: str) -> DataFrame:
    """All metrics of one (model, task)."""
    return long_df.where((F.col("model") == model) & (F.col("task") == task)) \
        .select("full_metric_name", "score").orderBy(F.desc_nulls_last("score"), "full_metric_name")


def common_metrics(long_df: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Metric names both models have (set intersection)."""
    a = long_df.where(F.col("model") == model_a).select("full_metric_name")
    b = long_df.where(F.col("model") == model_b).select("full_metric_name")
    return a.intersect(b)


def compare_two(long_df: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Both models' rows restricted to their common metrics."""
    both = long_df.where(F.col("model").isin(model_a, model_b))
    return both.join(common_metrics(long_df, model_a, model_b), "full_metric_name", "left_semi")


def compare_two_metric(long_df: DataFrame, model_a: str, model_b: str, metric: str) -> DataFrame:
    """One metric side by side per task, with availability flags."""
    x = long_df.where((F.col("full_metric_name") == metric) & F.col("model").isin(model_a, model_b))
    g = x.groupBy("task").agg(
        F.max(F.when(F.col("model") == model_a, F.col("score"))).alias("score_a"),
        F.max(F.when(F.col("model") == model_b, F.col("score"))).alias("score_b"),
        F.max((F.col("model") == model_a).cast("int")).alias("has_a"),
        F.max((F.col("model") == model_b).cast("int")).alias("has_b"))
    return g.select("task", "score_a", "score_b", (F.col("has_a") == 1).alias("has_a"), (F.col("has_b") == 1).alias("has_b"))


def heatmap(long_df: DataFrame, metric: str, tasks: Sequence[str] | None = None) -> DataFrame:
    """Model x task mean score for one metric; empty cells are null."""
    x = long_df.where(F.col("full_metric_name") == metric)
    if tasks is None:
        tasks = [r[0] for r in x.select("task").distinct().orderBy("task").collect()]
    return x.groupBy("model").pivot("task", list(tasks)).agg(F.avg("score"))


def metric_across_tasks(long_df: DataFrame, metric: str) -> DataFrame:
    """One metric on every (model, task), rows without a score dropped."""
    return long_df.where((F.col("full_metric_name") == metric) & F.col("score").isNotNull()) \
        .select("model", "task", "score")


def results_sorted(long_df: DataFrame) -> DataFrame:
    """The whole table ordered by model, task, full metric name."""
    return long_df.orderBy("model", "task", "full_metric_name")
