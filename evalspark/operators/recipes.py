"""U6 task recipes and the end-to-end run as chained DataFrame transforms.

``prompts_for(task, items)`` normalises and builds prompts / labels; ``run_tasks``
attaches the responses of every model, post-processes and evaluates each task,
and adds a status row for tasks that produced no results. One lazy plan per
task; the union is evaluated by one action of the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import postprocess as X
from ..functions import prompts as P
from ..sources.readers import head_cutoff
from ..spec import TaskSpec
from . import normalize as N
from .evaluate import evaluate_suite
from .respond import argmax_class, math_dual_view, regression_head

PROMPTED = {"glue_classification_prompting", "glue_text_pair_prompting"}
DEFAULT_POST = {
    "multiple_choice_qa": "mmlu",
    "math_reasoning_generation": "gsm8k",
    "summarization": "default",
    "translation": "default",
}


def prompts_for(task: TaskSpec, items: DataFrame) -> DataFrame:
    """Items -> ``(task, item_id, prompt, label)`` by the task's recipe."""
    h = task.handler.lower()
    items = head_cutoff(items, task.max_samples, list(task.order_key))
    if h in PROMPTED and (not task.prompt_builder or not task.postprocessor):
        raise ValueError(f"task {task.name}: prompted classification needs a prompt builder and a post-processor")
    if h == "custom_script":
        out = task.custom(items)
    elif h == "multiple_choice_qa":
        it = N.with_subject(N.drop_missing_choices(items, bool(task.prompt_template)), task.options.get("default_subject"))
        out = P.mcq_prompts(it, task.prompt_template).withColumn("label", N.label_of(it))
    elif h == "translation":
        out = P.translation_prompts(items, task.options.get("dataset_config_name", "src-tgt"), task.prompt_template) \
            .withColumn("label", F.col("target_text"))
    elif h == "summarization":
        out = P.summary_prompts(items, task.prompt_template).withColumn("label", F.col("target_text"))
    elif h == "creative_text_generation":
        out = P.creative_prompts(items, task.prompt_template).withColumn("label", F.col("target_text"))
    elif h == "glue_classification_prompting":
        out = P.sentiment_prompts(items, task.prompt_template).withColumn("label", N.label_of(items))
    elif h == "glue_text_pair_prompting":
        build = P.similarity_prompts if task.prompt_builder.lower() in ("stsb", "glue_stsb") else P.paraphrase_prompts
        out = build(items, task.prompt_template).withColumn("label", N.label_of(items))
    elif h == "math_reasoning_generation":
        out = P.generic_prompts(items, task.prompt_template).withColumn("label", F.col("target_text"))
    else:  # classification / text_pair_classification: scored from logits, no prompt
        out = items.withColumn("prompt", F.lit(None).cast("string")).withColumn("label", N.label_of(items))
    return out.select(F.lit(task.name).alias("task"), "item_id", "prompt", "label")


def score_task(task: TaskSpec, prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Attach responses (inner join: unpaired rows are not scored), post-process, evaluate."""
    h = task.handler.lower()
    joined = prompts.join(responses.where(F.col("task") == task.name), ["task", "item_id"])
    if h in ("classification", "text_pair_classification"):
        head = regression_head if task.options.get("regression") else argmax_class
        scored = joined.withColumn("prediction", head("logits"))
        return evaluate_suite(scored, task.metrics, persist=False)
    scored = joined.withColumnRenamed("response", "prediction")
    if h == "math_reasoning_generation":
        d = math_dual_view(scored.withColumnRenamed("prediction", "response").withColumnRenamed("label", "target_text"))
        return evaluate_suite(d, task.metrics, text_pred="text_prediction", text_label="text_label", persist=False)
    if h == "creative_text_generation" and not task.postprocessor:
        return evaluate_suite(scored, task.metrics, persist=False)  # creative applies no post-processing
    post = task.postprocessor or DEFAULT_POST.get(h, "default")
    return evaluate_suite(X.apply_post(scored, post, **task.post_options), task.metrics, persist=False)


def run_tasks(tasks: Sequence[TaskSpec], items: dict, responses: DataFrame, models: Sequence[str]) -> DataFrame:
    """All tasks x all models -> ``metrics_long`` plus ``status`` / ``error`` columns;
    a task that fails while its plan is built, or yields nothing, becomes an error row."""
    spark = responses.sparkSession
    parts = []
    for t in tasks:
        try:
            res = score_task(t, prompts_for(t, items[t.name]), responses)
            res.schema
        except Exception as e:  # noqa: BLE001 - one failing task must not stop the others
            parts.append(spark.createDataFrame([(m, t.name, str(e)) for m in models],
                                               "model string, task string, error string")
                         .select("model", "task", F.lit(None).cast("string").alias("metric"),
                                 F.lit(None).cast("string").alias("sub_metric"), F.lit(None).cast("double").alias("score"),
                                 F.lit("error").alias("status"), "error"))
            continue
        parts.append(res.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one left join finds the model-task pairs without results, so every task is computed once
    grid = spark.createDataFrame([(m, t.name) for m in models for t in tasks], "model string, task string")
    none = F.col("status").isNull()
    known = F.broadcast(grid).withColumn("wanted", F.lit(True))  # models x tasks of the spec
    return known.join(out, ["model", "task"], "full_outer").select(
        "model", "task", "metric", "sub_metric", "score", F.when(none, F.lit("error")).otherwise(F.col("status")).alias("status"),
        F.when(none, F.lit("No results obtained for this task")).otherwise(F.col("error")).alias("error"))
