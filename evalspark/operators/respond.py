"""Responses (R1-R6) and pairing / routing (Q1, Q4).

Model outputs are data: they are joined to prompts on ``(task, item_id)``,
or produced by a user batch function run per Arrow batch on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.postprocess import py_str, with_final_number


def attach_responses(prompts: DataFrame, responses: DataFrame, keys: Sequence[str] = ("task", "item_id"),
                     how: str = "left") -> DataFrame:
    """Pair every prompt with each model's response. A left join keeps items a
    model did not answer (response null). Both sides are large, so this is a
    shuffle join on the keys; AQE splits skewed keys and broadcasts a side only
    when its measured size is under the threshold."""
    return prompts.join(responses, list(keys), how)


def expand_models(items: DataFrame, models: Sequence[str], col: str = "model") -> DataFrame:
    """Every model runs on every task: each item row is repeated once per model
    of the spec (a literal list, so the fan-out is bounded by the config)."""
    return items.withColumn(col, F.explode(F.array(*[F.lit(m) for m in models])))


def infer_batches(prompts: DataFrame, fn: Callable[[list[str]], list[str]], prompt_col: str = "prompt",
                  out: str = "response", batch_size: int | None = None, error_col: str | None = None) -> DataFrame:
    """R2: ``fn(list_of_prompts) -> list_of_texts`` on executor-side Arrow batches.
    ``fn`` sees at most ``batch_size`` prompts at once (unless given, an Arrow batch).
    A batch that fails, or whose output length differs from its input, yields null responses;
    with ``error_col`` its rows say why. Where batches have a place in a task, and a failing one
    ends it, use ``batches.evaluate_batches``."""
    added = [StructField(out, StringType())] + ([StructField(error_col, StringType())] if error_col else [])
    schema = StructType(list(prompts.schema.fields) + added)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in it:
            step = batch_size or max(1, len(whole))
            for at in range(0, len(whole), step):
                pdf = whole.iloc[at:at + step].copy()
                texts = pdf[prompt_col].astype(object).where(pdf[prompt_col].notna(), None).tolist()
                res, error = [None] * len(texts), None
                try:
                    res = list(fn(texts))
                    if len(res) != len(texts):
                        raise ValueError(f"{len(texts)} prompts, {len(res)} responses")
                except Exception as e:  # noqa: BLE001 - a failing batch must not fail the job
                    res, error = [None] * len(texts), f"{type(e).__name__}: {e}"
                pdf[out] = res
                if error_col:
                    pdf[error_col] = error
                yield pdf

    return prompts.mapInPandas(run, schema)


def argmax_class(logits) -> Column:
    """Index of the first maximum logit."""
    l = F.col(logits) if isinstance(logits, str) else logits
    return (F.array_position(l, F.array_max(l)) - 1).cast("int")


def regression_head(logits) -> Column:
    """Exactly one logit -> that score, else null (rejected)."""
    l = F.col(logits) if isinstance(logits, str) else logits
    return F.when(F.size(l) == 1, F.element_at(l, 1).cast("double"))


def math_dual_view(df: DataFrame, response: str = "response", target: str = "target_text") -> DataFrame:
    """Full texts and extracted final numbers side by side, each with its label."""
    df = df.withColumns({"text_prediction": F.col(response), "text_label": py_str(F.col(target))})
    return with_final_number(with_final_number(df, "text_prediction", "prediction"), "text_label", "label")


def pairing_audit(prompts: DataFrame, responses: DataFrame, keys: Sequence[str] = ("task", "item_id"),
                  model_col: str = "model") -> DataFrame:
    """Q1: per (model, task), items paired, unanswered prompts and responses without a
    prompt, from one join. Scored rows come from the inner join only."""
    keys = list(keys)
    asked = prompts.select(*keys, F.lit(1).alias("_asked"))
    found = responses.select(model_col, *keys).join(asked, keys, "left").groupBy(model_col, "task").agg(
        F.count("_asked").alias("paired"), F.count_if(F.col("_asked").isNull()).alias("orphan_responses"))
    expected = prompts.groupBy("task").agg(F.count(F.lit(1)).alias("n_prompts"))
    # prompts of a model-task pair with no pair at all are reported by the status rows, not here
    return found.join(expected, "task", "left").select(
        model_col, "task", "paired", F.when(F.col("paired") > 0, F.col("n_prompts") - F.col("paired")).otherwise(F.lit(0)).alias("unanswered"), "orphan_responses")


def status_rows(results_long: DataFrame, spec: DataFrame, keys: Sequence[str] = ("model", "task")) -> DataFrame:
    """One status row per (model, task) of the spec: ``ok`` with its metric
    count, or ``error`` with a message when no results exist."""
    keys = list(keys)
    have = results_long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_metrics"))
    j = spec.join(have, keys, "left")
    return j.select(*keys, F.when(F.col("n_metrics").isNull(), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
                    F.coalesce("n_metrics", F.lit(0)).alias("n_metrics"),
                    F.when(F.col("n_metrics").isNull(), F.lit("No results obtained for this task")).alias("error"))
