"""Q4 at run time: user functions on batches of rows, and what becomes of a batch that fails.

A task's rows are numbered in their order and cut into batches (E4). Each batch goes through the
user's functions in one task: inference (R2), post-processing (X13) or any processor (U2). A
function that raises, or returns lists of the wrong length, fails its batch: the rows stay, with
null outputs, the stage and the text of the error. As a task stops at its first failing batch,
metrics count the batches before it, and a status row says which batch failed and why.

Rows of one batch meet in one Python group (``batch_size`` rows); a failing batch costs nothing
but itself, and the first one per key is a plain aggregate. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, shared_path
from .evaluate import batch_numbers, evaluate_suite

#: Types whose Arrow columns become pandas columns by ``to_pandas`` alone, as in ``applyInPandas``.
PLAIN = {T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.ByteType: pa.int8(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(),
         T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64()}
#: Added to the rows: batch number from 1, stage and text of the error (null: none).
BATCH, STAGE, ERROR = "batch", "failed_stage", "batch_error"


@dataclass(frozen=True)
class Stage:
    """One user function: ``call(batch) -> {column: values}`` of the columns in ``schema``."""

    name: str
    call: Callable[[pd.DataFrame], dict]
    schema: str


def _values(column: pd.Series) -> list:
    values, null = column.astype(object).tolist(), column.isna().to_numpy()
    return [None if n else v for v, n in zip(values, null)] if null.any() else values


def inference(fn: Callable[[list], list], prompt: str = "prompt", out: str = "response", out_type: str = "string") -> Stage:
    """R2: ``fn(prompts) -> responses``."""
    return Stage("inference", lambda batch: {out: fn(_values(batch[prompt]))}, f"`{out}` {out_type}")


def post_processing(fn: Callable, pred: str = "prediction", label: str = "label", pred_type: str = "string", label_type: str = "string",
                    script_args: dict | None = None) -> Stage:
    """``fn(predictions, labels, batch, script_args) -> (predictions, labels)``."""
    def call(batch: pd.DataFrame) -> dict:
        p, l = fn(_values(batch[pred]), _values(batch[label]), batch, dict(script_args or {}))
        return {pred: p, label: l}

    return Stage("post-processing", call, f"`{pred}` {pred_type}, `{label}` {label_type}")


def processing(fn: Callable[[pd.DataFrame], dict], schema: str, name: str = "processing") -> Stage:
    """``fn(batch) -> {column: values}``."""
    return Stage(name, fn, schema)


def run_batches(df: DataFrame, stages: Sequence[Stage], keys: Sequence[str], order: Sequence[str], batch_size: int) -> DataFrame:
    """All rows with the outputs of the stages and ``batch``, ``failed_stage``, ``batch_error``.

    The stages run one after the other on each batch; the first that fails ends its batch: its
    outputs and those of later stages are null. Columns that a stage names replace those of the
    rows. Batches of a key are cut in ``order`` (a total order of the key's rows)."""
    keys = list(keys)
    made = {f.name: f for s in stages for f in T._parse_datatype_string(s.schema).fields}
    kept = [f for f in df.schema.fields if f.name not in made]
    schema = T.StructType([*kept, *made.values(), T.StructField(BATCH, T.LongType()), T.StructField(STAGE, T.StringType()), T.StructField(ERROR, T.StringType())])

    def through(out: pd.DataFrame) -> tuple[dict, str | None, str | None]:
        stage_name = error = None
        done: dict[str, list] = {}
        for stage in stages:
            try:
                values = {c: list(v) for c, v in stage.call(out).items()}
                wrong = {c: len(v) for c, v in values.items() if len(v) != len(out)}
                if wrong:
                    raise ValueError(f"{len(out)} rows went in, {wrong} came out")
                for c, v in {c: pd.Series(v, dtype=object) for c, v in values.items()}.items():
                    out[c] = v
                done |= values
            except Exception as e:  # noqa: BLE001 - the batch carries its error; the job goes on
                stage_name, error = stage.name, f"{type(e).__name__}: {e}"
                break
        nulls = [None] * len(out)
        columns = {c: pd.Series(nulls if c not in done or error is not None else done[c], dtype=object) for c in made}
        return columns, stage_name, error

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch.sort_values(list(order), kind="stable", ignore_index=True)
        columns, stage_name, error = through(out)
        for c, v in columns.items():
            out[c] = v
        out[STAGE], out[ERROR] = stage_name, error
        return out[[f.name for f in schema.fields]]

    def run_arrow(batch: pa.Table) -> pa.Table:
        """The same; what no stage names stays as it is in Arrow."""
        batch = batch.take(pc.sort_indices(batch, sort_keys=[(c, "ascending") for c in order]))
        columns, stage_name, error = through(batch.to_pandas())

        def column(f: T.StructField):
            if f.name not in columns and f.name not in (STAGE, ERROR):
                return batch[f.name]
            to = PLAIN[type(f.dataType)]
            if f.name not in columns:
                return pa.array([stage_name if f.name == STAGE else error] * len(batch), to)
            v = columns[f.name]
            try:
                return pa.Array.from_pandas(v, mask=v.isnull(), type=to, safe=safe)
            except pa.lib.ArrowInvalid:
                return pa.Array.from_pandas(v, mask=v.isnull()).cast(to, safe=safe)

        return pa.table([column(f) for f in schema.fields], [f.name for f in schema.fields])

    numbered = batch_numbers(df, keys, order, batch_size)
    # the batch number first: sorting compares it before any text
    groups, conf = numbered.groupBy(BATCH, *keys), df.sparkSession.conf
    safe = conf.get("spark.sql.execution.pandas.convertToArrowArraySafely") == "true"
    if all(type(f.dataType) in PLAIN for f in (*schema.fields, *df.schema.fields)) and conf.get("spark.sql.execution.arrow.useLargeVarTypes") != "true":
        return groups.applyInArrow(run_arrow, schema)
    return groups.applyInPandas(run, schema)


def first_failures(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_batches, failed_batch, failed_stage, error): one row per key, the last three null
    if all batches went through."""
    failure = F.min(F.when(F.col(ERROR).isNotNull(), F.struct(BATCH, STAGE, ERROR)))
    per = rows.groupBy(*keys).agg(F.max(BATCH).alias("n_batches"), failure.alias("f"))
    return per.select(*keys, "n_batches", F.col(f"f.{BATCH}").alias("failed_batch"), F.col(f"f.{STAGE}").alias(STAGE), F.col(f"f.{ERROR}").alias("error"))


def before_failure(rows: DataFrame, failures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the batches before the first failing one of their key."""
    keys = list(keys)
    bad = failures.where("failed_batch IS NOT NULL").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "failed_batch")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    j = rows.join(bad, same, "left").where(F.col("failed_batch").isNull() | (F.col(BATCH) < F.col("failed_batch")))
    return j.select(*[c for c in rows.columns if c not in (BATCH, STAGE, ERROR)])


def evaluate_batches(df: DataFrame, stages: Sequence[Stage], metrics, keys: Sequence[str] = ("model", "task"), order: Sequence[str] = ("item_id",),
                     batch_size: int = 32, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Run the stages and score the batches before the first failing one of each key.

    Returns the metric rows with ``status`` ``ok`` (or ``partial`` where a batch failed) and one
    more row for each key with a failure: no metric, ``status`` ``error``, and the batch, stage
    and text in ``error``. A key that fails in its first batch has that row only. The rows are
    saved once under the shared folder, so that user functions run once and cannot disagree
    between the passes, which read only the columns they use."""
    keys = list(keys)
    rows = run_batches(df, stages, keys, order, batch_size)
    if "void" in rows.schema.simpleString():  # Parquet has no such type
        ensure_checkpoint_dir(df.sparkSession)
        rows = rows.checkpoint()
    else:
        path = shared_path(df.sparkSession, "batches")
        rows.write.parquet(path)
        rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    failures = first_failures(rows, keys)
    scored = evaluate_suite(before_failure(rows, failures, keys), metrics, keys, pred, label, persist=False)
    kinds = failures.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "failed_batch")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ok = scored.join(kinds, same, "left").select(
        *keys, "metric", "sub_metric", "score", F.when(F.col("failed_batch").isNull(), "ok").otherwise("partial").alias("status"), F.lit(None).cast("string").alias("error"))
    text = F.concat(F.lit("batch "), F.col("failed_batch").cast("string"), F.lit(" of "), F.col("n_batches").cast("string"), F.lit(", "), F.col(STAGE), F.lit(": "), F.col("error"))
    failed = failures.where("failed_batch IS NOT NULL").select(
        *keys, F.lit(None).cast("string").alias("metric"), F.lit(None).cast("string").alias("sub_metric"), F.lit(None).cast("double").alias("score"),
        F.lit("error").alias("status"), text.alias("error"))
    return ok.unionByName(failed)
