"""Sinks (O2-O4, E5): results to CSV, Parquet, JSON; partitioned appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O2: header row; missing values are empty; an empty result writes no rows."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """O3 / E5: Parquet, optionally partitioned (dynamic partition overwrite replaces
    only the partitions present in ``df``, so a model's results can be re-saved alone)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by)).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def nested_json(long_df: DataFrame) -> DataFrame:
    """One JSON document per model: ``{model: {task: {metric: score | {sub: score}}}}``.
    Grouped per (model, task) then per model, so a group holds one model's metric rows."""
    scalar = long_df.where(F.col("sub_metric") == "").select(
        "model", "task", "metric", F.col("score").cast("variant").alias("v"))
    nested = long_df.where(F.col("sub_metric") != "").groupBy("model", "task", "metric").agg(
        F.parse_json(F.to_json(F.map_from_entries(F.collect_list(F.struct("sub_metric", "score"))))).alias("v"))
    per_task = scalar.unionByName(nested).groupBy("model", "task").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "v"))).alias("m"))
    per_model = per_task.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("task", "m"))).alias("tasks"))
    return per_model.select("model", F.to_json(F.create_map("model", "tasks")).alias("json"))


def write_json(long_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    nested_json(long_df).select("json").write.mode(mode).text(path)
