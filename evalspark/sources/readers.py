"""Sources (S1-S7): file scans, split directories, user-registered sources,
head cutoff, empty-task status and sample items."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPLITS = ("train", "validation", "test")


def read_local(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               **options) -> DataFrame:
    """A file or directory in a named format (csv / json / parquet / text / orc)."""
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """One CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.options(header="true", **{k: str(v) for k, v in options.items()}).schema(schema).csv(path)


def read_splits(spark: SparkSession, directory: str, split: str, schema: StructType | str,
                fmt: str = "csv", **options) -> DataFrame | None:
    """S3: ``<split>.<fmt>``, or every present split when ``split == 'all'``; each row
    tagged with its split. Absent splits are skipped; none present -> None."""
    names = SPLITS if split == "all" else (split,)
    parts = []
    for s in names:
        try:
            if fmt == "csv":
                df = read_csv(spark, f"{directory.rstrip('/')}/{s}.csv", schema, **options)
            else:
                df = read_local(spark, f"{directory.rstrip('/')}/{s}.{fmt}", fmt, schema, **options)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(df.withColumn("split", F.lit(s)))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# S4 -------------------------------------------------------------------------------
SOURCES: dict[str, Callable[..., DataFrame | None]] = {}


def register_source(name: str):
    """Register ``fn(spark, **options) -> DataFrame`` under ``name`` (case-insensitive)."""
    def deco(fn):
        SOURCES[name.lower()] = fn
        return fn
    return deco


def load_source(spark: SparkSession, name: str, **options) -> DataFrame:
    fn = SOURCES.get(name.lower())
    if fn is None:
        raise KeyError(f"unknown source {name!r}")
    df = fn(spark, **options)
    if df is None:
        raise ValueError(f"source {name!r} returned no dataset")
    return df


# S5 -------------------------------------------------------------------------------
def head_cutoff(df: DataFrame, n: int | None, order: Sequence[str | Column], per: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in source order (an explicit total order key); null or <= 0
    means no cutoff. Per key, ``row_number() <= n`` is planned with a window group
    limit, so each task ships at most ``n`` rows per partition to the shuffle."""
    if n is None or n <= 0:
        return df
    if not per:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*per).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


# S6 -------------------------------------------------------------------------------
def empty_task_status(tasks: DataFrame, items: DataFrame, task_col: str = "task") -> DataFrame:
    """Tasks of the spec that have no items become error status rows (left anti join)."""
    have = items.select(task_col).distinct()
    return tasks.join(have, task_col, "left_anti").select(
        task_col, F.lit("error").alias("status"),
        F.concat(F.lit("dataset for task '"), F.col(task_col), F.lit("' is empty")).alias("error"))


# S7 -------------------------------------------------------------------------------
SAMPLE_PHRASES = (
    "Rain is expected along the coast tonight.",
    "The bridge was closed for repairs last spring.",
    "Every answer should cite the table it came from.",
    "A small team can maintain a large catalogue.",
    "The orchestra rehearsed the second movement twice.",
    "Fresh bread sells out before nine in the morning.",
    "Seeds were planted in rows across the field.",
    "The report compares three years of measurements.",
    "Trains to the north leave from platform four.",
    "Old maps show a river where the road is now.",
)


def sample_items(keys: DataFrame, key: str, split_col: str, index_col: str) -> DataFrame:
    """Sample evaluation rows ``id, text_content, category_label, split`` built from
    a key table: ``id = f"{split}_{i:04d}"``, text ``Sample {split} text {i+1}: p q``
    with phrases and a 0-2 label chosen deterministically from the key."""
    k = F.col(key).cast("long")
    phrases = F.array(*[F.lit(p) for p in SAMPLE_PHRASES])
    n = len(SAMPLE_PHRASES)
    p1 = F.element_at(phrases, (F.pmod(k * 7 + 3, F.lit(n)) + 1).cast("int"))
    p2 = F.element_at(phrases, (F.pmod(k * 13 + 5, F.lit(n)) + 1).cast("int"))
    i = F.col(index_col)
    return keys.select(
        F.col(split_col).alias("split"),
        # f"{i:04d}": pad to four digits, never cut longer numbers (lpad would)
        F.concat(F.col(split_col), F.lit("_"), F.when(F.length(i.cast("string")) >= 4, i.cast("string"))
                 .otherwise(F.lpad(i.cast("string"), 4, "0"))).alias("id"),
        F.concat(F.lit("Sample "), F.col(split_col), F.lit(" text "), (i + 1).cast("string"), F.lit(": "), p1, F.lit(" "), p2)
        .alias("text_content"),
        F.pmod(k * 31 + 1, F.lit(3)).cast("int").alias("category_label"),
    )
