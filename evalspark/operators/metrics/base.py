from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("metric", "sub_metric", "score")


def long_from_wide(wide: DataFrame, keys: Sequence[str], entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn one aggregated row per key into long rows.

    ``entries`` lists (column in ``wide``, metric, sub_metric). Implemented as
    an ``explode`` of a literal-sized array, so no shuffle and no join."""
    arr = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(s).alias("sub_metric"), F.col(c).cast("double").alias("score"))
            for c, m, s in entries
        ]
    )
    return wide.select(*keys, F.inline(arr))


def agg_to_long(df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """``groupBy(keys).agg(...)`` of (metric, sub_metric, expr) triples, then long rows."""
    cols, entries = [], []
    for i, (m, s, e) in enumerate(aggs):
        name = f"_m{i}"
        cols.append(e.alias(name))
        entries.append((name, m, s))
    wide = df.groupBy(*keys).agg(*cols)
    return long_from_wide(wide, keys, entries)


def safe_ratio(num: Column, den: Column, zero: float = 0.0) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(zero))
