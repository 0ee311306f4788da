"""Order-dependent values without one task per key.

``Window.partitionBy(key).orderBy(...)`` sends a whole key to one task; with a key holding a
third of all rows that task holds a third of the data. Here the rows are cut into range buckets
of about equal size over the whole tuple (keys, order columns), so a hot key spreads over many
buckets, and so do the rows that are equal in its first order column. Totals per (key, bucket)
are carried forward by a window over that small table, and each (key, bucket) group is finished
alone. This is the only path, at every size; results are exact, only the balance is approximate.

The cuts come from a sample that is a function of the data: the rows whose hash falls on a
multiple of ``rows / sample size``. Every evaluation of the plan, also one after a lost executor,
thus finds the same buckets, and the two branches (totals and rows) agree without relying on a
reused exchange. Counting and sampling are scalar subqueries of the plan: building it runs no job,
and they read the keys and order columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows per bucket; a bucket's size deviates by about 1 / sqrt of it.
SAMPLES = 32


def range_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """Adds ``_bkt``: the range bucket (0, 1, ...) of the row's (keys, order) tuple, nulls first.
    Rows of a key in a later bucket come later in ``order``. Equal tuples share a bucket. By
    default there are as many buckets as shuffle partitions. ``like`` names rows that are cheaper
    to read than ``df`` and spread alike (the rows that ``df`` aggregates): cuts come from there."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= 1:
        return df.withColumn("_bkt", F.lit(0))
    place = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate([*keys, *order])])
    rows = (df if like is None else like).select(place.alias("t"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    every = F.greatest(F.lit(1), (total / (n * SAMPLES)).cast("long"))
    sample = rows.where(F.pmod(F.xxhash64("t"), every) == 0).agg(F.sort_array(F.collect_list("t")).alias("s"))
    step = F.ceil(F.size("s") / F.lit(n))
    cuts = sample.select(F.filter("s", lambda t, i: (i > 0) & (i % step == 0)).alias("cuts")).scalar()
    # binary search: the number of cuts that are not greater than the row, a column a step, all in generated code
    out = df.withColumns({"_cuts": cuts, "_place": place, "_bkt": F.lit(0)})
    for half in (1 << k for k in range(n.bit_length() - 1, -1, -1)):
        up = F.col("_bkt") + half
        out = out.withColumn("_bkt", F.when((up <= F.size("_cuts")) & (F.get("_cuts", up - 1) <= F.col("_place")), up).otherwise(F.col("_bkt")))
    return out.drop("_cuts", "_place")


def carried(rows: DataFrame, keys: Sequence[str], totals: dict, carry) -> DataFrame:
    """Add to bucketed rows what the earlier buckets of their key hold, null if there are none:
    ``totals`` are named aggregates per (key, bucket), ``carry`` the aggregate function over the
    buckets before. Buckets are ranges, so only the first key of a bucket can have earlier ones:
    one entry a bucket, looked up in a scalar subquery without moving the rows."""
    keys = list(keys)
    at = Window.partitionBy(*keys).orderBy("_bkt")
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    small = rows.groupBy(*keys, "_bkt").agg(*[e.alias(f"_t{c}") for c, e in totals.items()])
    small = small.withColumns({"_i": F.row_number().over(at), **{f"_c{c}": carry(F.col(f"_t{c}")).over(before) for c in totals}})
    entry = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(f"_c{c}").alias(f"c{i}") for i, c in enumerate(totals)])
    found = small.where("_i > 1").agg(F.map_from_entries(F.collect_list(F.struct("_bkt", entry))).alias("m"), F.coalesce(F.max("_bkt"), F.lit(0)).alias("n"))
    entries = found.select(F.transform(F.sequence(F.lit(0), "n"), lambda i: F.try_element_at("m", i)).alias("e")).scalar()
    same = F.col("_here").isNotNull()
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_here.k{i}"))
    out = rows.withColumn("_entries", entries).withColumn("_here", F.get("_entries", F.col("_bkt")))
    return out.withColumns({c: F.when(same, F.col(f"_here.c{i}")) for i, c in enumerate(totals)}).drop("_entries", "_here")


def prefix_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column | None = None,
                  out: str = "before", buckets: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """Adds ``out`` = sum of ``weight`` (default 1) over earlier rows of the same key in
    ``order`` (columns of any sortable types, ascending). With weight 1 this is the 0-based
    position; rows that are equal in all order columns stand in any order."""
    keys, order = list(keys), list(order)
    w = weight if weight is not None else F.lit(1)
    b = range_buckets(df.withColumn("_w", w.cast("long")), keys, order, buckets, like)
    inner = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_loc", F.coalesce(F.sum("_w").over(inner), F.lit(0)))
    j = carried(local, keys, {"_off": F.sum("_w")}, F.sum)
    return j.withColumn(out, F.coalesce("_off", F.lit(0)) + F.col("_loc")).drop("_off", "_loc", "_bkt", "_w")


def prefix_max(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], values: dict, buckets: int | None = None) -> DataFrame:
    """Adds, for every ``out -> value`` in ``values``, the max of ``value`` over rows of
    the same key up to and including this one in ``order`` (unique per key). All values share
    the buckets."""
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    tmp = {f"_v{i}": v for i, v in enumerate(values.values())}
    b = range_buckets(df.withColumns(tmp), keys, order, buckets)
    inner = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumns({f"_l{t}": F.max(t).over(inner) for t in tmp})
    j = carried(local, keys, {f"_p{t}": F.max(t) for t in tmp}, F.max)
    j = j.withColumns({o: F.greatest(f"_p{t}", f"_l{t}") for o, t in zip(values, tmp)})
    return j.drop(*tmp, *[f"_p{t}" for t in tmp], *[f"_l{t}" for t in tmp], "_bkt")
