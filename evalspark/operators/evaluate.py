"""Multi-metric evaluation, running metrics and batch plans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .metrics import registry
from .metrics.base import long_from_wide
from .metrics.classification import prf_scores


PRF = {"precision", "recall", "f1_score", "f1"}


@dataclass
class MetricSpec:
    name: str
    options: dict = field(default_factory=dict)


def as_specs(metrics) -> list[MetricSpec]:
    out: dict[str, MetricSpec] = {}
    for m in metrics:
        spec = m if isinstance(m, MetricSpec) else MetricSpec(m["name"], dict(m.get("options") or {})) \
            if isinstance(m, dict) else MetricSpec(str(m))
        out[spec.name.lower()] = spec  # the later of two entries with one name wins
    return list(out.values())


def evaluate_suite(
    scored: DataFrame,
    metrics,
    keys: Sequence[str] = ("model", "task"),
    pred: str = "prediction",
    label: str = "label",
    text_pred: str | None = None,
    text_label: str | None = None,
    persist: bool = False,
) -> DataFrame:
    """Every requested metric over ``scored`` -> ``metrics_long``.

    All one-pass metrics are fused into a single ``groupBy(keys).agg``; the
    others (confusion, corpus, per-row UDF) are computed on the same input and
    unioned. Unknown metric names are skipped, as in the reference. A metric
    whose columns or options do not fit is reported as a row with a null score
    and the sub-metric ``error: <text>``; the other metrics are not affected.
    With ``text_pred`` / ``text_label`` (the dual view of math tasks),
    ``exact_match`` reads the extracted pair and every other metric the full text.

    Passes over the same input share its scan and exchanges only. With ``persist`` an input
    that several passes read is cached (spilling to disk), which pays for costly inputs; the
    caller then releases it with ``release(result)`` once the result is saved.
    """
    keys = list(keys)
    specs = [s for s in as_specs(metrics) if s.name.lower() in registry.METRICS]
    names = {s.name.lower() for s in specs}
    passes = len(names & registry.FRAMES) + len({(s.options.get("average"), s.options.get("zero_division")) for s in specs if s.name.lower() in PRF})
    passes += bool(names - registry.FRAMES - PRF)
    cached = None
    if persist and passes > 1:
        cached = scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    fused, frames, prf = [], [], {}
    for spec in specs:
        if text_pred and text_label and spec.name.lower() != "exact_match":
            p, l = text_pred, text_label
        else:
            p, l = pred, label
        try:
            kind, value = registry.METRICS[spec.name.lower()](scored, keys, p, l, **spec.options)
            if kind == "aggs":
                scored.groupBy(*keys).agg(*[e for _, _, e in value]).schema  # analysed here, alone
                fused.extend(value)
            elif kind == "prf":
                # precision / recall / F1 with the same options share one confusion table
                which, average, zd = value
                prf_scores(scored, keys, p, l, (which,), average, zd).schema
                prf.setdefault((p, l, average, zd), []).append(which)
            else:
                value.schema
                frames.append(value)
        except Exception as e:  # noqa: BLE001 - one metric must not stop the suite
            fused.append((spec.name.lower(), f"error: {e}", F.lit(None).cast("double")))
    for (p, l, average, zd), which in prf.items():
        frames.append(prf_scores(scored, keys, p, l, tuple(which), average, zd))
    parts = []
    if fused:
        cols, entries = [], []
        for i, (m, s, e) in enumerate(fused):
            cols.append(e.alias(f"_m{i}"))
            entries.append((f"_m{i}", m, s))
        parts.append(long_from_wide(scored.groupBy(*keys).agg(*cols), keys, entries))
    parts.extend(frames)
    if not parts:
        return scored.sparkSession.createDataFrame(
            [], ", ".join([f"{k} string" for k in keys] + ["metric string", "sub_metric string", "score double"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out._cached_input = cached
    return out


def release(result: DataFrame) -> None:
    """Drop the input that ``evaluate_suite`` cached for this result."""
    cached = getattr(result, "_cached_input", None)
    if cached is not None:
        cached.unpersist()


def batch_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], batch_size: int) -> DataFrame:
    """Batch number per row, ``floor(position / batch_size) + 1`` within each key in a
    total order (first order column numeric or timestamp). Positions come from the
    range-bucketed prefix sums of ``ranking.prefix_before``, so a hot key is numbered
    by many tasks, not one."""
    from .ranking import prefix_before

    pos = prefix_before(df, keys, order, out="_pos")
    return pos.withColumn("batch", F.floor(F.col("_pos") / F.lit(batch_size)).cast("long") + 1).drop("_pos")


def batch_plan(df: DataFrame, keys: Sequence[str], batch_size: int) -> DataFrame:
    """E4 summary: items, number of batches ``ceil(n / b)`` and size of the last one per key.
    Pure aggregation; no ordering and no row numbering needed."""
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        n.alias("n_items"),
        F.ceil(n / F.lit(batch_size)).cast("long").alias("n_batches"),
        (F.when(n % batch_size == 0, F.lit(batch_size)).otherwise(n % batch_size)).cast("long").alias("last_batch_size"),
    )


def running_metrics(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    batch_size: int,
    log_interval: int | None,
    sums: dict,
    ratios: dict,
) -> DataFrame:
    """Metric values over all rows seen so far, reported every ``log_interval`` batches.

    ``sums`` maps a partial-sum name to a per-row Column; ``ratios`` maps an output
    name to ``(numerator_sum, denominator_sum)``. Rows are first reduced to one row
    per (key, batch), so the running window only sees ``n / batch_size`` rows."""
    if not log_interval or log_interval <= 0:
        return df.sparkSession.createDataFrame([], "batch long")
    keys = list(keys)
    numbered = batch_numbers(df, keys, order, batch_size)
    per_batch = numbered.groupBy(*keys, "batch").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    w = Window.partitionBy(*keys).orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = per_batch.select(*keys, "batch", *[F.sum(n).over(w).alias(n) for n in sums])
    out = run.where(F.col("batch") % log_interval == 0)
    return out.select(*keys, "batch", *sums.keys(), *[(F.col(a) / F.col(b)).alias(name) for name, (a, b) in ratios.items()])
