"""T2 / T3 as a suite: a list of metric names over a stream, as E1 takes it over a table.

Metrics that are aggregates of row scores (M1, M5, M9-M12, M19-M21, M23, M25, M26), and those whose row
scores need a projection first (M7, M8, M15, M18), are fused into one streaming ``groupBy(keys).agg``
whose state Spark keeps. The others leave mergeable statistics per micro-batch, each in the folder
of its batch id (M2-M4 confusion counts, M6 sums, M13 and M14 n-gram counts, M16 distinct pairs, M17
counts per type, M24 user states), and are scored from the merged statistics by the batch code.
So a suite reads the source at most twice, and its result equals the batch suite's over the same
rows, whatever the micro-batches, also after a replay or a restart with the same ``location``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import PRF, as_specs
from ..operators.metrics import classification as C
from ..operators.metrics import corpus as K
from ..operators.metrics import custom as Cu
from ..operators.metrics import overlap as O
from ..operators.metrics import registry
from ..operators.metrics import sequence as Sq
from ..operators.metrics import vectors as Ve
from ..operators.metrics.base import long_from_wide
from ..session import shared_path
from .stream import read_written, run_foreach_batch, running_aggregate, save_batch

#: (stages of projections, aggregates, finish(wide, keys)) of metrics whose rows are projected first.
PROJECTED: dict[str, Callable] = {}
#: (state(batch, keys), result(states, keys)) of metrics with statistics per micro-batch.
STATES: dict[str, Callable] = {}


def _into(table: dict, *names: str):
    def deco(fn):
        table.update({n: fn for n in names})
        return fn
    return deco


@_into(PROJECTED, "rouge")
def _rouge(df, prefix, pred, label, metrics=("rouge-l",), stats=("f",), **o):
    return O.rouge_parts(pred, label, metrics, stats, prefix)


@_into(PROJECTED, "pearson", "pearson_correlation")
def _pearson(df, prefix, pred, label, **o):
    x, y, bad = K.numeric_pair(df, pred, label)
    stage = {f"{prefix}x": x, f"{prefix}y": y, f"{prefix}b": bad}
    aggs = K.pearson_aggs(F.col(f"{prefix}x"), F.col(f"{prefix}y"), F.col(f"{prefix}b"), prefix)
    return [stage], aggs, lambda wide, keys: long_from_wide(K.pearson_score(wide, keys, prefix), keys, [("r", "pearson", "")])


@_into(PROJECTED, "bertscore", "token_match")
def _match(df, prefix, pred, label, idf=False, **o):
    if idf:
        raise ValueError("document frequencies are known at the end of a stream only: idf needs the batch suite")
    entries = Ve.match_entries(f"{prefix}s")
    aggs = [e.alias(f"{prefix}{i}") for i, (_, _, e) in enumerate(entries)]
    named = [(f"{prefix}{i}", m, s) for i, (m, s, _) in enumerate(entries)]
    return [{f"{prefix}s": Ve.token_match(pred, label)}], aggs, lambda wide, keys: long_from_wide(wide, keys, named)


@_into(STATES, "bleu")
def _bleu(df, pred, label, weights=(0.25, 0.25, 0.25, 0.25), smoothing="method1", order=(), **o):
    order = [order] if isinstance(order, str) else list(order)

    def result(states, keys):
        return long_from_wide(O.bleu_score(O.merge_bleu_states(states, keys), keys, weights, smoothing), keys, [("score", "bleu", "")])

    return lambda b, keys: O.bleu_states(b, keys, pred, label, len(weights), order), result


@_into(STATES, "distinct_ngram")
def _distinct(df, pred, label, ngrams=(1, 2), **o):
    return lambda b, keys: K.ngram_states(b, keys, pred, ngrams), lambda s, keys: K.distinct_from_states(K.merge_ngram_states(s, keys), keys)


@_into(STATES, "word_entropy")
def _entropy(df, pred, label, **o):
    return lambda b, keys: K.entropy_states(b, keys, pred), lambda s, keys: K.entropy_from_states(K.merge_entropy_states(s, keys), keys)


@_into(STATES, "spearman", "spearman_correlation")
def _spearman(df, pred, label, **o):
    return lambda b, keys: K.spearman_states(b, keys, pred, label), lambda s, keys: K.spearman_from_states(K.merge_spearman_states(s, keys), keys)


@_into(STATES, "sequence_labeling", "seqeval")
def _sequence(df, pred, label, average_type="micro avg", mode="default", scheme=None, **o):
    if not dict(df.dtypes)[label].startswith("array"):
        raise ValueError("on a stream a tag sequence is one list per row")
    s = Sq.scheme_of(mode, scheme)
    return (lambda b, keys: Sq.counts_of_lists(b, keys, label, pred, s),
            lambda st, keys: Sq.scores_from_counts(Sq.merge_counts(st, keys), keys, average_type))


@_into(STATES, "custom_script", "custom")
def _custom(df, pred, label, init=None, update=None, result=None, merge=None, name="custom", options=None, **o):
    opts = options or o

    def finish(states, keys):
        # parts of one batch stay together and batches stay in order
        ordered = states.withColumn("part", F.col("batch_id").cast("long") * Cu.MERGE_WIDTH)
        out = Cu.custom_result(Cu.merge_custom_states(ordered, keys, merge), result, keys, merge, opts, name)
        text = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.col("error"))).otherwise(F.col("sub_metric"))
        return out.withColumn("sub_metric", text).drop("error")

    return lambda b, keys: Cu.merge_custom_states(Cu.custom_states(b, init, update, keys, pred, label, opts), keys, merge), finish


def _pairs(df, pred, label):
    return lambda b, keys: b.groupBy(*keys, C._class_key(b, label).alias("_l"), C._class_key(b, pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))


def _prf(df, pred, label, which, average, zero_division):
    """Confusion counts, scored as ``prf_scores`` does."""
    def result(states, keys):
        pairs = states.groupBy(*keys, "_l", "_p").agg(F.sum("_n").alias("_n"))
        if not C.comparable(df, pred, label, average):
            return C.prf_zeros(pairs, keys, which)
        return C.prf_from_confusion(C.confusion_from_pairs(pairs, keys), keys, which, average, zero_division, C.both_numeric(df, pred, label))

    return result


def stream_suite(df: DataFrame, metrics, keys: Sequence[str] = ("model", "task"), pred: str = "prediction", label: str = "label",
                 name: str = "stream-suite", location: str | None = None) -> DataFrame:
    """Every requested metric over the stream ``df``, drained -> ``metrics_long``.

    Unknown names are skipped and a metric that does not fit leaves an error row, as in
    ``evaluate_suite``. ``location`` (a folder the cluster shares) lets a later call go on where
    this one ended."""
    keys, base = list(keys), location or shared_path(df.sparkSession, name)
    stages: list[dict] = []
    aggs: list = []
    entries: list[tuple[str, str, str]] = []
    finishes: list[Callable] = []
    states: dict[str, tuple[Callable, list[Callable]]] = {}
    prf: dict[tuple, list[str]] = {}
    empty = df.sparkSession.createDataFrame([], df.schema)
    for i, spec in enumerate(s for s in as_specs(metrics) if s.name.lower() in registry.METRICS):
        n, prefix = spec.name.lower(), f"_x{i}_"
        try:
            if n in PRF:
                which, average, zero = registry.METRICS[n](df, keys, pred, label, **spec.options)[1]
                prf.setdefault((average, zero), []).append(which)
            elif n in PROJECTED:
                st, ag, finish = PROJECTED[n](df, prefix, pred, label, **spec.options)
                finish(_projected(empty, st).groupBy(*keys).agg(*ag), keys).schema
                for depth, stage in enumerate(st):
                    stages += [{}] * (depth + 1 - len(stages))
                    stages[depth] = stages[depth] | stage
                aggs += ag
                finishes.append(finish)
            elif n in STATES:
                state, result = STATES[n](df, pred, label, **spec.options)
                result(state(empty, keys).withColumn("batch_id", F.lit(0)), keys).schema
                states[f"s{i}"] = (state, [result])
            else:
                kind, value = registry.METRICS[n](df, keys, pred, label, **spec.options)
                if kind != "aggs":
                    raise ValueError(f"{n} has no streaming form")
                empty.groupBy(*keys).agg(*[e for _, _, e in value]).schema
                for k, (m, s, e) in enumerate(value):
                    aggs.append(e.alias(f"{prefix}{k}"))
                    entries.append((f"{prefix}{k}", m, s))
        except Exception as e:  # noqa: BLE001 - one metric must not stop the suite
            aggs.append(F.lit(None).cast("double").alias(f"{prefix}e"))
            entries.append((f"{prefix}e", n, f"error: {e}"))
    if prf:
        states["prf"] = (_pairs(df, pred, label), [_prf(df, pred, label, tuple(w), a, z) for (a, z), w in prf.items()])
    parts = []
    if aggs:
        wide = running_aggregate(_projected(df, stages), keys, aggs, name, f"{base}/fused")
        parts += [long_from_wide(wide, keys, entries)] if entries else []
        parts += [f(wide, keys) for f in finishes]
    if states:
        def save(b: DataFrame, i: int, out: str) -> None:
            b = b.persist(StorageLevel.MEMORY_AND_DISK)  # every state reads the micro-batch
            try:
                for k, (state, _) in states.items():
                    save_batch(state(b, keys), f"{out}/{k}", i)
            finally:
                b.unpersist()

        out = run_foreach_batch(df, name, save, location=f"{base}/states")
        for k, (state, results) in states.items():
            table = read_written(df, f"{out}/{k}", lambda b, state=state: state(b, keys))
            parts += [r(table, keys) for r in results]
    if not parts:
        return df.sparkSession.createDataFrame([], ", ".join([f"`{k}` string" for k in keys] + ["metric string", "sub_metric string", "score double"]))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def _projected(df: DataFrame, stages: list[dict]) -> DataFrame:
    for stage in stages:
        df = df.withColumns(stage)
    return df
