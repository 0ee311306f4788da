"""User-defined metrics ``init / update / merge / result``.

Each partition folds its rows into one state per key (``mapInPandas``); the states are merged in
two levels (``applyInPandas`` per key and group of partitions, then per key), so no task sees the
states of all partitions, and ``result`` turns the merged state into a number or a dict. The
reference's contract has no merge: numbers add up, lists are concatenated, dicts merge field by
field, equal values stay. Any other state needs ``merge=`` and otherwise ends in an error row, as
do errors of ``init``, ``update`` and ``result``: a failing metric never fails the job.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partitions whose states one task merges before the final merge.
MERGE_WIDTH = 256


def _number(x) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def default_merge(a, b):
    if isinstance(a, dict) and isinstance(b, dict):
        return {**a, **{k: default_merge(a[k], v) if k in a else v for k, v in b.items()}}
    if _number(a) and _number(b):
        return a + b
    if isinstance(a, list) and isinstance(b, list):
        return a + b
    if a is None or b is None:
        return b if a is None else a
    if type(a) is type(b) and isinstance(a, (bool, str, bytes)) and a == b:
        return a
    raise TypeError(f"states of {type(a).__name__} have no default merge; pass merge=")


PARTIAL = "part long, state binary, error string"


def _key_schema(keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}` string" for k in keys)


def custom_states(df: DataFrame, init: Callable, update: Callable, keys: Sequence[str], pred: str, label: str, options: dict | None = None) -> DataFrame:
    """(keys, part, state, error): the rows of each partition folded into one state per key."""
    keys, opts = list(keys), options or {}

    def partials(it):
        states, errors = {}, {}
        for pdf in it:
            for key, g in pdf.groupby(keys, dropna=False, sort=False):
                k = key if isinstance(key, tuple) else (key,)
                if k in errors:
                    continue
                try:
                    st = states[k] if k in states else init(opts)
                    states[k] = update(st, g[pred].tolist(), g[label].tolist(), opts)
                except Exception as e:  # noqa: BLE001 - errors become an error row, not a failed job
                    errors[k] = str(e)
        part = TaskContext.get().partitionId()
        rows = [dict(zip(keys, k), part=part, state=None if k in errors else pickle.dumps(v), error=errors.get(k))
                for k, v in {**dict.fromkeys(errors), **states}.items()]
        yield pd.DataFrame(rows, columns=[*keys, "part", "state", "error"]).astype({"part": "int64"})

    source = df.select(*[df[k].cast("string").alias(k) for k in keys], pred, label)
    return source.mapInPandas(partials, f"{_key_schema(keys)}, {PARTIAL}")


def _fold(pdf: pd.DataFrame, merge: Callable):
    """(merged state, first error) of some states."""
    bad = pdf["error"].dropna()
    if len(bad):
        return None, bad.min()
    st = None
    try:
        for i, blob in enumerate(pdf.sort_values("part")["state"]):
            s = pickle.loads(blob)
            st = s if i == 0 else merge(st, s)
    except Exception as e:  # noqa: BLE001
        return None, str(e)
    return st, None


def merge_custom_states(states: DataFrame, keys: Sequence[str], merge: Callable | None = None) -> DataFrame:
    """States of up to ``MERGE_WIDTH`` neighbouring parts merged into one, in the order of ``part``."""
    keys, merge = list(keys), merge or default_merge

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        st, error = _fold(pdf, merge)
        base = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([{**base, "part": pdf["group"].iloc[0], "state": None if error is not None else pickle.dumps(st), "error": error}])

    grouped = states.withColumn("group", F.floor(F.col("part") / MERGE_WIDTH)).groupBy(*keys, "group")
    return grouped.applyInPandas(combine, f"{_key_schema(keys)}, {PARTIAL}")


def custom_result(states: DataFrame, result: Callable, keys: Sequence[str], merge: Callable | None = None, options: dict | None = None,
                  name: str = "custom") -> DataFrame:
    """Merge all states of a key and turn them into metric rows."""
    keys, merge, opts = list(keys), merge or default_merge, options or {}

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        st, error = _fold(pdf, merge)
        rows = [(name, "error", None, error)]
        if error is None:
            try:
                res = result(st, opts)
                items = res.items() if isinstance(res, dict) else [("", res)]
                rows = [(name, str(k), float(v) if v is not None else None, None) for k, v in items]
            except Exception as e:  # noqa: BLE001
                rows = [(name, "error", None, str(e))]
        base = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([{**base, "metric": m, "sub_metric": s, "score": v, "error": err} for m, s, v, err in rows])

    return states.groupBy(*keys).applyInPandas(finish, f"{_key_schema(keys)}, metric string, sub_metric string, score double, error string")


def metric_custom(
    df: DataFrame,
    init: Callable,
    update: Callable,
    result: Callable,
    merge: Callable | None = None,
    keys: Sequence[str] = ("model", "task"),
    pred: str = "prediction",
    label: str = "label",
    options: dict | None = None,
    name: str = "custom",
) -> DataFrame:
    states = custom_states(df, init, update, keys, pred, label, options)
    return custom_result(merge_custom_states(states, keys, merge), result, keys, merge, options, name)
