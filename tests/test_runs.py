"""Runs that are saved after each model, broken and resumed."""

import pytest
from pyspark.sql import functions as F

from evalspark.operators.runs import ResultStore, run_models
from evalspark.session import shared_path


class Stop(BaseException):
    """The program ends here."""


def evaluator(spark, calls, broken=(), stop=None):
    def evaluate(model):
        if model == stop:
            raise Stop
        calls.append(model)
        if model in broken:
            raise OSError(f"no weights for {model}\nmore lines")
        return spark.createDataFrame([(model, t, "accuracy", len(model) + k / 10) for k, t in enumerate(("a", "b"))], "model string, task string, metric string, score double")
    return evaluate


def rows(df):
    return sorted((r["model"], r["task"], r["metric"], r["score"], r["status"], r["error"]) for r in df.select("model", "task", "metric", "score", "status", "error").collect() if r["task"]) \
        + sorted((r["model"], r["error"]) for r in df.collect() if r["status"] == "error")


MODELS = ["org/model one", "bad", "ORG/model one", "last"]


def test_a_broken_run_resumes_and_equals_an_unbroken_one(spark):
    whole, path = shared_path(spark, "whole"), shared_path(spark, "broken")
    want = rows(run_models(spark, MODELS, evaluator(spark, [], broken=["bad"]), whole, "spec"))
    calls = []
    with pytest.raises(Stop):
        run_models(spark, MODELS, evaluator(spark, calls, broken=["bad"], stop="ORG/model one"), path, "spec")
    assert calls == MODELS[:2] and ResultStore(spark, path, "spec").finished() == {MODELS[0]: "ok", "bad": "error"}
    got = rows(run_models(spark, MODELS, evaluator(spark, calls, broken=["bad"]), path, "spec"))
    assert calls == MODELS and got == want and len(got) == 7
    assert ("bad", "OSError: no weights for bad") in got
    # nothing is left to do
    assert rows(run_models(spark, MODELS, evaluator(spark, calls, broken=["bad"]), path, "spec")) == want and calls == MODELS


def test_errors_are_tried_again_on_request(spark):
    path, calls = shared_path(spark, "retry"), []
    run_models(spark, MODELS, evaluator(spark, calls, broken=["bad"]), path, "spec")
    out = run_models(spark, MODELS, evaluator(spark, calls), path, "spec", retry_errors=True)
    assert calls == [*MODELS, "bad"] and out.where("status = 'error'").count() == 0 and out.count() == 8


def test_rows_without_a_record_do_not_count(spark):
    path = shared_path(spark, "half")
    store = ResultStore(spark, path, "spec")
    assert store.results().count() == 0 and store.finished() == {}
    store.save("m", evaluator(spark, [])("m"))
    # a second model's rows were written, but the program ended before its record
    evaluator(spark, [])("other").select("model", "task", "metric", F.lit(None).cast("string").alias("sub_metric"), "score", F.lit(None).cast("string").alias("status"),
                                         F.lit(None).cast("string").alias("error")).write.parquet(f"{path}/results/key=other-0")
    assert {r["model"] for r in store.results().collect()} == {"m"}
    with pytest.raises(ValueError, match="another run"):
        run_models(spark, ["m"], evaluator(spark, []), path, "other spec")
