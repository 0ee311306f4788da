"""Streams over several micro-batches, user-metric states, metrics and tasks that fail alone."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from evalspark.functions.text import py_str, ws_split
from evalspark.operators.evaluate import evaluate_suite, release
from evalspark.operators.metrics import corpus as K
from evalspark.operators.metrics.custom import default_merge, metric_custom
from evalspark.operators.recipes import run_tasks
from evalspark.operators.respond import infer_batches
from evalspark.session import shared_path
from evalspark.sources.readers import read_splits
from evalspark.spec import TaskSpec
from evalspark.streaming import stream as T


@pytest.fixture()
def three_files(spark):
    """Three files of ten rows, read one file a micro-batch."""
    path = shared_path(spark, "stream-src")
    for k in range(3):
        spark.createDataFrame([("m", "t", 10 * k + i, f"word{i % 4} word{k} only{k}x{i}") for i in range(10)],
                              "model string, task string, id long, text string").coalesce(1).write.mode("append").parquet(path)
    return path


def source(spark, path):
    session = spark.newSession()  # nothing set by an earlier stream
    return session.readStream.schema("model string, task string, id long, text string").option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("n", [0, 7, 13, 30, 10_000_000, 10**12])
def test_take_is_exact_over_micro_batches(spark, three_files, n):
    assert T.stream_take(source(spark, three_files), n, ["id"], "take").count() == min(n, 30)


def test_take_resumes_and_replays(spark, three_files):
    base = shared_path(spark, "take-again")
    assert T.stream_take(source(spark, three_files), 25, ["id"], "take", base).count() == 25
    # new files after a restart: the quota is already filled
    spark.createDataFrame([("m", "t", 100 + i, "x") for i in range(10)], "model string, task string, id long, text string").write.mode("append").parquet(three_files)
    assert T.stream_take(source(spark, three_files), 25, ["id"], "take", base).count() == 25
    # a replayed batch replaces its own rows
    T.save_batch(spark.read.parquet(three_files).limit(3).select("id"), f"{base}/replay", 1)
    T.save_batch(spark.read.parquet(three_files).limit(3).select("id"), f"{base}/replay", 1)
    assert spark.read.parquet(f"{base}/replay").count() == 3


def test_corpus_counts_keep_every_micro_batch(spark, three_files):
    keys = ["model", "task"]
    counts = T.corpus_counts(source(spark, three_files), keys, "text", [1, 2], "counts")
    batch = spark.read.parquet(three_files)
    want = {r.sub_metric: r.score for r in K.metric_distinct_ngram(batch, keys, "text", ngrams_list=[1, 2]).collect()}
    assert {r.sub_metric: r.score for r in T.distinct_from_counts(counts, keys).collect()} == want
    assert counts.select("batch_id").distinct().count() == 3
    entropy = T.entropy_from_counts(counts, keys).first().score
    assert abs(entropy - K.metric_word_entropy(batch, keys, "text").first().score) < 1e-9


def test_running_aggregate_equals_batch(spark, three_files):
    words = F.size(ws_split(py_str("text")))
    got = T.running_aggregate(source(spark, three_files), ["model", "task"], [F.sum(words).alias("n"), F.covar_pop("id", words).alias("c")], "run").collect()
    want = spark.read.parquet(three_files).groupBy("model", "task").agg(F.sum(words).alias("n"), F.covar_pop("id", words).alias("c")).first()
    assert len(got) == 1 and got[0].n == want.n and math.isclose(got[0].c, want.c, abs_tol=1e-9)


def scored(df):
    """Predictions that share some words with their labels."""
    return df.select("model", "task", "id", F.col("text").alias("prediction"),
                     F.concat(F.col("text"), F.lit(" and word"), (F.col("id") % 3).cast("string"), F.lit(" too")).alias("label"))


@pytest.mark.parametrize("smoothing,order", [("method1", []), ("method4", []), ("method6", ["id"]), ("method7", ["id"])])
def test_stream_bleu_equals_batch_after_a_restart_and_a_replay(spark, three_files, smoothing, order):
    from evalspark.operators.metrics import overlap as O

    keys, base = ["model", "task"], shared_path(spark, "bleu")
    T.stream_bleu(scored(source(spark, three_files)), keys, "bleu", smoothing=smoothing, order=order, location=base)
    spark.createDataFrame([("m", "t", 100 + i, f"word{i} late words here") for i in range(5)], "model string, task string, id long, text string") \
        .coalesce(1).write.mode("append").parquet(three_files)
    got = T.stream_bleu(scored(source(spark, three_files)), keys, "bleu", smoothing=smoothing, order=order, location=base)
    want = O.metric_bleu(scored(spark.read.parquet(three_files)), smoothing=smoothing, order=order).first()["score"]
    assert got.first()["score"] == pytest.approx(want, abs=1e-12) and want > 0
    states = spark.read.parquet(f"{base}/out")
    assert states.select("batch_id").distinct().count() == 4
    # the same batch once more: its folder is replaced, the sums stay
    again = spark.createDataFrame(states.where("batch_id = 2").drop("batch_id").collect(), states.drop("batch_id").schema)
    T.save_batch(again, f"{base}/out", 2)
    merged = O.bleu_score(O.merge_bleu_states(spark.read.parquet(f"{base}/out"), keys), keys, (0.25,) * 4, smoothing)
    assert merged.first()["score"] == pytest.approx(want, abs=1e-12)


def test_a_stream_without_files_has_no_rows(spark):
    path = shared_path(spark, "no-files")
    spark.createDataFrame([], "model string, task string, id long, text string").write.parquet(path)
    assert T.stream_bleu(scored(source(spark, path)), ["model", "task"], "none").count() == 0
    assert T.running_aggregate(source(spark, path), ["model"], [F.count("id").alias("n")], "none").count() == 0


# --- user metrics --------------------------------------------------------------------------

def rows(spark, n=100, parts=4):
    return spark.range(n).select(F.lit("m").alias("model"), F.lit("t").alias("task"), F.col("id").cast("string").alias("prediction"),
                                 F.col("id").cast("string").alias("label")).repartition(parts)


def test_list_states_merge(spark):
    def update(state, preds, labels, options):
        return state + preds

    got = metric_custom(rows(spark), lambda o: [], update, lambda s, o: {"n": len(s), "different": len(set(s))}).collect()
    assert {r.sub_metric: r.score for r in got} == {"n": 100, "different": 100} and all(r.error is None for r in got)


def test_default_merge_never_drops():
    assert default_merge({"a": 1, "b": [1], "c": {"d": 2}}, {"a": 2, "b": [2], "c": {"d": 3}, "e": 4}) == {"a": 3, "b": [1, 2], "c": {"d": 5}, "e": 4}
    assert default_merge({"a": None, "k": "x"}, {"a": 1, "k": "x"}) == {"a": 1, "k": "x"}
    for a, b in (({"a": "x"}, {"a": "y"}), ({1}, {2}), (True, False)):
        with pytest.raises(TypeError):
            default_merge(a, b)


def test_user_metric_errors_become_rows(spark):
    def broken(state, preds, labels, options):
        raise ValueError("no update")

    got = metric_custom(rows(spark), lambda o: 0, broken, lambda s, o: s).collect()
    assert [(r.sub_metric, r.score, r.error) for r in got] == [("error", None, "no update")]
    unmerged = metric_custom(rows(spark), lambda o: set(), lambda s, p, l, o: s | set(p), lambda s, o: len(s)).collect()
    assert unmerged[0].sub_metric == "error" and "merge=" in unmerged[0].error
    merged = metric_custom(rows(spark), lambda o: set(), lambda s, p, l, o: s | set(p), lambda s, o: len(s), merge=lambda a, b: a | b).collect()
    assert merged[0].score == 100


# --- isolation -----------------------------------------------------------------------------

@pytest.mark.parametrize("bad", ["semantic_similarity", {"name": "exact_match", "options": {"no_such_option": 1}}, "factual_consistency",
                                 {"name": "sequence_labeling", "options": {"mode": "strict", "scheme": "no such"}}])
def test_a_bad_metric_leaves_the_others(spark, bad):
    out = evaluate_suite(rows(spark), ["accuracy", bad])
    got = {(r.metric, r.sub_metric.split(":")[0]): r.score for r in out.collect()}
    release(out)
    name = bad if isinstance(bad, str) else bad["name"]
    assert got == {("accuracy", ""): 1.0, (name, "error"): None}


def test_suite_releases_its_input(spark):
    spark.catalog.clearCache()
    out = evaluate_suite(rows(spark), ["accuracy", "distinct_ngram", "f1_score"], persist=True)
    assert out.count() == 4 and out._cached_input.storageLevel.useMemory
    release(out)
    assert not out._cached_input.storageLevel.useMemory


def test_tasks_without_results_get_error_rows(spark):
    items = spark.createDataFrame([(1, "a", "b")], "item_id long, input_text string, target_text string")
    responses = spark.createDataFrame([("sum", 1, "m0", "b"), ("sum", 2, "m1", "b")], "task string, item_id long, model string, response string")
    out = run_tasks([TaskSpec("sum", "summarization", metrics=["exact_match"])], {"sum": items}, responses, ["m0", "m1", "m2"])
    got = {(r.model, r.status): (r.score, r.error) for r in out.collect()}
    assert got == {("m0", "ok"): (1.0, None), ("m1", "error"): (None, "No results obtained for this task"), ("m2", "error"): (None, "No results obtained for this task")}


def test_inference_batches_are_small_and_settings_stay(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    prompts = spark.range(25).select(F.col("id").cast("string").alias("prompt")).coalesce(1)

    def sizes(texts):
        return [str(len(texts))] * len(texts)

    got = infer_batches(prompts, sizes, batch_size=10).groupBy("response").count().collect()
    assert {r.response: r["count"] for r in got} == {"10": 20, "5": 5}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_only_absent_splits_are_skipped(spark):
    path = shared_path(spark, f"splits-{uuid.uuid4().hex}")
    spark.range(3).write.option("header", "true").csv(f"{path}/train.csv")
    assert read_splits(spark, path, "all", "id long").count() == 3
    assert read_splits(spark, path, "test", "id long") is None
    with pytest.raises(Exception):
        read_splits(spark, path, "train", "id no_such_type")
