"""A suite over a stream equals the suite over the table."""

import pytest
from pyspark.sql import functions as F

from evalspark.operators.evaluate import evaluate_suite
from evalspark.session import shared_path
from evalspark.streaming.suite import stream_suite

SCHEMA = "model string, task string, item_id long, prediction string, label string, value double, other double, tags array<string>, guess array<string>"


def rows(spark, lo, hi):
    words = F.split(F.lit("the a cat sat on mat red dog ran far and wide"), " ")

    def text(k):
        return F.array_join(F.transform(F.sequence(F.lit(0), F.col("id") % 7 + 2), lambda i: F.get(words, (i * k + F.col("id")) % 12)), " ")

    tags = F.transform(F.sequence(F.lit(0), F.col("id") % 5), lambda i: F.when((i + F.col("id")) % 3 == 0, "B-X").when((i + F.col("id")) % 3 == 1, "I-X").otherwise("O"))
    return spark.range(lo, hi).select(
        F.concat(F.lit("m"), (F.col("id") % 2).cast("string")).alias("model"), F.lit("t").alias("task"), F.col("id").alias("item_id"),
        F.concat(text(1), F.when(F.col("id") % 6 == 0, ". done").otherwise(".")).alias("prediction"), F.concat(text(2), F.lit(" .")).alias("label"),
        (F.col("id") % 9).cast("double").alias("value"), (F.col("id") % 5 + F.col("id") % 2).cast("double").alias("other"),
        tags.alias("tags"), F.reverse(tags).alias("guess"))


@pytest.fixture()
def files(spark):
    path = shared_path(spark, "suite-src")
    for k in range(3):
        rows(spark, 20 * k, 20 * k + 20).coalesce(1).write.mode("append").parquet(path)
    return path


def source(spark, path):
    return spark.newSession().readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def table(df):
    return {(r["model"], r["metric"], r["sub_metric"]): r["score"] for r in df.collect()}


def count_states():
    def init(options):
        return {"n": 0, "words": []}

    def update(state, predictions, labels, options):
        return {"n": state["n"] + len(predictions), "words": state["words"] + [p.split()[0] for p in predictions]}

    def result(state, options):
        return {"n": state["n"], "first_words": len(set(state["words"]))}

    return {"init": init, "update": update, "result": result}


TEXT = ["accuracy", {"name": "exact_match", "options": {"normalize": True}}, {"name": "rouge", "options": {"metrics": ["rouge1", "rougeL"], "stats": ["f", "p"]}},
        {"name": "jaccard", "options": {"ngram": 2}}, "novelty", "avg_prediction_length", {"name": "keyword_match", "options": {"keywords_to_match": ["cat", "far"]}},
        "meteor", "bleu", "distinct_ngram", "word_entropy", "f1_score", {"name": "precision", "options": {"average": "macro"}},
        {"name": "semantic_similarity"}, "no_such_metric", {"name": "custom", "options": count_states()}]


def test_text_suite_equals_batch_over_micro_batches_and_a_restart(spark, files):
    base = shared_path(spark, "suite")
    stream_suite(source(spark, files), TEXT, location=base)
    rows(spark, 60, 75).coalesce(1).write.mode("append").parquet(files)
    got = table(stream_suite(source(spark, files), TEXT, location=base))
    want = table(evaluate_suite(spark.read.parquet(files), TEXT, persist=False))
    errors = {k for k in got if str(k[2]).startswith("error")}
    # neither vectors nor cleaned texts are here: these two report an error, as in the batch
    assert {k[1] for k in errors} == {"semantic_similarity", "novelty"} == {k[1] for k in want if str(k[2]).startswith("error")}
    plain = {k: v for k, v in got.items() if k not in errors}
    assert plain.keys() == {k for k in want if not str(k[2]).startswith("error")}
    assert all(v == pytest.approx(want[k], abs=1e-12) for k, v in plain.items()) and len(plain) > 30
    assert got[("m0", "custom", "n")] == 38.0
    assert spark.read.parquet(f"{base}/states/out/prf").select("batch_id").distinct().count() == 4


@pytest.mark.parametrize("metrics,pred,label", [(["pearson", "spearman", "precision", "accuracy"], "value", "other"),
                                                ([{"name": "seqeval", "options": {"mode": "strict", "scheme": "IOB2"}}], "guess", "tags")])
def test_numbers_and_tags_equal_batch(spark, files, metrics, pred, label):
    got = table(stream_suite(source(spark, files), metrics, pred=pred, label=label))
    want = table(evaluate_suite(spark.read.parquet(files), metrics, pred=pred, label=label, persist=False))
    assert got.keys() == want.keys() and all(v == pytest.approx(want[k], abs=1e-12) for k, v in got.items())


def test_a_stream_without_files_or_metrics_is_empty(spark):
    path = shared_path(spark, "suite-none")
    rows(spark, 0, 0).write.parquet(path)
    assert stream_suite(source(spark, path), ["accuracy", "bleu", "rouge"]).count() == 0
    assert stream_suite(source(spark, path), ["nothing"]).count() == 0
