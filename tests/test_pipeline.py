"""Driver contract, sequence spans, sources and streaming on the smallest tables."""

import pytest
from pyspark.sql import functions as F


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["model", "task", "metric", "sub_metric", "score"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def test_sequence_spans(spark):
    from evalspark.operators.metrics import sequence as Sq

    df = spark.createDataFrame([("m", "t", 0, ["O", "B-LOC", "I-LOC"], ["O", "B-LOC", "O"]),
                                ("m", "t", 1, ["O"], ["B-LOC"])],
                               "model string, task string, item_id int, label array<string>, prediction array<string>")
    rows = Sq.from_arrays(df, ["model", "task"], "item_id", "label", "prediction")
    out = {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows).collect()}
    assert out == {"overall_precision": 0.0, "overall_recall": 0.0, "overall_f1": 0.0}
    df2 = spark.createDataFrame([("m", "t", 0, ["B-PER", "I-PER", "O", "B-LOC"], ["B-PER", "I-PER", "O", "B-ORG"])],
                                "model string, task string, item_id int, label array<string>, prediction array<string>")
    rows2 = Sq.from_arrays(df2, ["model", "task"], "item_id", "label", "prediction")
    out2 = {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows2).collect()}
    assert out2["overall_precision"] == pytest.approx(0.5) and out2["overall_recall"] == pytest.approx(0.5)


def test_prefix_before_matches_row_number(spark):
    from pyspark.sql import Window

    from evalspark.operators.ranking import prefix_before

    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 5000).alias("v"))
    got = prefix_before(df, ["k"], ["v"], out="pos", buckets=17)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("v")) - 1)
    assert sorted(got.select("k", "v", "pos").collect()) == sorted(want.collect())


def positions(df, keys, order, **kw):
    from pyspark.sql import Window

    from evalspark.operators.ranking import prefix_before

    got = prefix_before(df, keys, order, out="pos", **kw)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return got.select(*keys, *order, "pos"), want.select(*keys, *order, "pos")


def test_one_time_stamp_of_a_hot_key_is_spread(spark):
    """A third of all rows share key and time stamp; (key, time stamp, id) still splits them."""
    from evalspark.operators.ranking import range_buckets

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("ts"), F.col("id"))
    sizes = [r["count"] for r in range_buckets(df, ["k"], ["ts", "id"], buckets=30).groupBy("_bkt").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 2.5 * 30_000 / 30
    got, want = positions(df, ["k"], ["ts", "id"], buckets=30)
    assert sorted(got.collect()) == sorted(want.collect())


def test_more_than_1024_buckets_nulls_and_strings(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), F.when(F.col("id") % 11 > 0, F.md5(F.col("id").cast("string"))).alias("s"), "id")
    got, want = positions(df, ["k"], ["s", "id"], buckets=1500)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    got, want = positions(df.limit(0), ["k"], ["s", "id"])
    assert got.count() == 0


def test_building_a_scan_runs_no_job(spark):
    from evalspark.operators.ranking import prefix_before

    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    df = spark.range(50_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = prefix_before(df, ["k"], ["v"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
    assert out.agg(F.max("before")).first()[0] == 16_666


def test_template_fallback_and_none(spark):
    from evalspark.functions import prompts as P

    df = spark.createDataFrame([("hi", None)], "input_text string, other string")
    row = P.generic_prompts(df, "{input_text}|{other}").collect()[0]
    assert row["prompt"] == "hi|None"
    assert P.generic_prompts(df, "{missing}").collect()[0]["prompt"] == "hi"
    assert P.sentiment_prompts(df, "").collect()[0]["prompt"] == ""


def test_custom_metric_error_value(spark):
    from evalspark.operators.metrics.custom import metric_custom

    df = spark.createDataFrame([("m", "t", "a b", "x")], "model string, task string, prediction string, label string")

    def bad_result(state, options):
        raise RuntimeError("boom")

    out = metric_custom(df, lambda o: {"n": 0}, lambda s, p, l, o: {"n": s["n"] + len(p)}, bad_result).collect()[0]
    assert out["sub_metric"] == "error" and "boom" in out["error"]


def test_prefix_max_matches_window(spark):
    from pyspark.sql import Window

    from evalspark.operators.ranking import prefix_max

    df = spark.range(0, 4000).select((F.col("id") % 2).alias("k"), ((F.col("id") * 131) % 4000).alias("pos"),
                                     F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    got = prefix_max(df, ["k"], "pos", {"m": F.col("v")}, buckets=16)
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("m", F.max("v").over(w))
    assert sorted(got.select("k", "pos", "v", "m").collect()) == sorted(want.collect())


def test_sequence_strict_iob2(spark):
    from evalspark.operators.metrics import sequence as Sq

    df = spark.createDataFrame([("m", "t", 0, ["I-PER", "I-PER", "O", "B-LOC", "I-LOC"], ["I-PER", "I-PER", "O", "B-LOC", "I-LOC"])],
                               "model string, task string, item_id int, label array<string>, prediction array<string>")
    rows = Sq.from_arrays(df, ["model", "task"], "item_id", "label", "prediction")
    lenient = {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows).collect()}
    strict = {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows, mode="strict", scheme="IOB2").collect()}
    assert lenient["overall_f1"] == 1.0 and strict["overall_f1"] == 1.0
    df2 = spark.createDataFrame([("m", "t", 0, ["B-PER", "I-PER", "O"], ["I-PER", "I-PER", "O"])],
                                "model string, task string, item_id int, label array<string>, prediction array<string>")
    rows2 = Sq.from_arrays(df2, ["model", "task"], "item_id", "label", "prediction")
    assert {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows2).collect()}["overall_f1"] == 1.0
    s2 = {r["sub_metric"]: r["score"] for r in Sq.metric_sequence_labeling(rows2, mode="strict", scheme="IOB2").collect()}
    assert s2["overall_precision"] == 0.0 and s2["overall_recall"] == 0.0
    bad = {r["sub_metric"] for r in Sq.metric_sequence_labeling(rows2, average_type="nope").collect()}
    assert "error" in bad


def test_stream_equals_batch(spark, sf_dir):
    """The running streaming aggregate ends equal to the batch aggregate."""
    import __spark_entry__ as E

    q = E.queries()
    stream = {(r["model"], r["task"]): r["score"] for r in q["stream_metrics"](spark, sf_dir).collect()
              if r["metric"] == "accuracy"}
    batch = {(r["model"], r["task"]): r["score"] for r in q["evaluate_suite"](spark, sf_dir).collect()
             if r["metric"] == "accuracy"}
    assert stream == batch and stream
