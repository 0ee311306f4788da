"""User functions that fail in a batch: metrics before it, error rows, nothing lost."""

import pytest
from pyspark.sql import functions as F

from evalspark.functions.postprocess import apply_batch_post
from evalspark.operators import batches as B
from evalspark.operators.respond import infer_batches

KEYS = ["model", "task"]


@pytest.fixture()
def rows(spark):
    """Three tasks of 50 rows in random partitions; the label is the item's parity."""
    df = spark.range(150).select(F.lit("m").alias("model"), (F.col("id") % 3).cast("string").alias("task"), F.floor(F.col("id") / 3).alias("item_id"),
                                 F.lit("x").alias("batch_error"))
    df = df.select("model", "task", "item_id", F.concat_ws(" ", "task", "item_id").alias("prompt"), (F.col("item_id") % 2).cast("string").alias("label"))
    return df.repartition(7, F.rand(1))


@pytest.fixture()
def model():
    """Answers even items right and odd ones wrong; task 1 breaks at item 24, task 2 returns too little from item 0."""
    def answer(prompts):
        if "1 24" in prompts:
            raise RuntimeError("no such item: 24")
        return prompts[:-1] if prompts[0].startswith("2") else ["0" for _ in prompts]

    return answer


def test_a_failing_batch_ends_its_task_only(rows, model):
    out = B.evaluate_batches(rows, [B.inference(model, out="prediction")], ["accuracy", "exact_match"], batch_size=10)
    got = {(r["task"], r["metric"]): (r["score"], r["status"], r["error"]) for r in out.collect()}
    assert got[("0", "accuracy")] == (0.5, "ok", None) and got[("0", "exact_match")] == (0.5, "ok", None)
    # batch 3 (items 20 to 29) fails: batches 1 and 2 are scored, 4 and 5 are not
    assert got[("1", "accuracy")] == (0.5, "partial", None)
    assert got[("1", None)] == (None, "error", "batch 3 of 5, inference: RuntimeError: no such item: 24")
    assert got[("2", None)] == (None, "error", "batch 1 of 5, inference: ValueError: 10 rows went in, {'prediction': 9} came out")
    assert ("2", "accuracy") not in got and len(got) == 6


def test_rows_stay_and_carry_the_error(rows, model):
    def post(p, l, batch, args):
        if 49 in batch["item_id"].tolist() and batch["task"][0] == "0":
            raise KeyError("late")
        return [f"{x}{args['mark']}" for x in p], l

    stages = [B.inference(model, out="prediction"), B.post_processing(post, script_args={"mark": "!"})]
    out = B.run_batches(rows, stages, KEYS, ["item_id"], 20).collect()
    assert len(out) == 150 and {r["batch"] for r in out} == {1, 2, 3}
    first = [r for r in out if r["task"] == "0" and r["batch"] < 3]
    assert all(r["prediction"] == "0!" and r["batch_error"] is None for r in first) and len(first) == 40
    last = [r for r in out if r["task"] == "0" and r["batch"] == 3]
    assert {(r["prediction"], r["failed_stage"], r["batch_error"]) for r in last} == {(None, "post-processing", "KeyError: 'late'")}
    f = {r["task"]: (r["n_batches"], r["failed_batch"], r["failed_stage"]) for r in B.first_failures(B.run_batches(rows, stages, KEYS, ["item_id"], 20), KEYS).collect()}
    assert f == {"0": (3, 3, "post-processing"), "1": (3, 2, "inference"), "2": (3, 1, "inference")}


def test_processors_null_keys_and_no_rows(spark, rows):
    df = rows.withColumn("task", F.when(F.col("task") != "1", F.col("task")))
    half = B.processing(lambda b: {"prediction": (b["item_id"] % 2).astype(str).tolist(), "n": [len(b)] * len(b)}, "prediction string, n int", "halves")
    out = B.evaluate_batches(df, [half], ["accuracy"], order=["item_id", "prompt"], batch_size=30)
    assert {(r["task"], r["score"], r["status"]) for r in out.collect()} == {("0", 1.0, "ok"), ("2", 1.0, "ok"), (None, 1.0, "ok")}
    assert B.evaluate_batches(df.limit(0), [half], ["accuracy"], order=["item_id", "prompt"]).count() == 0


def test_errors_of_arrow_batches_are_kept_on_request(spark):
    prompts = spark.range(25).select(F.col("id").cast("string").alias("prompt")).coalesce(1)

    def fails_at_12(texts):
        if "12" in texts:
            raise ValueError("twelve")
        return texts[:-1] if "24" in texts else texts

    got = infer_batches(prompts, fails_at_12, batch_size=10, error_col="why").groupBy("why").agg(F.count("response").alias("n"), F.count("*").alias("all")).collect()
    assert {(r["why"], r["n"], r["all"]) for r in got} == {(None, 10, 10), ("ValueError: twelve", 0, 10), ("ValueError: 5 prompts, 4 responses", 0, 5)}
    df = prompts.select(F.col("prompt").alias("prediction"), F.col("prompt").alias("label"))
    row = apply_batch_post(df, lambda p, l, b, a: (p[1:], l), error_col="why").first()
    assert row["why"] == "ValueError: 25 rows, 24 predictions and 25 labels" and row["prediction"] == "0"


def test_columns_no_stage_names_stay_exact(spark):
    """Whole numbers above 2^53 next to a null, through batches of plain and of other types."""
    big = 2**53 + 1
    data = [("m", "t", i, big + i if i % 3 else None, "p") for i in range(12)]
    df = spark.createDataFrame(data, "model string, task string, item_id long, big long, prompt string")
    stages = [B.inference(lambda ps: [p.upper() for p in ps], out="prediction")]
    out = B.run_batches(df, stages, KEYS, ["item_id"], 5).collect()
    assert sorted((r["item_id"], r["big"], r["prediction"], r["batch"]) for r in out if r["big"]) == [(i, big + i, "P", i // 5 + 1) for i in range(12) if i % 3]
    dated = df.drop("big").withColumns({"day": F.lit("2024-02-29").cast("date"), "label": F.lit("P"), "none": F.lit(None)})
    got = B.evaluate_batches(dated, stages, ["accuracy"], batch_size=5).collect()
    assert [(r["score"], r["status"]) for r in got] == [(1.0, "ok")]
    assert {str(r["day"]) for r in B.run_batches(dated, stages, KEYS, ["item_id"], 5).collect()} == {"2024-02-29"}


def test_numbering_moves_the_rows_once(spark):
    """Buckets come from generated code, offsets of earlier buckets from a lookup, not from a join."""
    import contextlib
    import io

    from evalspark.operators.ranking import prefix_before

    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    with contextlib.redirect_stdout(io.StringIO()) as text:
        prefix_before(df, ["k"], ["v"]).explain()
    main = text.getvalue().split("Subqueries")[0]
    assert "Join" not in main and "namedlambda" not in main and "narrowed" not in main
