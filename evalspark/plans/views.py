"""Base views over the driver tables, each defined once for Spark.

The matching DuckDB text lives next to every query in ``catalog.py``. Every
view reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mcq_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiple-choice responses over ``lineitem``: the flagship's scored input.

    response = ``The answer is (X)`` with X = chr(65 + l_linenumber % 5) (E never
    valid), label index = ``l_partkey % 4``, model = return flag, task = line status."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("model"),
        F.col("l_linestatus").alias("task"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.concat(F.lit("The answer is ("), F.char(F.lit(65) + F.col("l_linenumber") % 5), F.lit(")")).alias("prediction"),
        (F.col("l_partkey") % 4).alias("label"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue pairs: each user turn with the assistant turn that follows it.

    item_id = conv_id * 1000 + turn, prompt = label = user text, prediction =
    assistant text, model = ``m{conv_id % 3}``, task = ``dialog``."""
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("u_text"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a_text"))
    j = u.join(a, ["conv_id", "turn"])
    return j.select(
        F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")).alias("model"),
        F.lit("dialog").alias("task"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
        F.col("u_text").alias("prompt"),
        F.col("a_text").alias("prediction"),
        F.col("u_text").alias("label"),
    )


SQL_PAIRS = """
  SELECT 'm' || CAST(u.conv_id % 3 AS VARCHAR) AS model, 'dialog' AS task, u.conv_id * 1000 + u.turn AS item_id,
         u.text AS prompt, a.text AS prediction, u.text AS label
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
"""


def clf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality classification: label = quality, prediction = n_chars > 1000,
    model = source, task = lang."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return lab.join(d, "doc_id").select(
        F.col("source").alias("model"), F.col("lang").alias("task"), F.col("doc_id").alias("item_id"),
        (F.col("n_chars") > 1000).cast("int").alias("prediction"), F.col("quality").alias("label"),
        F.col("toxic"), F.col("n_chars"))


SQL_CLF = """
  SELECT d.source AS model, d.lang AS task, d.doc_id AS item_id, CAST(d.n_chars > 1000 AS INTEGER) AS prediction,
         l.quality AS label, l.toxic, d.n_chars
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
"""


def lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities: ``logp = -value / 100`` per event, model = ``lm``, task = event type."""
    e = table(spark, sf_dir, "events")
    return e.select(F.lit("lm").alias("model"), F.col("event_type").alias("task"), F.col("event_id").alias("item_id"),
                    "ts", (-F.col("value") / 100.0).alias("prediction"), F.lit(None).cast("string").alias("label"))


SQL_LP = """
  SELECT 'lm' AS model, event_type AS task, event_id AS item_id, ts, -value / 100.0 AS prediction, NULL AS label FROM events
"""


def num(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("task"),
                     F.col("l_quantity").alias("prediction"), F.col("l_extendedprice").alias("label"))


SQL_NUM = """
  SELECT l_returnflag AS model, l_linestatus AS task, l_quantity AS prediction, l_extendedprice AS label FROM lineitem
"""


def vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding pairs: each vector with the next id; model = ``emb``, task = label of the first."""
    e = table(spark, sf_dir, "embeddings")
    a = e.select("vec_id", F.col("embedding").alias("prediction"), "label")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("label_vec"))
    return a.join(b, "vec_id").select(
        F.lit("emb").alias("model"), F.concat(F.lit("t"), F.col("label").cast("string")).alias("task"),
        F.col("vec_id").alias("item_id"), "prediction", F.col("label_vec").alias("label"))


SQL_VECS = """
  SELECT 'emb' AS model, 't' || CAST(a.label AS VARCHAR) AS task, a.vec_id AS item_id,
         a.embedding AS prediction, b.embedding AS label
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""


def resp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text responses over ``lineitem``: template chosen by ``l_orderkey % 6``, all
    numbers integers; label = the quantity as text."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int").cast("string")
    t = F.col("l_orderkey") % 6
    text = (
        F.when(t == 0, F.concat(F.lit("The answer is "), q))
        .when(t == 1, F.concat(F.lit("Answer: ("), F.char(F.lit(65) + F.col("l_linenumber") % 4), F.lit(")")))
        .when(t == 2, F.when(F.col("l_partkey") % 2 == 0, F.lit("I think it is positive")).otherwise(F.lit("Clearly negative.")))
        .when(t == 3, F.when(F.col("l_suppkey") % 2 == 0, F.lit("yes, equivalent")).otherwise(F.lit("not equivalent")))
        .when(t == 4, F.concat(F.lit("Similarity Score: "), (F.col("l_linenumber") % 7).cast("string")))
        .otherwise(F.concat(F.lit("  Final: #### "), q, F.lit(".")))
    )
    return li.select(
        F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("task"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        text.alias("prediction"), q.alias("label"), (F.col("l_partkey") % 5).alias("label_index"))


SQL_RESP = """
  SELECT l_returnflag AS model, l_linestatus AS task, l_orderkey * 10 + l_linenumber AS item_id,
    CASE l_orderkey % 6
      WHEN 0 THEN 'The answer is ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
      WHEN 1 THEN 'Answer: (' || chr(CAST(65 + l_linenumber % 4 AS INTEGER)) || ')'
      WHEN 2 THEN CASE WHEN l_partkey % 2 = 0 THEN 'I think it is positive' ELSE 'Clearly negative.' END
      WHEN 3 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'yes, equivalent' ELSE 'not equivalent' END
      WHEN 4 THEN 'Similarity Score: ' || CAST(l_linenumber % 7 AS VARCHAR)
      ELSE '  Final: #### ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.' END AS prediction,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS label, l_partkey % 5 AS label_index
  FROM lineitem
"""


def part_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transposed multiple-choice options: four consecutive parts form one item."""
    p = table(spark, sf_dir, "part")
    return p.select(F.floor((F.col("p_partkey") - 1) / 4).cast("long").alias("item_id"),
                    ((F.col("p_partkey") - 1) % 4).cast("int").alias("option_idx"),
                    F.col("p_name").alias("text"), "p_brand")


SQL_PART_OPTIONS = """
  SELECT CAST(floor((p_partkey - 1) / 4) AS BIGINT) AS item_id, CAST((p_partkey - 1) % 4 AS INTEGER) AS option_idx,
         p_name AS text, p_brand FROM part
"""


def mlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long results computed from ``clf`` per (source, lang): accuracy, positive rate,
    length mean / max (a two-part metric) and toxic share (only where a toxic
    document exists, so some cells are missing by nature)."""
    d = clf(spark, sf_dir)
    g = d.groupBy("model", "task").agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc"),
        F.avg("prediction").alias("pos"), (F.avg("n_chars") / 1000.0).alias("lm"), (F.max("n_chars") / 1000.0).alias("lx"),
        F.avg("toxic").alias("tox"), F.max("toxic").alias("mt"))
    def row(m, s, v):
        return F.struct(F.lit(m).alias("metric"), F.lit(s).alias("sub_metric"), v.cast("double").alias("score"))

    rows = F.array(row("accuracy", "", F.col("acc")), row("positive_rate", "", F.col("pos")),
                   row("length", "mean", F.col("lm")), row("length", "max", F.col("lx")),
                   row("toxic_share", "", F.when(F.col("mt") == 1, F.col("tox"))))
    out = g.select("model", "task", F.inline(rows)).where(F.col("score").isNotNull())
    return out.withColumn("full_metric_name", F.when(F.col("sub_metric") != "", F.concat("metric", F.lit("_"), "sub_metric"))
                          .otherwise(F.col("metric")))


SQL_MLONG = f"""
  SELECT *, CASE WHEN sub_metric <> '' THEN metric || '_' || sub_metric ELSE metric END AS full_metric_name FROM (
  WITH g AS (SELECT model, task, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS acc, avg(prediction) AS pos,
                    avg(n_chars) / 1000.0 AS lm, max(n_chars) / 1000.0 AS lx, avg(toxic) AS tox, max(toxic) AS mt
             FROM ({SQL_CLF}) GROUP BY ALL)
  SELECT model, task, 'accuracy' AS metric, '' AS sub_metric, acc AS score FROM g
  UNION ALL SELECT model, task, 'positive_rate', '', pos FROM g
  UNION ALL SELECT model, task, 'length', 'mean', lm FROM g
  UNION ALL SELECT model, task, 'length', 'max', lx FROM g
  UNION ALL SELECT model, task, 'toxic_share', '', tox FROM g WHERE mt = 1)
"""


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag sequences from ``events``: one sequence per user ordered by (ts, event_id);
    purchase -> B-P, click -> I-P, else O; the prediction also maps error -> I-P.
    Positions come from the distributed ``prefix_before`` (no per-user window)."""
    from ..operators.ranking import prefix_before

    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    e = prefix_before(e, ["user_id"], ["ts", "event_id"], out="pos")
    et = F.col("event_type")
    true = F.when(et == "purchase", "B-P").when(et == "click", "I-P").otherwise("O")
    pred = F.when(et == "purchase", "B-P").when(et.isin("click", "error"), "I-P").otherwise("O")
    return e.select(F.lit("tagger").alias("model"), F.lit("events").alias("task"), F.col("user_id").alias("item_id"),
                    F.col("pos").cast("long").alias("pos"), true.alias("label"), pred.alias("prediction"))


SQL_TAGS = """
  SELECT 'tagger' AS model, 'events' AS task, user_id AS item_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         CASE event_type WHEN 'purchase' THEN 'B-P' WHEN 'click' THEN 'I-P' ELSE 'O' END AS label,
         CASE WHEN event_type = 'purchase' THEN 'B-P' WHEN event_type IN ('click', 'error') THEN 'I-P' ELSE 'O' END AS prediction
  FROM events
"""
