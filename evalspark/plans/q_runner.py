"""End-to-end run over several task recipes (U6, SURVEY 3.1) with status rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.recipes import run_tasks
from ..spec import TaskSpec
from . import sqlfrag as Q
from . import views as V
from .catalog import finish, query, sql_choice_label, sql_choice_letter
from .q_data import MCQ_SQL, _mcq_items

MODELS = ["m0", "m1", "m2"]
BROKEN_MSG = "task broken: prompted classification needs a prompt builder and a post-processor"


def _tasks():
    return [
        TaskSpec("mcq", "multiple_choice_qa", metrics=["accuracy", "exact_match"]),
        TaskSpec("dialog", "summarization", metrics=[{"name": "jaccard", "options": {"normalize": True}}, "exact_match"]),
        TaskSpec("broken", "glue_classification_prompting", metrics=["accuracy"]),
    ]


def _responses(spark, sf):
    mcq = _mcq_items(spark, sf).select("item_id")
    r1 = mcq.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        F.lit("mcq").alias("task"), "item_id", F.concat(F.lit("m"), F.col("k").cast("string")).alias("model"),
        F.concat(F.lit("The answer is ("), F.char(F.lit(65) + (F.col("item_id") + F.col("k")) % 4), F.lit(")")).alias("response"))
    p = V.pairs(spark, sf)
    r2 = p.select(F.lit("dialog").alias("task"), "item_id", F.lit("m0").alias("model"), F.col("prediction").alias("response"))
    r3 = p.select(F.lit("dialog").alias("task"), "item_id", F.lit("m1").alias("model"), F.col("prompt").alias("response"))
    return r1.unionByName(r2).unionByName(r3)


def _items(spark, sf):
    mcq = _mcq_items(spark, sf).withColumn("label_index", F.col("item_id") % 4)
    p = V.pairs(spark, sf).select("item_id", F.col("prompt").alias("input_text"), F.col("prediction").alias("target_text"))
    return {"mcq": mcq, "dialog": p, "broken": p.withColumn("label_index", F.lit(0))}


_JAC = ("avg(CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0.0 END)")


EVALUATE_TASKS_SQL = f"""
WITH items AS ({MCQ_SQL}),
mr AS (SELECT i.item_id, 'm' || CAST(k AS VARCHAR) AS model,
              'The answer is (' || chr(CAST(65 + (i.item_id + k) % 4 AS INTEGER)) || ')' AS response, i.item_id % 4 AS li
       FROM items i CROSS JOIN (SELECT unnest([0, 1, 2]) AS k)),
ms AS (SELECT model, {sql_choice_letter('response')} AS prediction, {sql_choice_label('li')} AS label FROM mr),
p AS ({V.SQL_PAIRS}),
dr AS (SELECT 'm0' AS model, prediction, prediction AS label FROM p UNION ALL SELECT 'm1', prompt, prediction FROM p),
dw AS MATERIALIZED (SELECT model, {Q.ws_split('lower(prediction)')} AS a, {Q.ws_split('lower(label)')} AS b FROM dr),
dj AS MATERIALIZED (SELECT model, list_distinct(a) AS a, list_distinct(b) AS b FROM dw)
SELECT model, 'mcq' AS task, 'accuracy' AS metric, '' AS sub_metric, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS score,
       'ok' AS status, NULL::VARCHAR AS error FROM ms GROUP BY ALL
UNION ALL SELECT model, 'mcq', 'exact_match', '', round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6), 'ok', NULL FROM ms GROUP BY ALL
UNION ALL SELECT model, 'dialog', 'jaccard', '', round({_JAC}, 6), 'ok', NULL FROM dj GROUP BY ALL
UNION ALL SELECT model, 'dialog', 'exact_match', '', round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6), 'ok', NULL FROM dr GROUP BY ALL
UNION ALL SELECT 'm2', 'dialog', NULL, NULL, NULL, 'error', 'No results obtained for this task'
UNION ALL SELECT unnest({MODELS!r}), 'broken', NULL, NULL, NULL, 'error', '{BROKEN_MSG}'"""


@query("evaluate_tasks", EVALUATE_TASKS_SQL)
def evaluate_tasks(spark, sf):
    return finish(run_tasks(_tasks(), _items(spark, sf), _responses(spark, sf), MODELS))


# A user batch processor (creative elaboration) as a custom_script recipe ----------------
ELAB_KEYWORDS = ["team", "weather", "language"]


def _theme_processor(items):
    from ..functions import prompts as P

    return P.theme_prompts(items).select(F.col("id").alias("item_id"), "prompt", "label")


def _theme_responses(spark, sf):
    from .q_data import _sample

    th = _theme_processor(_sample(spark, sf))
    a = th.select(F.lit("theme").alias("task"), "item_id", F.lit("m0").alias("model"),
                  F.concat(F.lit("  Elaboration:  "), F.col("label"), F.lit(" And more.")).alias("response"))
    b = th.select(F.lit("theme").alias("task"), "item_id", F.lit("m1").alias("model"),
                  F.concat(F.lit("A story: "), F.lower("label")).alias("response"))
    return a.unionByName(b)


def custom_task(spark, sf):
    from .q_data import _sample

    t = TaskSpec("theme", "custom_script", custom=_theme_processor, postprocessor="elaboration",
                 metrics=[{"name": "rouge", "options": {"metrics": ["rouge1"], "stats": ["f"]}},
                          {"name": "keyword_match", "options": {"keywords_to_match": ELAB_KEYWORDS}},
                          "avg_prediction_length"])
    return finish(run_tasks([t], {"theme": _sample(spark, sf)}, _theme_responses(spark, sf), ["m0", "m1"]))


def _custom_task_sql():
    from .q_data import SAMPLE_SQL
    from .q_overlap import _rouge_n_sql

    theme = Q.strip("regexp_replace(text_content, 'Sample (train|validation|test) text \\d+:\\s*', '')")
    src = f"""
  SELECT model, 'theme' AS task, {Q.strip(
      "regexp_replace(CASE WHEN starts_with(lower(" + Q.strip('response') + "), 'elaboration:') THEN "
      + Q.strip("substr(" + Q.strip('response') + ", 13)") + " ELSE " + Q.strip('response') + " END, '\\s+', ' ', 'g')")} AS prediction,
      theme AS label
  FROM (SELECT {theme} AS theme FROM ({SAMPLE_SQL})) s
  CROSS JOIN (SELECT unnest(['m0', 'm1']) AS model) m
  CROSS JOIN LATERAL (SELECT CASE WHEN model = 'm0' THEN '  Elaboration:  ' || theme || ' And more.'
                                  ELSE 'A story: ' || lower(theme) END AS response)"""
    kw = " OR ".join(f"contains(lower(prediction), '{k}')" for k in ELAB_KEYWORDS)
    return f"""
SELECT *, 'ok' AS status, NULL::VARCHAR AS error FROM (
{_rouge_n_sql(src, ns=(1,), stats=("f",))}
UNION ALL SELECT model, task, 'keyword_match', 'keyword_match_count', round(sum(CASE WHEN prediction <> '' AND ({kw}) THEN 1.0 ELSE 0.0 END), 6)
  FROM ({src}) GROUP BY ALL
UNION ALL SELECT model, task, 'keyword_match', 'keyword_match_ratio', round(avg(CASE WHEN prediction <> '' AND ({kw}) THEN 1.0 ELSE 0.0 END), 6)
  FROM ({src}) GROUP BY ALL
UNION ALL SELECT model, task, 'avg_prediction_length', 'avg_prediction_length', round(avg(len({Q.ws_split('prediction')})), 6)
  FROM ({src}) GROUP BY ALL)"""


query("custom_task", _custom_task_sql())(custom_task)


# Q4 at run time: a user model that cannot answer some items ends its task there -----------------
BATCH_SIZE, STUMBLING = 500, 2503


def _stumbling_model(prompts):
    """Answers a letter; cannot answer every ``STUMBLING``-th item id."""
    out = []
    for p in prompts:
        item = int(p.split()[1])
        if item % STUMBLING == 0:
            raise ValueError(f"cannot answer item {item}")
        out.append(f" the answer is ({'ABCDE'[item % 5]})")
    return out


def _letters(predictions, labels, batch, script_args):
    """User post-processor: the letter in parentheses; label index to letter."""
    return [p[p.index("(") + 1] for p in predictions], [script_args["letters"][x] for x in labels]


@query("batch_failures", f"""
WITH r AS (
  SELECT l_returnflag AS model, l_linestatus AS task, l_orderkey * 10 + l_linenumber AS item, CAST(l_partkey % 4 AS INTEGER) AS label,
         (row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey * 10 + l_linenumber, l_partkey) - 1) // {BATCH_SIZE} + 1 AS batch
  FROM lineitem),
f AS (SELECT model, task, max(batch) AS n, min(CASE WHEN item % {STUMBLING} = 0 THEN batch END) AS failed,
             min(CASE WHEN item % {STUMBLING} = 0 THEN item END) AS item FROM r GROUP BY ALL),
s AS (SELECT r.model, r.task, r.label, r.item, f.failed FROM r JOIN f USING (model, task) WHERE f.failed IS NULL OR r.batch < f.failed),
a AS (SELECT model, task, CASE WHEN any_value(failed) IS NULL THEN 'ok' ELSE 'partial' END AS status,
             round(avg(CASE WHEN substr('ABCDE', CAST(item % 5 + 1 AS INTEGER), 1) = substr('ABCD', label + 1, 1) THEN 1.0 ELSE 0.0 END), 6) AS score FROM s GROUP BY model, task)
SELECT model, task, 'accuracy' AS metric, '' AS sub_metric, score, status, NULL::VARCHAR AS error FROM a
UNION ALL SELECT model, task, 'exact_match', '', score, status, NULL FROM a
UNION ALL SELECT model, task, NULL, NULL, NULL, 'error',
  'batch ' || failed || ' of ' || n || ', inference: ValueError: cannot answer item ' || item FROM f WHERE failed IS NOT NULL""")
def batch_failures(spark, sf):
    """Metrics of the batches before the first failing one, and the error of that one."""
    from ..operators import batches as B

    li = V.table(spark, sf, "lineitem")
    item = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = li.select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("task"), item.alias("item_id"), "l_partkey",
                     F.concat(F.lit("Question "), item.cast("string"), F.lit(" : A, B, C or D?")).alias("prompt"), (F.col("l_partkey") % 4).cast("int").alias("label"))
    stages = [B.inference(_stumbling_model, out="prediction"), B.post_processing(_letters, script_args={"letters": "ABCD"})]
    return finish(B.evaluate_batches(rows, stages, ["accuracy", "exact_match"], order=["item_id", "l_partkey"], batch_size=BATCH_SIZE))


class _Interrupted(BaseException):
    """Stands for whatever ends a program between two models."""


@query("save_per_model", EVALUATE_TASKS_SQL + """
UNION ALL SELECT 'm_broken', NULL, NULL, NULL, NULL, 'error', 'RuntimeError: model m_broken cannot be loaded'""")
def save_per_model(spark, sf):
    """E5: a run that ends after its first model and is started again equals an unbroken run."""
    from ..operators.runs import run_models
    from ..session import shared_path

    path = shared_path(spark, "run-by-model")
    items, responses, done = _items(spark, sf), _responses(spark, sf), []

    def evaluate(model, stop_after=None):
        if stop_after is not None and len(done) >= stop_after:
            raise _Interrupted
        if model == "m_broken":
            raise RuntimeError("model m_broken cannot be loaded")
        done.append(model)
        return run_tasks(_tasks(), items, responses.where(F.col("model") == model), [model])

    models = [MODELS[0], "m_broken", *MODELS[1:]]
    try:
        run_models(spark, models, lambda m: evaluate(m, stop_after=1), path, "evaluate_tasks")
    except _Interrupted:
        pass
    out = run_models(spark, models, evaluate, path, "evaluate_tasks")
    if done != MODELS:
        raise RuntimeError(f"every model is evaluated once, here {done}")
    return finish(out)
