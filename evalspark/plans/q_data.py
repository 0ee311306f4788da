"""Queries for sources, normalisation, prompts, responses, pairing and
post-processing, each with its DuckDB oracle where one is expressible."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import postprocess as X
from ..functions import prompts as P
from ..operators import normalize as N
from ..operators import respond as R
from ..operators.evaluate import evaluate_suite
from ..operators.metrics import classification as C
from ..session import shared_path
from ..sources import readers as S
from . import sqlfrag as Q
from . import views as V
from .catalog import finish, query, sql_choice_label, sql_choice_letter

# =====================================================================================
# Sources
# =====================================================================================


@query("scan_local", "SELECT * FROM nation")
def scan_local(spark, sf):
    return S.read_local(spark, f"{sf}/nation.parquet", "parquet")


CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_csv", "SELECT * FROM customer")
def scan_csv(spark, sf):
    path = shared_path(spark, "customer-csv")
    S.read_local(spark, f"{sf}/customer.parquet").write.mode("overwrite").option("header", "true").csv(path)
    return S.read_csv(spark, path, CUSTOMER_SCHEMA)


SPLIT_OF = "CASE WHEN c_custkey % 10 < 7 THEN 'train' WHEN c_custkey % 10 < 9 THEN 'validation' ELSE 'test' END"


@query("scan_splits", f"SELECT *, {SPLIT_OF} AS split FROM customer")
def scan_splits(spark, sf):
    d = shared_path(spark, "splits")
    c = S.read_local(spark, f"{sf}/customer.parquet")
    k = F.col("c_custkey") % 10
    c = c.withColumn("_s", F.when(k < 7, "train").when(k < 9, "validation").otherwise("test"))
    for s in S.SPLITS:
        c.where(F.col("_s") == s).drop("_s").write.mode("overwrite").option("header", "true").csv(f"{d}/{s}.csv")
    return S.read_splits(spark, d, "all", CUSTOMER_SCHEMA)


@S.register_source("orders_value")
def _orders_value(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") / 1000.0).alias("value_k"))


@query("scan_custom", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice / 1000.0, 6) AS value_k FROM orders")
def scan_custom(spark, sf):
    return finish(S.load_source(spark, "orders_value", sf_dir=sf))


@query("head_cutoff", """
SELECT l_linestatus AS task, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem)
WHERE rn <= 100""")
def head_cutoff(spark, sf):
    li = V.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("task"), "l_orderkey", "l_linenumber")
    return S.head_cutoff(li, 100, ["l_orderkey", "l_linenumber"], per=["task"])


TASKS = ["en", "fr", "de", "es", "it", "ja"]


@query("empty_task_status", f"""
SELECT t.task, 'error' AS status, 'dataset for task ''' || t.task || ''' is empty' AS error
FROM (SELECT unnest({TASKS!r}) AS task) t WHERE t.task NOT IN (SELECT DISTINCT task FROM ({V.SQL_CLF}))""")
def empty_task_status(spark, sf):
    items = V.clf(spark, sf)
    spec = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in TASKS])).alias("task"))
    return S.empty_task_status(spec, items)


SAMPLE_SQL = """
  SELECT split, split || '_' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 4 THEN CAST(o_orderkey AS VARCHAR)
                                    ELSE lpad(CAST(o_orderkey AS VARCHAR), 4, '0') END AS id,
    'Sample ' || split || ' text ' || CAST(o_orderkey + 1 AS VARCHAR) || ': ' ||
      {ph}[(o_orderkey * 7 + 3) % 10 + 1] || ' ' || {ph}[(o_orderkey * 13 + 5) % 10 + 1] AS text_content,
    CAST((o_orderkey * 31 + 1) % 3 AS INTEGER) AS category_label
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 9 THEN 'validation' ELSE 'test' END AS split FROM orders)
""".format(ph=repr(list(S.SAMPLE_PHRASES)))


def _sample(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey")
    k = F.col("o_orderkey") % 10
    o = o.withColumn("split", F.when(k < 7, "train").when(k < 9, "validation").otherwise("test"))
    return S.sample_items(o, "o_orderkey", "split", "o_orderkey")


query("sample_items", SAMPLE_SQL)(_sample)

# =====================================================================================
# Normalisation
# =====================================================================================


@query("normalize_fields", "SELECT d.text AS input_text, l.quality AS label_index FROM labels l JOIN documents d USING (doc_id)")
def normalize_fields(spark, sf):
    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id")
    return N.normalize_fields(d, "classification", dataset="docs",
                              dataset_specific_fields={"input": "text", "label": "quality"})


def _translation_items(spark, sf):
    p = V.pairs(spark, sf)
    return p.select(F.struct(F.col("prompt").alias("en"), F.col("prediction").alias("fr")).alias("translation"))


@query("normalize_translation", f"""
SELECT prompt AS input_text, prediction AS target_text FROM ({V.SQL_PAIRS})
WHERE prompt IS NOT NULL AND prompt <> '' AND prediction IS NOT NULL AND prediction <> ''""")
def normalize_translation(spark, sf):
    return N.normalize_fields(_translation_items(spark, sf), "translation", dataset="opus100", config="en-fr")


@query("choices_transpose", f"""
SELECT item_id, list(text ORDER BY option_idx) AS choices FROM ({V.SQL_PART_OPTIONS}) GROUP BY item_id""")
def choices_transpose(spark, sf):
    return N.choices_from_long(V.part_options(spark, sf))


MCQ_SQL = f"""
  WITH o AS ({V.SQL_PART_OPTIONS}),
  items AS (SELECT item_id, list(text ORDER BY option_idx) AS choices,
                   max(CASE WHEN option_idx = 0 AND item_id % 2 = 0 THEN p_brand END) AS subject FROM o GROUP BY item_id)
  SELECT item_id, 'Which part was listed first for item ' || CAST(item_id AS VARCHAR) || '?' AS question, choices,
         COALESCE(subject, 'general knowledge') AS subject,
         array_to_string(list_transform(choices, lambda x, i: chr(CAST(64 + i AS INTEGER)) || ') ' || x), chr(10)) AS choices_formatted_str
  FROM items WHERE len(choices) > 0
"""


def _mcq_items(spark, sf):
    brand = F.max(F.when((F.col("option_idx") == 0) & (F.col("item_id") % 2 == 0), F.col("p_brand")))
    items = N.choices_from_long(V.part_options(spark, sf), extra={"subject": brand})
    items = items.withColumn("question", F.concat(F.lit("Which part was listed first for item "),
                                                   F.col("item_id").cast("string"), F.lit("?")))
    return N.with_subject(N.drop_missing_choices(items))


@query("mcqa_choices", f"""
SELECT item_id, choices_formatted_str, choices[1] AS choice_A, choices[2] AS choice_B, choices[3] AS choice_C,
       choices[4] AS choice_D, choices[5] AS choice_E FROM ({MCQ_SQL})""")
def mcqa_choices(spark, sf):
    it = N.choice_fields(_mcq_items(spark, sf), n=5).withColumn("choices_formatted_str", P.format_choices("choices"))
    return it.select("item_id", "choices_formatted_str", "choice_A", "choice_B", "choice_C", "choice_D", "choice_E")


@query("mcqa_prompts", f"""
SELECT item_id, subject, 'Question: ' || question || chr(10) || 'Choices:' || chr(10) || choices_formatted_str || chr(10) || 'Answer: ' AS prompt,
       'Sub: ' || subject || chr(10) || 'Q: ' || question || chr(10) || choices_formatted_str || chr(10) || 'A: ' AS custom_prompt
FROM ({MCQ_SQL})""")
def mcqa_prompts(spark, sf):
    it = _mcq_items(spark, sf)
    a = P.mcq_prompts(it)
    b = P.mcq_prompts(a, "Sub: {subject}\nQ: {question}\n{choices_formatted_str}\nA: ", out="custom_prompt")
    return b.select("item_id", "subject", "prompt", "custom_prompt")


@query("translation_prompts", f"""
SELECT prompt AS input_text, 'Translate the following text from English to French: ' || prompt AS prompt,
       'ja' AS source_lang_code, 'en' AS target_lang_code, 'JA' AS source_lang_name, 'English' AS target_lang_name,
       'JA->English ' || prompt AS custom_prompt
FROM ({V.SQL_PAIRS}) WHERE prompt <> '' AND prediction <> ''""")
def translation_prompts(spark, sf):
    items = N.normalize_fields(_translation_items(spark, sf), "translation", dataset="opus100", config="en-fr")
    a = P.translation_prompts(items, "en-fr")
    # a second pair with a custom template; its language fields replace the first pair's
    b = P.translation_prompts(a, "ja-en", template="{source_lang_name}->{target_lang_name} {input_text}", out="custom_prompt")
    return b.select("input_text", "prompt", "source_lang_code", "target_lang_code", "source_lang_name", "target_lang_name",
                    "custom_prompt")


# =====================================================================================
# Prompts
# =====================================================================================
DOCS_SQL = "SELECT doc_id, text AS input_text, source, lang FROM documents"


@query("template_prompts", f"""
SELECT doc_id, 'Doc ' || CAST(doc_id AS VARCHAR) || ' from ' || source || ' [' || lang || ']: ' || input_text AS prompt,
       input_text AS fallback_prompt, input_text AS raw_prompt FROM ({DOCS_SQL})""")
def template_prompts(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("input_text"), "source", "lang")
    a = P.generic_prompts(d, "Doc {doc_id} from {source} [{lang}]: {input_text}")
    a = P.generic_prompts(a, "{missing_field} {input_text}", out="fallback_prompt")
    a = P.generic_prompts(a, None, out="raw_prompt")
    return a.select("doc_id", "prompt", "fallback_prompt", "raw_prompt")


@query("sentiment_prompts", f"""
SELECT doc_id, 'Classify the sentiment of the following review as ''positive'' or ''negative''. Do not add any other text. Review: "'
       || input_text || '"' || chr(10) || 'Sentiment:' AS prompt, '' AS empty_template_prompt FROM ({DOCS_SQL})""")
def sentiment_prompts(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("input_text"))
    a = P.sentiment_prompts(P.sentiment_prompts(d), "", out="empty_template_prompt")
    return a.select("doc_id", "prompt", "empty_template_prompt")


@query("pair_prompts", f"""
SELECT item_id,
  'Are the following two sentences paraphrases? Answer ONLY with ''yes'' or ''no''.' || chr(10) || 'Sentence 1: "' || prompt || '"' || chr(10)
    || 'Sentence 2: "' || prediction || '"' || chr(10) || 'Answer:' AS mrpc_prompt,
  'Rate the similarity of the following two sentences on a scale of 0.0 to 5.0. Provide ONLY the numerical score.' || chr(10)
    || 'Sentence 1: "' || prompt || '"' || chr(10) || 'Sentence 2: "' || prediction || '"' || chr(10) || 'Similarity Score:' AS stsb_prompt
FROM ({V.SQL_PAIRS})""")
def pair_prompts(spark, sf):
    p = V.pairs(spark, sf).select("item_id", F.col("prompt").alias("input_text_pair1"), F.col("prediction").alias("input_text_pair2"))
    a = P.similarity_prompts(P.paraphrase_prompts(p, out="mrpc_prompt"), out="stsb_prompt")
    return a.select("item_id", "mrpc_prompt", "stsb_prompt")


@query("summary_prompts", f"""
SELECT doc_id, 'Summarize the following article:' || chr(10) || chr(10) || input_text || chr(10) || chr(10) || 'Summary:' AS prompt
FROM ({DOCS_SQL})""")
def summary_prompts(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("input_text"))
    return P.summary_prompts(d).select("doc_id", "prompt")


@query("creative_prompts", """
SELECT item_id, 'Write a creative piece about: ' || text AS prompt, NULL::VARCHAR AS target_text FROM benchmark""")
def creative_prompts(spark, sf):
    b = V.table(spark, sf, "benchmark").select("item_id", F.col("text").alias("input_text"))
    return P.creative_prompts(b).select("item_id", "prompt", "target_text")


@query("theme_prompts", f"""
WITH s AS ({SAMPLE_SQL}),
t AS (SELECT id, {Q.strip("regexp_replace(text_content, 'Sample (train|validation|test) text \\d+:\\s*', '')")} AS theme FROM s)
SELECT id, theme AS label, 'Expand on this idea with a creative paragraph:' || chr(10) || 'Idea: ' || theme || chr(10) || chr(10)
       || 'Creative Paragraph:' AS prompt FROM t""")
def theme_prompts(spark, sf):
    return P.theme_prompts(_sample(spark, sf)).select("id", "label", "prompt")


# =====================================================================================
# Responses and pairing
# =====================================================================================
PROMPTS_SQL = """SELECT 'dialog' AS task, conv_id * 1000 + turn AS item_id, text AS prompt FROM conversations WHERE role = 'user'"""
RESPONSES_SQL = """SELECT 'dialog' AS task, conv_id * 1000 + turn - 1 AS item_id, 'm' || CAST(conv_id % 3 AS VARCHAR) AS model,
                          text AS response FROM conversations WHERE role = 'assistant'"""


def _prompts(spark, sf):
    c = V.table(spark, sf, "conversations")
    return c.where(F.col("role") == "user").select(F.lit("dialog").alias("task"),
                                                   (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
                                                   F.col("text").alias("prompt"))


def _responses(spark, sf):
    c = V.table(spark, sf, "conversations")
    return c.where(F.col("role") == "assistant").select(
        F.lit("dialog").alias("task"), (F.col("conv_id") * 1000 + F.col("turn") - 1).alias("item_id"),
        F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")).alias("model"), F.col("text").alias("response"))


@query("attach_responses", f"""
SELECT p.task, p.item_id, r.model, r.response FROM ({PROMPTS_SQL}) p LEFT JOIN ({RESPONSES_SQL}) r USING (task, item_id)""")
def attach_responses(spark, sf):
    return R.attach_responses(_prompts(spark, sf), _responses(spark, sf)).select("task", "item_id", "model", "response")


def _echo_model(prompts):
    return [" ".join(reversed(p.split())) if p else "" for p in prompts]


@query("infer_batches", f"""
SELECT conv_id * 1000 + turn AS item_id, CASE WHEN COALESCE(text, '') = '' THEN '' ELSE array_to_string(list_reverse({Q.ws_split('text')}), ' ') END AS response
FROM conversations WHERE role = 'user'""")
def infer_batches(spark, sf):
    return R.infer_batches(_prompts(spark, sf), _echo_model).select("item_id", "response")


MODELS = ["m0", "m1", "m2"]


@query("model_task_grid", f"""
SELECT m.model, 'creative' AS task, count(*) AS n_items FROM benchmark CROSS JOIN (SELECT unnest({MODELS!r}) AS model) m GROUP BY ALL""")
def model_task_grid(spark, sf):
    b = V.table(spark, sf, "benchmark").select("item_id", F.lit("creative").alias("task"))
    return R.expand_models(b, MODELS).groupBy("model", "task").agg(F.count(F.lit(1)).alias("n_items"))


@query("argmax_class", """
SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction FROM embeddings""")
def argmax_class(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return e.select("vec_id", "label", R.argmax_class("embedding").alias("prediction"))


@query("regression_head", """
SELECT vec_id, CASE WHEN label % 2 = 0 THEN round(CAST(embedding[1] AS DOUBLE), 6) END AS score FROM embeddings""")
def regression_head(spark, sf):
    e = V.table(spark, sf, "embeddings")
    logits = F.slice("embedding", 1, (F.col("label") % 2 + 1).cast("int"))
    return finish(e.select("vec_id", R.regression_head(logits).alias("score")))


@query("math_dual_view", f"""
WITH d AS (SELECT model, task, prediction AS text_prediction, label AS text_label,
                  {Q.final_number('prediction')} AS prediction, {Q.final_number('label')} AS label FROM ({V.SQL_RESP}))
SELECT model, task, 'exact_match' AS metric, '' AS sub_metric, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS score
FROM d GROUP BY ALL
UNION ALL
SELECT model, task, 'accuracy', '', round(avg(CASE WHEN text_prediction = text_label THEN 1.0 ELSE 0.0 END), 6) FROM d GROUP BY ALL""")
def math_dual_view(spark, sf):
    r = V.resp(spark, sf).withColumnRenamed("prediction", "response").withColumnRenamed("label", "target_text")
    d = R.math_dual_view(r)
    return finish(evaluate_suite(d, ["exact_match", "accuracy"], text_pred="text_prediction", text_label="text_label",
                                 persist=False))


@query("pairing_audit", f"""
WITH p AS ({PROMPTS_SQL}), r AS ({RESPONSES_SQL}),
paired AS (SELECT model, task, count(*) AS paired FROM p JOIN r USING (task, item_id) GROUP BY ALL),
n AS (SELECT task, count(*) AS n_prompts FROM p GROUP BY ALL),
orphan AS (SELECT model, task, count(*) AS orphan_responses FROM r WHERE NOT EXISTS (
    SELECT 1 FROM p WHERE p.task = r.task AND p.item_id = r.item_id) GROUP BY ALL)
SELECT COALESCE(paired.model, orphan.model) AS model, COALESCE(paired.task, orphan.task) AS task,
       COALESCE(paired, 0) AS paired, COALESCE(n_prompts, 0) - COALESCE(paired, 0) AS unanswered,
       COALESCE(orphan_responses, 0) AS orphan_responses
FROM paired LEFT JOIN n USING (task) FULL JOIN orphan ON orphan.model = paired.model AND orphan.task = paired.task""")
def pairing_audit(spark, sf):
    return R.pairing_audit(_prompts(spark, sf), _responses(spark, sf))


@query("status_rows", f"""
WITH spec AS (SELECT m.model, t.task FROM (SELECT DISTINCT model FROM ({V.SQL_CLF})) m CROSS JOIN (SELECT unnest({TASKS!r}) AS task) t),
have AS (SELECT model, task, 1 AS n_metrics FROM ({V.SQL_CLF}) GROUP BY ALL)
SELECT spec.model, spec.task, CASE WHEN n_metrics IS NULL THEN 'error' ELSE 'ok' END AS status, CAST(COALESCE(n_metrics, 0) AS BIGINT) AS n_metrics,
       CASE WHEN n_metrics IS NULL THEN 'No results obtained for this task' END AS error
FROM spec LEFT JOIN have USING (model, task)""")
def status_rows(spark, sf):
    d = V.clf(spark, sf)
    res = C.metric_accuracy(d)
    spec = d.select("model").distinct().withColumn("task", F.explode(F.array(*[F.lit(t) for t in TASKS])))
    return R.status_rows(res, spec)


# =====================================================================================
# Post-processing (X1-X12) over the free-text responses
# =====================================================================================
RESP_COLS = "model, task, item_id"


def _resp(spark, sf):
    return V.resp(spark, sf)


@query("post_default", f"""SELECT {RESP_COLS}, prediction, CAST(label_index AS VARCHAR) AS label FROM ({V.SQL_RESP})""")
def post_default(spark, sf):
    r = _resp(spark, sf).select("model", "task", "item_id", "prediction", F.col("label_index").alias("label"))
    return X.apply_post(r, "default")


@query("post_choice_letter", f"""
SELECT {RESP_COLS}, {sql_choice_letter('prediction')} AS prediction,
       CASE WHEN label_index BETWEEN 0 AND 3 THEN chr(CAST(65 + label_index AS INTEGER)) ELSE 'INVALID_LABEL' END AS label
FROM ({V.SQL_RESP})""")
def post_choice_letter(spark, sf):
    r = _resp(spark, sf).select("model", "task", "item_id", "prediction", F.col("label_index").alias("label"))
    return X.apply_post(r, "mmlu")


@query("post_final_number", f"""
SELECT {RESP_COLS}, {Q.final_number('prediction')} AS prediction, {Q.final_number('label')} AS label FROM ({V.SQL_RESP})""")
def post_final_number(spark, sf):
    return X.apply_post(_resp(spark, sf).drop("label_index"), "gsm8k")


# The same extractors over whole real texts (documents and dialogue turns)
SQL_TEXTS = """
  SELECT 'documents' AS task, doc_id AS item_id, text AS prediction, doc_id % 6 AS label FROM documents
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text, turn % 6 FROM conversations
"""
_EDGE = r"[^\p{L}\p{M}\p{N}_]"
# a letter on its own by Unicode word rules, which this dialect's \b does not follow
SQL_TEXT_CHOICE = rf"""
  CASE WHEN prediction IS NULL OR prediction = '' THEN 'INVALID_PRED' ELSE COALESCE(
    NULLIF(regexp_extract(u, '(?:THE\s+CORRECT\s+ANSWER\s+IS|THE\s+ANSWER\s+IS|ANSWER:|CORRECT\s+OPTION:|OPTION:)\s*\(?([ABCD])\)?', 1), ''),
    NULLIF(regexp_extract(u, 'CORRECT\s+IS\s+([ABCD])', 1), ''), NULLIF(regexp_extract(u, 'IS:\s*([ABCD])', 1), ''),
    NULLIF(regexp_extract(u, '(?:^|{_EDGE})([ABCD])(?:{_EDGE}|$)', 1), ''), 'INVALID_PRED') END"""


def _texts(spark, sf):
    d = V.table(spark, sf, "documents").select(F.lit("documents").alias("task"), F.col("doc_id").alias("item_id"), F.col("text").alias("prediction"),
                                               (F.col("doc_id") % 6).alias("label"))
    c = V.table(spark, sf, "conversations").select(F.lit("conversations").alias("task"), (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
                                                   F.col("text").alias("prediction"), (F.col("turn") % 6).cast("long").alias("label"))
    return d.unionByName(c)


@query("post_choice_letter_text", f"""
SELECT task, item_id, {SQL_TEXT_CHOICE} AS prediction, {sql_choice_label('label')} AS label FROM (SELECT *, upper({Q.strip('prediction')}) AS u FROM ({SQL_TEXTS}))""")
def post_choice_letter_text(spark, sf):
    return X.apply_post(_texts(spark, sf), "mmlu")


@query("post_final_number_text", f"""
SELECT task, item_id, {Q.final_number('prediction')} AS prediction, CAST(label AS VARCHAR) AS label FROM ({SQL_TEXTS})""")
def post_final_number_text(spark, sf):
    return X.apply_post(_texts(spark, sf), "gsm8k")


@query("post_sentiment_text", f"""
SELECT task, item_id, CASE WHEN contains(lower({Q.strip('prediction')}), 'positive') OR regexp_matches(lower({Q.strip('prediction')}), '(?:^|{_EDGE})pos(?:{_EDGE}|$)')
       THEN 1 ELSE 0 END AS prediction, CAST(label AS INTEGER) AS label FROM ({SQL_TEXTS})""")
def post_sentiment_text(spark, sf):
    return X.apply_post(_texts(spark, sf), "sst2")


@query("post_sentiment", f"""
SELECT {RESP_COLS}, CASE WHEN contains(lower({Q.strip('prediction')}), 'positive') OR regexp_matches(lower({Q.strip('prediction')}), '\\bpos\\b')
       THEN 1 ELSE 0 END AS prediction,
       CASE WHEN regexp_matches(label, '^[0-9]+$') THEN CAST(label AS INTEGER) ELSE -1 END AS label FROM ({V.SQL_RESP})""")
def post_sentiment(spark, sf):
    return X.apply_post(_resp(spark, sf).drop("label_index"), "sst2")


@query("post_paraphrase", f"""
SELECT {RESP_COLS}, CASE WHEN contains(lower(prediction), 'not equivalent') OR contains(lower(prediction), 'no') THEN 0
       WHEN contains(lower(prediction), 'yes') OR contains(lower(prediction), 'equivalent') THEN 1 ELSE 0 END AS prediction,
       CASE WHEN label_index >= 0 THEN CAST(label_index AS INTEGER) ELSE -1 END AS label FROM ({V.SQL_RESP})""")
def post_paraphrase(spark, sf):
    r = _resp(spark, sf).select("model", "task", "item_id", "prediction", F.col("label_index").alias("label"))
    return X.apply_post(r, "mrpc")


@query("post_similarity", f"""
SELECT {RESP_COLS}, CASE WHEN regexp_extract({Q.strip('prediction')}, '(\\d+\\.?\\d*|\\.\\d+)', 1) = '' THEN -1.0
       ELSE greatest(0.0, least(5.0, CAST(regexp_extract({Q.strip('prediction')}, '(\\d+\\.?\\d*|\\.\\d+)', 1) AS DOUBLE))) END AS prediction,
       CASE WHEN {Q.is_float('label')} THEN CAST(label AS DOUBLE) ELSE -1.0 END AS label FROM ({V.SQL_RESP})""")
def post_similarity(spark, sf):
    return X.apply_post(_resp(spark, sf).drop("label_index"), "stsb")


@query("post_creative", f"""
SELECT {RESP_COLS}, {Q.creative_clean('prediction')} AS cleaned_text, len({Q.ws_split(Q.creative_clean('prediction'))}) AS word_count,
       label FROM ({V.SQL_PAIRS})""")
def post_creative(spark, sf):
    p = V.pairs(spark, sf).select("model", "task", "item_id", "prediction", "label")
    c = X.apply_post(p, "creative")
    return c.select("model", "task", "item_id", F.col("prediction.cleaned_text").alias("cleaned_text"),
                    F.col("prediction.word_count").cast("long").alias("word_count"), "label")


@query("post_prefix", f"""
SELECT {RESP_COLS}, CASE WHEN starts_with(prediction, 'The answer is') THEN {Q.strip('substr(prediction, 14)')} ELSE prediction END AS prediction,
       label FROM ({V.SQL_RESP})""")
def post_prefix(spark, sf):
    return X.apply_post(_resp(spark, sf).drop("label_index"), "prefix", prefix_to_remove="The answer is")


def _choice_custom_sql(t):
    u = f"upper({Q.strip(t)})"
    parts = [f"WHEN regexp_matches({u}, '\\({c}\\s*\\)|\\(\\s*{c}\\s*\\)|\\b{c}\\s*\\.|\\b{c}\\s*\\)|\\b{c}\\b') THEN '{c}'" for c in "ABCD"]
    parts += [f"WHEN contains({u}, '{c}') THEN '{c}'" for c in "ABCD"]
    return f"(CASE WHEN {t} IS NULL THEN 'INVALID_PRED' {' '.join(parts)} ELSE 'INVALID_PRED' END)"


@query("post_choice_custom", f"""
SELECT {RESP_COLS}, {_choice_custom_sql('prediction')} AS prediction,
       CASE label_index WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' ELSE 'INVALID_LABEL' END AS label
FROM ({V.SQL_RESP})""")
def post_choice_custom(spark, sf):
    r = _resp(spark, sf).select("model", "task", "item_id", "prediction", F.col("label_index").alias("label"))
    return X.apply_post(r, "choice_custom", label_map={0: "A", 1: "B", 2: "C", 3: "D"})


@query("post_elaboration", f"""
SELECT {RESP_COLS}, {Q.strip("regexp_replace(CASE WHEN starts_with(lower(" + Q.strip('prediction') + "), 'answer:') THEN " + Q.strip("substr(" + Q.strip('prediction') + ", 8)") + " ELSE " + Q.strip('prediction') + " END, '\\s+', ' ', 'g')")} AS prediction,
       label FROM ({V.SQL_RESP})""")
def post_elaboration(spark, sf):
    return X.apply_post(_resp(spark, sf).drop("label_index"), "elaboration", elaboration_prefix_to_remove="Answer:")


def _upper_post(df, pred, label):
    return df.withColumn(pred, F.upper(F.col(pred))).withColumn(label, F.col(label).cast("string"))


def _broken_post(df, pred, label):
    return df.withColumn(pred, F.col("no_such_column"))


@query("post_custom", f"""
SELECT {RESP_COLS}, upper(prediction) AS prediction, label, 'user' AS used FROM ({V.SQL_RESP})
UNION ALL SELECT {RESP_COLS}, prediction, label, 'fallback' FROM ({V.SQL_RESP})""")
def post_custom(spark, sf):
    r = _resp(spark, sf).drop("label_index")
    a = X.apply_custom_post(r, _upper_post).withColumn("used", F.lit("user"))
    b = X.apply_custom_post(r, _broken_post).withColumn("used", F.lit("fallback"))
    return a.unionByName(b)


def strip_prefix_lists(predictions, labels, batch=None, script_args=None):
    """A list-style user post-processor (cut a prefix, labels to text)."""
    prefix = (script_args or {}).get("prefix_to_remove")
    preds = [p[len(prefix):].strip() if isinstance(p, str) and prefix and p.startswith(prefix) else p for p in predictions]
    return preds, [None if x is None else str(x) for x in labels]


@query("post_custom_batch", f"""
SELECT {RESP_COLS}, CASE WHEN starts_with(prediction, 'The answer is') THEN {Q.strip('substr(prediction, 14)')} ELSE prediction END AS prediction,
       label FROM ({V.SQL_RESP})""")
def post_custom_batch(spark, sf):
    r = _resp(spark, sf).drop("label_index")
    return X.apply_batch_post(r, strip_prefix_lists, script_args={"prefix_to_remove": "The answer is"})
