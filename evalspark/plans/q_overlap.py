"""BLEU / ROUGE queries over dialogue pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import overlap as O
from . import sqlfrag as Q
from . import views as V
from .catalog import finish, query

TOK = Q.ws_split


def _bleu_sql(max_n=4, weights=(0.25, 0.25, 0.25, 0.25)):
    items = f"SELECT model, task, item_id, {TOK('prediction')} AS h, {TOK('label')} AS r FROM ({V.SQL_PAIRS})"
    hg = " UNION ALL ".join(f"SELECT model, task, item_id, {n} AS n, unnest({Q.ngrams('h', n)}) AS g FROM items" for n in range(1, max_n + 1))
    rg = " UNION ALL ".join(f"SELECT model, task, item_id, {n} AS n, unnest({Q.ngrams('r', n)}) AS g FROM items" for n in range(1, max_n + 1))
    tot = " UNION ALL ".join(f"SELECT model, task, {n} AS n, greatest(1, greatest(len(h) - {n} + 1, 0)) AS d FROM items" for n in range(1, max_n + 1))
    logs = " + ".join(
        f"{w} * ln(CASE WHEN max(CASE WHEN n = {n} THEN num END) = 0 THEN 0.1 / max(CASE WHEN n = {n} THEN den END) "
        f"ELSE max(CASE WHEN n = {n} THEN num END) / max(CASE WHEN n = {n} THEN den END) END)"
        for n, w in zip(range(1, max_n + 1), weights))
    return f"""
WITH items AS ({items}),
hc AS (SELECT model, task, item_id, n, g, count(*) AS c FROM ({hg}) GROUP BY ALL),
rc AS (SELECT model, task, item_id, n, g, count(*) AS c FROM ({rg}) GROUP BY ALL),
clip AS (SELECT hc.model, hc.task, hc.n, sum(least(hc.c, COALESCE(rc.c, 0))) AS num FROM hc
         LEFT JOIN rc ON rc.model = hc.model AND rc.task = hc.task AND rc.item_id = hc.item_id AND rc.n = hc.n AND rc.g = hc.g GROUP BY ALL),
tot AS (SELECT model, task, n, sum(d) AS den FROM ({tot}) GROUP BY ALL),
pn AS (SELECT t.model, t.task, t.n, COALESCE(c.num, 0) AS num, t.den FROM tot t LEFT JOIN clip c USING (model, task, n)),
lens AS (SELECT model, task, sum(len(h)) AS c, sum(len(r)) AS r FROM items GROUP BY ALL),
s AS (SELECT model, task, {logs} AS lg, max(CASE WHEN n = 1 THEN num END) AS n1 FROM pn GROUP BY ALL)
SELECT model, task, 'bleu' AS metric, '' AS sub_metric,
       round(CASE WHEN n1 = 0 THEN 0.0 ELSE (CASE WHEN c > r THEN 1.0 WHEN c = 0 THEN 0.0 ELSE exp(1 - r / c) END) * exp(lg) END, 6) AS score
FROM s JOIN lens USING (model, task)"""


@query("metric_bleu", _bleu_sql())
def metric_bleu(spark, sf):
    return finish(O.metric_bleu(V.pairs(spark, sf)))


def _rw(t):
    sents = f"list_filter(string_split({t}, '.'), lambda s: length(s) > 0)"
    return f"flatten(list_transform({sents}, lambda s: string_split(regexp_replace({Q.strip('s')}, '\\s+', ' ', 'g'), ' ')))"


def _rouge_n_sql(src=None, ns=(1, 2), stats=("f", "p", "r")):
    """Words once per row, n-gram sets by unnest and distinct, overlaps by a join."""
    src = src or V.SQL_PAIRS
    stripped = f"SELECT model, task, {Q.strip('prediction')} AS h, {Q.strip('label')} AS r FROM ({src})"
    grams = {c: " UNION ALL ".join(f"SELECT id, {n} AS n, unnest({Q.ngrams(c, n)}) AS g FROM b" for n in ns) for c in "hr"}
    value = {"f": "avg(2.0 * (p * r) / (p + r + 1e-8))", "p": "avg(p)", "r": "avg(r)"}
    rows = [f"SELECT model, task, 'rouge' AS metric, 'rouge' || n || '_{s}' AS sub_metric, round({value[s]}, 6) AS score FROM x GROUP BY model, task, n"
            for s in ("f", "p", "r") if s in stats]
    return f"""WITH b AS MATERIALIZED (SELECT row_number() OVER () AS id, model, task, {_rw('h')} AS h, {_rw('r')} AS r FROM ({stripped}) WHERE h <> '' AND r <> ''),
e AS (SELECT DISTINCT id, n, g FROM ({grams['h']})),
f AS (SELECT DISTINCT id, n, g FROM ({grams['r']})),
i AS (SELECT id, n, count(*) AS c FROM e JOIN f USING (id, n, g) GROUP BY ALL),
en AS (SELECT id, n, count(*) AS c FROM e GROUP BY ALL),
fn AS (SELECT id, n, count(*) AS c FROM f GROUP BY ALL),
x AS (SELECT b.model, b.task, k.n, coalesce(i.c / en.c, 0.0) AS p, coalesce(i.c / fn.c, 0.0) AS r
      FROM b CROSS JOIN (SELECT unnest({list(ns)!r}) AS n) k LEFT JOIN i ON i.id = b.id AND i.n = k.n
      LEFT JOIN en ON en.id = b.id AND en.n = k.n LEFT JOIN fn ON fn.id = b.id AND fn.n = k.n)
""" + "\nUNION ALL ".join(rows)


@query("metric_rouge_n", _rouge_n_sql())
def metric_rouge_n(spark, sf):
    return finish(O.metric_rouge(V.pairs(spark, sf), metrics=("rouge1", "rouge2"), stats=("f", "p", "r")))


@query("metric_rouge_l")
def metric_rouge_l(spark, sf):
    """ROUGE-L needs an LCS reconstruction per sentence pair; checked against the
    pure-Python pair function on fixtures (tests/test_overlap.py)."""
    return finish(O.metric_rouge(V.pairs(spark, sf), metrics=("rougeL", "rougeLsum", "rouge-3"), stats=("f", "r")))


def _ents_sql(col):
    """Spans of one tag column with lag / lead (the oracle side may use windows)."""
    return f"""
  (SELECT model, task, item_id, ty AS type, begin, pos AS "end" FROM (
    SELECT *, COALESCE(max(CASE WHEN st THEN pos END) OVER (PARTITION BY item_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS begin
    FROM (SELECT *,
      (p0 = 'B' OR p0 = 'S' OR (pp = 'E' AND p0 IN ('E', 'I')) OR (pp = 'S' AND p0 IN ('E', 'I')) OR (pp = 'O' AND p0 IN ('E', 'I'))
        OR (p0 <> 'O' AND p0 <> '.' AND pty <> ty)) AS st,
      (p0 IN ('E', 'S') OR (p0 = 'B' AND np IN ('B', 'S', 'O')) OR (p0 = 'I' AND np IN ('B', 'S', 'O'))
        OR (p0 <> 'O' AND p0 <> '.' AND ty <> nty)) AS en
    FROM (SELECT model, task, item_id, pos, left({col}, 1) AS p0,
       COALESCE(nullif(split_part(substr({col}, 2), '-', 2), ''), '_') AS ty,
       left(COALESCE(lag({col}) OVER w, 'O'), 1) AS pp,
       CASE WHEN lag({col}) OVER w IS NULL THEN '' ELSE COALESCE(nullif(split_part(substr(lag({col}) OVER w, 2), '-', 2), ''), '_') END AS pty,
       left(COALESCE(lead({col}) OVER w, 'O'), 1) AS np,
       COALESCE(nullif(split_part(substr(COALESCE(lead({col}) OVER w, 'O'), 2), '-', 2), ''), '_') AS nty
     FROM ({V.SQL_TAGS}) WINDOW w AS (PARTITION BY item_id ORDER BY pos))))
  WHERE en)"""


@query("metric_sequence_labeling", f"""
WITH te AS {_ents_sql('label')}, pe AS {_ents_sql('prediction')},
tp AS (SELECT count(*) AS tp FROM te JOIN pe USING (model, task, item_id, type, begin, "end")),
c AS (SELECT (SELECT tp FROM tp) AS tp, (SELECT count(*) FROM pe) AS np, (SELECT count(*) FROM te) AS nt),
s AS (SELECT CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS r FROM c)
SELECT 'tagger' AS model, 'events' AS task, 'sequence_labeling' AS metric, 'overall_precision' AS sub_metric, round(p, 6) AS score FROM s
UNION ALL SELECT 'tagger', 'events', 'sequence_labeling', 'overall_recall', round(r, 6) FROM s
UNION ALL SELECT 'tagger', 'events', 'sequence_labeling', 'overall_f1', round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) FROM s""")
def metric_sequence_labeling(spark, sf):
    from ..operators.metrics import sequence as Sq

    return finish(Sq.metric_sequence_labeling(V.tags(spark, sf)))


# M18 -------------------------------------------------------------------------------------
def _token_vecs(spark, sf):
    from pyspark.sql import functions as F

    e = V.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    e1 = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("v1"))
    e2 = e.select((F.col("vec_id") - 2).alias("vec_id"), F.col("v").alias("v2"))
    j = e.join(e1, "vec_id").join(e2, "vec_id")
    return j.select(F.lit("emb").alias("model"), F.concat(F.lit("t"), F.col("label").cast("string")).alias("task"),
                    F.array("v", "v1").alias("prediction"), F.array("v1", "v2").alias("label"))


_TV = """
  SELECT 'emb' AS model, 't' || CAST(a.label AS VARCHAR) AS task,
         [CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])] AS p, [CAST(b.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])] AS l
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 JOIN embeddings c ON c.vec_id = a.vec_id + 2"""
_COS = "list_dot_product(x, y) / (sqrt(list_dot_product(x, x)) * sqrt(list_dot_product(y, y)))"
_GP = f"list_avg(list_transform(p, lambda x: list_max(list_transform(l, lambda y: {_COS}))))"
_GR = f"list_avg(list_transform(l, lambda y: list_max(list_transform(p, lambda x: {_COS}))))"


@query("metric_token_match", f"""
WITH s AS (SELECT model, task, {_GP} AS P, {_GR} AS R FROM ({_TV}))
SELECT model, task, 'bertscore' AS metric, 'bertscore_precision' AS sub_metric, round(avg(P), 6) AS score FROM s GROUP BY ALL
UNION ALL SELECT model, task, 'bertscore', 'bertscore_recall', round(avg(R), 6) FROM s GROUP BY ALL
UNION ALL SELECT model, task, 'bertscore', 'bertscore_f1', round(avg(CASE WHEN P + R > 0 THEN 2 * P * R / (P + R) ELSE 0.0 END), 6)
FROM s GROUP BY ALL""")
def metric_token_match(spark, sf):
    from ..operators.evaluate import evaluate_suite

    return finish(evaluate_suite(_token_vecs(spark, sf), ["bertscore"], persist=False))


# M18 with idf: a token is a vector's cluster label; its identity stands beside the vector --------
_TVI = """
  SELECT 'emb' AS model, 'g' || CAST(a.vec_id % 3 AS VARCHAR) AS task, a.vec_id AS item,
         [CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])] AS p, [CAST(b.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])] AS l,
         [a.label, b.label] AS pt, [b.label, c.label] AS lt
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 JOIN embeddings c ON c.vec_id = a.vec_id + 2"""


def _weighted_sql(values, weights):
    return (f"CASE WHEN list_sum({weights}) > 0 THEN list_sum(list_transform({values}, lambda v, i: v * {weights}[i])) / list_sum({weights}) ELSE 0.0 END")


@query("metric_token_match_idf", f"""
WITH b AS MATERIALIZED ({_TVI}),
n AS (SELECT task, count(*) AS n FROM b GROUP BY task),
d AS (SELECT task, tok, count(*) AS c FROM (SELECT task, unnest(list_distinct(lt)) AS tok FROM b) GROUP BY ALL),
w AS (SELECT item, list(idf ORDER BY i) FILTER (side = 0) AS wp, list(idf ORDER BY i) FILTER (side = 1) AS wl FROM (
  SELECT x.item, x.side, x.i, ln((n + 1)::DOUBLE / (coalesce(c, 0) + 1)) AS idf FROM (
    SELECT task, item, 0 AS side, unnest(pt) AS tok, unnest([1, 2]) AS i FROM b UNION ALL SELECT task, item, 1, unnest(lt), unnest([1, 2]) FROM b) x
  JOIN n USING (task) LEFT JOIN d USING (task, tok)) GROUP BY item),
m AS (SELECT model, task, item, list_transform(p, lambda x: list_max(list_transform(l, lambda y: {_COS}))) AS pm,
             list_transform(l, lambda y: list_max(list_transform(p, lambda x: {_COS}))) AS lm FROM b),
s AS (SELECT model, task, {_weighted_sql('pm', 'wp')} AS P, {_weighted_sql('lm', 'wl')} AS R FROM m JOIN w USING (item))
SELECT model, task, 'bertscore' AS metric, 'bertscore_precision' AS sub_metric, round(avg(P), 6) AS score FROM s GROUP BY ALL
UNION ALL SELECT model, task, 'bertscore', 'bertscore_recall', round(avg(R), 6) FROM s GROUP BY ALL
UNION ALL SELECT model, task, 'bertscore', 'bertscore_f1', round(avg(CASE WHEN P + R > 0 THEN 2 * P * R / (P + R) ELSE 0.0 END), 6)
FROM s GROUP BY ALL""")
def metric_token_match_idf(spark, sf):
    from ..operators.evaluate import evaluate_suite

    e = V.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.col("label").alias("t"))
    nth = [e] + [e.select((F.col("vec_id") - k).alias("vec_id"), F.col("v").alias(f"v{k}"), F.col("t").alias(f"t{k}")) for k in (1, 2)]
    j = nth[0].join(nth[1], "vec_id").join(nth[2], "vec_id")
    df = j.select(F.lit("emb").alias("model"), F.concat(F.lit("g"), (F.col("vec_id") % 3).cast("string")).alias("task"), F.col("vec_id").alias("item_id"),
                  F.array("v", "v1").alias("prediction"), F.array("v1", "v2").alias("label"), F.array("t", "t1").alias("prediction_tokens"), F.array("t1", "t2").alias("label_tokens"))
    return finish(evaluate_suite(df, [{"name": "bertscore", "options": {"idf": True}}], persist=False))


# M10 ---------------------------------------------------------------------------------------
@query("metric_meteor")
def metric_meteor(spark, sf):
    from ..operators.evaluate import evaluate_suite

    return finish(evaluate_suite(V.pairs(spark, sf), ["meteor"], persist=False))


@query("metric_meteor_synonyms")
def metric_meteor_synonyms(spark, sf):
    """METEOR with a synonym table: neighbouring words of the benchmark items stand for synonyms."""
    from ..functions.text import ws_split
    from ..operators.metrics import meteor as Me

    words = V.table(spark, sf, "benchmark").select(ws_split(F.lower("text")).alias("w"))
    pairs = words.select(F.explode(F.arrays_zip(F.col("w").alias("word"), F.slice("w", 2, F.size("w")).alias("synonym"))).alias("p"))
    table = pairs.select("p.word", "p.synonym").where("synonym IS NOT NULL")
    return finish(Me.metric_meteor(V.pairs(spark, sf), synonyms=table))


# M24 ---------------------------------------------------------------------------------------
def _len_init(options):
    return {"total_word_count": 0, "num_predictions": 0}


def _len_update(state, preds, labels, options):
    for p in preds:
        if isinstance(p, str):
            state["total_word_count"] += len(p.split())
            state["num_predictions"] += 1
    return state


def _len_result(state, options):
    if state["num_predictions"] == 0:
        return {"avg_prediction_length": 0.0}
    return {"avg_prediction_length": state["total_word_count"] / state["num_predictions"]}


@query("metric_custom", f"""
SELECT model, task, 'custom_length' AS metric, 'avg_prediction_length' AS sub_metric,
       round(avg(len({Q.ws_split('prediction')})), 6) AS score FROM ({V.SQL_PAIRS}) GROUP BY ALL""")
def metric_custom(spark, sf):
    from ..operators.evaluate import evaluate_suite

    spec = {"name": "custom_script", "options": {"init": _len_init, "update": _len_update, "result": _len_result,
                                                 "name": "custom_length"}}
    return finish(evaluate_suite(V.pairs(spark, sf), [spec], persist=False))


# A5 + A6 on real composite names: wide ROUGE results melted back, "rouge_*" split -----------
@query("results_melt_rouge", f"""
WITH r AS ({_rouge_n_sql(None, ns=(1, 2), stats=("f",))})
SELECT model, task, 'rouge_' || sub_metric AS full_metric_name, score, 'rouge' AS metric, sub_metric FROM r""")
def results_melt_rouge(spark, sf):
    from ..operators import analyze as A

    long = O.metric_rouge(V.pairs(spark, sf), metrics=("rouge1", "rouge2"), stats=("f",))
    long = long.withColumn("full_metric_name", A.full_metric_name())
    return finish(A.results_melt(A.report_wide(long, ["rouge_rouge1_f", "rouge_rouge2_f"])))


# M17, strict schemes: the lines of an order are a short tag sequence ------------------------------
def _strict_tag(letters: str, index, flag):
    letter = F.substr(F.lit(letters), index % len(letters) + 1, F.lit(1))
    return F.when(letter == "O", "O").otherwise(F.concat(letter, F.lit("-"), flag))


def _strict_sql() -> str:
    from ..operators.metrics.sequence import ANY, SAME, SCHEMES

    def hits(patterns, pp, pt, p, t):
        rel = {ANY: "", SAME: f" AND {pt} = {t}"}
        one = [f"({pp} IN ({', '.join(repr(x) for x in a)}) AND {p} IN ({', '.join(repr(x) for x in b)})" + rel.get(r, f" AND {pt} <> {t}") + ")" for a, b, r in patterns]
        return "(" + " OR ".join(one) + ")"

    parts = []
    for name, s in SCHEMES.items():
        letter = f"substr('{s.allowed}', CAST({{i}} % {len(s.allowed)} + 1 AS INTEGER), 1)"
        tag = f"CASE WHEN {letter} = 'O' THEN 'O' ELSE {letter} || '-' || l_returnflag END"
        start, inside, end = (hits(x, "pp", "pt", "p", "t") for x in (s.start, s.inside, s.end))
        parts.append(f"""
SELECT '{name}' AS model, item, side, b, max(e) AS e, any_value(ty) AS ty FROM (
  SELECT item, side, run, min(i) FILTER (st) AS b, max(i) AS e, any_value(t) AS ty, lead(any_value(en) FILTER (NOT ins)) OVER (PARTITION BY item, side ORDER BY run) AS ended FROM (
    SELECT *, sum(CASE WHEN ins THEN 0 ELSE 1 END) OVER (PARTITION BY item, side ORDER BY i) AS run FROM (
      SELECT *, {start} AS st, {inside} AS ins, {end} AS en FROM (
        SELECT *, coalesce(lag(p) OVER w, 'O') AS pp, coalesce(lag(t) OVER w, '_') AS pt FROM (
          SELECT item, side, i, substr(tag, 1, 1) AS p, CASE WHEN tag = 'O' THEN '_' ELSE substr(tag, 3) END AS t FROM (
            SELECT l_orderkey AS item, 't' AS side, i, {tag.format(i="CAST(l_quantity AS BIGINT)")} AS tag FROM li
            UNION ALL SELECT l_orderkey, 'p', i, {tag.format(i="(CASE WHEN l_partkey % 4 = 0 THEN l_suppkey ELSE CAST(l_quantity AS BIGINT) END)")} FROM li
            UNION ALL SELECT l_orderkey, s, max(i) + 1, 'O' FROM li, (VALUES ('t'), ('p')) v(s) GROUP BY ALL)) WINDOW w AS (PARTITION BY item, side ORDER BY i))))
  GROUP BY item, side, run) WHERE b IS NOT NULL AND ended GROUP BY item, side, b""")
    return f"""
WITH li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag, l_partkey, l_suppkey) - 1 AS i FROM lineitem),
s AS MATERIALIZED ({" UNION ALL ".join(parts)}),
c AS (SELECT model, sum(n) FILTER (side = 't') AS nt, sum(n) FILTER (side = 'p') AS np, sum(n) FILTER (side = 'b') AS tp FROM (
  SELECT model, side, count(*) AS n FROM s GROUP BY ALL
  UNION ALL SELECT a.model, 'b', count(*) FROM s a JOIN s b ON a.side = 't' AND b.side = 'p' AND a.model = b.model AND a.item = b.item AND a.b = b.b AND a.e = b.e AND a.ty = b.ty GROUP BY ALL) GROUP BY model),
r AS (SELECT model, tp / np AS p, tp / nt AS r FROM c)
SELECT model, 'orders' AS task, 'sequence_labeling' AS metric, 'overall_precision' AS sub_metric, round(p, 6) AS score FROM r
UNION ALL SELECT model, 'orders', 'sequence_labeling', 'overall_recall', round(r, 6) FROM r
UNION ALL SELECT model, 'orders', 'sequence_labeling', 'overall_f1', round(2 * p * r / (p + r), 6) FROM r"""


@query("metric_sequence_strict", _strict_sql())
def metric_sequence_strict(spark, sf):
    """Tag lists per order, made from its lines in line order; every strict scheme over them."""
    from ..operators.metrics import sequence as Sq

    lines = F.struct("l_linenumber", "l_quantity", "l_returnflag", "l_partkey", "l_suppkey")
    orders = V.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(lines)).alias("lines"))
    out = None
    for name, scheme in Sq.SCHEMES.items():
        def tags(index, letters=scheme.allowed):
            return F.transform("lines", lambda x: _strict_tag(letters, index(x).cast("int"), x["l_returnflag"]))

        df = orders.select(F.lit(name).alias("model"), F.lit("orders").alias("task"), F.col("l_orderkey").alias("item_id"),
                           tags(lambda x: x["l_quantity"]).alias("label"),
                           tags(lambda x: F.when(x["l_partkey"] % 4 == 0, x["l_suppkey"].cast("double")).otherwise(x["l_quantity"])).alias("prediction"))
        part = Sq.metric_sequence_labeling(df, mode="strict", scheme=name)
        out = part if out is None else out.unionByName(part)
    return finish(out)
