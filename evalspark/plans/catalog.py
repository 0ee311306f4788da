"""Query catalog: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. Doubles are rounded to 6 places on both sides so that value
hashes agree; every computed column carries the same alias in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import postprocess as X
from ..functions.text import round6
from ..operators.evaluate import evaluate_suite
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round every double column (stable hashes, -0.0 -> 0.0)."""
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- shared SQL fragments (DuckDB) ------------------------------------------------
SQL_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_strip(x: str) -> str:
    return SQL_STRIP.format(x=x)


SQL_MCQ = """
  SELECT l_returnflag AS model, l_linestatus AS task, l_orderkey * 10 + l_linenumber AS item_id,
         'The answer is (' || chr(CAST(65 + l_linenumber % 5 AS INTEGER)) || ')' AS prediction,
         l_partkey % 4 AS label
  FROM lineitem
"""

SQL_CHOICE_LETTER = r"""
  CASE WHEN {t} IS NULL OR {t} = '' THEN 'INVALID_PRED' ELSE COALESCE(
    NULLIF(regexp_extract(upper({s}), '(?:THE\s+CORRECT\s+ANSWER\s+IS|THE\s+ANSWER\s+IS|ANSWER:|CORRECT\s+OPTION:|OPTION:)\s*\(?([ABCD])\)?', 1), ''),
    NULLIF(regexp_extract(upper({s}), 'CORRECT\s+IS\s+([ABCD])', 1), ''),
    NULLIF(regexp_extract(upper({s}), 'IS:\s*([ABCD])', 1), ''),
    NULLIF(regexp_extract(upper({s}), '\b([ABCD])\b', 1), ''),
    'INVALID_PRED') END
"""


def sql_choice_letter(t: str) -> str:
    return SQL_CHOICE_LETTER.format(t=t, s=sql_strip(t))


def sql_choice_label(l: str) -> str:
    return f"CASE WHEN {l} BETWEEN 0 AND 3 THEN chr(CAST(65 + {l} AS INTEGER)) ELSE 'INVALID_LABEL' END"


def sql_prf_macro(src: str, keys: str = "model, task") -> str:
    """Macro precision / recall / F1 over (keys, prediction, label) in ``src``."""
    return f"""
  conf AS (SELECT {keys}, label AS l, prediction AS p, count(*) AS n FROM {src} GROUP BY ALL),
  cls AS (
    SELECT {keys}, c, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
      SELECT {keys}, l AS c, CASE WHEN l = p THEN n ELSE 0 END AS tp, 0 AS fp, CASE WHEN l = p THEN 0 ELSE n END AS fn FROM conf
      UNION ALL
      SELECT {keys}, p AS c, 0, CASE WHEN l = p THEN 0 ELSE n END, 0 FROM conf) GROUP BY ALL),
  prf AS (
    SELECT {keys},
      avg(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) AS precision,
      avg(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) AS recall,
      avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END) AS f1_score
    FROM cls GROUP BY ALL)
"""


# =====================================================================================
# E1 - flagship: multi-metric evaluation of a multiple-choice task
# =====================================================================================

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = V.mcq_lineitem(spark, sf_dir)
    scored = X.apply_post(raw, "mmlu")
    suite = [
        {"name": "accuracy"},
        {"name": "exact_match"},
        {"name": "precision", "options": {"average": "macro"}},
        {"name": "recall", "options": {"average": "macro"}},
        {"name": "f1_score", "options": {"average": "macro"}},
        {"name": "accuracy"},  # listed twice, the later entry wins
    ]
    return finish(evaluate_suite(scored, suite))


query("evaluate_suite", f"""
WITH raw AS ({SQL_MCQ}),
scored AS (SELECT model, task, {sql_choice_letter('prediction')} AS prediction, {sql_choice_label('label')} AS label FROM raw),
{sql_prf_macro('scored')},
one AS (SELECT model, task, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS acc FROM scored GROUP BY ALL)
SELECT model, task, 'accuracy' AS metric, '' AS sub_metric, round(acc, 6) AS score FROM one
UNION ALL SELECT model, task, 'exact_match', '', round(acc, 6) FROM one
UNION ALL SELECT model, task, 'precision', '', round(precision, 6) FROM prf
UNION ALL SELECT model, task, 'recall', '', round(recall, 6) FROM prf
UNION ALL SELECT model, task, 'f1_score', '', round(f1_score, 6) FROM prf
""")(flagship)


def load_all() -> None:
    """Import every query module (each registers its queries on import). Kept out of
    module import time so that executors unpickling a query's UDF import only the
    module they need."""
    from . import q_data, q_metrics, q_overlap, q_results, q_runner, q_stream  # noqa: F401
