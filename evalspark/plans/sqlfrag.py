"""DuckDB SQL fragments used by the oracles (Python string semantics spelled in SQL)."""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ws_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def ngrams(toks: str, n: int) -> str:
    return (f"(CASE WHEN len({toks}) >= {n} THEN list_transform(range(1, len({toks}) - {n} + 2), "
            f"lambda i: array_to_string({toks}[i:i + {n - 1}], ' ')) ELSE [] END)")


def pystr(x: str) -> str:
    return f"COALESCE(CAST({x} AS VARCHAR), 'None')"


def creative_clean(t: str) -> str:
    lines = f"replace(replace({strip(t)}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    one = f"regexp_replace({strip('x')}, '\\s+', ' ', 'g')"
    s = f"array_to_string(list_transform(regexp_split_to_array({lines}, '\\n\\s*\\n+'), lambda x: {one}), chr(10) || chr(10))"
    return f"(CASE WHEN {t} IS NULL THEN '' ELSE {s} END)"


def prf(src: str, average: str, zd: float = 0.0, keys: str = "model, task", numeric: bool = True) -> str:
    """CTEs conf / cls / prf(keys, precision, recall, f1_score) with sklearn averaging."""
    z = f"{float(zd)}"
    per = f"""
  cls_s AS (SELECT {keys}, c, tp, fp, fn, tp + fn AS support,
      CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE {z} END AS precision,
      CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE {z} END AS recall,
      CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE {z} END AS f1_score FROM cls)"""
    if average == "macro":
        body = "avg(precision) AS precision, avg(recall) AS recall, avg(f1_score) AS f1_score"
    elif average == "weighted":
        body = ", ".join(f"CASE WHEN sum(support) > 0 THEN sum({m} * support) / sum(support) ELSE {z} END AS {m}"
                         for m in ("precision", "recall", "f1_score"))
    elif average == "micro":
        body = (f"CASE WHEN sum(tp + fp) > 0 THEN sum(tp) / sum(tp + fp) ELSE {z} END AS precision, "
                f"CASE WHEN sum(tp + fn) > 0 THEN sum(tp) / sum(tp + fn) ELSE {z} END AS recall, "
                f"CASE WHEN sum(2 * tp + fp + fn) > 0 THEN 2 * sum(tp) / sum(2 * tp + fp + fn) ELSE {z} END AS f1_score")
    else:
        bad = "TRUE" if not numeric else "(count(*) > 2 OR (count(*) = 2 AND max(CASE WHEN c = 1 THEN 1 ELSE 0 END) = 0))"
        body = ", ".join(f"CASE WHEN {bad} THEN 0.0 ELSE COALESCE(max(CASE WHEN c = 1 THEN {m} END), {z}) END AS {m}"
                         for m in ("precision", "recall", "f1_score"))
    return f"""
  conf AS (SELECT {keys}, label AS l, prediction AS p, count(*) AS n FROM {src} GROUP BY ALL),
  cls AS (
    SELECT {keys}, c, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
      SELECT {keys}, l AS c, CASE WHEN l = p THEN n ELSE 0 END AS tp, 0 AS fp, CASE WHEN l = p THEN 0 ELSE n END AS fn FROM conf
      UNION ALL
      SELECT {keys}, p AS c, 0, CASE WHEN l = p THEN 0 ELSE n END, 0 FROM conf) GROUP BY ALL),
  {per},
  prf AS (SELECT {keys}, {body} FROM cls_s GROUP BY ALL)
"""


PY_FLOAT_RX = "'^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\\s*$'"
ANSWER_PHRASES = ("the final answer is", "the answer is", "so the result is", "which gives us", "is equal to")


def is_float(x: str) -> str:
    return f"COALESCE(regexp_matches({x}, {PY_FLOAT_RX}), FALSE)"


def drop_dot(x: str) -> str:
    return (f"(CASE WHEN ends_with({x}, '.') AND strpos(left({x}, length({x}) - 1), '.') = 0 "
            f"THEN left({x}, length({x}) - 1) ELSE {x} END)")


def final_number(t: str) -> str:
    s = strip(t)
    hashes = f"regexp_extract_all({s}, '####\\s*([\\d,.-]+)', 1)"
    h = drop_dot(f"replace({hashes}[-1], ',', '')")
    phr = []
    for ph in ANSWER_PHRASES:
        found = f"regexp_extract_all({s}, '(?i){ph}\\s*:?\\s*([-+]?\\s*[\\d,.]+\\d)', 1)"
        c = f"replace(replace({found}[-1], ',', ''), ' ', '')"
        phr.append(f"CASE WHEN {is_float(c)} THEN {c} END")
    last = drop_dot(f"replace(regexp_extract_all({s}, '[-+]?\\b\\d[\\d,.]*\\b', 0)[-1], ',', '')")
    lastv = f"CASE WHEN {is_float(last)} THEN {last} END"
    return (f"(CASE WHEN {t} IS NULL OR {t} = '' THEN 'ANSWER_NOT_FOUND' "
            f"WHEN len({hashes}) > 0 THEN (CASE WHEN {is_float(h)} THEN {h} ELSE 'INVALID_NUM_FORMAT_IN_HASH_PATTERN' END) "
            f"ELSE COALESCE({', '.join(phr)}, {lastv}, 'ANSWER_NOT_FOUND') END)")
