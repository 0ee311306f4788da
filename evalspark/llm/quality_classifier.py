"""Quality classifier by hierarchical empirical Bayes (operator 6).

The evidence of a document (a log likelihood ratio from a logistic model of its text) is combined
with what its site suggests: the host's share of good documents, shrunk towards the global share,
and the path's share, shrunk towards its host's. How strongly sparse sites are shrunk is estimated
from the data (between-site against within-site variance, method of moments). The shares are sums
of classifier probabilities over all documents, made by grouped aggregation; a document's own
probability is left out of the shares it is judged by, so its evidence counts once.

The logistic model is fitted on at most ``sample`` labelled documents (picked by a hash of their
id); scores and site counts cover all documents.

Site of a document: ``source`` up to the first slash after an optional scheme is the host; the next
path segment is the path, or, for a bare host, the language (sites often hold one section each).

Defined cases: null or empty text has zero evidence beyond its features (length zero); null source,
path or language are sites of their own; repeated ids share the mean of their labels, null labels do
not count; without labels of both kinds the evidence is zero everywhere and every document is kept;
each row gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .quality_rules import features

#: Sites never count for more than this when variances between them vanish.
MAX_STRENGTH = 1e9

FEATURES = ["log_words", "short", "symbols", "duplicate_lines", "repeated", "capitals", "exclamations", "distinct", "stops", "no_stops", "word_length", "length_square"]


def feature_matrix(buf: np.ndarray, off: np.ndarray, hasher: C.ByteHash) -> np.ndarray:
    """One row of FEATURES per text; ratios lie between 0 and 1."""
    f = features(buf, off, hasher)
    words = np.maximum(f["n_words"], 1)
    letters = np.maximum(f["n_upper"] + f["n_lower"], 1)
    log_words = np.log1p(f["n_words"]) / 10
    columns = [
        log_words, f["n_words"] < 5, np.minimum(f["n_symbols"] / words, 1), f["n_dup_lines"] / np.maximum(f["n_lines"], 1), f["n_repeat_words"] / words,
        f["n_upper"] / letters, np.minimum(f["n_exclaim"] / words, 1), f["n_distinct"] / words, np.minimum(f["n_stops"] / words, 1),
        (f["n_stops"] == 0) & (f["n_words"] > 20), np.minimum(f["word_chars"] / words, 20) / 10, log_words**2]
    return np.stack([np.asarray(c, dtype=float) for c in columns], axis=1)


@dataclass
class EvidenceModel:
    """Logistic model: evidence = weights . features + bias (prior odds taken out)."""

    weights: np.ndarray
    bias: float
    base_logit: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights + self.bias, -12, 12)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> EvidenceModel:
    """Ridge logistic regression by Newton steps; y may be fractional."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share <= 0 or share >= 1:
        return EvidenceModel(np.zeros(x.shape[1] if x.ndim == 2 else len(FEATURES)), 0.0, 0.0)
    base = float(np.log(share / (1 - share)))
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(design.shape[1])
    w[-1] = base
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - penalty * w
        hess = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return EvidenceModel(w[:-1], float(w[-1] - base), base)


def site_columns(source: Column, lang: Column) -> tuple[Column, Column]:
    """(host, path) of a source."""
    bare = F.regexp_replace(source, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    segment = F.regexp_extract(bare, r"^[^/]*/+([^/?#]+)", 1)
    return F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1)), F.when(segment != "", segment).otherwise(lang)


def _with_text_last(docs: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    return docs.select(*carry, F.col(text_col).cast("string").alias("__text"))


def score_evidence(docs: DataFrame, model: EvidenceModel, carry: list[str], text_col: str = "text") -> DataFrame:
    """``carry`` columns of every document plus ``evidence`` (double). A carried text crosses to
    the tasks once."""
    fields = docs.select(*carry).schema
    carried = text_col in carry
    width, source = len(carry), text_col if carried else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = C.ByteHash(3)
        for batch in batches:
            for rows, buf, off in C.slices(batch, source):
                e = model.evidence(feature_matrix(buf, off, hasher))
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], pa.array(e)], names=[*rows.schema.names[:width], "evidence"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", evidence double"
    return (docs.select(*carry) if carried else _with_text_last(docs, carry, text_col)).mapInArrow(run, schema)


def fit_evidence(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> EvidenceModel:
    """Logistic model from at most ``sample`` labelled documents."""
    y = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    y = C.checkpointed(y.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample).select("doc_id", "y"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(y), "doc_id")  # at most `sample` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = C.ByteHash(3)
        for batch in batches:
            for rows, buf, off in C.slices(batch, "__text"):
                x = feature_matrix(buf, off, hasher)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    rows = _with_text_last(texts, ["y"], "text").mapInArrow(run, "y double, x array<double>").limit(2 * sample).collect()
    return fit_logistic(np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r["y"] for r in rows]))


def _strength(moments) -> float:
    """Prior strength (in documents) of a level: within-group over between-group variance.

    ``moments``: n (documents), k (groups), n2 (sum of squared sizes), between (sum of
    size * (mean - parent mean)**2), within (sum of squared deviations in the groups)."""
    n, k = moments["n"] or 0, moments["k"] or 0
    if n <= k or k < 2:
        return MAX_STRENGTH
    within = max(moments["within"], 0.0) / (n - k)
    between = (moments["between"] - (k - 1) * within) / max(n - moments["n2"] / n, 1e-9)
    return MAX_STRENGTH if between <= 0 or within / between > MAX_STRENGTH else max(within / between, 1e-3)


def site_posteriors(scored: DataFrame, base_logit: float) -> tuple[DataFrame, float, float, float]:
    """Per (host, path): sums of the probabilities, for host and path; the global share and
    the two prior strengths."""
    p = 1 / (1 + F.exp(-(F.col("evidence") + base_logit)))
    paths = C.checkpointed(scored.withColumn("p", p).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("path_n"), F.sum("p").alias("path_good"), F.sum(F.col("p") * F.col("p")).alias("path_square")))
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_good").alias("host_good"), F.sum("path_square").alias("host_square"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).first()
    share = total["good"] / total["n"] if total["n"] else 0.5

    def moments(table: DataFrame, level: str, parent: Column):
        n, good = F.col(f"{level}_n"), F.col(f"{level}_good")
        return table.agg(F.sum(n).alias("n"), F.count(F.lit(1)).alias("k"), F.sum(n * n).cast("double").alias("n2"),
                         F.sum(n * (good / n - parent) * (good / n - parent)).alias("between"),
                         F.sum(F.col(f"{level}_square") - good * good / n).alias("within")).first()

    host_strength = _strength(moments(hosts, "host", F.lit(share)))
    sites = paths.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host"))).drop("h")
    sites = C.checkpointed(sites)
    path_strength = _strength(moments(sites, "path", F.col("host_good") / F.col("host_n")))
    return sites.select("host", "path", "host_n", "host_good", "path_n", "path_good"), share, host_strength, path_strength


def classify(docs: DataFrame, labels: DataFrame, carry: list[str], sample: int = 20_000, keep_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """``carry`` columns of every document plus host, path, evidence, host_posterior,
    path_posterior, quality (posterior probability) and kept."""
    C.prepare(docs.sparkSession)
    model = fit_evidence(docs, labels, sample)
    host, path = site_columns(F.col("source").cast("string"), F.col("lang").cast("string"))
    sited = docs.withColumns({"__host": host, "__path": path})
    slim = C.checkpointed(score_evidence(sited, model, ["__host", "__path"]).withColumnsRenamed({"__host": "host", "__path": "path"}))
    sites, share, host_strength, path_strength = site_posteriors(slim, model.base_logit)
    scored = score_evidence(sited, model, [*carry, "__host", "__path"], text_col)
    known = C.join_small(scored.withColumn("__null", F.concat(F.col("__host").isNull().cast("string"), F.col("__path").isNull().cast("string")))
                         .withColumns({"__h": F.coalesce("__host", F.lit("")), "__p": F.coalesce("__path", F.lit(""))}),
                         sites.select(F.concat(F.col("host").isNull().cast("string"), F.col("path").isNull().cast("string")).alias("__null"),
                                      F.coalesce("host", F.lit("")).alias("__h"), F.coalesce("path", F.lit("")).alias("__p"),
                                      *[F.col(c).alias(f"__{c}") for c in ("host_n", "host_good", "path_n", "path_good")]),
                         ["__null", "__h", "__p"])
    own = 1 / (1 + F.exp(-(F.col("evidence") + model.base_logit)))
    at_host = (F.greatest(F.col("__host_good") - own, F.lit(0.0)) + host_strength * share) / (F.col("__host_n") - 1 + host_strength)
    at_path = (F.greatest(F.col("__path_good") - own, F.lit(0.0)) + path_strength * F.col("__host_post")) / (F.col("__path_n") - 1 + path_strength)
    clipped = F.least(F.greatest(F.col("__path_post"), F.lit(1e-6)), F.lit(1 - 1e-6))
    out = known.withColumn("__host_post", at_host).withColumn("__path_post", at_path)
    out = out.withColumn("__quality", 1 / (1 + F.exp(-(F.col("evidence") + F.log(clipped / (1 - clipped))))))
    return out.select(*carry, F.col("__host").alias("host"), F.col("__path").alias("path"), "evidence", F.col("__host_post").alias("host_posterior"),
                      F.col("__path_post").alias("path_posterior"), F.col("__quality").alias("quality"), (F.col("__quality") >= keep_at).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, same columns."""
    names = docs.columns
    fresh = [f"__c{i}" for i in range(len(names))]
    # own names, so that columns of the input cannot clash with those of the classifier
    wide = docs.withColumns({f: F.col(f"`{n}`") for f, n in zip(fresh, names)})
    out = classify(wide, labels, fresh, text_col=fresh[names.index("text")], **options).filter("kept")
    return out.select(*[F.col(f).alias(n) for f, n in zip(fresh, names)])
