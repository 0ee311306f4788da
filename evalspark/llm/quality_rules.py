"""Quality rules by weak supervision (operator 3).

Every rule votes ``good``, ``bad`` or abstains on a document. Expectation-maximisation
estimates how often each rule accuses documents by mistake and how often it accuses each kind
of bad ones rightly; the posterior probability of ``good`` replaces the usual "all rules must
pass" filter. A rule that accuses at random loses its say, whatever the other rules do.

The votes of a document form one of 3**len(RULES) patterns, so the pattern counts of the
whole corpus are an exact and bounded statistic: one aggregation collects them, EM runs
on the counts, and the posteriors go back to the documents by a join on the pattern.

Defined cases: a null or empty text has no words, fails the base rules and is not kept;
every row gives one output row, repeated rows and null ids included; other columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

GOOD, ABSTAIN, BAD = 2, 1, 0

#: Rate of false accusations expected of a rule before the votes are seen, the weight of that
#: expectation in documents (at every size of the corpus), and the share of its own kind of bad
#: documents that a rule accuses, which defines the kind.
FALSE_ALARM, PRIOR_DOCS, OWN_ALARM = 0.002, 10.0, 0.95

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_EXCLAIM = np.zeros(256, dtype=bool)
_EXCLAIM[list(b"!?")] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


def _vote(bad, good) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN)).astype(np.int64)


#: name -> vote of every document from its features (arrays); thresholds are fixed values.
RULES = {
    "word_length": lambda f: _vote((f["word_chars"] > 12 * f["n_words"]) | (f["word_chars"] < 2 * f["n_words"]),
                                   (f["word_chars"] >= 3 * f["n_words"]) & (f["word_chars"] <= 9 * f["n_words"])),
    "symbols": lambda f: _vote(100 * f["n_symbols"] > 15 * f["n_words"], 100 * f["n_symbols"] <= f["n_words"]),
    "duplicate_lines": lambda f: _vote(100 * f["n_dup_lines"] > 30 * f["n_lines"], (f["n_dup_lines"] == 0) & (f["n_lines"] >= 3)),
    "repeated_words": lambda f: _vote(100 * f["n_repeat_words"] > 30 * f["n_words"], 100 * f["n_repeat_words"] < 10 * f["n_words"]),
    "capitals": lambda f: _vote(2 * f["n_upper"] > f["n_upper"] + f["n_lower"], 100 * f["n_upper"] < 15 * (f["n_upper"] + f["n_lower"])),
    "exclamations": lambda f: _vote(100 * f["n_exclaim"] > 20 * f["n_words"], 100 * f["n_exclaim"] <= 2 * f["n_words"]),
    "vocabulary": lambda f: _vote((f["n_words"] >= 50) & (100 * f["n_distinct"] < 15 * f["n_words"]), 100 * f["n_distinct"] > 35 * f["n_words"]),
    "sentences": lambda f: _vote((f["n_words"] >= 50) & (f["n_stops"] == 0), (100 * f["n_stops"] >= 2 * f["n_words"]) & (100 * f["n_stops"] <= 30 * f["n_words"])),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(buf: np.ndarray, off: np.ndarray, hasher: C.ByteHash) -> dict[str, np.ndarray]:
    """Counts of every row of a text buffer."""
    n = len(off) - 1
    starts, ends, first = C.word_spans(buf, off)
    h = hasher.ranges(buf, starts, ends)
    row = C.rows_of(first)
    salt = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    f = {"n_words": np.diff(first)}
    f["word_chars"] = _per_row(((buf & 0xC0) != 0x80) & ~C.IS_SPACE[buf], off)
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_lower", _LOWER), ("n_exclaim", _EXCLAIM)):
        f[name] = _per_row(table[buf], off)
    f["n_stops"] = _per_row(_STOP[buf[ends - 1]], first)
    _, at = np.unique(h + salt, return_index=True)
    f["n_distinct"] = np.bincount(row[at], minlength=n)

    line = np.union1d(off[:-1], np.flatnonzero(buf == 10) + 1)
    line = line[line < len(buf)]
    stop = np.append(line[1:], len(buf))
    stop = stop - (buf[stop - 1] == 10) if len(stop) else stop
    has = np.searchsorted(starts, line) < np.searchsorted(starts, stop)
    line, stop = line[has], stop[has]
    line_row = np.searchsorted(off, line, side="right") - 1
    key = hasher.ranges(buf, line, stop) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, at = np.unique(key, return_index=True)
    f["n_lines"] = np.bincount(line_row, minlength=n)
    f["n_dup_lines"] = f["n_lines"] - np.bincount(line_row[at], minlength=n)

    pos = np.flatnonzero(C.window_starts(first, 3))
    covered = np.zeros(len(h) + 3, dtype=bool)
    if len(pos):
        key = C.rolling(h, 3)[pos] + salt[pos]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        at = pos[count[inverse] > 1]
        covered[at] = covered[at + 1] = covered[at + 2] = True
    f["n_repeat_words"] = _per_row(covered[:len(h)], first)
    return f


def rule_votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts, base_failed and its vote pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = C.ByteHash(3)
        for batch in batches:
            for rows, buf, off in C.slices(batch, "text"):
                f = features(buf, off, hasher)
                pattern = sum(rule(f) * 3**k for k, rule in enumerate(RULES.values()))
                failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), *[pa.array(f[c], pa.int64()) for c in COUNTS], pa.array(failed), pa.array(pattern, pa.int32())],
                    names=[id_col, *COUNTS, "base_failed", "pattern"])

    schema = f"{id_col} long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, pattern int"
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _first_false_alarms(n: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Where EM starts: the rate of false accusations that the votes' dependence allows.

    A rule that errs at random accuses the documents that another rule accuses as often as those
    that no other rule accuses; one that finds a kind of its own accuses the documents of some
    other rule less often. So the start is the smallest of these rates, each with its standard
    error added. Rates of few documents lean on the rate among unaccused ones, and a corpus where
    other rules accuse few documents leans on ``FALSE_ALARM`` (``PRIOR_DOCS`` documents either way)."""
    rules = bad.shape[1]
    out = np.empty(rules)
    for j in range(rules):
        others = np.delete(bad, j, axis=1)
        accused = others.any(axis=1)
        free = n[~accused].sum()
        alone = (n[~accused] @ bad[~accused, j] + PRIOR_DOCS * FALSE_ALARM) / (free + PRIOR_DOCS)
        size, both = n @ others, (n * bad[:, j]) @ others
        among = (both + PRIOR_DOCS * alone) / (size + PRIOR_DOCS)
        least = min(alone, (among + np.sqrt(among * (1 - among) / (size + PRIOR_DOCS))).min(initial=1.0))
        known = n[accused].sum()
        out[j] = (known * least + PRIOR_DOCS * FALSE_ALARM) / (known + PRIOR_DOCS)
    return out


def _accusation_rates(false: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Bad-vote rate per class and rule: a mistake, or a right accusation, or both."""
    return 1 - (1 - false) * (1 - np.vstack([np.zeros(len(false)), hit]))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, n_rules: int = len(RULES), rounds: int = 200, tol: float = 1e-9) -> tuple[np.ndarray, dict]:
    """EM over vote patterns: (posterior of ``good`` per pattern, model).

    A document is good, or bad in one of ``n_rules`` ways (bad documents fail in different
    ways, so one class for all of them would fit none). Rule j accuses any document by mistake
    with rate ``false_alarm[j]``, and documents of class k rightly with rate ``detection[k - 1, j]``:
    it votes bad on them unless neither happens. Class k starts from the documents that rule
    k - 1 accuses, less the false ones among them (``_first_false_alarms``). Votes that are not
    bad are good or abstentions with a rate per class and rule (where a rule misses its own kind,
    the rate of the good class). A right accusation outside a rule's own kind has to show in more
    than a few documents (``PRIOR_DOCS`` without one are added); other priors weigh one or two
    documents, so the corpus decides."""
    votes = np.stack([(patterns // 3**k) % 3 for k in range(n_rules)], axis=1)
    n, bad, good = counts.astype(float), (votes == BAD).astype(float), (votes == GOOD).astype(float)
    own = np.eye(n_rules, dtype=bool)
    false = _first_false_alarms(n, bad)
    mistaken = np.minimum(1.0, false / np.maximum((n @ bad) / max(n.sum(), 1.0), false))  # share of a rule's accusations
    right = bad * (1 - mistaken)
    clean = np.prod(1 - right, axis=1, keepdims=True)  # every accusation is a mistake
    post = np.concatenate([clean, (1 - clean) * right / np.maximum(right.sum(axis=1, keepdims=True), 1e-300)], axis=1)
    hit = np.where(own, OWN_ALARM, 0.05)
    model: dict = {}
    for step in range(rounds):
        weight = n[:, None] * post
        size = weight.sum(axis=0)
        prior = (size + 1) / (n.sum() + 1 + n_rules)
        accused = weight.T @ bad  # class x rule
        rate = _accusation_rates(false, hit)
        if n.sum():
            false = np.maximum((accused * false / rate).sum(axis=0) / n.sum(), 1e-9)
        hit = np.where(own, OWN_ALARM, accused[1:] * hit / rate[1:] / (size[1:, None] + PRIOR_DOCS))
        rate = _accusation_rates(false, hit)
        counted, agreed = size[:, None] - accused, weight.T @ good  # votes that are not bad, good ones
        usual = (agreed[0] + 1) / (counted[0] + 2)
        share = np.vstack([usual, np.where(own, usual, (agreed[1:] + usual) / (counted[1:] + 1))])
        score = np.log(prior) + bad @ np.log(rate).T + (1 - bad) @ np.log(1 - rate).T
        score += good @ np.log(share).T + (1 - bad - good) @ np.log(1 - share).T
        new = np.exp(score - score.max(axis=1, keepdims=True)) if len(score) else score
        new /= new.sum(axis=1, keepdims=True)
        model = {"prior": prior, "false_alarm": false, "detection": hit, "good_share": share, "rounds": step + 1}
        moved = np.abs(new - post).max() if len(new) else 0.0
        post = new
        if moved < tol:
            break
    return post[:, 0], model


def rule_accuracies(model: dict) -> list[dict]:
    """What EM learned, per rule: how often it accuses by mistake, how often it accuses a bad
    document rightly, and how many of its accusations are right."""
    bad = model["prior"][1:]
    out = []
    for j, name in enumerate(RULES):
        false, hit = float(model["false_alarm"][j]), float(bad @ model["detection"][:, j])
        caught = hit / float(bad.sum()) if bad.sum() else 0.0
        out.append({"rule": name, "false_alarm": false, "detection": caught, "precision": hit / (hit + false * (1 - hit))})
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Counts, base_failed, posterior and verdict of every document.

    kept is false when base_failed, else posterior >= keep_at."""
    spark = docs.sparkSession
    C.prepare(spark)
    votes = C.checkpointed(rule_votes(docs, id_col, text_col))
    found = votes.groupBy("pattern").count().collect()  # at most 3 ** len(RULES) rows
    patterns = np.array([r["pattern"] for r in found], dtype=np.int64)
    counts = np.array([r["count"] for r in found], dtype=np.int64)
    post, _ = fit_label_model(patterns, counts)
    table = spark.createDataFrame([(int(p), float(x)) for p, x in zip(patterns, post)], "pattern int, posterior double")
    out = votes.join(F.broadcast(table), "pattern", "left")
    return out.select(id_col, *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("posterior") >= keep_at)).alias("kept"), "posterior")
