"""Language identification (operator 1).

Sparse multinomial logistic regression on TF-IDF character n-grams, trained with the
follow-the-regularised-leader rule (elastic-net penalties), then temperature calibration.

* Features: lower-cased letters with single spaces between words; n-grams of 1 to
  ``max_n`` characters, hashed into ``2**bits`` buckets. A document's vector is tf * idf,
  scaled to sum 1, so a score is a plain sum over n-gram occurrences and needs no
  per-document dictionary.
* Document frequencies come from all training documents (one aggregation of at most
  ``2**bits`` counts).
* The sample is bounded: at most ``per_language + calibration`` training documents of each
  language, picked by a hash. In every language, whatever its size, the same share of them
  (``calibration`` of ``per_language + calibration``, spread evenly) sets the temperature and
  the others fit the weights. Without any row to calibrate with (no language has five
  documents, at the default share) the temperature is 1.
* The model (``languages * 2**bits`` floats, fixed size per language) goes to the tasks
  with the function that applies it.

Texts longer than ``TEXT_CHUNK`` are read in pieces of that size whose n-grams join exactly, so
memory does not grow with a text.

Defined cases: null text or no letter gives ``und`` and score 0, as does a corpus without
any training language; null ids count as any other row; each input row gives one row;
other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SPACE = 32
TEXT_CHUNK = 1 << 19


@dataclass(frozen=True)
class LanguageConfig:
    """Fixed parameters; ``per_language`` and ``calibration`` bound the training sample."""

    bits: int = 16
    max_n: int = 4
    per_language: int = 800
    calibration: int = 200
    epochs: int = 3
    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01


def _letters_table() -> np.ndarray:
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    points = np.arange(0x110000)
    points = points[(points < 0xD800) | (points > 0xDFFF)]
    text = points.astype(np.uint32).tobytes().decode("utf-32-le")
    keep = np.fromiter((c.isalpha() for c in text), dtype=bool, count=len(text))
    table[points[keep]] = points[keep]
    return table


_LETTERS: list[np.ndarray] = []


def letters_table() -> np.ndarray:
    """Code point -> itself for letters, space for all else (built once per worker)."""
    if not _LETTERS:
        _LETTERS.append(_letters_table())
    return _LETTERS[0]


def ngram_buckets(texts: list[str], cfg: LanguageConfig) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For n = 1..max_n: (bucket of every n-gram, row bounds); and the letters per row."""
    low = [" " + t.lower() + " " for t in texts]
    size = np.array([len(t) for t in low], dtype=np.int64)
    code = np.frombuffer("".join(low).encode("utf-32-le", "replace"), dtype=np.uint32)
    code = letters_table()[code]
    bounds = np.concatenate([[0], np.cumsum(size)])
    space = code == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]  # one space after each run of letters
    keep[bounds[:-1]] = True  # and one in front of the text
    total = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(~space)])
    code, bounds = code[keep], total[bounds]
    n_letters = np.diff(letters[np.concatenate([[0], np.cumsum(size)])])
    grams, rows = [], []
    h = code.copy()
    for n in range(1, cfg.max_n + 1):
        if n > 1:
            h = h[:-1] * np.uint32(0x9E3779B1) + code[n - 1:]
        # the last n - 1 starts of a row reach into the next row: dropped through the bounds
        grams.append(_bucket(h, n, cfg))
        rows.append(np.stack([bounds[:-1], np.maximum(bounds[1:] - (n - 1), bounds[:-1])], axis=1))
    return grams, rows, n_letters


def long_text_buckets(text: str, cfg: LanguageConfig) -> Iterator[tuple[np.ndarray, int]]:
    """Pieces (n-gram buckets, letters) of one text, together those of ``ngram_buckets``."""
    tail = np.empty(0, dtype=np.uint32)  # the last max_n - 1 characters
    at = 0
    while at < len(text):
        end = min(len(text), at + TEXT_CHUNK)
        if end < len(text):  # lower-casing looks at a whole word, so cut behind a space if there is one
            end = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1 or end
        piece = text[at:end].lower()
        piece = (" " if at == 0 else "") + piece + (" " if end == len(text) else "")
        code = letters_table()[np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32)]
        space = code == SPACE
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[0] |= not len(tail) or tail[-1] != SPACE
        code = code[keep]
        grams = []
        for n in range(1, cfg.max_n + 1):
            seq = np.concatenate([tail[len(tail) - min(n - 1, len(tail)):], code])
            if len(seq) >= n:
                grams.append(_hashed(seq, n, cfg))
        tail = np.concatenate([tail, code])[-(cfg.max_n - 1):] if cfg.max_n > 1 else code[-1:]
        at = end
        yield np.concatenate(grams) if grams else np.empty(0, dtype=np.uint32), int((~space).sum())


def _hashed(code: np.ndarray, n: int, cfg: LanguageConfig) -> np.ndarray:
    """Bucket of every n-gram of a run of characters."""
    h = code[:len(code) - n + 1].copy()
    for k in range(1, n):
        h = h * np.uint32(0x9E3779B1) + code[k:len(code) - n + 1 + k]
    return _bucket(h, n, cfg)


def _bucket(h: np.ndarray, n: int, cfg: LanguageConfig) -> np.ndarray:
    mixed = (h + np.uint32(n)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0xC2B2AE35) >> np.uint32(7)) & np.uint32((1 << cfg.bits) - 1)


def text_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    i, size = 0, 0
    for j, t in enumerate(texts):
        if size and size + len(t) > TEXT_CHUNK:
            yield i, j
            i, size = j, 0
        size += len(t) + 2
    if i < len(texts):
        yield i, len(texts)


def _texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def document_frequencies(training: DataFrame, cfg: LanguageConfig) -> tuple[np.ndarray, int]:
    """Number of training documents that hold each bucket, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << cfg.bits
        df, seen, n = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool), 0
        for batch in batches:
            texts = _texts(batch.column(0))
            for i, j in text_slices(texts):
                if len(texts[i]) > TEXT_CHUNK:  # alone in its slice
                    for g, _ in long_text_buckets(texts[i], cfg):
                        seen[g] = True
                    df += seen
                    seen[:] = False
                    continue
                grams, rows, _ = ngram_buckets(texts[i:j], cfg)
                for r in range(j - i):
                    for g, b in zip(grams, rows):
                        seen[g[b[r, 0]:b[r, 1]]] = True
                    df += seen
                    seen[:] = False
            n += len(texts)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["bucket", "n"])

    counts = training.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(1 << cfg.bits, dtype=np.int64), 0
    for r in counts:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, n


def sparse_vector(text: str, idf: np.ndarray, cfg: LanguageConfig) -> tuple[np.ndarray, np.ndarray]:
    count = np.zeros(1 << cfg.bits, dtype=np.int64)
    for g, _ in long_text_buckets(text, cfg):
        count += np.bincount(g, minlength=1 << cfg.bits)
    idx = np.flatnonzero(count)
    tf = count[idx]
    x = tf * idf[idx]
    total = x.sum()
    return idx, (x / total if total > 0 else x)


@dataclass
class LanguageModel:
    """languages, weights [language, bucket], bias, idf and temperature."""

    languages: list[str]
    cfg: LanguageConfig
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    table: np.ndarray | None = field(default=None, repr=False)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores [row, language], letters per row)."""
        if self.table is None:  # bucket -> (idf, idf * weight per language)
            self.table = np.concatenate([self.idf[:, None], self.idf[:, None] * self.weights.T], axis=1).astype(np.float32)
        out, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        for i, j in text_slices(texts):
            if len(texts[i]) > TEXT_CHUNK:  # alone in its slice
                total = np.zeros(self.table.shape[1])
                for g, n in long_text_buckets(texts[i], self.cfg):
                    letters[i] += n
                    total += np.bincount(g, minlength=len(self.table)) @ self.table
                out[i] = total[1:] / max(total[0], 1e-12) + self.bias
                continue
            grams, rows, letters[i:j] = ngram_buckets(texts[i:j], self.cfg)
            total = np.zeros((j - i, self.table.shape[1]))
            for g, b in zip(grams, rows):
                picked = self.table[g]
                some = b[:, 1] > b[:, 0]
                if some.any():  # ends and starts alternate; every other sum is a row's own
                    cuts = np.minimum(b[some].ravel(), len(g))
                    padded = np.concatenate([picked, np.zeros((1, picked.shape[1]), dtype=np.float32)])
                    total[some] += np.add.reduceat(padded, cuts, axis=0, dtype=np.float64)[::2]
            out[i:j] = total[:, 1:] / np.maximum(total[:, :1], 1e-12) + self.bias
        return out, letters


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_ftrl(samples, n_languages: int, cfg: LanguageConfig) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net, one document at a time: (weights, bias).

    ``samples()`` starts a new pass of (indices, values, class); only the coordinates of
    the document are touched in each step. Bucket 2**bits is the bias (not penalised)."""
    size = (1 << cfg.bits) + 1
    z, n = np.zeros((n_languages, size)), np.zeros((n_languages, size))
    l1 = np.full(size, cfg.l1)
    l1[-1] = 0.0

    def weight(idx):
        zi, ni = z[:, idx], n[:, idx]
        w = -(zi - np.sign(zi) * l1[idx]) / ((cfg.beta + np.sqrt(ni)) / cfg.alpha + cfg.l2)
        return np.where(np.abs(zi) <= l1[idx], 0.0, w)

    for _ in range(cfg.epochs):
        for idx, x, y in samples():
            idx, x = np.append(idx, size - 1), np.append(x * 30.0, 0.1)
            w = weight(idx)
            p = softmax((w @ x)[None, :])[0]
            p[y] -= 1
            g = p[:, None] * x[None, :]
            sigma = (np.sqrt(n[:, idx] + g * g) - np.sqrt(n[:, idx])) / cfg.alpha
            z[:, idx] += g - sigma * w
            n[:, idx] += g * g
    w = weight(np.arange(size))
    return w[:, :-1] * 30.0, w[:, -1] * 0.1


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature with the least negative log-likelihood (golden-section search). Not below
    1/4: on a set without errors ever smaller ones would look better."""
    if len(y) == 0:
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(z / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean())

    a, b, r = np.log(0.25), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit_language_model(training: DataFrame, cfg: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """Model from rows (key, text, lang), lang not null. ``key`` orders the sample."""
    df, n = document_frequencies(training, cfg)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    wanted = cfg.per_language + cfg.calibration
    # a first cut by hash leaves some four times the wanted rows of each language, so that
    # the window below never gathers a language
    rows = {r["lang"]: r["count"] for r in training.groupBy("lang").count().collect()}  # one row a language
    rate = F.create_map(*[F.lit(x) for k, c in rows.items() for x in (k, min(1.0, 4.0 * wanted / c))])[F.col("lang")] if rows else F.lit(1.0)
    w = Window.partitionBy("lang").orderBy("h", "text")
    sample = (training.withColumn("h", F.xxhash64("key", "text"))
              .filter((F.pmod("h", F.lit(1 << 20)) / (1 << 20)) < rate)
              .filter(F.col("text").rlike(r"\p{L}"))
              .withColumn("rank", F.row_number().over(w))
              .filter(F.col("rank") <= wanted)
              .select("lang", "text", "rank", "h").orderBy("h", "lang", "rank"))
    sample = C.checkpointed(sample)  # bounded rows
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    at = {x: k for k, x in enumerate(languages)}
    if not languages:
        return LanguageModel([], cfg, idf, np.zeros((0, 1 << cfg.bits)), np.zeros(0))
    calibrates = (F.col("rank") * cfg.calibration) % wanted < cfg.calibration  # never the first row of a language

    def passes():
        for r in sample.filter(~calibrates).toLocalIterator():
            idx, x = sparse_vector(r["text"], idf, cfg)
            yield idx, x, at[r["lang"]]

    weights, bias = fit_ftrl(passes, len(languages), cfg)
    model = LanguageModel(languages, cfg, idf, weights.astype(np.float32), bias)
    held = sample.filter(calibrates)
    z, y = [], []
    for r in held.toLocalIterator():
        z.append(model.logits([r["text"]])[0][0])
        y.append(at[r["lang"]])
    model.temperature = fit_temperature(np.array(z), np.array(y)) if z else 1.0
    model.table = None
    return model


def predict_language(docs: DataFrame, model: LanguageModel, carry: list[str], text_col: str = "text") -> DataFrame:
    """``carry`` columns of every document plus lang_pred and score. Reads the text only."""
    fields = docs.select(*carry).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(batch.num_columns - 1))
            if model.languages:
                z, letters = model.logits(texts)
                p = softmax(z / model.temperature)
                best = p.argmax(axis=1)
                lang = [model.languages[b] if k else "und" for b, k in zip(best, letters)]
                score = np.where(letters > 0, p[np.arange(len(texts)), best], 0.0)
            else:
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"
    return docs.select(*carry, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """True where crc32 of the key's text is divisible by five (null key: as '')."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.crc32(F.lit(b""))) % 5 == 0
