"""Exact ranked lexical search with geometrically blocked posting lists (operator 12).

A document is a sparse vector of integer impacts, a query a sparse vector of integer term
weights, the score their inner product (a BM25 whose arithmetic is fixed in integers).

1. One pass over the texts gives the forward index: for each document its length and the
   counts of the terms that some query uses (checkpointed). The numbers of documents and terms
   come from one aggregate, document frequencies from another one with map-side combine.
2. A task cuts its documents into shards of bounded size (``CELLS``) and builds for each term a
   posting list, split into blocks: the list's documents are clustered by the similarity of their
   vectors (inner products after a random sign projection, nearest of evenly drawn centroids),
   and a cluster is cut into blocks of at most ``BLOCK``. A block stores the coordinatewise
   maximum of its documents' vectors.
3. A query visits the lists of its terms, rarest first. The inner product of the query and a
   summary bounds every document of the block. A block is skipped only if that bound lies below
   the query's threshold; all other blocks are scored exactly. A query is done with a shard as
   soon as the greatest impacts of its remaining lists cannot reach the threshold.
4. The threshold is the k-th best score so far. It starts from the k-th best score of a sample
   of the documents (every 64th by hash, searched the same way), which can only lie below the
   final one; so it changes the work, never the result. Equal scores are never skipped.
5. Each task keeps k documents a query; these short lists are merged in a tree.

Queries are broadcast in groups of about ``GROUP_PAIRS`` distinct (query, term) pairs; more
queries mean more passes, not more memory.

Defined cases: a null or term-free text is no document; a null or term-free query has no result;
every row is a document or query of its own, also with repeated ids; a null doc_id sorts first;
other columns are ignored; an empty table gives an empty result. A very long text is counted in
pieces. Term identity is a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Documents of a block.
BLOCK = 32
#: Documents times distinct terms of a shard, held as one matrix of 32-bit impacts.
CELLS = 1 << 23
#: Distinct (query, term) pairs that one pass handles.
GROUP_PAIRS = 1 << 20
SAMPLE = 64

_code = np.arange(256)
#: Bytes that no term holds: ASCII other than digits and letters.
NO_TERM = (_code < 128) & ~(((_code >= 48) & (_code <= 57)) | ((_code >= 65) & (_code <= 90)) | ((_code >= 97) & (_code <= 122)))


def _hasher() -> C.ByteHash:
    return C.ByteHash(seed=12, lower=True)


def term_hashes(terms: list[str]) -> np.ndarray:
    buf, off = C.text_buffer(pa.array(terms, pa.string()))
    return _hasher().ranges(buf, off[:-1], off[1:])


# --- forward index ---------------------------------------------------------------------------

def _pieces(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets); a single long row comes in pieces cut between terms."""
    if len(off) > 2 or len(buf) <= 2 * C.CHUNK_BYTES:
        yield 0, buf, off
        return
    at = 0
    while at < len(buf):
        end = min(at + C.CHUNK_BYTES, len(buf))
        while end < len(buf):  # go on to the next separator
            gap = np.flatnonzero(NO_TERM[buf[end:end + C.CHUNK_BYTES]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + C.CHUNK_BYTES, len(buf))
        yield 0, buf[at:end], np.array([0, end - at])
        at = end


def _count_terms(buf: np.ndarray, off: np.ndarray, vocabulary: np.ndarray, hasher: C.ByteHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each row (with repeats), and (row, vocabulary index, count) of those known."""
    total, codes = np.zeros(len(off) - 1, dtype=np.int64), []
    for row, part, bounds in _pieces(buf, off):
        starts, ends, first = C.word_spans(part, bounds, NO_TERM)
        total[row:row + len(bounds) - 1] += np.diff(first)
        if not len(vocabulary):
            continue
        h = hasher.ranges(part, starts, ends)
        at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        hit = vocabulary[at] == h
        codes.append((C.rows_of(first)[hit] + row) * len(vocabulary) + at[hit])
    code, count = np.unique(np.concatenate(codes) if codes else np.empty(0, dtype=np.int64), return_counts=True)
    return total, code // max(1, len(vocabulary)), code % max(1, len(vocabulary)), count


def forward_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), terms (indices into the sorted hashes), counts."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            for rows, buf, off in C.slices(batch, "text"):
                n, row, term, count = _count_terms(buf, off, vocabulary, hasher)
                bounds = pa.array(np.searchsorted(row, np.arange(len(n) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(count.astype(np.int64)))], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(index, "doc_id long, n long, terms array<int>, counts array<long>").filter("n > 0")


# --- blocked posting lists ---------------------------------------------------------------------

@dataclass
class Queries:
    """Weighted queries over a vocabulary: query q has the terms and weights first[q] ..."""

    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # occurrences in the query times the term's weight
    hashes: np.ndarray  # of the vocabulary
    term_weights: np.ndarray


class Shard:
    """Posting lists of a few thousand documents."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, queries: Queries):
        self.vocabulary, column = np.unique(terms, return_inverse=True)
        rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.impacts = np.zeros((len(bounds) - 1, len(self.vocabulary)), dtype=np.int32)
        self.impacts[rows, column] = impacts
        order = np.argsort(column, kind="stable")
        self.members, self.starts = rows[order], np.searchsorted(column[order], np.arange(len(self.vocabulary) + 1))
        self.greatest = self.impacts.max(axis=0, initial=0).astype(np.int64)
        # 64 random signs a term, from the bits of its hash
        bits = np.unpackbits(C.fmix(queries.hashes[self.vocabulary]).view(np.uint8).reshape(-1, 8), axis=1)
        weighted = self.impacts * queries.term_weights[self.vocabulary].astype(np.float32)
        self.sketch = weighted @ (bits.astype(np.float32) * 2 - 1)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)

    def blocks(self, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list of a term: documents in block order, block bounds, and the coordinatewise
        maxima of the blocks."""
        docs = self.members[self.starts[column]:self.starts[column + 1]]
        if len(docs) <= BLOCK:
            cuts = np.array([0])
        else:
            near = np.argmax(self.sketch[docs] @ self.sketch[docs[::BLOCK]].T, axis=1)
            order = np.lexsort((-self.impacts[docs, column], near))
            docs, near = docs[order], near[order]
            begin = np.r_[0, np.flatnonzero(np.diff(near)) + 1]
            place = np.arange(len(docs)) - np.repeat(begin, np.diff(np.r_[begin, len(docs)]))
            cuts = np.flatnonzero(place % BLOCK == 0)
        return docs, np.r_[cuts, len(docs)], np.maximum.reduceat(self.impacts[docs], cuts, axis=0)


class TopLists:
    """The k best documents of every query so far, and the thresholds these give."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, np.maximum(least, 1)
        self.scores = [np.empty(0, dtype=np.int64) for _ in range(n)]
        self.ids = [np.empty(0, dtype=np.int64) for _ in range(n)]
        self.nulls = [np.empty(0, dtype=bool) for _ in range(n)]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        good = scores >= self.least[q]
        if not good.any():
            return
        s = np.concatenate([self.scores[q], scores[good]])
        i, z = np.concatenate([self.ids[q], ids[good]]), np.concatenate([self.nulls[q], nulls[good]])
        best = np.lexsort((i, ~z, -s))[:self.k]
        self.scores[q], self.ids[q], self.nulls[q] = s[best], i[best], z[best]
        if len(best) == self.k:
            self.least[q] = max(self.least[q], s[best[-1]])


def search_shard(shard: Shard, ids: np.ndarray, nulls: np.ndarray, queries: Queries, top: TopLists) -> dict[str, int]:
    """Bring the documents of a shard into the top lists; returns how many blocks were met and
    skipped."""
    work = {"blocks": 0, "skipped": 0, "scored": 0}
    if not len(shard.vocabulary):
        return work
    at = np.minimum(np.searchsorted(shard.vocabulary, queries.terms), len(shard.vocabulary) - 1)
    known = (shard.vocabulary[at] == queries.terms) & (queries.weights > 0)
    owner = np.repeat(np.arange(len(queries.first) - 1), np.diff(queries.first))[known]
    column, weight = at[known], queries.weights[known]
    # Lists are met in one order by all queries, rarest term first, so that one list's blocks are held at a time.
    rare = queries.term_weights[shard.vocabulary]
    order = np.lexsort((column, -rare[column], owner))
    owner, column, weight = owner[order], column[order], weight[order]
    first = np.searchsorted(owner, np.arange(len(queries.first)))
    reach = weight * shard.greatest[column]  # the most that a list adds to a score
    total = np.r_[0, np.cumsum(reach)]
    rest = total[first[owner + 1]] - total[:-1]  # this list and those after it
    seen: dict[int, np.ndarray] = {}
    by_list = np.lexsort((owner, column, -rare[column]))
    edge = np.r_[0, np.flatnonzero(np.diff(column[by_list])) + 1, len(by_list)] if len(by_list) else np.array([0])
    for a, b in zip(edge[:-1], edge[1:]):
        visits = by_list[a:b]
        visits = visits[rest[visits] >= top.least[owner[visits]]]
        if not len(visits):
            continue
        docs, cuts, summary = shard.blocks(int(column[visits[0]]))
        block_of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        for v in visits:
            q = int(owner[v])
            mine = slice(int(first[q]), int(first[q + 1]))
            cols, w = column[mine], weight[mine]
            bound = summary[:, cols].astype(np.int64) @ w
            alive = bound >= top.least[q]
            work["blocks"] += len(alive)
            work["skipped"] += len(alive) - int(alive.sum())
            if not alive.any():
                continue
            if q not in seen:
                seen[q] = np.zeros(len(ids), dtype=bool)
            chosen = docs[alive[block_of]]
            chosen = chosen[~seen[q][chosen]]
            if not len(chosen):
                continue
            seen[q][chosen] = True
            work["scored"] += len(chosen)
            top.add(q, shard.impacts[np.ix_(chosen, cols)].astype(np.int64) @ w, ids[chosen], nulls[chosen])
    return work


def _shards(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, nulls, bounds, terms, impacts) of consecutive documents whose matrix is bounded."""
    def joined(parts: list[tuple]) -> tuple:
        ids, nulls, sizes, terms, impacts = (np.concatenate(x) for x in zip(*parts))
        return ids, nulls, np.r_[0, np.cumsum(sizes)], terms, impacts

    held, docs, entries = [], 0, 0
    for batch in batches:
        doc = batch.column("doc_id")
        nulls = np.asarray(doc.is_null())
        ids = doc.fill_null(0).to_numpy(zero_copy_only=False)
        lists, weights = batch.column("terms"), batch.column("impacts")
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        base = int(bounds[0])
        bounds = bounds - base
        terms = np.asarray(lists.values)[base:base + int(bounds[-1])]
        start = int(weights.offsets[0].as_py())
        impacts = np.asarray(weights.values)[start:start + int(bounds[-1])]
        i = 0
        while i < len(ids):
            # the longest run whose documents times terms stay in CELLS (one document at least)
            count = np.arange(docs + 1, docs + len(ids) - i + 1)
            cells = count * np.minimum(n_terms, entries + bounds[i + 1:] - bounds[i])
            j = i + int(np.searchsorted(cells, CELLS, side="right"))
            if j == i and not held:
                j = i + 1
            if j > i:
                held.append((ids[i:j], nulls[i:j], np.diff(bounds[i:j + 1]), terms[bounds[i]:bounds[j]], impacts[bounds[i]:bounds[j]]))
                docs, entries = docs + j - i, entries + int(bounds[j] - bounds[i])
            if j < len(ids):
                yield joined(held)
                held, docs, entries = [], 0, 0
            i = j
    if held:
        yield joined(held)


def _search(index: DataFrame, queries: Queries, least: np.ndarray, k: int) -> DataFrame:
    """The k best documents of each query in each partition of the index (doc_id, terms, impacts)."""
    n, n_terms = len(queries.first) - 1, len(queries.hashes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = TopLists(n, k, least.copy())
        for ids, nulls, bounds, terms, impacts in _shards(batches, n_terms):
            search_shard(Shard(bounds, terms, impacts, queries), ids, nulls, queries, top)
        sizes = [len(s) for s in top.scores]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(n), sizes)), pa.array(np.concatenate(top.ids), mask=np.concatenate(top.nulls)), pa.array(np.concatenate(top.scores))],
                names=["q", "doc_id", "score"])

    return index.mapInArrow(search, "q long, doc_id long, score long")


def _merge(lists: DataFrame, parts: int, k: int, fan: int = 32) -> DataFrame:
    """Merge the short lists of all tasks, ``fan`` at a time: q, rank, doc_id, score."""
    lists = lists.withColumn("node", F.spark_partition_id())
    while True:
        parts = -(-parts // fan)
        lists = lists.withColumn("node", F.floor(F.col("node") / fan))
        w = Window.partitionBy("q", "node").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        lists = lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        if parts <= 1:
            return lists.select("q", "rank", "doc_id", "score")
        lists = lists.drop("rank")


def _term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents of every item."""
    spark = docs.sparkSession
    C.prepare(spark)
    items = C.checkpointed(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id()))
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TERM), 0)
    pairs = C.checkpointed(items.select("item", F.explode(words).alias("term")).groupBy("item", "term").count())
    groups = max(1, -(-pairs.count() // group_pairs))
    out = None
    for g in range(groups):
        found = _rank_group(docs, pairs.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g), k)
        out = found if out is None else out.unionByName(found)
    return out.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _rank_group(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """item, rank, doc_id, score for the items of ``pairs`` (item, term, count), which are few."""
    spark = docs.sparkSession
    rows = sorted((r["item"], r["term"], r["count"]) for r in pairs.collect())
    names = sorted({term for _, term, _ in rows})
    hashes = term_hashes(names)
    order = np.argsort(hashes)
    number = {names[i]: j for j, i in enumerate(order)}
    hashes = hashes[order]
    keys = sorted({item for item, _, _ in rows})
    first = np.r_[np.searchsorted(np.array([r[0] for r in rows], dtype=np.int64), np.array(keys, dtype=np.int64)), len(rows)]

    index = C.checkpointed(forward_index(docs, hashes))
    size = index.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(names), dtype=np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = _term_weights(df, size["docs"])
    terms = np.array([number[t] for _, t, _ in rows], dtype=np.int64)
    queries = Queries(first, terms, np.array([c for _, _, c in rows], dtype=np.int64) * weights[terms], hashes, weights)

    n_docs, n_terms = F.lit(size["docs"]).cast("decimal(20,0)"), F.lit(max(1, size["terms"])).cast("decimal(20,0)")
    index = index.withColumn("n_docs", n_docs).withColumn("n_terms", n_terms)
    index = index.withColumn("m", F.expr("25 + (75 * cast(n AS decimal(12,0)) * n_docs) div n_terms"))
    index = index.select("doc_id", "terms", F.expr("transform(counts, c -> (1000000000 * c) div (1000 * c + 8 * m))").alias("impacts"))
    parts = index.rdd.getNumPartitions()
    nothing = np.zeros(len(keys), dtype=np.int64)
    sample = _merge(_search(index.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0), queries, nothing, k), parts, k)
    least = nothing.copy()
    for r in sample.filter(F.col("rank") == k).collect():
        least[r["q"]] = r["score"]
    found = _merge(_search(index, queries, least, k), parts, k)
    names_of = spark.createDataFrame(list(enumerate(keys)), "q long, item long")
    return found.join(names_of, "q").select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
