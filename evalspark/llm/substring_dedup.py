"""Exact substring deduplication by fixed-block anchors (operator 7).

A window is ``width`` consecutive words of a document. A word is removed if a window covers it
whose word sequence also starts in a document with a smaller doc_id.

Documents are dealt into buckets of some megabytes of text, which is shuffled once; each step
works on a bucket at a time and exchanges hashes with hash ranges, in packed rows (one row per
bucket and range). A range answers with one bit per hash, in the order sent, so answers are tiny,
copies are pre-aggregated in their bucket, and a passage with m copies costs m hashes at most.

1. *Anchors.* Blocks of ``width // 2`` words at fixed, non-overlapping positions of every document
   are the index; every rolling window of that length probes it. A bucket sends its distinct
   hashes and marks the anchors. A range answers which hashes are an anchor somewhere and occur in
   several documents. Any repeated window holds a whole block of its other copy, so these hits mark
   all places that can repeat.
2. *Extension.* The windows around the hits are compared whole: a bucket sends the 96-bit hash and
   the smallest doc_id of each distinct one, the range answers where another bucket's document is
   smaller. Consecutive windows extend a repeat to its full length.
3. *Removal.* Covered words go; the others are joined by one space.

Defined cases: null and empty texts have no words; a null doc_id neither removes nor loses words;
documents with the same doc_id do not remove from one another; repeated rows each give a row;
other columns are ignored; an empty table gives an empty result. Word identity is a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Text bytes of a bucket, and text bytes whose hashes make up one range.
BUCKET_BYTES = 4 << 20
RANGE_BYTES = 12 << 20


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values[bounds[i]:bounds[i + 1]] as binary values."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _bits(flags: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """flags[bounds[i]:bounds[i + 1]] as packed bits."""
    return pa.array([np.packbits(flags[i:j]).tobytes() for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())


def _unpack(blobs: list[bytes], sizes: np.ndarray) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=int(n)) for x, n in zip(blobs, sizes)]
    return (np.concatenate(parts) if parts else np.empty(0, dtype=np.uint8)).astype(bool)


def _range_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Range of a hash; rises with the hash, so sorted hashes lie range by range."""
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _slices(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranges that occur, bounds of their slices) of sorted hashes."""
    part = _range_of(h, parts)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, dtype=np.int64)
    return part[first], np.append(first, len(h))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal tuples."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class _Bucket:
    """Words, anchors and windows of one bucket of documents."""

    def __init__(self, table: pa.Table, width: int):
        self.table, self.width, self.block = table, width, width // 2
        self.buf, self.off = C.text_buffer(table.column("text"))
        self.starts, self.ends, self.first = C.word_spans(self.buf, self.off)
        ids = table.column("doc_id")
        self.known = np.asarray(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy()
        self.row = C.rows_of(self.first)

    def probes(self) -> None:
        """Rolling hashes ``h`` at words ``at``; distinct ones ``u``, and which is which."""
        self.words = C.ByteHash(7).ranges(self.buf, self.starts, self.ends)
        at = np.flatnonzero(C.window_starts(self.first, self.block))
        self.at = at[self.known[self.row[at]]]
        h = C.rolling(self.words, self.block)[self.at] if len(self.at) else np.empty(0, dtype=np.uint64)
        self.order = np.argsort(h, kind="stable")
        sorted_h = h[self.order]
        self.begin = _runs(sorted_h)
        self.u = sorted_h[self.begin]

    def probe_rows(self, bucket: int, parts: int) -> pa.Table:
        self.probes()
        at, doc = self.at[self.order], self.ids[self.row[self.at[self.order]]]
        anchor = (at - self.first[self.row[at]]) % self.block == 0
        if len(self.u):
            several = np.minimum.reduceat(doc, self.begin) != np.maximum.reduceat(doc, self.begin)
            anchor = np.logical_or.reduceat(anchor, self.begin)
        else:
            several = anchor
        part, bounds = _slices(self.u, parts)
        rest = (self.u & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table([pa.array(np.full(len(part), bucket)), pa.array(part), _binary(rest, bounds), _bits(anchor, bounds), _bits(several, bounds)],
                        names=["bucket", "part", "rest", "anchor", "several"])

    def windows(self, answers: pa.Table | None, parts: int) -> None:
        """Windows that hold a hit: words ``start``, distinct hashes ``w1, w2`` with the
        smallest document ``least``, and which is which."""
        self.probes()
        hit = _answered(answers, 1, self.u, parts)
        of = np.zeros(len(self.at), dtype=bool)  # hits in the order of the sorted hashes
        if hit.any():
            of = hit[np.cumsum(np.bincount(self.begin, minlength=len(self.at))) - 1]
        found = self.at[self.order[of]]
        change = np.zeros(len(self.words) + 1, dtype=np.int64)
        # a window that holds a found block whole starts up to width - block words before it
        np.add.at(change, np.maximum(found - (self.width - self.block), self.first[self.row[found]]), 1)
        np.add.at(change, found + 1, -1)
        start = np.flatnonzero((np.cumsum(change[:-1]) > 0) & C.window_starts(self.first, self.width))
        if len(start):
            h1 = C.rolling(self.words, self.width)[start]
            h2 = (C.rolling(C.ByteHash(8).ranges(self.buf, self.starts, self.ends), self.width)[start] >> np.uint64(32)).astype(np.uint32)
        else:
            h1, h2 = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint32)
        doc = self.ids[self.row[start]]
        order = np.lexsort((h2, h1))
        self.start, self.doc = start[order], doc[order]
        h1, h2 = h1[order], h2[order]
        begin = _runs(h1, h2)
        self.w1, self.w2 = h1[begin], h2[begin]
        self.least = np.minimum.reduceat(self.doc, begin) if len(begin) else self.doc
        self.which = np.cumsum(np.bincount(begin, minlength=len(h1))) - 1 if len(begin) else begin

    def window_rows(self, bucket: int, answers: pa.Table | None, parts: int) -> pa.Table:
        self.windows(answers, parts)
        part, bounds = _slices(self.w1, parts)
        low = (self.least & 0xFFFFFFFF).astype(np.uint32)
        high = (self.least >> 32).astype(np.int32)
        return pa.table([pa.array(np.full(len(part), bucket)), pa.array(part), _binary(self.w1, bounds), _binary(self.w2, bounds), _binary(low, bounds), _binary(high, bounds)],
                        names=["bucket", "part", "w1", "w2", "low", "high"])

    def kept(self, answers: pa.Table | None, parts: int) -> pa.Table:
        self.windows(answers, parts)
        elsewhere = _answered(answers, 2, self.w1, parts)
        gone = self.start[elsewhere[self.which] | (self.doc > self.least[self.which])] if len(self.start) else self.start
        change = np.zeros(len(self.starts) + 1, dtype=np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + self.width, -1)
        keep = np.cumsum(change[:-1]) == 0
        row = self.row[keep]
        n_words = np.diff(self.first)
        n_removed = n_words - np.bincount(row, minlength=len(n_words))
        text = _joined_words(self.buf, self.starts[keep], self.ends[keep], row, len(n_words))
        return pa.table([self.table.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), text], names=["doc_id", "n_words", "n_removed", "text"])


def _answered(answers: pa.Table | None, step: int, hashes: np.ndarray, parts: int) -> np.ndarray:
    """The ranges' answers to sorted hashes; a range without a row answers no."""
    out = np.zeros(len(hashes), dtype=bool)
    part, bounds = _slices(hashes, parts)
    if answers is None or answers.num_rows == 0 or len(part) == 0:
        return out
    where = {int(p): k for k, p in enumerate(part)}
    for s, p, bits in zip(answers.column("step").to_pylist(), answers.column("part").to_pylist(), answers.column("bits").to_pylist()):
        if s == step:
            i, j = bounds[where[p]], bounds[where[p] + 1]
            out[i:j] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=j - i)
    return out


def _flat(table: pa.Table, name: str, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)


def _answers(table: pa.Table, step: int, yes: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """One row of bits for each row received that has a yes."""
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    some = np.array([yes[i:j].any() for i, j in zip(bounds[:-1], bounds[1:])], dtype=bool)
    rows = pa.table([table.column("bucket"), pa.array(np.full(table.num_rows, step, dtype=np.int32)), table.column("part"), _bits(yes, bounds)], names=["bucket", "step", "part", "bits"])
    return rows.filter(pa.array(some))


def _match_anchors(table: pa.Table) -> pa.Table:
    """Hashes of a range that are an anchor and occur in several documents."""
    sizes = np.array([len(x) // 4 for x in table.column("rest").to_pylist()], dtype=np.int64)
    rest = _flat(table, "rest", np.uint32)
    anchor = _unpack(table.column("anchor").to_pylist(), sizes)
    several = _unpack(table.column("several").to_pylist(), sizes)
    order = np.argsort(rest, kind="stable")
    begin = _runs(rest[order])
    yes = np.zeros(len(rest), dtype=bool)
    if len(begin):
        count = np.diff(np.append(begin, len(rest)))
        good = np.logical_or.reduceat(anchor[order], begin) & ((count > 1) | np.logical_or.reduceat(several[order], begin))
        yes[order] = np.repeat(good, count)
    return _answers(table, 1, yes, sizes)


def _match_windows(table: pa.Table) -> pa.Table:
    """Windows of a range whose smallest document is in another bucket."""
    sizes = np.array([len(x) // 8 for x in table.column("w1").to_pylist()], dtype=np.int64)
    w1, w2 = _flat(table, "w1", np.uint64), _flat(table, "w2", np.uint32)
    doc = (_flat(table, "high", np.int32).astype(np.int64) << 32) | _flat(table, "low", np.uint32).astype(np.int64)
    order = np.lexsort((w2, w1))
    begin = _runs(w1[order], w2[order])
    yes = np.zeros(len(w1), dtype=bool)
    if len(begin):
        least = np.minimum.reduceat(doc[order], begin)
        yes[order] = np.repeat(least, np.diff(np.append(begin, len(w1)))) < doc[order]
    return _answers(table, 2, yes, sizes)


def _joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, n_rows: int) -> pa.Array:
    """Words of every row joined by one space."""
    size = ends - starts
    last = np.concatenate([row[1:] != row[:-1], [True]]) if len(row) else np.empty(0, dtype=bool)
    room = size + ~last  # a space after every word but a row's last
    upto = np.cumsum(room)
    total = int(upto[-1]) if len(upto) else 0
    take = np.arange(total) + np.repeat(starts - (upto - room), room)
    out = buf[np.minimum(take, len(buf) - 1)] if total else np.empty(0, dtype=np.uint8)
    out[(upto - 1)[~last]] = 32
    per_row = np.bincount(row, weights=room, minlength=n_rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(per_row)])
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out))).cast(pa.string())


def dedup_substrings(docs: DataFrame, width: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and text (kept words joined by one space) of every document."""
    C.prepare(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = max(1, -(-size // RANGE_BYTES)), max(1, -(-size // BUCKET_BYTES))
    # every step groups the same rows by the same key, so Spark shuffles the texts once
    d = d.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))
    probe_type = "bucket long, part long, rest binary, anchor binary, several binary"
    window_type = "bucket long, part long, w1 binary, w2 binary, low binary, high binary"
    answer_type = "bucket long, step int, part long, bits binary"

    def probe(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _Bucket(table, width).probe_rows(key[0].as_py(), parts)

    def extend(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        return _Bucket(table, width).window_rows(key[0].as_py(), answers, parts)

    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        return _Bucket(table, width).kept(answers, parts)

    probes = d.groupBy("bucket").applyInArrow(probe, probe_type)
    hits = probes.groupBy("part").applyInArrow(_match_anchors, answer_type)
    windows = d.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(extend, window_type)
    owned = windows.groupBy("part").applyInArrow(_match_windows, answer_type)
    answers = hits.union(owned)
    return d.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, text string")
