"""Sequence packing by Karmarkar-Karp multiway differencing (operator 4).

Documents become token ids (end id appended) and are cut at multiples of the capacity; a
full piece is a sequence of its own. The tails, cut again into parts of at most ``part``
ids, are dealt into groups of about ``windows`` sequences. In each group the differencing
method merges partial partitions with opposing imbalances (the largest sums of one meet the
smallest of the other) until one partition into near-equal windows is left; while a window
exceeds the capacity, the window count rises and the group is solved again.

Groups are dealt by a hash of the piece's number in a checkpointed table, never by a column
value, so repeated or missing ids cannot fill one group; a group holds a bounded number of
ids and of pieces.

The tokenizer (a ``tokenizers`` JSON file, its path is a parameter) reaches the tasks by a
broadcast of the file, which has a fixed size. Words recur, so a chunk of text is cut into
units at places where the tokenizer always cuts too (ASCII white space; between ASCII
letters, digits and punctuation), each distinct unit is encoded once, and a document's ids
are joined from them. Words with ``<`` (special tokens), an apostrophe (contractions) or
code points beyond ASCII stay whole.

Defined cases: null and empty texts are documents of one id (the end id); null and repeated
doc_ids are documents like any other; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from . import common as C

CAPACITY = 4096
END_ID = 2

#: Window numbers of one group lie below this (a group has some hundreds).
MAX_WINDOWS = 1 << 24

#: Byte classes: 0 other (not ASCII), 1 letter, 2 digit, 3 punctuation.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(33, 127)]] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(48, 58)]] = 2


class UnitEncoder:
    """Token ids of whole texts through a bounded table of encoded units.

    The table is direct-mapped by the unit's 64-bit hash: a new unit replaces the one in its
    place, so memory stays fixed whatever the vocabulary of the corpus."""

    SLOTS = 1 << 20
    MAX_IDS = 1 << 22
    AT_ONCE = 4096

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocab = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.hasher = C.ByteHash(4)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, dtype=np.uint64)
        self.begin = np.zeros(self.SLOTS, dtype=np.int32)
        self.size = np.zeros(self.SLOTS, dtype=np.int32)  # 0: empty slot
        self.store, self.used = np.empty(1 << 16, dtype=np.uint32), 0

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per unit). Units that are one pre-token are encoded as one text, where
        the ends of pre-tokens tell them apart; the others one by one."""
        plain = np.array([u.isalpha() or (len(u) == 1 and u.isascii()) or (u.isascii() and not any(map(str.isalnum, u)) and "<" not in u and "'" not in u) for u in units], dtype=bool)
        together = [u for u, p in zip(units, plain) if p]
        ids = np.array(self.tokenizer.encode(" ".join(together), add_special_tokens=False).ids if together else [], dtype=np.int64)
        ends = np.flatnonzero(self.is_end[ids])
        if len(ends) != len(together):
            plain[:], ids, ends = False, ids[:0], ends[:0]
        sizes = np.zeros(len(units), dtype=np.int64)
        sizes[plain] = np.diff(np.concatenate([[-1], ends]))
        rest = self.tokenizer.encode_batch_fast([u for u, p in zip(units, plain) if not p], add_special_tokens=False)
        sizes[~plain] = [len(e.ids) for e in rest]
        out = np.empty(int(sizes.sum()), dtype=np.uint32)
        of = np.repeat(plain, sizes)
        out[of] = ids
        out[~of] = [i for e in rest for i in e.ids]
        return out, sizes

    def units(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the words without white space, start of every unit in them, row of every unit."""
        starts, ends, first = C.word_spans(buf, off)
        size = ends - starts
        data = buf[~C.IS_SPACE[buf]]
        begin = np.cumsum(size) - size
        cut = np.zeros(len(data), dtype=bool)
        if len(data):
            kind = _KIND[data]
            np.not_equal(kind[1:], kind[:-1], out=cut[1:])
            cut |= kind == 2
            # words with '<' (special tokens), apostrophes (contractions) or other code points stay whole
            odd = np.flatnonzero((kind == 0) | (data == 60) | (data == 39))
            whole = np.unique(np.searchsorted(begin, odd, side="right") - 1)
            lengths = size[whole]
            inside = np.arange(int(lengths.sum())) + np.repeat(begin[whole] - (np.cumsum(lengths) - lengths), lengths)
            cut[inside] = False
            original = data[inside]
            data = C.ASCII_LOWER[data]
            data[inside] = original
            cut[begin] = True
        at = np.flatnonzero(cut)
        bounds = np.append(begin, len(data))[first]
        return data, at, np.searchsorted(bounds[1:], at, side="right")

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, number of ids per row), without end ids."""
        data, at, row = self.units(buf, off)
        if len(at) == 0:
            return np.empty(0, dtype=np.uint32), np.zeros(len(off) - 1, dtype=np.int64)
        stop = np.append(at[1:], len(data))
        h = self.hasher.ranges(data, at, stop)
        if self.used > self.MAX_IDS:
            self._clear()
        slot = (h >> np.uint64(44)).astype(np.int64)
        begin, size = self.begin[slot].astype(np.int64), self.size[slot].astype(np.int64)
        miss = np.flatnonzero((self.keys[slot] != h) | (size == 0))
        if len(miss):
            fresh, pick, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            raw = data.tobytes()
            lo, hi = at[miss[pick]].tolist(), stop[miss[pick]].tolist()
            names = [raw[a:b].decode() for a, b in zip(lo, hi)]
            done = [self._encode(names[i:i + self.AT_ONCE]) for i in range(0, len(names), self.AT_ONCE)]
            ids, sizes = (np.concatenate(x) for x in zip(*done))
            while self.used + len(ids) > len(self.store):
                self.store = np.concatenate([self.store, np.empty_like(self.store)])
            self.store[self.used:self.used + len(ids)] = ids
            begins = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
            begin[miss], size[miss] = begins[inverse], sizes[inverse]
            place = (fresh >> np.uint64(44)).astype(np.int64)
            self.keys[place], self.begin[place], self.size[place] = fresh, begins, sizes
            # two new units in one slot: the assignments above keep the last of each column
        ends = np.cumsum(size)
        ids = self.store[np.arange(int(ends[-1])) + np.repeat(begin - (ends - size), size)]
        return ids, np.bincount(row, weights=size, minlength=len(off) - 1).astype(np.int64)


_ENCODERS: dict[int, UnitEncoder] = {}


def _encoder(tokenizer_json: str) -> UnitEncoder:
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(tokenizer_json)
    return _ENCODERS[key]


def cut_lengths(n: np.ndarray, capacity: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut rows of n ids into full pieces of ``capacity`` and tail parts of at most ``part``:
    (row, start, length) of the pieces, in order."""
    full, tail = n // capacity, n % capacity
    parts = -(-tail // part)
    count = full + parts
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    over = k - full[row]
    start = np.where(over < 0, k * capacity, full[row] * capacity + over * part)
    end = np.where(over < 0, start + capacity, np.minimum(start + part, n[row]))
    return row, start, end - start


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, part: int = 1024, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: id, start, length, doc_tokens, ids (little-endian uint32)."""
    spark = docs.sparkSession
    C.prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # one file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(shared.value)
        for batch in batches:
            for rows, buf, off in C.slices(batch, "text"):
                ids, n = encode(buf, off)
                n = n + 1
                out = np.full(len(ids) + len(n), end_id, dtype="<u4")
                keep = np.ones(len(out), dtype=bool)
                keep[np.cumsum(n) - 1] = False
                out[keep] = ids
                row, start, length = cut_lengths(n, capacity, part)
                step = np.concatenate([[0], np.cumsum(length)])
                for i in range(0, len(row), 4096):
                    j = min(len(row), i + 4096)
                    blob = out[step[i]:step[j]]
                    offsets = ((step[i:j + 1] - step[i]) * 4).astype(np.int32)
                    column = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(blob))])
                    take = pa.array(row[i:j])
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(take), pa.array(start[i:j], pa.int64()), pa.array(length[i:j], pa.int64()), pa.array(n[row[i:j]], pa.int64()), column],
                        names=[id_col, "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"{id_col} long, start long, length long, doc_tokens long, ids binary")


# --- multiway differencing -----------------------------------------------------------------------

def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0..k-1) of every item by Karmarkar-Karp differencing into k subsets.

    A partial partition is k sums in falling order with, for each, the chain of its items.
    The two with the largest spread are merged, largest sum on smallest, until one is left."""
    n = len(sizes)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    left, right = np.full(2 * n * 2, -1, dtype=np.int64), np.full(2 * n * 2, -1, dtype=np.int64)
    next_node = n  # nodes below n are items, the others join two nodes
    heap = []
    for i in range(n):
        heap.append((-int(sizes[i]), i, None))
    heapq.heapify(heap)
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    made = n

    def pop():
        _, key, _ = heapq.heappop(heap)
        if key < n:
            sums, nodes = np.zeros(k, dtype=np.int64), np.full(k, -1, dtype=np.int64)
            sums[0], nodes[0] = sizes[key], key
            return sums, nodes
        return parts.pop(key)

    while len(heap) > 1:
        a_sum, a_node = pop()
        b_sum, b_node = pop()
        sums = a_sum + b_sum[::-1]
        a, b = a_node, b_node[::-1]
        both = (a >= 0) & (b >= 0)
        nodes = np.where(a >= 0, a, b)
        m = int(both.sum())
        if m:
            fresh = np.arange(next_node, next_node + m)
            left[fresh], right[fresh] = a[both], b[both]
            nodes[both] = fresh
            next_node += m
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums = sums - sums[-1]
        parts[made] = (sums, nodes)
        heapq.heappush(heap, (-int(sums[0]), made, None))
        made += 1
    _, nodes = pop()
    window = np.empty(n, dtype=np.int64)
    todo = [(int(x), w) for w, x in enumerate(nodes) if x >= 0]
    while todo:
        x, w = todo.pop()
        if x < n:
            window[x] = w
        else:
            todo += [(int(left[x]), w), (int(right[x]), w)]
    return window


def pack_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of every item; the window count starts at the least possible and rises while
    a window exceeds the capacity."""
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        window = differencing(sizes, k)
        load = np.bincount(window, weights=sizes, minlength=k) if len(window) else np.zeros(k)
        if load.max() <= capacity:
            return window
        k += 1


def assign_windows(pieces: DataFrame, capacity: int = CAPACITY, windows: int = 128) -> DataFrame:
    """``pieces`` plus sequence_id and offset (gapless from 0 in each sequence).

    ``pieces`` needs doc_id, start and length <= capacity; other columns are carried."""
    kept = C.checkpointed(pieces)  # fixes the rows' order, which numbers them
    return place_pieces(kept.withColumn("piece_id", F.monotonically_increasing_id()), capacity, windows)


def place_pieces(numbered: DataFrame, capacity: int = CAPACITY, windows: int = 128) -> DataFrame:
    """As :func:`assign_windows`, for stored pieces that have a unique piece_id."""
    spark = numbered.sparkSession
    small = numbered.filter(F.col("length") < capacity)
    total = small.agg(F.sum("length").alias("ids"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, -(-(total["ids"] or 0) // (capacity * windows)), -(-total["n"] // (16 * windows)))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece_id")
        sizes = group["length"].to_numpy()
        window = pack_windows(sizes, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(sizes[order])
        w = window[order]
        first = np.concatenate([[True], w[1:] != w[:-1]])
        base = (ends - sizes[order])[first][np.cumsum(first) - 1]
        return pd.DataFrame({"piece_id": group["piece_id"].to_numpy()[order], "window": group["grp"].to_numpy()[order] * MAX_WINDOWS + w, "offset": ends - sizes[order] - base})

    per_task = max(1, min(groups, C.shuffle_partitions(spark)))
    solved = (small.select("piece_id", "length", F.pmod(F.xxhash64("piece_id"), F.lit(groups)).alias("grp"))
              .repartition(per_task, "grp").groupBy("grp").applyInPandas(solve, "piece_id long, window long, offset long"))
    out = numbered.join(solved, "piece_id", "left")
    # odd ids: windows of the groups; even ids: full pieces, numbered by piece
    return out.select(*[c for c in numbered.columns if c != "piece_id"], F.when(F.col("window").isNotNull(), F.col("window") * 2 + 1).otherwise(F.col("piece_id") * 2).alias("sequence_id"), F.coalesce("offset", F.lit(0).cast("long")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, part: int = 1024, windows: int = 128, end_id: int = END_ID) -> DataFrame:
    """Packed pieces with their ids: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    The pieces are written once, numbered, as Parquet: the windows are solved from two of its
    columns, and the ids are read again only to be returned."""
    path = shared_path(docs.sparkSession, "pieces")
    pieces = tokenize_pieces(docs, tokenizer_path, capacity, part, end_id)
    pieces.withColumn("piece_id", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return place_pieces(docs.sparkSession.read.parquet(path), capacity, windows)
