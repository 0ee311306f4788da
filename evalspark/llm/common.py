"""Helpers shared by the operators: Arrow text buffers, word spans, word hashes.

Text is handled as UTF-8 bytes in Numpy. A word is ``[^\\x20\\x09-\\x0D]+``; the
separators are ASCII, so byte offsets of words never split a code point. Word
identity is a 64-bit hash built from prefix sums of ``R[byte] * BASE**i`` (one
gather, one product and one running sum per byte, no Python strings).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: Text bytes handled at once inside a task; bounds the Numpy work arrays.
CHUNK_BYTES = 1 << 19

WORD = r"[^\x20\x09-\x0D]+"

_U64 = np.uint64
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and package on the executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    prepare(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fmix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply) so that every bit depends on every bit."""
    h = h ^ (h >> _U64(33))
    h *= _U64(0xFF51AFD7ED558CCD)
    h ^= h >> _U64(33)
    h *= _U64(0xC4CEB9FE1A85EC53)
    h ^= h >> _U64(33)
    return h


class ByteHash:
    """Hashes of byte ranges from prefix sums; ``seed`` picks the random table. Ranges are
    hashed in stretches of ``size`` bytes, which bounds the tables of powers."""

    def __init__(self, seed: int = 1, lower: bool = False, size: int = 1 << 18):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
        if lower:
            self.table = self.table[ASCII_LOWER]
        base = int(rng.integers(2**61, 2**62)) * 4 + 1 | 4  # 5 mod 8: full period
        self._grow(base, size)

    def _grow(self, base: int, size: int) -> None:
        self.base = base
        inv = pow(base, -1, 2**64)
        self.power = np.ones(size + 1, dtype=np.uint64)
        self.inverse = np.ones(size + 1, dtype=np.uint64)
        np.multiply.accumulate(np.full(size, base, dtype=np.uint64), out=self.power[1:])
        np.multiply.accumulate(np.full(size, inv, dtype=np.uint64), out=self.inverse[1:])

    def ranges(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of buf[s:e] for every range; ranges are sorted and do not overlap."""
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            first = int(starts[i])
            j = int(np.searchsorted(ends, first + len(self.power) - 1, side="right"))
            if j <= i:  # one range is longer than the tables
                self._grow(self.base, int(ends[i]) - first)
                j = i + 1
            part = buf[first:int(ends[j - 1])]
            pre = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(self.table[part] * self.power[:len(part)], out=pre[1:])
            s, e = starts[i:j] - first, ends[i:j] - first
            out[i:j] = fmix((pre[e] - pre[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            i = j
        return out


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (length len(h) - width + 1),
    by doubling: H[2k](i) = H[k](i) * B^k + H[k](i + k)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    piece, size = h, 1
    out, done = None, 0
    while True:
        if width & size:
            if out is None:
                out, done = piece[:len(h) - size + 1].copy(), size
            else:
                m = len(h) - done - size + 1
                out = out[:m] * _U64(pow(base, size, 2**64)) + piece[done:done + m]
                done += size
        if size * 2 > width:
            break
        m = len(h) - 2 * size + 1
        piece = piece[:m] * _U64(pow(base, size, 2**64)) + piece[size:size + m]
        size *= 2
    return fmix(out[:n])


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string array (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    if len(arr) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with at most ``size`` text bytes each (one row at least):
    (rows, text bytes, offsets)."""
    arr = batch.column(batch.schema.get_field_index(column))
    buf, off = text_buffer(arr)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield batch.slice(i, j - i), buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words: word k is buf[starts[k]:ends[k]], and row r
    holds words first[r] .. first[r + 1] - 1. A row boundary always ends a word. ``space``
    flags the bytes that separate words (ASCII ones, so that no code point is split)."""
    n = len(buf)
    if n == 0:
        e = np.empty(0, dtype=np.int64)
        return e, e, np.zeros(len(off), dtype=np.int64)
    word = ~space[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[1:n] = word[1:] & ~word[:-1]
    edge[0] = word[0]
    bounds = off[(off < n)]
    edge[bounds] = word[bounds]
    starts = np.flatnonzero(edge[:n])
    stop = np.zeros(n + 1, dtype=bool)
    stop[1:n] = word[:-1] & ~word[1:]
    stop[n] = word[-1]
    inner = off[(off > 0)]
    stop[inner] = word[inner - 1]
    ends = np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, off)


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row number of every element when row r holds elements first[r]..first[r+1]-1."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """True at the positions where a window of ``width`` elements stays in its row."""
    n = int(first[-1])
    ok = np.ones(n, dtype=bool)
    for back in range(1, min(width, n + 1)):
        at = first[1:] - back
        ok[at[(at >= 0)]] = False  # the last width - 1 elements of a row start no window
    return ok


def set_apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with all columns under names of our own (old name -> new one), so that columns
    an operator adds or joins cannot clash with the input's, whatever these are called."""
    own = {n: f"__c{i}" for i, n in enumerate(df.columns)}
    return df.select(*[F.col(f"`{n}`").alias(o) for n, o in own.items()]), own


def put_back(df: DataFrame, own: dict[str, str]) -> DataFrame:
    """The input's columns under their old names; all others go."""
    return df.select(*[F.col(o).alias(n) for n, o in own.items()])


#: Rows up to which a small side is broadcast; callers join by shuffle beyond it.
BROADCAST_ROWS = 100_000


def join_small(df: DataFrame, small: DataFrame, on, how: str = "left", rows: int | None = None) -> DataFrame:
    """Join with a side that is usually small: broadcast only when its counted rows are at
    most BROADCAST_ROWS, else a shuffle join (whose skewed partitions AQE splits)."""
    n = small.count() if rows is None else rows
    return df.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)
