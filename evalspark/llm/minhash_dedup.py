"""Near-duplicate documents by MinHash, banding and connected components (operator 9).

Two documents are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct
word shingles. The steps:

1. One pass gives each document a digest of its set, ``bands * rows`` minima of universal
   (multiply-shift) hashes, one byte of each minimum as signature, and one key per band. The
   number of bands follows from ``percent``: a link of that similarity shares no band with a
   probability of at most ``MISS``.
2. Documents with equal sets form a class; its smallest doc_id stands for it from here on.
3. In each band bucket every member meets the bucket's *hub* (its smallest member): a bucket of
   m members gives m pairs. Pairs pass the size bound and a signature test five standard
   deviations below ``percent``, and are then confirmed on their full sets.
4. Components of the confirmed links by alternating large-star and small-star.
5. Buckets that still hold several components may hide links between members that are no
   hubs. Their members meet in tiles of about ``TILE`` by ``TILE``, each pair in one bucket only.
   First the signatures pick the members with a likely partner in another component; these
   bring their full sets to the same tiles, and a tile returns the confirmed links that join
   components, at most one a member. So links do not depend on the hubs, rows stay in
   proportion to the members, and copies that are linked already never meet pairwise.

Defined cases: a text without words (or null) has an empty set and is linked with nothing; fewer
words than ``words`` give one shingle, the whole sequence; rows with the same doc_id count as one
document; a null doc_id has no component (null) and is kept; other columns are ignored; an empty
table gives an empty result. Shingle identity is a 64-bit hash of the lower-cased (A-Z) words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import connected_components

ROWS = 5
MISS = 1e-7
TILE = 1024
#: Shingles of one side of a tile.
TILE_SHINGLES = 1 << 21


def n_bands(percent: int) -> int:
    p = (percent / 100) ** ROWS
    return 1 if p >= 1 else math.ceil(math.log(MISS) / math.log(1 - p))


def least_matches(percent: int) -> int:
    """Matching signature bytes below which a pair cannot be a link (five sigma)."""
    k, p = n_bands(percent) * ROWS, percent / 100
    return max(0, math.floor(k * p - 5 * math.sqrt(k * p * (1 - p))))


def shingle_sets(buf: np.ndarray, off: np.ndarray, hasher: C.ByteHash, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and the bounds of each row's set."""
    starts, ends, first = C.word_spans(buf, off)
    h = hasher.ranges(buf, starts, ends)
    at = np.flatnonzero(C.window_starts(first, words))
    row = C.rows_of(first)[at]
    value = C.rolling(h, words)[at] if len(at) else np.empty(0, dtype=np.uint64)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        whole = [C.fmix(C.rolling(h[first[r]:first[r + 1]], int(n[r])) + np.uint64(n[r] * 0x5851F42D)) for r in short]
        row, value = np.concatenate([row, short]), np.concatenate([value, *whole])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(off)))


def set_digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each (non-empty) set: sums of two mixed values of its members."""
    one = np.add.reduceat(C.fmix(values ^ np.uint64(0xA0761D6478BD642F)), starts)
    two = np.add.reduceat(C.fmix(values ^ np.uint64(0xE7037ED1A0B428DB)), starts)
    return one.view(np.int64), two.view(np.int64)


def minima(values: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """k minima [hash, set] of universal hashes (a * x + b) >> 32 with odd random a."""
    rng = np.random.default_rng(9)
    a = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, k, dtype=np.uint64)
    out = np.empty((k, len(starts)), dtype=np.uint64)
    v = np.empty_like(values)
    for i in range(k):
        np.multiply(values, a[i], out=v)
        v += b[i]
        out[i] = np.minimum.reduceat(v, starts)
    return out >> np.uint64(32)


def band_keys(low: np.ndarray) -> np.ndarray:
    """[set, band] keys from minima [hash, set]."""
    k, n = low.shape
    keys = np.empty((n, k // ROWS), dtype=np.int64)
    for band in range(k // ROWS):
        acc = np.full(n, band + 1, dtype=np.uint64)
        for r in range(band * ROWS, (band + 1) * ROWS):
            acc = C.fmix(acc * np.uint64(0x9E3779B97F4A7C15) + low[r])
        keys[:, band] = acc.view(np.int64)
    return keys


def document_signatures(docs: DataFrame, percent: int, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digests), sig (one byte per minimum), bands (a key each); the
    last four null for an empty set."""
    k = n_bands(percent) * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = C.ByteHash(5, lower=True)
        for batch in batches:
            for rows, buf, off in C.slices(batch, "text"):
                values, bounds = shingle_sets(buf, off, hasher, words)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                slot = np.full(len(size), -1)
                slot[full] = np.arange(len(full))
                take = pa.array(slot, mask=slot < 0)
                if len(full):
                    begin = bounds[full]
                    d1, d2 = set_digests(values, begin)
                    low = minima(values, begin, k)
                    sig = pa.array([x.tobytes() for x in (low.T & np.uint64(255)).astype(np.uint8)], pa.binary())
                    bands = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * (k // ROWS), pa.int32()), pa.array(band_keys(low).ravel()))
                    columns = [pa.array(d1), pa.array(d2), sig, bands]
                else:
                    columns = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size, pa.int64()), *[c.take(take) for c in columns]],
                                                 names=["doc_id", "n_shingles", "d1", "d2", "sig", "bands"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, sig binary, bands array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, d1 and the sorted set as bytes, for documents with a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = C.ByteHash(5, lower=True)
        for batch in batches:
            for rows, buf, off in C.slices(batch, "text"):
                values, bounds = shingle_sets(buf, off, hasher, words)
                full = np.flatnonzero(np.diff(bounds))
                if len(full) == 0:
                    continue
                d1, _ = set_digests(values, bounds[full])
                sets = pa.array([values[bounds[r]:bounds[r + 1]].tobytes() for r in full], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(full)), pa.array(d1), sets], names=["doc_id", "d1", "members"])

    return _texts(docs).mapInArrow(run, "doc_id long, d1 long, members binary")


def _signature_test(percent: int):
    need = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (4, 5))
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array((a == b).sum(axis=1) >= need))

    return run


def _set_test(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                keep.append(_linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _tiles(batches: Iterator[pa.RecordBatch], key: tuple[str, ...] = ("bucket", "lo", "hi")) -> Iterator[pa.Table]:
    """The tiles of rows sorted by tile; a tile may span batches."""
    rest = None
    for batch in _and_end(batches):
        if batch is not None:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
        if rest is None or rest.num_rows == 0:
            continue
        keys = np.stack([rest.column(c).to_numpy() for c in key], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), *([rest.num_rows] if batch is None else [])]
        for i, j in zip(bounds[:-1], bounds[1:]):
            yield rest.slice(i, j - i)
        rest = rest.slice(bounds[-1])


def _likely_pairs(tile: pa.Table, percent: int, need: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the later rows of the tile that are in another component, fit in size, have
    matching signatures and share no earlier band (there they meet in that band's tile)."""
    n_rows = tile.num_rows
    if n_rows < 2:
        return
    side, n, comp = (tile.column(c).to_numpy() for c in ("side", "n", "component"))
    band, one = tile.column("band").to_numpy(), tile.column("lo")[0].as_py() == tile.column("hi")[0].as_py()
    if (comp == comp[0]).all():
        return
    sig = np.frombuffer(b"".join(tile.column("sig").to_pylist()), dtype=np.uint8).reshape(n_rows, -1)
    keys = tile.column("bands").combine_chunks().flatten().to_numpy().reshape(n_rows, -1)[:, :int(band[0])]
    left = np.arange(n_rows) if one else np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    for k, i in enumerate(left):
        others = left[k + 1:] if one else right
        others = others[(comp[others] != comp[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
        if len(others):
            others = others[(sig[others] == sig[i]).sum(axis=1) >= need]
        if len(others):
            others = others[~(keys[others] == keys[i]).any(axis=1)]
        if len(others):
            yield i, others


def _members_with_partners(percent: int):
    need = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            keep = np.zeros(tile.num_rows, dtype=bool)
            for i, others in _likely_pairs(tile, percent, need):
                keep[i] = True
                keep[others] = True
            if keep.any():
                yield from tile.filter(pa.array(keep)).combine_chunks().to_batches()

    return run


def _joining_links(percent: int):
    """Confirmed links (u, v) of each tile that join components, tested on the full sets."""
    need = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            ids, comp = tile.column("id").to_numpy(), tile.column("component").to_pylist()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in tile.column("members").to_pylist()]
            parent = {c: c for c in comp}

            def find(x, parent=parent):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            links = []
            for i, others in _likely_pairs(tile, percent, need):
                for j in others:
                    u, v = find(comp[i]), find(comp[j])
                    if u != v and _linked(sets[i], sets[j], percent):
                        parent[v] = u
                        links.append((ids[i], ids[j]))
            if links:
                found = np.array(links, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _sets_of(nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Full sets (doc_id, d1, members) of the classes named by ``nodes`` (doc_id): only the
    texts of these documents are read into sets."""
    wanted = C.join_small(_texts(docs), C.checkpointed(nodes.distinct()), "doc_id", "left_semi")
    return C.checkpointed(_full_sets(wanted, words).dropDuplicates(["doc_id", "d1"]))


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (u, v) among pairs (a, a1, b, b1), tested on the full sets."""
    pairs = C.checkpointed(pairs)
    sets = _sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs, words)
    left = sets.select(F.col("doc_id").alias("a"), F.col("d1").alias("a1"), F.col("members").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("d1").alias("b1"), F.col("members").alias("y"))
    return pairs.join(left, ["a", "a1"]).join(right, ["b", "b1"]).select("a", "b", "x", "y").mapInArrow(_set_test(percent), "u long, v long")


def _hidden_links(labelled: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (u, v) that join components, among the members (bucket, band, id, d1, n, component)
    of buckets with several components."""
    spark = docs.sparkSession
    several = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles"))
    tiles = F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES))
    several = C.checkpointed(several.filter("lo < hi").select("bucket", tiles.alias("tiles")))
    rest = labelled.join(several, "bucket").withColumn("own", F.pmod(F.xxhash64("id", "d1"), F.col("tiles")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rest = rest.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                       F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "band", "id", "d1", "n", "component")
    rest = rest.join(classes.select("id", "d1", "sig", "bands"), ["id", "d1"])
    tile, columns = ["bucket", "lo", "hi"], ["bucket", "lo", "hi", "side", "band", "id", "d1", "n", "component", "sig", "bands"]
    parts = C.shuffle_partitions(spark)
    rest = rest.select(*columns).repartition(parts, *tile).sortWithinPartitions(*tile)
    likely = C.checkpointed(rest.mapInArrow(_members_with_partners(percent), rest.schema))
    sets = _sets_of(likely.select(F.col("id").alias("doc_id")), docs, words)
    full = likely.join(sets.withColumnRenamed("doc_id", "id"), ["id", "d1"]).select(*columns, "members")
    return full.repartition(parts, *tile).sortWithinPartitions(*tile).mapInArrow(_joining_links(percent), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    spark = docs.sparkSession
    C.prepare(spark)
    signed = C.checkpointed(document_signatures(docs, percent, words))
    graph = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = C.checkpointed(graph.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    members = classes.select(F.posexplode("bands").alias("band", "bucket"), "id", "d1", "n")
    hubs = C.checkpointed(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("id", "d1", "n")).alias("hub")).filter("m > 1"))
    shared = C.checkpointed(members.join(hubs, "bucket"))
    sizes_fit = 100 * F.least("n", F.col("hub.n")) >= percent * F.greatest("n", F.col("hub.n"))
    met = shared.filter(sizes_fit & ((F.col("id") != F.col("hub.id")) | (F.col("d1") != F.col("hub.d1")))).select(
        F.col("id").alias("a"), F.col("d1").alias("a1"), F.col("hub.id").alias("b"), F.col("hub.d1").alias("b1")).distinct()
    left = classes.select(F.col("id").alias("a"), F.col("d1").alias("a1"), F.col("sig").alias("x"))
    right = classes.select(F.col("id").alias("b"), F.col("d1").alias("b1"), F.col("sig").alias("y"))
    likely = met.join(left, ["a", "a1"]).join(right, ["b", "b1"]).select("a", "a1", "b", "b1", "x", "y").mapInArrow(
        _signature_test(percent), "a long, a1 long, b long, b1 long")
    # classes with the same smallest doc_id (a repeated id) are one document
    links = C.checkpointed(_confirmed(likely, docs, percent, words))
    comp = C.checkpointed(connected_components(links))

    labelled = shared.join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "band", "id", "d1", "n", F.coalesce("component", "id").alias("component"))
    more = C.checkpointed(_hidden_links(C.checkpointed(labelled), classes, docs, percent, words))
    if more.limit(1).count():
        comp = connected_components(comp.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
        comp = C.checkpointed(comp)

    reps = C.checkpointed(classes.select("d1", "d2", "id").join(comp.withColumnRenamed("node", "id"), "id", "left")
                          .select("d1", "d2", F.coalesce("component", "id").alias("component")))
    # a repeated doc_id can be in several classes; its smallest component stands
    labelled = C.join_small(signed.select("doc_id", "n_shingles", "d1", "d2"), reps, ["d1", "d2"])
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"))


def _one_id_a_text(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """Adds ``__id``, a long that rows share if and only if they share doc_id and text, and says
    which doc_id the invented ones stand for (new, known; None: there are no invented ones).

    It is the doc_id where that is not null and stands for one text. The other rows, which are few
    as a rule, get ids of their own: one for each further text of a doc_id and one for each text
    without a doc_id. So unrelated texts under one doc_id are two documents, and copies without a
    doc_id are copies. The invented ids are hashes; a salt is tried until none is taken."""
    named = docs.withColumns({"__id": F.col(doc_id).cast("long"), "__md5": F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))})
    ids = named.groupBy("__id").agg(F.min("__md5").alias("first"), F.max("__md5").alias("last"))
    shared = C.checkpointed(ids.filter("__id is null or first <> last").select(F.col("__id").alias("__shared"), "first"))
    n = shared.count()
    if n == 0:
        return named.drop("__md5"), None
    plain = C.join_small(named.filter("__id is not null"), shared.filter("__shared is not null"), F.col("__id") == F.col("__shared"), "left_anti", n)
    odd = C.join_small(named, shared, F.col("__id").eqNullSafe(F.col("__shared")), "inner", n)
    keys = C.checkpointed(odd.filter("__id is null or __md5 <> first").select(F.col("__id").alias("known"), F.col("__md5").alias("k_md5")).distinct())
    rows, salt = keys.count(), 0
    while True:
        own = C.checkpointed(keys.withColumn("new", F.xxhash64(F.lit(salt), "known", "k_md5")))
        taken = C.join_small(named.select("__id"), own.select("new"), F.col("__id") == F.col("new"), "left_semi", rows)
        if own.select("new").distinct().count() == rows and not taken.limit(1).count():
            break
        salt += 1
    odd = C.join_small(odd, own, F.col("__id").eqNullSafe(F.col("known")) & (F.col("__md5") == F.col("k_md5")), "left", rows)
    odd = odd.withColumn("__id", F.coalesce("new", "__id")).select(*plain.columns)
    return plain.unionByName(odd).drop("__md5"), own.select("new", "known")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """The documents without near copies, same columns: of each component one row stays, the one
    with the smallest doc_id, or one without a doc_id if there is no other. A document is a text
    with its doc_id: different texts under one doc_id are different documents, and copies with a
    null doc_id are copies like others. Texts without words are linked with nothing; equal ones
    under one doc_id (or none) leave one row."""
    wide, own = C.set_apart(docs)
    named, invented = _one_id_a_text(wide, own["doc_id"], own["text"])
    found = near_duplicates(named.select(F.col("__id").alias("doc_id"), F.col(own["text"]).alias("text")), percent, words)
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("kept").alias("kept"), F.min("component_id").alias("component_id"))
    if invented is not None:  # the least id of a component may be an invented one: choose by the doc_ids they stand for
        ids = C.join_small(C.checkpointed(ids), invented, F.col("doc_id") == F.col("new"))
        place = F.struct((F.col("new").isNotNull() & F.col("known").isNull()).alias("none"), F.coalesce("known", "doc_id").alias("known"), F.col("doc_id").alias("id"))
        ids = C.checkpointed(ids.select("doc_id", "rows", "component_id", place.alias("place")))
        best = ids.groupBy(F.col("component_id").alias("c")).agg(F.min("place").alias("best"))
        ids = ids.join(best, F.col("component_id") == F.col("c")).withColumn("kept", F.col("best.id") == F.col("doc_id"))
    ids = C.checkpointed(ids.select("doc_id", "rows", "kept"))
    gone = ids.filter("not kept").select(F.col("doc_id").alias("__gone"))
    rest = C.join_small(named, gone, F.col("__id") == F.col("__gone"), "left_anti")
    twice = ids.filter("kept and rows > 1").select(F.col("doc_id").alias("__gone"))
    n = twice.count()
    if n:
        again = C.join_small(rest, twice, F.col("__id") == F.col("__gone"), "left_semi", n).dropDuplicates(["__id"])
        rest = C.join_small(rest, twice, F.col("__id") == F.col("__gone"), "left_anti", n).union(again)
    return C.put_back(rest, own)
