"""Top-k search, packing, substring dedup, mixing, near duplicates, the pipeline."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.llm import common as C
from evalspark.llm import minhash_dedup as M
from evalspark.llm import mixing as X
from evalspark.llm import packing as P
from evalspark.llm import queries
from evalspark.llm import substring_dedup as D
from evalspark.llm import topk as T
from evalspark.llm.components import connected_components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- top-k ---------------------------------------------------------------------------------

def brute_top(rows, k):
    import math

    vecs = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    q = [[math.floor(256 * x) for x in v] for _, v in vecs]
    out = []
    for a, (i, _) in enumerate(vecs):
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q[a], q[b])), vecs[b][0]) for b in range(len(vecs)) if b != a)[:k]
            out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_matches_brute_force_with_ties_nulls_and_big_values(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=4) / 3]) for i in range(700)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(700, 1000)]  # ties
    rows += [(100, [0.5, 0.5, 0.5, 0.5]), (50, rows[50][1]), (None, [1.0]), (1000, None), (1001, [float("nan")] * 4), (1002, [None, 1.0]), (1003, [float("inf")]), (1050, [])]
    rows += [(1004, [1e15, 1.0, 0.0, -1e15]), (1100, [3.0, 1e14, 0.25, 2.0])]  # beyond exact doubles
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(5)
    for tile in (300, 16384):
        got = sorted(map(tuple, T.top_k(df, F.col("vec_id") % 50 == 0, 5, tile_rows=tile, query_rows=7, fan=2).collect()))
        assert got == brute_top(rows, 5)
    assert T.top_k(df.limit(0), F.lit(True), 5).count() == 0
    few = df.filter("vec_id in (0, 1, 2)")
    assert T.top_k(few, F.col("vec_id") == 0, 5).count() == 2


# --- packing -------------------------------------------------------------------------------

def test_units_join_to_the_tokenizer_ids():
    import pyarrow as pa

    encoder = P.UnitEncoder(open(queries.tokenizer_path()).read())
    rng = np.random.default_rng(0)
    parts = ["it's", "DON'T", "<|endoftext|>", " ", "x<|startoftext|>y", "É", "é", "a.b", "!!'s", "ß", " ", "\n\t", "12.5%", "́", "abc", "İ", "Σ", "'LL", "Å", "‍", "<|", "|>", "😀", "á.", "\x1c", "\x85"]
    for _ in range(200):
        texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(5)]
        for rows, buf, off in C.slices(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), "text"):
            ids, n = encoder(buf, off)
            want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert np.split(ids, np.cumsum(n))[:-1] is not None and [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == want


def test_differencing_balances():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 1000, 400)
    window = P.differencing(sizes, 16)
    load = np.bincount(window, weights=sizes, minlength=16)
    assert load.max() - load.min() <= 3  # far below any item
    assert P.differencing(np.array([5]), 3).tolist() == [0] and len(P.differencing(np.array([], dtype=int), 3)) == 0
    packed = P.pack_windows(np.array([3000, 3000, 3000]), 4096)
    assert sorted(packed.tolist()) == [0, 1, 2]  # the count rises from 3 only if needed
    assert P.pack_windows(np.array([2049, 2049, 2049, 1]), 4096).max() == 2


def test_packing_round_trip(spark, sf_dir, edge_docs, no_docs):
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    for docs in (C.read(spark, sf_dir, "documents"), edge_docs):
        rows = P.pack_documents(docs, path).collect()
        by_text = defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            by_text[r.doc_id].append(tok.encode(r.text or "", add_special_tokens=False).ids + [2])
        pieces, windows = defaultdict(list), defaultdict(list)
        for r in rows:
            ids = np.frombuffer(r.ids, dtype="<u4").tolist()
            assert len(ids) == r.length <= 4096
            pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
            windows[r.sequence_id].append((r.offset, r.length))
        for doc, want in by_text.items():
            assert sum(len(p[1]) for p in pieces[doc]) == sum(map(len, want))
            for start, ids, n in pieces[doc]:
                assert any(len(w) == n and w[start:start + len(ids)] == ids for w in want)
        for w in windows.values():
            at = 0
            for offset, length in sorted(w):
                assert offset == at
                at += length
            assert at <= 4096
        total = sum(r.length for r in rows)
        assert len(windows) <= 1.03 * total / 4096 + 2
    assert P.pack_documents(no_docs, path).count() == 0


def test_packing_digest(spark, sf_dir):
    one = queries.QUERIES["op4_packing"](spark, sf_dir).filter("doc_id = 0").orderBy("start").first()
    from tokenizers import Tokenizer

    text = C.read(spark, sf_dir, "documents").filter("doc_id = 0").first().text
    ids = Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids + [2]
    assert one.ids_crc32 == zlib.crc32(np.array(ids[:one.length], dtype="<u4").tobytes()) and one.doc_tokens == len(ids)


# --- substring dedup -----------------------------------------------------------------------

def brute_substrings(rows, width=50):
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    owner = {}
    for i, w in words:
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            if i is not None:
                owner[k] = min(owner.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if i is not None and owner[tuple(w[s:s + width])] < i:
                gone[s:s + width] = [True] * width
        out.append((-1 if i is None else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def test_substrings_match_brute_force(spark, sf_dir, edge_docs, no_docs):
    rng = np.random.default_rng(5)
    vocab = [f"v{i}" for i in range(400)]
    passage = list(rng.choice(vocab, 130))
    made = []
    for i in range(60):  # passages cut at any place, touching, overlapping, repeated in one text
        w = list(rng.choice(vocab, rng.integers(0, 90)))
        for _ in range(rng.integers(0, 3)):
            a = int(rng.integers(0, 70))
            w += passage[a:a + int(rng.integers(40, 75))]
        made.append((int(i), " ".join(w)))
    made += [(100 + i, "same " * n) for i, n in enumerate((49, 50, 51, 200))] + [(7, " ".join(passage)), (None, " ".join(passage))]
    for docs in (C.read(spark, sf_dir, "documents"), edge_docs, spark.createDataFrame(made, "doc_id long, text string").repartition(4)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in D.dedup_substrings(docs).collect())
        assert got == brute_substrings(rows)
    assert D.dedup_substrings(no_docs).count() == 0


def test_substrings_with_many_ranges(spark, sf_dir, monkeypatch):
    docs = C.read(spark, sf_dir, "documents")
    want = sorted(map(tuple, D.dedup_substrings(docs).collect()))
    monkeypatch.setattr(D, "RANGE_BYTES", 1 << 12)
    monkeypatch.setattr(D, "BUCKET_BYTES", 1 << 13)
    assert sorted(map(tuple, D.dedup_substrings(docs.repartition(7)).collect())) == want


# --- mixing --------------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), list(names), {}
    while True:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 2 * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in over]
        if not free:
            return target


def test_mixing_meets_targets(spark, sf_dir, edge_docs, no_docs):
    for docs in (C.read(spark, sf_dir, "documents"), edge_docs):
        rows = X.taken_words(X.mix_pieces(docs)).collect()
        assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, X.taken_words(X.mix_pieces(docs.repartition(5))).collect()), key=repr)
        source = docs.select("doc_id", "source", "text").collect()
        sizes, per_doc = defaultdict(int), defaultdict(list)
        for r in source:
            n = len(WORDS.findall(r.text or ""))
            sizes[r.source] += n
            per_doc[r.doc_id].append((n, r.source))
        target = brute_targets(sizes)
        taken = defaultdict(int)
        assert len(rows) == len(source)
        for r in rows:
            assert r.taken <= 2 * r.size
            match = [s for n, s in per_doc[r.doc_id] if n == r.size and sizes[s] == r.source_size]
            assert match and abs(target[match[0]] - r.target) < 1e-6 * max(1, r.target)
            taken[match[0]] += r.taken
        for s, t in target.items():
            assert abs(taken[s] - t) <= 100 + 0.02 * t
    assert X.taken_words(X.mix_pieces(no_docs)).count() == 0


def test_mixing_meets_targets_far_below_a_block(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "big") for i in range(500)]
    rows += [(1000 + i, " ".join(f"s{j}" for j in range(1 + i % 7)), f"small{i:02d}") for i in range(40)] + [(2000, "one two three", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    target, source = brute_targets(sizes), {i: s for i, _, s in rows}
    for slots in (1 << 21, 40, 3):  # blocks of 32, some 760 and some 10,000 words
        taken = defaultdict(int)
        for r in X.taken_words(X.mix_pieces(docs, slots=slots)).collect():
            taken[source[r.doc_id]] += r.taken
        assert dict(taken) == {s: int(t) for s, t in target.items()}
    mixed = X.mixed_documents(docs, slots=3)
    assert {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(X.word_count(F.col("text"))).alias("n")).collect()} == taken


def test_schedule_deals_every_block_once(spark):
    sizes = [10**6, 5, 70, 3, 33, 1, 4000] + [1] * 30
    targets = spark.createDataFrame([(str(i), i, n, float(n)) for i, n in enumerate(sizes)], "source string, sid long, source_size long, target double")
    rows = X.slot_schedule(targets, 32).orderBy("slot", "sid").collect()
    for i, n in enumerate(sizes):  # in order, none missing, none twice
        assert [r.block for r in rows if r.sid == i] == list(range(-(-n // 32)))
    lone = sorted(r.slot for r in rows if sizes[r.sid] == 1)
    assert lone[0] < len(rows) * 0.2 and lone[-1] > len(rows) * 0.8 and max(r.slot for r in rows) < len(rows) + 16 * len(sizes) + 256


def test_schedule_is_well_spread(spark):
    targets = spark.createDataFrame([("a", 0, 100000, 50000.0), ("b", 1, 100000, 30000.0), ("c", 2, 100000, 20000.0)], "source string, sid long, source_size long, target double")
    rows = X.slot_schedule(targets, 32).orderBy("slot").collect()
    assert {s: max(r.block for r in rows if r.sid == s) + 1 for s in range(3)} == {0: 1563, 1: 938, 2: 625}
    assert len({(r.sid, r.block) for r in rows}) == len(rows)
    for lo in range(0, 2800, 100):
        part = [r.sid for r in rows if lo <= r.slot < lo + 100]
        assert abs(part.count(0) - 50) <= 4 and abs(part.count(1) - 30) <= 4
    for s in range(3):  # a source's blocks come in order
        blocks = [r.block for r in rows if r.sid == s]
        assert blocks == sorted(blocks)


def test_mixed_documents_hold_the_words(spark, sf_dir, edge_docs):
    for docs in (C.read(spark, sf_dir, "documents"), edge_docs):
        mixed = X.mixed_documents(docs)
        assert mixed.columns == docs.columns
        words = mixed.agg(F.sum(X.word_count(F.col("text")))).first()[0]
        assert words == X.taken_words(X.mix_pieces(docs)).agg(F.sum("taken")).first()[0]


# --- near duplicates -----------------------------------------------------------------------

def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for g in s:
            by[g].add(k)
    seen = set()
    for ks in by.values():
        ks = sorted(ks)
        for a in range(len(ks)):
            for b in range(a + 1, len(ks)):
                pair = ks[a], ks[b]
                if pair in seen or None in (sets[ks[a]][0], sets[ks[b]][0]):
                    continue
                seen.add(pair)
                x, y = sets[ks[a]][1], sets[ks[b]][1]
                if 100 * len(x & y) >= percent * len(x | y):
                    u, v = find(sets[ks[a]][0]), find(sets[ks[b]][0])
                    parent[max(u, v)] = min(u, v)
    return sorted((-1 if i is None else i, len(s), None if i is None else find(i)) for i, s in sets)


def near_copies(n_groups=12, size=9, words=120, edits=6, seed=6):
    """Groups of edited copies, some linked through others only."""
    rng = np.random.default_rng(seed)
    rows, doc = [], 0
    for g in range(n_groups):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(size):
            w = list(base)
            for at in rng.choice(words, rng.integers(0, edits), replace=False):
                w[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((doc, " ".join(w)))
            doc += 1
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, edge_docs, percent):
    order = np.random.default_rng(7).permutation(108)
    made = [(int(order[i]), t) for i, t in near_copies()]
    for docs in (edge_docs, spark.createDataFrame(made, "doc_id long, text string").repartition(4)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = M.near_duplicates(docs, percent).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, percent)
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_links_between_members_that_are_no_hubs(spark, monkeypatch):
    """With tiny tiles and a chain of copies, links beyond the hubs are still found."""
    monkeypatch.setattr(M, "TILE", 2)
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join([f"x{j}" for j in range(3 * k)] + words[3 * k:])) for k in range(14)]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 85)


def test_near_duplicates_empty_and_drop(spark, no_docs, edge_docs):
    assert M.near_duplicates(no_docs).count() == 0
    rest = M.drop_near_duplicates(edge_docs)
    assert rest.columns == edge_docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rest.collect()) == sorted(
        (i is not None, i or 0) for i in [None, 1, 2, 3, 4, 6, 8, 10])  # the copy of 1 without an id goes


A, B = "one two three four five six seven eight nine ten", "red orange yellow green blue indigo violet black white grey"


@pytest.mark.parametrize("top", [9, 2**63 - 1])
def test_drop_loses_no_text_by_shared_or_missing_ids(spark, top):
    rows = [(1, A), (1, B), (2, A), (3, B + " more words of its own that make it quite another text altogether"), (1, B), (top, "alone " * 9),
            (None, B.upper()), (None, "without an id " * 5), (None, "without an id " * 5), (None, None), (None, None), (4, ""), (4, None), (4, "")]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, __id string, __gone int, __md5 int").repartition(5)
    rest = M.drop_near_duplicates(df)
    assert rest.columns == df.columns and rest.filter("__id <> 'x' or __gone <> 1 or __md5 <> 2").count() == 0
    got = sorted(((r.doc_id, r.text) for r in rest.collect()), key=str)
    want = [(1, A), (1, B), (3, rows[3][1]), (top, rows[5][1]), (None, rows[7][1]), (None, None), (4, ""), (4, None)]
    assert got == sorted(want, key=str)
    assert M.drop_near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 130)) and got[201] == 200 and 300 not in got
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- pipeline ------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = C.read(spark, sf_dir, "documents")
    counts = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        docs = C.checkpointed(stage(spark, docs, sf_dir))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    assert docs.filter(F.length("text") != F.col("n_chars")).count() == 0
    packed = C.checkpointed(pipeline.STAGES[-1][1](spark, docs, sf_dir))
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert ends.filter("n <> m or n > 4096").count() == 0
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


CLASHING = ["size", "start", "copy", "n_words", "text_hash", "__id", "__hash", "round", "sid", "bucket", "kept", "evidence", "spans", "doc tokens"]


def test_stages_carry_columns_named_like_their_own(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = C.read(spark, sf_dir, "documents").withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHING})
    for _, stage in pipeline.STAGES[:-1]:
        docs = C.checkpointed(stage(spark, docs, sf_dir))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
        wrong = F.lit(False)
        for c in CLASHING:
            wrong = wrong | (F.col(f"`{c}`") != F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
        assert docs.filter(wrong).count() == 0 and docs.count() > 0


def test_pipeline_runs_end_to_end_and_on_empty_tables(spark, sf_dir, no_docs):
    import corpus_pipeline as pipeline
    from evalspark.session import shared_path

    out = pipeline.run(spark, sf_dir)
    assert {"doc_id", "ids", "ids_crc32", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    empty = shared_path(spark, "no-documents")
    no_docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{empty}/documents.parquet")
    C.read(spark, sf_dir, "labels").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert pipeline.run(spark, empty).count() == 0


def test_pipeline_returns_whole_sequences(spark, sf_dir, edge_docs):
    """The ids of the last stage join to sequences that hold every reading of every document."""
    import corpus_pipeline as pipeline
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    for docs in (C.read(spark, sf_dir, "documents").limit(100).union(C.read(spark, sf_dir, "documents").limit(40)), edge_docs):
        rows = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        pieces, sequences = defaultdict(int), defaultdict(list)
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            pieces[r.doc_id, r.start, r.ids] += 1
            sequences[r.sequence_id].append((r.offset, r.ids))
        whole = [np.frombuffer(b"".join(x for _, x in sorted(s)), dtype="<u4") for s in sequences.values()]
        want, ends = defaultdict(int), 0
        for d in docs.select("doc_id", "text").collect():
            ids = np.array(tok.encode(d.text or "", add_special_tokens=False).ids + [P.END_ID], dtype="<u4")
            ends += int((ids == P.END_ID).sum())
            for start, length in zip(*P.cut_lengths(np.array([len(ids)]), P.CAPACITY, 1024)[1:]):
                want[d.doc_id, int(start), ids[start:start + length].tobytes()] += 1
        assert pieces == want
        assert max(map(len, whole)) <= P.CAPACITY and sum(int((s == P.END_ID).sum()) for s in whole) == ends
