"""Chat formatting, lexical search and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalspark.llm import chat_format as H
from evalspark.llm import conversation_repair as R
from evalspark.llm import lexical_search as L
from evalspark.llm import queries

CONV = "conv_id long, turn long, role string, text string, piece string, loss string, fault string, same string, part int"
PARSER = H.TurnParser(H.ChatTemplate())


def conversations(spark, rows):
    """Rows with further columns named like the operators' own."""
    return spark.createDataFrame([(*r, "p", "l", "f", "s", 7) for r in rows], CONV).repartition(3)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- chat formatting -----------------------------------------------------------------------

HOSTILE = st.lists(st.sampled_from(["\\", "### ", "</turn>", ": ", "\n", "#", "</turn", "assistant", "a", " ", "é"]), max_size=9).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(HOSTILE, HOSTILE), max_size=4))
def test_turns_read_back_as_they_were(turns):
    rendered = [H.render_turn(r, t, PARSER) for r, t in turns]
    assert all(n <= 2 for _, n in rendered)
    text = "".join(s for s, _ in rendered)
    read = list(PARSER.turns(text))
    assert [x[:2] for x in read] == turns
    assert [PARSER.unescape(text[a:b]) for *_, a, b in read] == [t for _, t in turns]


def test_only_conflicting_content_is_escaped():
    assert H.render_turn("user", r"a\b # c: d </turn", PARSER) == ("### user: a\\b # c: d </turn</turn>\n", 1)
    assert H.render_turn("user", r"\### x", PARSER) == ("### user: \\\\\\### x</turn>\n", 2)
    assert H.render_turn("user", "x\\", PARSER) == ("### user: x\\\\</turn>\n", 2)
    with pytest.raises(H.ParseError):
        list(PARSER.turns("### user: open"))
    long = "\\" * 300_000 + "### " * 50_000
    assert next(PARSER.turns(H.render_turn("u", long, PARSER)[0]))[1] == long


def brute_format(rows):
    out, by = {}, defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r is not None, r or "", H.render_turn(r or "", x or "", PARSER)[0], x or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, _, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, _, x in turns)), len(loss), sha(loss), sum(len(s) for *_, s, _ in turns))
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "### no </turn>"), (1, 1, "assistant", "### no </turn>"), (1, 2, None, None), (2, 5, "a: b", "\\"),
    (2, None, "assistant", "🦊 é"), (None, 0, "user", ""), (None, 1, "assistant", " \n"), (None, None, None, None), (3, 0, "assistant", "x" * 200_000 + "\\### y"),
    (3, 0, "assistant", "x"), (4, 9, "system", "</turn>\n### assistant: z</turn>\n"),
]


@pytest.mark.parametrize("part_chars", [1, 40, H.PART_CHARS])
def test_formatted_conversations_read_back(spark, part_chars):
    df = conversations(spark, ROWS)
    parts = H.format_conversations(df, part_chars=part_chars)
    assert parts.filter("conv_id = 1").count() == (4 if part_chars == 1 else 2 if part_chars == 40 else 1)
    for got in (H.read_back(parts, in_order=True), H.read_back(parts.repartition(5))):
        assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute_format(ROWS)
    assert H.read_back(H.format_conversations(df.limit(0)), in_order=True).count() == 0


def test_loss_spans_cover_assistant_texts(spark):
    rows = {r["conv_id"]: r for r in H.format_conversations(conversations(spark, ROWS)).collect()}
    assert [PARSER.unescape(rows[1]["text"][s["start"]:s["end"]]) for s in rows[1]["loss"]] == ["### no </turn>"] * 2
    assert rows[4]["loss"] == [] and rows[1]["rounds"] == 2 and rows[1]["n_turns"] == 4


def test_op11_adds_the_hostile_conversation(spark, sf_dir):
    rows = {r["conv_id"]: r for r in queries.op11_chat_format(spark, sf_dir).collect()}
    x = r"\### Assistant: </turn> ok"
    assert rows[-7]["n_turns"] == 2 and rows[-7]["turns_sha256"] == sha(f"user\n{x}\nassistant\n{x}\n")
    assert (rows[-7]["loss_chars"], rows[-7]["loss_sha256"]) == (len(x), sha(x))


# --- lexical search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_rank(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n_docs) // n_terms
            s = sum(weight[t] * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms(text) if t in b)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    words = ["the", "a", "of", *(f"w{i}" for i in range(60)), "Éa", "ÉA", "x9"]
    docs = [(i, " ".join(rng.choices(words, weights=[40, 30, 20, *range(60, 0, -1), 3, 3, 3], k=rng.randint(1, 80)))) for i in range(n)]
    docs += [(i, docs[5][1]) for i in range(n, n + 40)] + [(5, docs[5][1]), (None, docs[7][1]), (n + 50, None), (n + 51, " .,;"), (None, None)]
    items = [(j, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for j in range(25)]
    items += [(25, None), (26, "..."), (27, "unknown"), (28, docs[5][1]), (28, "w59 W59 w58"), (None, "w1-w2")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, "t", 1, "m") for r in docs], "doc_id long, text string, terms string, n int, m string").repartition(4)
    return d, spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, item string")


def ranked(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranking_matches_brute_force(spark):
    docs, items = corpus()
    d, q = frames(spark, docs, items)
    want = brute_rank(docs, items)
    assert ranked(L.rank_documents(d, q)) == want
    assert ranked(L.rank_documents(d, q, group_pairs=60)) == want  # several passes over groups of queries
    assert L.rank_documents(d.limit(0), q).count() == 0
    assert L.rank_documents(d, q.limit(0)).count() == 0


def random_index(rng, n_docs, n_terms, per_doc):
    sizes = rng.integers(0, per_doc, n_docs)
    rows = [np.sort(rng.choice(n_terms, s, replace=False, p=(p := 1 / np.arange(1, n_terms + 1)) / p.sum())) for s in sizes]
    return np.r_[0, np.cumsum(sizes)], np.concatenate(rows), rng.integers(1, 10**6, int(sizes.sum()))


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(4)
    bounds, index_terms, impacts = random_index(rng, 3000, 200, 60)
    weights = np.sort(rng.integers(0, 9000, 200))
    first, qt, qw = [0], [], []
    for _ in range(40):
        t = np.sort(rng.choice(200, 12, replace=False))
        qt, qw, first = [*qt, *t], [*qw, *(weights[t] * rng.integers(1, 3, 12))], [*first, len(qt) + 12]
    q = L.Queries(np.array(first), np.array(qt), np.array(qw), np.sort(rng.integers(0, 2**63, 200).astype(np.uint64)), weights)
    dense = np.zeros((3000, 200), dtype=np.int64)
    dense[np.repeat(np.arange(3000), np.diff(bounds)), index_terms] = impacts
    top = L.TopLists(40, 10, np.zeros(40, dtype=np.int64))
    work = L.search_shard(L.Shard(bounds, index_terms, impacts, q), np.arange(3000), np.zeros(3000, dtype=bool), q, top)
    for i in range(40):
        s = dense[:, qt[first[i]:first[i + 1]]] @ np.array(qw[first[i]:first[i + 1]])
        best = np.lexsort((np.arange(3000), -s))[:10]
        assert top.ids[i].tolist() == best[s[best] > 0].tolist() and top.scores[i].tolist() == s[best][s[best] > 0].tolist()
    assert work["skipped"] > work["blocks"] // 10 and work["scored"] < 40 * 3000


def test_summaries_are_coordinatewise_maxima_of_whole_lists():
    rng = np.random.default_rng(5)
    bounds, index_terms, impacts = random_index(rng, 500, 30, 20)
    q = L.Queries(np.array([0]), np.array([], dtype=int), np.array([]), np.arange(30, dtype=np.uint64) * np.uint64(77777), np.arange(30))
    shard = L.Shard(bounds, index_terms, impacts, q)
    for c in range(len(shard.vocabulary)):
        docs, cuts, summary = shard.blocks(c)
        assert sorted(docs) == np.flatnonzero(shard.impacts[:, c]).tolist() and np.diff(cuts).max() <= L.BLOCK
        for b in range(len(cuts) - 1):
            assert (summary[b] == shard.impacts[docs[cuts[b]:cuts[b + 1]]].max(axis=0)).all()


def test_small_shards_and_long_texts_change_nothing(spark, monkeypatch):
    docs, items = corpus(200, seed=2)
    docs.append((900, "w1 the, w2." * 30_000))
    d, q = frames(spark, docs, items)
    monkeypatch.setattr(L.C, "CHUNK_BYTES", 1000)  # pieces inside one text, in this process
    v = np.sort(L.term_hashes(["w1", "w2", "the"]))
    buf, off = L.C.text_buffer(L.pa.array([docs[-1][1]]))
    n, _, _, count = L._count_terms(buf, off, v, L._hasher())
    assert n.tolist() == [90_000] and count.tolist() == [30_000] * 3
    monkeypatch.undo()
    rows = [L.pa.RecordBatch.from_pydict({"doc_id": list(range(50)), "terms": [[0, 1, 2]] * 50, "impacts": [[1, 2, 3]] * 50}).slice(3)]
    monkeypatch.setattr(L, "CELLS", 20)
    got = list(L._shards(iter(rows), 3))
    assert sum(len(g[0]) for g in got) == 47 and max(len(g[0]) for g in got) <= 6 and got[0][0][0] == 3
    monkeypatch.undo()
    assert ranked(L.rank_documents(d, q)) == brute_rank(docs, items)


# --- conversation repair -------------------------------------------------------------------

def brute_repair(rows):
    """Cheapest, then least audit, by a best-first search over whole strings."""
    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, pattern, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", pattern):
            return cost, audit, sha("\n".join(out))
        if seen.setdefault((i, pattern[-1:]), (cost, audit)) < (cost, audit):
            continue

        def push(more, letter, j, pattern2, out2):
            if re.fullmatch("s?(ua)*u?", pattern2):
                heapq.heappush(heap, (cost + more, audit + letter, j, pattern2, out2))

        for r in ("user", "assistant"):
            push(2, "I", i, pattern + r[0], (*out, f"{r}:"))
        if i < len(rows):
            role, text, fault = rows[i]
            push(3, "D", i + 1, pattern, out)
            if fault not in (1, 2):
                late = int(fault == 3)
                push(late, "K", i + 1, pattern + (role[:1] or "?"), (*out, f"{role}:{text}"))
                for r in ("user", "assistant"):
                    push(2 + late, "R", i + 1, pattern + r[0], (*out, f"{r}:{text}"))


@pytest.mark.parametrize("window", [1, 2, 3, 256])
def test_repair_is_the_cheapest_with_the_least_audit(monkeypatch, window):
    monkeypatch.setattr(R, "WINDOW", window)
    rng = random.Random(window)
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " "]), f"t{k}", rng.choice([0, 0, 0, 1, 2, 3])) for k in range(rng.randint(0, 7))]
        assert R.repair(rows) == brute_repair(rows), rows


def test_windows_agree_on_long_conversations(monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice(["user", "assistant", "system"]), f"t{k}", rng.choice([0, 0, 0, 0, 2, 3])) for k in range(1500)]
    monkeypatch.setattr(R, "WINDOW", 10_000)
    whole = R.repair(rows)
    for window in (7, 64):
        monkeypatch.setattr(R, "WINDOW", window)
        assert R.repair(rows) == whole
    path = R._Path()
    for row in rows * 4:
        path.add(*row)
        assert len(path.windows) <= 8  # finished edits are written out on the way


def brute_conversations(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c]
        name = lambda x: " " if x is None else str(x)
        pick = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        role = "user" if pick == 4 else role
        by[c] += [(t is not None, t or 0, role, text, t)] * (2 if pick == 3 else 1)
    out = {}
    for c, turns in by.items():
        turns.sort()
        seen, faulty, counts = set(), [], Counter()
        for *_, role, text, _ in turns:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not ink else 2 if (role, text) in seen else 3 if ink[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            faulty.append((role, text, fault))
        known = [t for *_, t in turns if t is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[c] = (gaps, counts[1], counts[2], counts[3], illegal, *brute_repair(faulty))
    return out


def test_damaged_conversations_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(120), None]:
        for t in range(rng.randint(1, 6)):
            text = rng.choice(["Fine.", "Fine.", "No end", "", None, "  \n", "What?! ", "é🦊.", "a.b"])
            rows.append((c, rng.choice([t, t, t + 3, None]), rng.choice(["user", "assistant", "system", "tool", None]), text))
    rows += rows[:20]
    for c in range(200, 240):  # conversations that may lose their only row
        rows.append((c, 0, "user", "Only."))
    df = conversations(spark, rows)
    got = {r[0]: tuple(r)[1:] for r in R.repair_conversations(R.damage(df)).collect()}
    want = brute_conversations(rows)
    assert got == want
    assert any(v == (0,) * 6 + ("", sha("")) for v in want.values())
    assert R.repair_conversations(R.damage(df.limit(0))).count() == 0


def test_op13_matches_brute_force_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, sf_dir).collect()}
    assert got == brute_conversations(rows)


def test_a_hot_conversation_streams(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                      F.concat(F.lit("text "), (F.col("id") % 20_000).cast("string"), F.lit(".")).alias("text"), F.lit(False).alias("gone"))
    (r,) = R.repair_conversations(rows).collect()
    assert (r["duplicate"], r["cost"], r["audit"]) == (10_000, 30_000, "K" * 20_000 + "D" * 10_000)
