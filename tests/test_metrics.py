"""Pinned metric values (hand-computed in the reference's tests) on literal frames."""

import math

import pytest

from evalspark.operators.evaluate import evaluate_suite
from evalspark.operators.metrics import overlap as O


def score(spark, rows, schema, metric, options=None, sub=None):
    df = spark.createDataFrame([("m", "t") + tuple(r) for r in rows], "model string, task string, " + schema)
    out = evaluate_suite(df, [{"name": metric, "options": options or {}}], persist=False).collect()
    vals = {r["sub_metric"]: r["score"] for r in out}
    return vals[sub if sub is not None else ""] if vals else None


def test_accuracy(spark):
    assert score(spark, [("A", "A"), ("B", "B"), ("C", "D")], "prediction string, label string", "accuracy") == pytest.approx(2 / 3)
    rows = list(zip([1, 2, 3, 1, 2, 3], [1, 2, 3, 1, 2, 4]))
    assert score(spark, rows, "prediction long, label long", "accuracy") == pytest.approx(5 / 6)
    assert score(spark, [("1", 1)], "prediction string, label long", "accuracy") == 0.0


@pytest.mark.parametrize("metric,p,l,avg,zd,expected", [
    ("precision", [1, 0, 1, 0], [1, 1, 0, 0], "binary", 0, 0.5),
    ("precision", [1, 1], [1, 0], "micro", 0, 0.5),
    ("precision", [0, 1], [0, 1], "macro", 0, 1.0),
    ("precision", [0, 0], [1, 1], "weighted", 0, 0.0),
    ("recall", [1, 0, 1, 0], [1, 1, 0, 0], "binary", 0, 0.5),
    ("recall", [1, 0], [1, 1], "micro", 0, 0.5),
    ("recall", [0, 1], [0, 1], "macro", 0, 1.0),
    ("f1_score", [1, 0, 1, 0], [1, 1, 0, 0], "binary", 0, 0.5),
    ("f1_score", [1, 0, 1, 0], [1, 1, 0, 0], "weighted", 0, 0.5),
    ("precision", [0, 0], [1, 1], "binary", 1, 1.0),
    ("precision", [0, 0], [1, 1], "binary", 0, 0.0),
    ("precision", [0, 1, 2], [0, 1, 1], "binary", 0, 0.0),
])
def test_prf(spark, metric, p, l, avg, zd, expected):
    got = score(spark, list(zip(p, l)), "prediction long, label long", metric, {"average": avg, "zero_division": zd})
    assert got == pytest.approx(expected)


def test_exact_match(spark):
    s = "prediction string, label string"
    assert score(spark, [("hello world", "hello world"), ("test", "Test")], s, "exact_match") == 0.5
    assert score(spark, [("Test, Test!", "test test")], s, "exact_match",
                 {"normalize": True, "ignore_case": True, "ignore_punct": True}) == 1.0
    assert score(spark, [("Test!", "test!")], s, "exact_match", {"normalize": True, "ignore_case": True}) == 1.0
    assert score(spark, [("Test, Test!", "Test Test")], s, "exact_match", {"normalize": True, "ignore_punct": True}) == 1.0
    assert score(spark, [("Hello", "hello"), ("Test!", "Test")], s, "exact_match", {"ignore_case": True}) == 0.0


def test_bleu(spark):
    s = "prediction string, label string"
    assert score(spark, [("a b c d", "a b c d")], s, "bleu") == pytest.approx(1.0)
    assert score(spark, [("completely different text", "nothing in common here")], s, "bleu") < 0.1
    b1 = score(spark, [("the cat sat on the mat", "the cat sat on the mat in the room")], s, "bleu", {"weights": (1, 0, 0, 0)})
    assert b1 == pytest.approx(math.exp(-0.5)) and 0.5 < b1 < 0.7
    u = score(spark, [("the cat is on the mat", "the cat sat on the mat")], s, "bleu", {"weights": (1,)})
    bi = score(spark, [("the cat is on the mat", "the cat sat on the mat")], s, "bleu", {"weights": (0.5, 0.5)})
    assert 0.6 < u < 0.9 and bi < u
    assert score(spark, [(None, "this is a string"), ("valid pred", "valid ref")], s, "bleu") > 0


def test_rouge(spark):
    s = "prediction string, label string"
    got = score(spark, [("the quick brown fox jumps", "the quick brown fox")], s, "rouge",
                {"metrics": ["rouge2"], "stats": ["p"]}, "rouge2_p")
    assert got == pytest.approx(0.75)
    assert score(spark, [("the quick brown fox", "the quick brown dog")], s, "rouge",
                 {"metrics": ["rouge1"], "stats": ["f"]}, "rouge1_f") > 0
    assert score(spark, [("hello world", "hello world")], s, "rouge", None, "rouge-l_f") == pytest.approx(1.0, abs=1e-6)
    assert score(spark, [("   ", "ref"), ("pred", "  ")], s, "rouge", None, "rouge-l_f") == 0.0
    df = spark.createDataFrame([("m", "t", "First one. Second two.", "First one. Another two.")],
                               "model string, task string, prediction string, label string")
    out = {r["sub_metric"] for r in O.metric_rouge(df, metrics=["rougeLsum"], stats=["f", "r"]).collect()}
    assert out == {"rougeLsum_f", "rougeLsum_r"}


def _table_lcs_words(x, y):
    """The words of the LCS that the full table gives: from the end, a match first, else up when
    that is longer, else left."""
    t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            t[i + 1][j + 1] = t[i][j] + 1 if x[i] == y[j] else max(t[i][j + 1], t[i + 1][j])
    out, i, j = [], len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            out.append(x[i - 1])
            i, j = i - 1, j - 1
        elif t[i - 1][j] > t[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def test_rouge_l_against_bruteforce(spark):
    """Exact LCS word sets against the full table, whose length an exhaustive search confirms."""
    import itertools
    import random
    import time

    def lcs_len(a, b):
        for k in range(len(a), 0, -1):
            for idx in itertools.combinations(range(len(a)), k):
                it = iter(b)
                if all(w in it for w in [a[i] for i in idx]):
                    return k
        return 0

    rnd = random.Random(3)
    vocab = "a b c d e".split()
    for _ in range(300):
        x = [rnd.choice(vocab) for _ in range(rnd.randint(0, 7))]
        y = [rnd.choice(vocab) for _ in range(rnd.randint(0, 7))]
        words = _table_lcs_words(x, y)
        assert len(words) == lcs_len(x, y)
        assert O._lcs_words(x, y) == set(words)
    for _ in range(20):
        x, y = ([rnd.choice(range(rnd.choice((3, 60)))) for _ in range(rnd.randint(60, 200))] for _ in range(2))
        assert O._lcs_words(x, y) == set(_table_lcs_words(x, y))
    x, y = ([str(rnd.randint(0, 500)) for _ in range(3000)] for _ in range(2))
    start = time.time()
    assert O._lcs_words(x, y)
    assert time.time() - start < 2  # a table of nine million cells took seven
    rows = [("m", "t", " ".join(rnd.choice(vocab) for _ in range(8)) + ". " + " ".join(rnd.choice(vocab) for _ in range(5)),
             " ".join(rnd.choice(vocab) for _ in range(7))) for _ in range(30)]
    df = spark.createDataFrame(rows, "model string, task string, prediction string, label string")
    got = O.metric_rouge(df, metrics=["rougeL"], stats=["f"]).collect()[0]["score"]
    want = 0.0
    for _, _, h, r in rows:
        union = set()
        for s in h.split("."):
            union |= set(_table_lcs_words(r.split(), s.split()))
        rec, prec = len(union) / len(set(r.split())), len(union) / len({w for s in h.split(".") for w in s.split()})
        want += 2 * rec * prec / (rec + prec + 1e-8) / len(rows)
    assert got == pytest.approx(want)


def corpus_bleu_of(pairs, method, weights=(0.25,) * 4):
    """Corpus BLEU with smoothing 5-7 by the published formulas, pair by pair in plain Python."""
    from collections import Counter

    def grams(t, n):
        return Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))

    def matched(h, r, n):
        a, b = grams(h, n), grams(r, n)
        return sum(min(c, b[g]) for g, c in a.items()), max(1, sum(a.values()))

    n = len(weights)
    num, den = [0] * n, [0] * n
    for h, r in pairs:
        for i in range(n):
            c, t = matched(h, r, i + 1)
            num[i], den[i] = num[i] + c, den[i] + t
    hyp, ref = sum(len(h) for h, _ in pairs), sum(len(r) for _, r in pairs)
    if not num[0]:
        return 0.0
    p = [a / b for a, b in zip(num, den)]
    last_h, last_r = pairs[-1]
    if method == "method7":
        k = 1
        for i in range(n):
            if num[i] == 0 and hyp > 1:
                p[i], k = 1 / (2 ** k * 5 / math.log(hyp)) / den[i], k + 1
    if method in ("method5", "method7"):
        c, t = matched(last_h, last_r, 5)
        after, before = [*p[1:], c / t], p[0] + 1
        for i in range(n):
            before = p[i] = (before + p[i] + after[i]) / 3
    else:
        if not p[2]:
            return 0.0
        for i in range(2, n):
            guess = 0 if p[i - 2] == 0 else p[i - 1] ** 2 / p[i - 2]
            p[i] = (num[i] + 5 * guess) / (max(0, len(last_h) - i) + 5)
    if min(p) <= 0:
        return 0.0
    return (1.0 if hyp > ref else math.exp(1 - ref / hyp)) * math.exp(sum(w * math.log(x) for w, x in zip(weights, p)))


BLEU_PAIRS = [("the cat sat on the mat today", "the cat sat on the red mat"), ("a dog ran", "the dog ran off"), ("one two three four five six", "one two three four five seven")]


#: The example pair of the BLEU library's documentation, with the values given there.
GUIDE = ("It is a guide to action which ensures that the military always obeys the commands of the party",
         "It is a guide to action that ensures that the military will forever heed Party commands")


@pytest.mark.parametrize("method,published", [("method5", 0.4905), ("method6", 0.4135), ("method7", 0.4905)])
def test_bleu_smoothing_that_reads_the_last_pair(spark, method, published):
    one = spark.createDataFrame([("m", "t", 1, *GUIDE)], "model string, task string, k long, prediction string, label string")
    assert O.metric_bleu(one, smoothing=method, order="k").first()["score"] == pytest.approx(published, abs=1e-4)
    df = spark.createDataFrame([("m", "t", k, h, r) for k, (h, r) in enumerate(BLEU_PAIRS)], "model string, task string, k long, prediction string, label string")
    got = O.metric_bleu(df.repartition(3), smoothing=method, order=["k"]).first()["score"]
    assert got == pytest.approx(corpus_bleu_of([(h.split(), r.split()) for h, r in BLEU_PAIRS], method), abs=1e-12)
    backwards = O.metric_bleu(df.withColumn("k", -df["k"]), smoothing=method, order=["k"]).first()["score"]
    assert backwards == pytest.approx(corpus_bleu_of([(h.split(), r.split()) for h, r in BLEU_PAIRS[::-1]], method), abs=1e-12) and backwards != got


@pytest.mark.parametrize("method", ["method5", "method6", "method7"])
def test_bleu_smoothing_without_matches_or_order(spark, method):
    pairs = [("a b c d e", "a x c y e"), ("q", "q")]
    df = spark.createDataFrame([("m", "t", k, h, r) for k, (h, r) in enumerate(pairs)], "model string, task string, k long, prediction string, label string")
    want = corpus_bleu_of([(h.split(), r.split()) for h, r in pairs], method)
    assert O.metric_bleu(df, smoothing=method, order=["k"]).first()["score"] == pytest.approx(want, abs=1e-12)
    with pytest.raises(ValueError, match="order"):
        O.metric_bleu(df, smoothing=method)


def test_perplexity(spark):
    s = "prediction double, label string"
    assert score(spark, [(-1.0, None), (-2.0, None), (-3.0, None)], s, "perplexity") == pytest.approx(math.exp(2))
    assert score(spark, [(0.0, None)], s, "perplexity") == pytest.approx(1.0)


def test_jaccard(spark):
    s = "prediction string, label string"
    assert score(spark, [("apple banana orange", "apple orange grape")], s, "jaccard", {"normalize": True}) == 0.5
    assert score(spark, [("the cat sat", "the cat sat on mat")], s, "jaccard", {"ngram": 2}) == 0.5
    assert score(spark, [("apple", "orange"), ("", ""), ("a", "")], s, "jaccard") == 0.0


def test_similarity(spark):
    s = "prediction array<double>, label array<double>"
    d = math.dist([0.1, 0.2], [0.8, 0.9])
    assert score(spark, [([0.1, 0.2], [0.8, 0.9])], s, "semantic_similarity", {"metric_type": "euclidean"}) == pytest.approx(1 / (1 + d))
    assert score(spark, [([0.1, 0.2], [0.8, 0.9])], s, "semantic_similarity", {"metric_type": "dot"}) == pytest.approx(0.26)
    assert score(spark, [([0.1, 0.2], [0.8, 0.9])], s, "semantic_similarity", {"metric_type": "nope"}) == 0.0
    assert score(spark, [([0.1, 0.2, 0.3], [0.12, 0.22, 0.32])], s, "semantic_similarity") > 0.9


def test_distinct_entropy(spark):
    s = "prediction string, label string"
    rows = [("a b c", None), ("a b c d", None), ("x y z", None)]
    assert score(spark, rows, s, "distinct_ngram", None, "distinct_1") == pytest.approx(7 / 10)
    assert score(spark, rows, s, "distinct_ngram", None, "distinct_2") == pytest.approx(5 / 7)
    assert score(spark, [("a b", None), ("c", None)], s, "distinct_ngram", {"ngrams": [1, 2, 3]}, "distinct_3") == 0.0
    assert score(spark, [("a a b b", None), ("a c", None)], s, "word_entropy") == pytest.approx(1.4591, abs=1e-4)
    assert score(spark, [("test", None), ("", None), ("test test test", None)], s, "word_entropy") == 0.0


def test_correlation(spark):
    s = "prediction double, label double"
    rows = list(zip([1.0, 2.0, 3.0, 4.0, 5.0], [1.1, 2.2, 2.8, 4.1, 5.3]))
    assert score(spark, rows, s, "pearson") > 0.9
    assert score(spark, list(zip([1.0, 2.0, 3.0, 4.0, 5.0], [5.0, 4.0, 3.0, 2.0, 1.0])), s, "spearman") < -0.9
    assert score(spark, [(1.0, 2.0)], s, "pearson") == 0.0
    assert score(spark, [("a", "1"), ("2", "3")], "prediction string, label string", "pearson") == 0.0
    assert score(spark, [(1.0, 1.0), (1.0, 2.0)], s, "pearson") == 0.0


def test_novelty_and_custom(spark):
    from evalspark.functions import postprocess as X

    df = spark.createDataFrame([("m", "t", "the cat sat on the mat", "the cat was on the mat"),
                                ("m", "t", "a new sentence with new words", None)],
                               "model string, task string, prediction string, label string")
    c = X.apply_post(df, "creative")
    out = evaluate_suite(c, ["novelty"], persist=False).collect()[0]
    assert out["score"] == pytest.approx(0.7)
    kw = spark.createDataFrame([("m", "t", "Hello World", None), ("m", "t", "nothing", None)],
                               "model string, task string, prediction string, label string")
    res = {r["sub_metric"]: r["score"] for r in evaluate_suite(
        kw, [{"name": "keyword_match", "options": {"keywords_to_match": ["world"]}}], persist=False).collect()}
    assert res == {"keyword_match_count": 1.0, "keyword_match_ratio": 0.5}


def test_invariance_under_repartition(spark):
    import __spark_entry__ as E

    q = E.queries()["metric_word_entropy"]
    a = sorted(q(spark, "/root/testdata/sf0.001").collect())
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    b = sorted(q(spark, "/root/testdata/sf0.001").collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_meteor_stems_and_published_value(spark):
    from evalspark.functions.porter import stem
    from evalspark.operators.metrics.meteor import meteor_pair

    for word, want in {"caresses": "caress", "ponies": "poni", "dies": "die", "agreed": "agre", "hopping": "hop", "filing": "file", "relational": "relat",
                       "vietnamization": "vietnam", "sensibiliti": "sensibl", "electriciti": "electr", "adoption": "adopt", "bowdlerize": "bowdler",
                       "controll": "control", "rate": "rate", "cease": "ceas", "sky": "sky"}.items():
        assert stem(word) == want
    hyp = "It is a guide to action which ensures that the military always obeys the commands of the party".split()
    ref = "It is a guide to action that ensures that the military will forever heed Party commands".split()
    assert meteor_pair(hyp, ref) == pytest.approx(0.6944, abs=1e-4)
    assert meteor_pair(["cats", "running"], ["cat", "runs"]) == pytest.approx(1 - 0.5 * 0.5**3)
    assert meteor_pair(["cats"], ["cat"], stem=None) == 0.0
    s = "prediction string, label string"
    assert score(spark, [("the cats were running", "the cat was running")], s, "meteor") > 0.5


def full_table_lcs_words(x, y):
    """The same reconstruction from a full table of lengths."""
    t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            t[i + 1][j + 1] = t[i][j] + 1 if a == b else max(t[i][j + 1], t[i + 1][j])
    out, i, j = set(), len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            out.add(x[i - 1])
            i, j = i - 1, j - 1
        elif t[i - 1][j] > t[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def test_lcs_by_kept_rows_equals_the_full_table(monkeypatch):
    import random

    rng = random.Random(8)
    for _ in range(400):
        x, y = ([rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(0, 40))] for _ in range(2))
        monkeypatch.setattr(O, "MASK_BYTES", rng.choice([1, 1 << 20]))  # few masks kept, or all
        assert O._lcs_words(x, y) == full_table_lcs_words(x, y), (x, y)


def test_lcs_of_a_long_pair_stays_small():
    """Two texts of 60,000 words without a full stop: all rows would take 450 MB."""
    import random
    import tracemalloc

    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    x, y = ([rng.choice(words) for _ in range(60_000)] for _ in range(2))
    tracemalloc.start()
    found = O._lcs_words(x, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 120_000_000


def token_pairs(spark, rows):
    return spark.createDataFrame([("m", "t", i, *r) for i, r in enumerate(rows)], "model string, task string, item_id long, prediction array<array<double>>, "
                                 "label array<array<double>>, prediction_tokens array<string>, label_tokens array<string>")


def test_token_match_with_idf(spark):
    from evalspark.operators.metrics import vectors as Ve

    a, b, c = [1.0, 0.0], [0.0, 1.0], [0.6, 0.8]
    rows = [([a, c], [a, b], ["a", "c"], ["a", "b"]), ([b], [b], ["b"], ["b"]), ([a], [c, b], ["a"], ["c", "b"])]
    got = {r["sub_metric"]: r["score"] for r in Ve.metric_token_match(token_pairs(spark, rows), idf=True).collect()}
    ia = ic = math.log(4 / 2)
    ib = math.log(4 / 4)  # in every label: weighs nothing
    p = [(ia * 1 + ic * 0.8) / (ia + ic), 0.0, 0.6]
    r = [(ia * 1 + ib * 0.8) / (ia + ib), 0.0, (ic * 0.6 + ib * 0.0) / (ic + ib)]
    f = [2 * x * y / (x + y) if x + y else 0.0 for x, y in zip(p, r)]
    assert got == pytest.approx({"bertscore_precision": sum(p) / 3, "bertscore_recall": sum(r) / 3, "bertscore_f1": sum(f) / 3})
    table = {x["token"]: x["idf"] for x in Ve.idf_table(token_pairs(spark, rows), ["model", "task"], "label_tokens").collect()}
    assert table == pytest.approx({"a": ia, "b": ib, "c": ic, None: math.log(4)})
    plain = {r["sub_metric"]: r["score"] for r in Ve.metric_token_match(token_pairs(spark, rows)).collect()}
    assert plain["bertscore_precision"] == pytest.approx((0.9 + 1 + 0.6) / 3)


def plain_meteor_synonyms(hyp, ref, synonyms):
    """The synonym stage by trying every pair of remaining words."""
    h, r, out = list(enumerate(hyp)), list(enumerate(ref)), []
    for i in range(len(h))[::-1]:
        for j in range(len(r))[::-1]:
            if r[j][1] in {h[i][1], *synonyms.get(h[i][1], ())}:
                out.append((h[i][0], r[j][0]))
                h.pop(i)
                r.pop(j)
                break
    return sorted(out)


def test_meteor_synonyms(spark):
    import random
    import time

    from evalspark.operators.metrics import meteor as Me

    rng = random.Random(5)
    for _ in range(200):
        words = "abcdefgh"
        synonyms = {w: {x for x in words if rng.random() < 0.3} for w in words}
        hyp, ref = ([rng.choice(words) for _ in range(rng.randint(0, 15))] for _ in range(2))
        assert sorted(Me._align_synonyms(list(enumerate(hyp)), list(enumerate(ref)), synonyms)) == plain_meteor_synonyms(hyp, ref, synonyms)

    rows = [(1, "the quick car stopped", "the fast automobile stopped"), (2, "a big dog", "a large cat"), (3, "none here", "other words"), (4, "", "x")]
    df = spark.createDataFrame([("m", "t", *r) for r in rows], "model string, task string, item_id long, prediction string, label string")
    table = spark.createDataFrame([("Quick", "fast"), ("car", "automobile"), ("big", "large"), ("car", "automobile"), ("here", "absent")], "word string, synonym string")
    # pair 1: four matches in one chunk; pair 2: two of three words, one chunk; pairs 3 and 4: none
    one = (1 - 0.5 * (1 / 4) ** 3) * 1.0
    two = (1 - 0.5 * (1 / 2) ** 3) * (2 / 3)
    for given in (table, {"quick": ["fast"], "car": ["automobile"], "big": ["large"]}):
        assert Me.metric_meteor(df, synonyms=given).first()["score"] == pytest.approx((one + two) / 4)
    assert evaluate_suite(df, [{"name": "meteor", "options": {"synonyms": table}}], persist=False).first()["score"] == pytest.approx((one + two) / 4)
    links = {r["item_id"]: sorted(map(tuple, r[Me.LINKS] or [])) for r in Me.with_synonyms(df, ["model", "task"], "item_id", "prediction", "label", table).collect()}
    assert links == {1: [("car", "automobile"), ("quick", "fast")], 2: [("big", "large")], 3: [], 4: []}

    n = 20_000
    hyp, ref = [f"h{i % 3000}" for i in range(n)], [f"r{i % 3000}" for i in range(n)]
    began = time.time()
    Me.meteor_pair(hyp, ref, stem=None, synonyms={f"h{i}": {f"r{i}", f"r{i + 1}"} for i in range(3000)})
    assert time.time() - began < 1


def test_rouge_n_intersects_the_grams_once(spark):
    """The plan names the intersection once per order, and texts of repeated words score right."""
    from pyspark.sql import functions as F

    from evalspark.operators.metrics import overlap as O

    df = spark.createDataFrame([("m", "t", "a b b c. d", "b a x. d e")], "model string, task string, prediction string, label string")
    out = O.metric_rouge(df, metrics=("rouge1",), stats=("p", "r", "f"))
    stages, _, _ = O.rouge_parts(metrics=("rouge1",), stats=("f",))
    one = df.withColumns(stages[0]).select(stages[1]["_r1"].alias("x"))
    assert one._jdf.queryExecution().analyzed().toString().count("array_intersect(") == 1
    got = {r.sub_metric: r.score for r in out.where(F.col("metric") == "rouge").collect()}
    assert got == pytest.approx({"rouge1_p": 3 / 4, "rouge1_r": 3 / 5, "rouge1_f": 2 * 0.45 / (1.35 + 1e-8)})


@pytest.mark.parametrize("xs,ys", [(3, 2), (1, 50), (400, 3), (1000, 1000), (7, 10**6)])
def test_spearman_with_ties_across_buckets(spark, xs, ys):
    """Average ranks where a frequent value fills several range buckets, against ranks by pandas."""
    import random

    import pandas as pd

    from evalspark.operators.metrics.corpus import metric_spearman

    rnd = random.Random(xs + ys)
    rows = [(rnd.choice("ab"), "t", float(int(xs * rnd.random() ** 2)), float(int(ys * rnd.random() ** 3)) + k % 3) for k in range(3000)]
    got = {r["model"]: r["score"] for r in metric_spearman(spark.createDataFrame(rows, "model string, task string, prediction double, label double").repartition(5)).collect()}
    d = pd.DataFrame(rows, columns=["m", "t", "x", "y"])
    for m, g in d.groupby("m"):
        want = g.x.rank().corr(g.y.rank()) if g.x.nunique() > 1 else 0.0
        assert got[m] == pytest.approx(want, abs=1e-9)


def test_spearman_joins_no_ranks_back(spark):
    """Every row is placed once by x and once by y; ranks are not joined back to the rows."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from evalspark.operators.metrics.corpus import metric_spearman

    df = spark.range(100).select(F.lit("m").alias("model"), F.lit("t").alias("task"), F.rand(1).alias("prediction"), F.rand(2).alias("label"))
    with contextlib.redirect_stdout(io.StringIO()) as text:
        metric_spearman(df).explain()
    assert "Window" in text.getvalue() and "Join" not in text.getvalue()
