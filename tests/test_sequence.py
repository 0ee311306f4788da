"""Entities by scheme against a token-by-token reader, in the row and over long rows."""

import random

import pytest
from pyspark.sql import functions as F

from evalspark.operators.evaluate import evaluate_suite
from evalspark.operators.metrics import sequence as Sq

LISTS = "model string, task string, item_id int, label array<string>, prediction array<string>"


def hit(patterns, pp, pt, p, t):
    return any(pp in b and p in n and (r == "any" or (r == "same") == (pt == t)) for b, n, r in patterns)


def strict_entities(tags, scheme):
    """Start at a tag that may start, go on while tags are inside, count if the next one ends it."""
    ext = [*[(x[0], x[1:].strip("-") or "_") for x in tags], ("O", "_")]
    out, i, prev = [], 0, ("O", "_")
    while i < len(ext):
        if hit(scheme.start, *prev, *ext[i]):
            j = i + 1
            while j < len(ext) and hit(scheme.inside, *ext[j - 1], *ext[j]):
                j += 1
            if hit(scheme.end, *ext[j - 1], *ext[j]):
                out.append(f"{i}:{j - 1}:{ext[i][1]}")
            i = j
        else:
            i += 1
        prev = ext[i - 1]
    return out


def lenient_entities(tags):
    out, pt, ptype, begin = [], "O", "", 0
    for i, tag in enumerate([*tags, "O"]):
        t, ty = tag[0], tag[1:].split("-", 1)[-1] or "_"
        if pt in "ES" or (pt in "BI" and t in "BSO") or (pt not in "O." and ptype != ty):
            out.append(f"{begin}:{i - 1}:{ptype}")
        if t in "BS" or (pt in "ESO" and t in "EI") or (t not in "O." and ptype != ty):
            begin = i
        pt, ptype = t, ty
    return out


PINNED = {  # tags, entities of each scheme that allows the tags
    "IOB1": [(["I-X", "I-X", "B-X", "I-X", "O", "I-Y"], ["0:1:X", "2:3:X", "5:5:Y"]), (["B-X", "I-X"], ["1:1:X"])],
    "IOB2": [(["B-X", "I-X", "O", "I-X", "B-Y"], ["0:1:X", "4:4:Y"]), (["I-X", "I-X"], [])],
    "IOE1": [(["I-X", "E-X", "I-X", "O"], ["0:1:X", "2:2:X"]), (["I-X", "I-Y", "O"], ["0:0:X", "1:1:Y"])],
    "IOE2": [(["I-X", "E-X", "E-X", "I-Y", "O"], ["0:1:X", "2:2:X"]), (["I-X", "I-X"], [])],
    "IOBES": [(["B-X", "E-X", "S-Y", "B-X", "I-X", "O"], ["0:1:X", "2:2:Y"]), (["I-X", "E-X"], [])],
    "BILOU": [(["B-X", "I-X", "L-X", "U-Y", "L-X"], ["0:2:X", "3:3:Y"]), (["B-X", "L-Y"], [])],
}


@pytest.mark.parametrize("name", Sq.SCHEMES)
def test_pinned_entities(spark, name):
    scheme = Sq.SCHEMES[name]
    for tags, want in PINNED[name]:
        assert strict_entities(tags, scheme) == want
    df = spark.createDataFrame([(t,) for t, _ in PINNED[name]], "t array<string>").coalesce(1)
    assert [r[0] for r in df.select(Sq.entities(F.col("t"), scheme)).collect()] == [w for _, w in PINNED[name]]


@pytest.mark.parametrize("name", [*Sq.SCHEMES, "lenient"])
def test_rows_and_lists_agree_with_the_reader(spark, name):
    rng, scheme = random.Random(name), Sq.SCHEMES.get(name, Sq.LENIENT)

    def tag():
        p = rng.choice(scheme.allowed or "IOBES")
        return "O" if p == "O" else f"{p}-{rng.choice('XY')}"

    label = [[tag() for _ in range(rng.randint(0, 9))] for _ in range(150)]
    pred = [[tag() if rng.random() < 0.4 else x for x in s] for s in label]
    df = spark.createDataFrame([("m", "t", i, *x) for i, x in enumerate(zip(label, pred))], LISTS)
    got = {r[0]: r[1] for r in df.select("item_id", Sq.entities(F.col("label"), scheme)).collect()}
    for i, s in enumerate(label):
        assert got[i] == (strict_entities(s, scheme) if scheme.allowed else lenient_entities(s)), s
    want = sorted(map(tuple, Sq.counts_of_lists(df, ["model", "task"], "label", "prediction", scheme).collect()), key=str)
    long = Sq.from_arrays(df, ["model", "task"], "item_id", "label", "prediction")
    for block in (1, 3, Sq.BLOCK):  # entities across the edges of blocks
        rows = Sq.counts_of_rows(long, ["model", "task"], "item_id", "pos", "label", "prediction", scheme, block)
        assert sorted(map(tuple, rows.collect()), key=str) == want


def test_unknown_tags_and_averages_give_zeros_and_an_error(spark):
    df = spark.createDataFrame([("m", "t", 0, ["B-X", "L-X"], ["B-X", "L-X"]), ("m", "u", 1, ["B-X"], ["B-X"]), ("m", "v", 2, [], None)], LISTS)
    for rows in (df, Sq.from_arrays(df.where("task <> 'v'"), ["model", "task"], "item_id", "label", "prediction")):
        got = {(r["task"], r["sub_metric"]): r["score"] for r in Sq.metric_sequence_labeling(rows, mode="strict", scheme="IOB2").collect()}
        assert got[("t", "overall_f1")] == 0.0 and ("t", "error") in got
        assert got[("u", "overall_f1")] == 1.0 and ("u", "error") not in got
    lenient = {(r["task"], r["sub_metric"]): r["score"] for r in Sq.metric_sequence_labeling(df).collect()}
    assert lenient[("v", "overall_f1")] == 0.0
    with pytest.raises(ValueError):
        Sq.metric_sequence_labeling(df, mode="strict", scheme="nope")


def test_suite_takes_tag_lists_and_a_long_sequence_is_linear(spark):
    n = 60_000
    tags = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i % 3 == 0, "B-X").when(i % 3 == 1, "I-X").otherwise("O"))
    df = spark.range(1).select(F.lit("m").alias("model"), F.lit("t").alias("task"), F.col("id").alias("item_id"), tags.alias("label"), tags.alias("prediction"))
    got = {r["sub_metric"]: r["score"] for r in evaluate_suite(df, [{"name": "seqeval", "options": {"mode": "strict", "scheme": "IOB2"}}], persist=False).collect()}
    assert got == {"overall_precision": 1.0, "overall_recall": 1.0, "overall_f1": 1.0}
    (row,) = [r for r in Sq.counts_of_lists(df, ["model"], "label", "prediction", Sq.SCHEMES["IOB2"]).collect() if r["type"]]
    assert row["tp"] == n // 3


@pytest.mark.parametrize("name", ["lenient", *Sq.SCHEMES])
def test_flags_of_values_equal_those_of_columns(spark, name):
    """The lists read a pair of tags as values, the long rows as columns; null tags included."""
    scheme = Sq.SCHEMES.get(name, Sq.LENIENT)
    tags = [*[f"{p}{rest}" for p in "BIOESLU." for rest in ("", "-P", "-Q")], "B-P-Q", "-", "", "B--", None]
    got = spark.createDataFrame([(a, b) for a in tags for b in tags], "a string, b string")
    read = [(Sq._prefix(F.col(c)), scheme.type_of(F.col(c))) for c in "ab"]
    got = got.select("a", "b", *[f.alias(n) for f, n in zip(scheme.flags(*read[0], *read[1]), "sie")])

    def value(tag):
        return (None, "_") if tag is None else (tag[:1], scheme.type_in(tag))

    for r in got.collect():
        assert (r.s, r.i, r.e) == scheme.flags_in(*value(r.a), *value(r.b)), (r.a, r.b)


def test_lists_are_cut_by_batches_not_by_functions_per_tag(spark):
    df = spark.createDataFrame([("m", "t", 1, ["B-P", None], ["B-P", "O"]), ("m", "t", 2, None, [])], LISTS)
    counts = Sq.counts_of_lists(df, ["model", "task"], "label", "prediction", Sq.SCHEMES["IOB2"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("ArrowEvalPython") == 1
    rows = {r["type"]: (r.tp, r.n_true, r.n_pred, r.bad) for r in counts.collect()}
    assert rows[None] == (0, 0, 0, True) and rows["P"][2] == 1
