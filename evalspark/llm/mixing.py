"""Mixing sources to target weights by a low-discrepancy schedule (operator 8, native).

* Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
  ``share`` times all words; no target exceeds ``cap`` times its source (water filling).
* Blocks: the documents of a source, in the order of a hash, form a stream of words, read up
  to ``cap`` times round; it is cut into blocks of equally many words.
* Schedule: slot n of the mix goes to the source in whose interval of the cumulative target
  weights the point frac(n * golden ratio) falls. The r-th slot of a source takes its r-th
  block, until the target is reached. So every stretch of the schedule mixes the sources close
  to their weights, and reruns agree. A source that the points hit too seldom (its target may be
  far below a block) gets further slots for the blocks left, spread over the schedule after its
  last point; these share the number of another slot, and (slot, sid) orders the mix. So every
  source reaches its target to the word.

Only DataFrame operations. No window spans a source: positions in a source's stream and ranks
of its slots come from totals per (source, bucket), a running sum of these, and a window inside
each bucket. The number of slots is about ``slots`` whatever the size of the corpus; the block
size follows from it.

Defined cases: a null or empty text has size 0 and taken 0; null source is a source of its own;
null and repeated doc_ids and repeated rows are documents like any other; other columns are
carried by :func:`mixed_documents` and ignored elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
CELLS = 4096
CHUNK = 4096
MAX_BUCKETS = 65536
BUCKET_ROWS = 512


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: source, sid (its rank), source_size, target.

    Water filling: sources in order of cap / weight; one is held at its cap if the words left
    by those before it, dealt by weight, reach its cap; the rest share by weight."""
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.asc_nulls_last("source"))
    filled = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(ordered).cast("long") - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("cap") / F.col("w"))
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))
    weight_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filled), F.lit(0.0))
    s = s.withColumn("level", left / weight_left)
    free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "sid", "level"))).over(everything)
    return s.withColumn("free", free).select(
        "source", "sid", "source_size", F.when(F.col("free").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("free.level") * F.col("w"))).alias("target"))


def stream_positions(sized: DataFrame, rows: int) -> DataFrame:
    """``sized`` (sid, h, size, ...) plus bucket, place (unique in sid and bucket) and at, the
    word position at which a document starts in its source's stream."""
    buckets = min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS)))))
    d = sized.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words")).select(
        "sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "text_hash")
    d = d.withColumn("place", F.row_number().over(inside)).withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return d.join(totals, ["sid", "bucket"]).withColumn("at", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto")


def slot_schedule(targets: DataFrame, block: int) -> DataFrame:
    """The mix as slots: slot, sid, block (its number in the source's stream)."""
    spark = targets.sparkSession
    everything = Window.partitionBy()
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    t = targets.withColumn("quota", F.ceil(F.col("target") / block)).withColumn("all", F.sum("target").over(everything))
    t = t.filter("target > 0").withColumn("hi", F.sum("target").over(upto) / F.col("all")).withColumn("lo", F.col("hi") - F.col("target") / F.col("all"))
    need = t.agg(F.sum("quota").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    n_slots = int(need["n"] or 0) + 16 * need["sources"] + 256  # a margin for the points' discrepancy
    # sources meet slots in cells of the unit interval: an equi-join, then the exact bounds
    ends = Window.orderBy("sid")
    t = t.withColumn("hi", F.when(F.lead("sid").over(ends).isNull(), F.lit(1.0)).otherwise(F.col("hi"))).withColumn("lo", F.coalesce(F.lag("hi").over(ends), F.lit(0.0)))
    cells = t.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))))).select("sid", "lo", "hi", "quota", "cell")
    point = F.col("slot") * F.lit(GOLDEN)
    slots = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("u", point - F.floor(point)).withColumn("cell", F.floor(F.col("u") * CELLS))
    dealt = slots.join(cells, "cell").filter("u >= lo and u < hi").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = dealt.withColumn("r", F.row_number().over(inside)).join(totals, ["sid", "chunk"])
    hit = ranked.withColumn("block", F.col("base") + F.col("r") - 1).filter("block < quota").select("slot", "sid", "block")
    # the blocks without a slot, some few a source: both numbers below rise from block to block
    got = dealt.groupBy("sid").agg(F.count(F.lit(1)).alias("got"), F.max("slot").alias("last"))
    short = t.select("sid", "quota").join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < quota")
    missed = short.withColumn("block", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)))
    phase = (F.col("sid") + 1) * F.lit(GOLDEN)
    even = F.floor((F.col("block") + phase - F.floor(phase)) * F.lit(float(need["n"] or 0)) / F.col("quota"))
    after = F.coalesce("last", F.lit(-1)) + 1 + F.col("block") - F.col("got")
    return hit.union(missed.select(F.greatest(even, after).alias("slot"), "sid", "block"))


def mix_pieces(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2, slots: int = 1 << 21, seed: int = 17) -> DataFrame:
    """The mix: for every document and block of its source's stream one row with doc_id,
    text_hash, size, source_size, target, sid, bucket, place (these three name a row of the
    input), round (0: first reading), start (word), n_words, slot (null: not in the mix)."""
    C.prepare(docs.sparkSession)
    # hex of bytes keeps null, empty text and equal texts apart as the hash's seed values do
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64(F.col("text")).alias("text_hash")).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
    sized = C.checkpointed(sized)
    targets = C.checkpointed(source_targets(sized, weights, share, cap))
    facts = targets.agg(F.sum("target").alias("target"), F.count(F.lit(1)).alias("sources")).first()
    rows = sized.count()
    block = max(32, math.ceil((facts["target"] or 0) / slots))
    known = C.join_small(sized.withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit(""))),
                         targets.withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit(""))),
                         ["source", "no_source"], "inner", facts["sources"]).drop("source", "no_source")
    placed = stream_positions(known, rows)
    end = F.floor("target")  # the stream is read up to here
    rounds = placed.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))).withColumn("at", F.col("at") + F.col("round") * F.col("source_size"))
    rounds = rounds.filter((F.col("round") == 0) | (F.col("at") < end))
    last = F.floor((F.col("at") + F.greatest("size", F.lit(1)) - 1) / block)
    pieces = rounds.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), last)))
    lo = F.greatest(F.col("at"), F.col("block") * block)
    hi = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block, end)
    pieces = pieces.withColumn("start", lo - F.col("at")).withColumn("n_words", F.greatest(hi - lo, F.lit(0)))
    plan = slot_schedule(targets, block)
    return pieces.join(plan, ["sid", "block"], "left").select(
        "doc_id", "text_hash", "size", "source_size", "target", "sid", "bucket", "place", "round", "start", "n_words", "slot")


def taken_words(pieces: DataFrame) -> DataFrame:
    """Words of each document in the mix: doc_id, size, source_size, target, taken."""
    used = F.when(F.col("slot").isNotNull(), F.col("n_words")).otherwise(F.lit(0))
    return (pieces.groupBy("sid", "bucket", "place", "doc_id", "size", "source_size", "target")
            .agg(F.sum(used).cast("long").alias("taken")).select("doc_id", "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, same columns: one row per document and reading, its text
    whole, or the words taken when the mix ends inside it."""
    pieces = mix_pieces(docs, **options).filter("slot is not null and n_words > 0")
    reads = pieces.groupBy("sid", "bucket", "place", "doc_id", "text_hash", "size", "round").agg(
        F.min("start").alias("start"), F.sum("n_words").alias("n_words"))
    # equal rows of (doc_id, text) hold equal text: one copy of the text serves all of them
    wide, own = C.set_apart(docs)
    doc_id, text = F.col(own["doc_id"]), F.col(own["text"])
    keyed = wide.withColumns({"__id": doc_id.cast("long"), "__hash": F.xxhash64(text)})
    same = Window.partitionBy("__id", "__hash").orderBy(*[F.col(c) for n, c in own.items() if n not in ("doc_id", "text")] or [F.lit(0)])
    keyed = keyed.withColumn("__copy", F.row_number().over(same))
    nth = Window.partitionBy("doc_id", "text_hash", "round").orderBy("sid", "bucket", "place")
    reads = reads.withColumn("copy", F.row_number().over(nth))
    joined = keyed.join(reads.select(F.col("doc_id").alias("r_id"), "text_hash", "copy", "size", "start", "n_words"),
                        F.col("__id").eqNullSafe(F.col("r_id")) & (F.col("__hash") == F.col("text_hash")) & (F.col("__copy") == F.col("copy")))
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(C.WORD), F.lit(0)), (F.col("start") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return C.put_back(joined.withColumn(own["text"], F.when(F.col("n_words") == F.col("size"), text).otherwise(words)), own)
