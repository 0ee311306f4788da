"""Exact top-k search by inner product (operator 2).

Queries and candidates are cut into tiles of bounded size. For every pair of a query tile and
a candidate tile one task computes the matrix product in blocks, selects each query's best k of
the tile, and the short lists are merged in a tree (``fan`` lists at a time). A tile pair is
found by an equi-join on (query tile, candidate tile): no cross join, nothing grows in one task.

Components are quantised to floor(256 * x). Products are exact: in double precision where
magnitudes allow (below 2**53), in Python integers for the rows beyond; scores outside a long
are set to its ends.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part,
nor do rows without vec_id; a shorter vector counts as padded with zeros; a query's own row is
no candidate, but another row with the same vec_id is; ties go to the smaller vec_id; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SCALE = 256.0
LONG = (-(2**63), 2**63 - 1)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Quantised vectors as rows of doubles (exact up to 2**53 in magnitude)."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return np.floor(out * SCALE)


def _integers(row: np.ndarray) -> list[int]:
    return [math.floor(float(x) * SCALE) if math.isfinite(float(x) * SCALE) else int(x) * int(SCALE) for x in row]


def tile_top(queries: pd.DataFrame, cands: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of a tile (vec_id, row_id, embedding) for each query (query_id,
    q_row, query)."""
    empty = pd.DataFrame({"q_row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
    if len(queries) == 0 or len(cands) == 0:
        return empty
    cands = cands.sort_values(["vec_id", "row_id"], ignore_index=True)
    width = max(int(cands["embedding"].map(len).max()), int(queries["query"].map(len).max()))
    c, q = _matrix(cands["embedding"], width), _matrix(queries["query"], width)
    limit = math.isqrt(2**53 // max(width, 1))
    c_big = np.flatnonzero(~(np.abs(c) <= limit).all(axis=1))
    q_big = ~(np.abs(q) <= limit).all(axis=1)
    where = pd.Series(np.arange(len(cands)), index=cands["row_id"])
    ids, out = cands["vec_id"].to_numpy(), []
    block = max(1, (1 << 22) // max(len(cands), 1))
    for lo in range(0, len(queries), block):
        part = queries.iloc[lo:lo + block]
        with np.errstate(all="ignore"):
            scores = q[lo:lo + block] @ c.T
        for i, (row, query_id) in enumerate(zip(part["q_row"], part["query_id"])):
            s = scores[i]
            own = where.get(row, -1)
            if q_big[lo + i] or len(c_big):
                s = s.astype(object)
                mine = _integers(part["query"].iloc[i])
                for j in range(len(s)) if q_big[lo + i] else c_big:
                    s[j] = sum(a * b for a, b in zip(mine, _integers(cands["embedding"].iloc[j])))
                best = sorted((j for j in range(len(s)) if j != own), key=lambda j: (-s[j], j))[:k]
            else:
                s = s.copy()
                if own >= 0:
                    s[own] = -np.inf
                m = min(k, len(s) - (own >= 0))
                if m == 0:
                    continue
                kth = np.partition(s, len(s) - m)[len(s) - m]
                over = np.flatnonzero(s > kth)
                best = np.concatenate([over[np.argsort(-s[over], kind="stable")], np.flatnonzero(s == kth)[:m - len(over)]])
            for j in best:
                out.append((row, query_id, ids[j], min(max(int(s[j]), LONG[0]), LONG[1])))
    return pd.DataFrame(out, columns=["q_row", "query_id", "vec_id", "score"]).astype("int64") if out else empty


def _best(k: int, group: list[str], lists: DataFrame) -> DataFrame:
    """Merge short lists: the k best rows of each group (a group is a few lists long)."""
    item = F.struct((-F.col("score").cast("decimal(20,0)")).alias("neg"), F.col("vec_id"), F.col("score"))
    best = F.slice(F.array_sort(F.collect_list(item)), 1, k)
    return lists.groupBy(*group).agg(best.alias("best"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, tile_rows: int = 16384, query_rows: int = 8192, fan: int = 32) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of every query row."""
    spark = vectors.sparkSession
    C.prepare(spark)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    rows = C.checkpointed(rows.withColumn("row_id", F.monotonically_increasing_id()))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("is_query", F.lit(False))).alias("q")).first()
    parts = C.shuffle_partitions(spark)
    tile = min(tile_rows, max(256, -(-size["n"] // parts)))  # small inputs still use every core
    n_tiles, n_blocks = max(1, -(-size["n"] // tile)), max(1, -(-size["q"] // query_rows))
    cands = rows.select("vec_id", "row_id", "embedding", F.pmod(F.xxhash64("row_id"), F.lit(n_tiles)).alias("tile"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    queries = rows.filter("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("row_id").alias("q_row"), F.col("embedding").alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long"))).alias("q_tile"),
        F.pmod(F.xxhash64(F.lit(1), "row_id"), F.lit(n_blocks)).cast("int").alias("q_block"))

    def solve(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = tile_top(q, c, k)
        out["tile"] = key[0]
        return out

    lists = queries.groupBy("q_tile", "q_block").cogroup(cands.groupBy("tile", "block")).applyInPandas(
        solve, "q_row long, query_id long, vec_id long, score long, tile long")
    while n_tiles > fan:  # each round merges up to `fan` lists of a query
        lists = _best(k, ["q_row", "query_id", "tile"], lists.withColumn("tile", F.floor(F.col("tile") / fan)))
        lists = lists.select("q_row", "query_id", "tile", F.inline("best")).drop("neg")
        n_tiles = -(-n_tiles // fan)
    final = _best(k, ["q_row", "query_id"], lists)
    return final.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
