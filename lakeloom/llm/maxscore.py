"""Exact top-k by inner product with MaxScore over signed integer components.

A dimension is a term; a vector's non-zero components are its postings, and in
a shard every term has the bound ``max(q * lowest, q * highest, 0)`` on what it
can add to a query's score.  Per query the terms are split: the largest set of
smallest bounds that together stay below a share of the threshold (the k-th
best score so far) is non-essential, the rest is essential.  Essential postings
are traversed for all rows of a chunk (one matrix product, the non-essential
terms set to zero); a row whose partial score plus the non-essential bounds
cannot reach the threshold is dropped, the others are probed for their exact
score.  The first chunk of a shard has no threshold, so all its terms are
essential.  Every shard hands on at most k rows a query; a window per query
merges them.

Plan: vectors are packed into shards (blocks of about ``SHARD`` rows) and query
blocks, both bounded; each shard is paired with each query block by an equi-join
on the block number, and one task works through the pairs of its partition.
Nothing is broadcast or collected.  The threshold carries over from shard to
shard of one query block within a task.

Defined cases: vectors that are NULL or hold NULL, NaN or infinite components,
and rows without an id, take no part; a missing dimension counts as zero; rows
that share an id are rows of their own (each query row gets its own list, only
the row itself is left out); equal scores go to the smaller id; fewer than k candidates are all returned; empty tables give no rows; other
columns are ignored.  Scores are exact in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.store import written

#: Rows of a shard and of a query block, and rows taken at a time.
SHARD, QUERIES, CHUNK = 8192, 1024, 1024
#: The share of the threshold that the non-essential bounds may add up to.
SLACK = 0.25


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """``id, v``: floor(scale * x) per component, usable rows only."""
    x = F.col(vec_col).cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~odd)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _packed(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of about ``size`` vectors: ``name, ids, rows, dims, data`` (row-major int64)."""
    n = max(1, -(-vectors.count() // size))

    def pack(key, pdf):
        pdf = pdf.sort_values(["id", "row"])
        m = np.zeros((len(pdf), max(map(len, pdf["v"]))), np.int64)
        for row, v in zip(m, pdf["v"]):
            row[:len(v)] = v
        return pd.DataFrame({name: [key[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "rows": [pdf["row"].to_numpy(np.int64).tobytes()],
                             "dims": [m.shape[1]], "data": [m.tobytes()]})

    return (vectors.groupBy(F.pmod(F.xxhash64("row"), F.lit(n)).alias(name))
            .applyInPandas(pack, f"{name} long, ids binary, rows binary, dims long, data binary"))


def _matrix(dims: int, data: bytes, width: int) -> np.ndarray:
    own = np.frombuffer(data, np.int64).reshape(-1, dims)
    return own if dims == width else np.pad(own, ((0, 0), (0, width - dims)))


def _essential(q: np.ndarray, x: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which terms are essential (queries x terms), and the sum of the other
    terms' bounds per query."""
    bound = np.maximum(np.maximum(q * x.min(0), q * x.max(0)), 0)
    order = np.argsort(bound, axis=1, kind="stable")
    total = np.cumsum(np.take_along_axis(bound, order, 1), 1)
    spare = total <= np.where(floor > 0, floor * SLACK, -1.0)[:, None]
    essential = np.ones(bound.shape, bool)
    np.put_along_axis(essential, order, ~spare, 1)
    return essential, np.where(essential, 0, bound).sum(1)


def shard_topk(q_rows, q, rows, x, k: int, best: np.ndarray):
    """Top-k candidates (query index, row index, score) of one shard, whose rows
    are in the order of their ids.  ``best`` (queries x k) holds the best scores
    so far and is updated."""
    big = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1]) >= 1 << 53
    kind = np.int64 if big else np.float64       # below 2 ** 53 doubles are exact (and far faster)
    qk = q.astype(kind)
    found = []
    for lo in range(0, len(rows), CHUNK):
        part = x[lo:lo + CHUNK]
        floor = best[:, -1]
        essential, rest = _essential(qk, part, floor)
        partial = (qk * essential) @ part.T.astype(kind)
        hope = (partial + rest[:, None] >= floor[:, None]) & (q_rows[:, None] != rows[None, lo:lo + CHUNK])
        qi, ri = np.nonzero(hope)
        score = partial[qi, ri]
        probe = np.flatnonzero(rest[qi] > 0)
        for a in range(0, len(probe), 1 << 16):  # non-essential terms of rows still competitive
            p = probe[a:a + (1 << 16)]
            score[p] = np.einsum("ij,ij->i", qk[qi[p]], part[ri[p]].astype(kind))
        keep = score >= floor[qi]
        qi, ri, score = qi[keep], ri[keep] + lo, score[keep]
        if len(qi):                              # at most k rows of a chunk go on, ties to the smaller id
            o = np.lexsort((ri, -score, qi))
            qi, ri, score = qi[o], ri[o], score[o]
            first = np.searchsorted(qi, qi)
            top = np.arange(len(qi)) - first < k
            qi, ri, score, rank = qi[top], ri[top], score[top], (np.arange(len(qi)) - first)[top]
            fresh = np.full(best.shape, -np.inf)
            fresh[qi, rank] = score
            best[:] = -np.sort(-np.concatenate([best, fresh], 1), axis=1)[:, :k]
            found.append((qi, ri, score))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    qi, ri, score = (np.concatenate(c) for c in zip(*found))
    keep = score >= best[qi, -1]
    return qi[keep], ri[keep], score[keep].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` over ``vectors`` (``id, v``): for the
    rows where ``is_query`` holds, the k best of all rows but their own."""
    vectors = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    shards = written(_packed(vectors, SHARD, "shard"), "shards")
    blocks = _packed(vectors.where(is_query), QUERIES, "block").selectExpr("block", "ids q_ids", "rows q_rows", "dims q_dims", "data q_data")
    blocks = written(blocks, "query-blocks")
    pairs = (shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks.count() - 1)))))
             .join(blocks, "block"))

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, None
        for part in parts:
            for r in part.itertuples():
                width = max(r.dims, r.q_dims)
                q_ids, q_rows, ids, rows = (np.frombuffer(v, np.int64) for v in (r.q_ids, r.q_rows, r.ids, r.rows))
                if r.block != at:
                    at, best = r.block, np.full((len(q_ids), k), -np.inf)
                qi, ri, score = shard_topk(q_rows, _matrix(r.q_dims, r.q_data, width), rows, _matrix(r.dims, r.data, width), k, best)
                yield pd.DataFrame({"q_row": q_rows[qi], "query_id": q_ids[qi], "vec_id": ids[ri], "row": rows[ri], "score": score})

    found = pairs.select("block", "ids", "rows", "dims", "data", "q_ids", "q_rows", "q_dims", "q_data").mapInPandas(
        search, "q_row long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
