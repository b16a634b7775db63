"""Approximate nearest neighbours by vantage-point trees, one per shard.

A shard's rows are halved again and again by their distance to a vantage row;
a node keeps the vantage vector and the least and greatest distance in either
half.  By the triangle inequality a row of a half whose distances span [lo, hi]
is at least ``max(lo - d, d - hi)`` away from a query at distance d from the
vantage row.  A half is skipped when ``factor`` times that bound exceeds the
query's k-th best distance so far: at factor 1 nothing near is lost (exact
search, ties included), larger factors skip more.

A block of queries goes through a tree together.  Each query first visits the
leaf it falls into, which bounds its k-th distance, then the tree is walked
once with the queries not yet ruled out.  In a leaf one matrix product gives
all distances nearly; those that can count are taken again from the original
vectors in double precision.

Plan: rows are packed into shards of about ``SHARD`` rows by a hash of the row,
so a vector repeated many times spreads over all shards, and a tree is built
per shard.  Queries (a stated set) are packed into blocks and meet shard 0
first; their k-th distance there is an upper bound they carry to all other
shards, where an equi-join on the shard number gives every block to every shard
(the smaller side, the queries, is what is shuffled).  Every pair of shard and
block hands on at most k rows a query, merged by a window per query row.
Nothing is broadcast or collected.

Defined cases: vectors that are NULL, zero or hold NULL, NaN or infinite
components, and rows without an id, take no part; a missing dimension counts as
zero; rows that share an id are rows of their own (each query row gets its own
list, only the row itself is left out); equal distances go to the smaller id;
fewer than k candidates are all returned; empty tables give no rows; other
columns are ignored.  Memory per task: one shard and one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.store import written

#: Rows of a shard, queries of a block, rows of a leaf, and pairs of shard and
#: block that a Python worker holds at a time.
SHARD, QUERIES, LEAF, PAIRS = 16384, 1024, 64, "2"
#: By how much the triangle inequality's bound is stretched (1: exact).
FACTOR = 5.0


class Tree:
    """A vantage-point tree over the rows of ``x``; ``order`` tells which rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        n = len(x)
        self.levels = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
        nodes = 2 ** self.levels - 1
        self.order, self.vantage, self.span = np.arange(n), np.zeros((nodes, x.shape[1])), np.zeros((nodes, 4))
        rng, todo = np.random.default_rng(n), [(0, 0, n)]
        while todo:
            node, a, b = todo.pop()
            if node >= nodes:
                continue
            own = x[self.order[a:b]]
            some = own[rng.integers(0, b - a, 64)]
            wide = [float(np.linalg.norm(some - c, axis=1).std()) for c in some[:5]]
            self.vantage[node] = some[int(np.argmax(wide))]
            d = np.linalg.norm(own - self.vantage[node], axis=1)
            o, m = np.argsort(d, kind="stable"), (a + b) // 2
            self.order[a:b] = self.order[a:b][o]
            d = d[o]
            self.span[node] = d[0], d[m - a - 1], d[m - a], d[-1]
            todo += [(2 * node + 1, a, m), (2 * node + 2, m, b)]


class Search:
    """One block of queries against one tree after another; ``seen`` counts the
    distances taken in leaves."""

    def __init__(self, q: np.ndarray, q_rows: np.ndarray, bound: np.ndarray, k: int, factor: float):
        self.q, self.q_rows, self.k, self.factor, self.seen = q, q_rows, k, factor, 0
        self.start = bound                                   # upper bounds known before (inf: none)
        self.d = np.full((len(q), k), np.inf)
        self.id = np.full((len(q), k), np.iinfo(np.int64).max)
        self.row = np.full((len(q), k), -1, np.int64)
        self.q2 = np.einsum("ij,ij->i", q, q)

    def reach(self, act: np.ndarray) -> np.ndarray:
        """The distance beyond which a row can't count, a rounding error wider."""
        return np.minimum(self.d[act, -1], self.start[act]) * (1 + 1e-9) + 1e-300

    def tree(self, t: Tree, x: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``x``, ``ids``, ``rows`` in the order of the tree."""
        self.t, self.x, self.ids, self.rows = t, x, ids, rows
        self.x2 = np.einsum("ij,ij->i", x, x)
        self.home = np.full(len(self.q), -1)
        everyone = np.arange(len(self.q))
        self._descend(0, 0, len(x), everyone)
        self._walk(0, 0, len(x), everyone)

    def _from(self, node: int, act: np.ndarray) -> np.ndarray:
        return np.linalg.norm(self.q[act] - self.t.vantage[node], axis=1)

    def _descend(self, node: int, a: int, b: int, act: np.ndarray) -> None:
        if not len(act):
            return
        if node >= len(self.t.vantage):
            self.home[act] = node
            return self._leaf(a, b, act)
        s, m = self.t.span[node], (a + b) // 2
        left = self._from(node, act) <= (s[1] + s[2]) / 2
        self._descend(2 * node + 1, a, m, act[left])
        self._descend(2 * node + 2, m, b, act[~left])

    def _walk(self, node: int, a: int, b: int, act: np.ndarray) -> None:
        if not len(act):
            return
        if node >= len(self.t.vantage):
            return self._leaf(a, b, act[self.home[act] != node])
        d, m = self._from(node, act), (a + b) // 2
        for child, lo, hi, c, e in ((2 * node + 1, a, m, *self.t.span[node, :2]), (2 * node + 2, m, b, *self.t.span[node, 2:])):
            off = np.maximum(c - d, d - e) - 1e-12 * (c + d + e)        # less a rounding error
            self._walk(child, lo, hi, act[self.factor * off <= self.reach(act)])

    def _leaf(self, a: int, b: int, act: np.ndarray) -> None:
        if not len(act):
            return
        self.seen += len(act) * (b - a)
        sums = self.q2[act][:, None] + self.x2[None, a:b]
        near = sums - 2 * (self.q[act] @ self.x[a:b].T)
        qi, ri = np.nonzero((near <= self.reach(act)[:, None] ** 2 + 1e-12 * sums)
                            & (self.q_rows[act][:, None] != self.rows[None, a:b]))
        qi, ri = act[qi], ri + a
        d = np.sqrt(((self.q[qi] - self.x[ri]) ** 2).sum(1))
        keep = d <= self.reach(qi)
        if keep.any():
            self._merge(qi[keep], d[keep], self.ids[ri[keep]], self.rows[ri[keep]])

    def _merge(self, qi: np.ndarray, d: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        u, k = np.unique(qi), self.k
        qi = np.concatenate([np.repeat(u, k), qi])
        d, ids, rows = (np.concatenate([own[u].ravel(), new]) for own, new in ((self.d, d), (self.id, ids), (self.row, rows)))
        o = np.lexsort((rows, ids, d, qi))
        o = o[np.arange(len(o)) - np.searchsorted(qi[o], qi[o]) < k]        # the first k of each query
        self.d[u], self.id[u], self.row[u] = d[o].reshape(-1, k), ids[o].reshape(-1, k), rows[o].reshape(-1, k)

    def found(self) -> tuple[np.ndarray, ...]:
        """Query place, id, row and distance of every row found."""
        qi, at = np.nonzero(np.isfinite(self.d))
        return qi, self.id[qi, at], self.row[qi, at], self.d[qi, at]


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v`` (doubles): finite vectors that are not zero, rows with an id."""
    x = F.col(vec_col).cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~odd & F.exists(x, lambda c: c != 0))
            .select(F.col(id_col).cast("long").alias("id"), x.alias("v")))


def _stacked(vectors) -> np.ndarray:
    m = np.zeros((len(vectors), max(map(len, vectors))))
    for row, v in zip(m, vectors):
        row[:len(v)] = v
    return m


def _shards(vectors: DataFrame, n: int) -> DataFrame:
    """One row per shard: its rows in the order of its tree, and the tree."""
    def build(key, pdf):
        pdf = pdf.sort_values("row")
        x = _stacked(pdf["v"].to_list())
        t = Tree(x)
        return pd.DataFrame({"shard": [key[0]], "dims": [x.shape[1]], "x": [x[t.order].tobytes()],
                             "ids": [pdf["id"].to_numpy(np.int64)[t.order].tobytes()],
                             "rows": [pdf["row"].to_numpy(np.int64)[t.order].tobytes()],
                             "vantage": [t.vantage.tobytes()], "span": [t.span.tobytes()]})

    return (vectors.groupBy(F.pmod(F.xxhash64("row"), F.lit(n)).alias("shard"))
            .applyInPandas(build, "shard long, dims long, x binary, ids binary, rows binary, vantage binary, span binary"))


def _blocks(queries: DataFrame, n: int) -> DataFrame:
    """One row per block of queries (``id, row, v, bound``)."""
    def pack(key, pdf):
        pdf = pdf.sort_values("row")
        q = _stacked(pdf["v"].to_list())
        return pd.DataFrame({"block": [key[0]], "q_dims": [q.shape[1]], "q": [q.tobytes()],
                             "q_ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "q_rows": [pdf["row"].to_numpy(np.int64).tobytes()],
                             "bound": [pdf["bound"].to_numpy(np.float64).tobytes()]})

    return (queries.groupBy(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n)).alias("block"))
            .applyInPandas(pack, "block long, q_dims long, q binary, q_ids binary, q_rows binary, bound binary"))


def _widened(data: bytes, dims: int, width: int) -> np.ndarray:
    m = np.frombuffer(data).reshape(-1, dims)
    return m if dims == width else np.pad(m, ((0, 0), (0, width - dims)))


def _hits(pairs: DataFrame, k: int, factor: float, purpose: str) -> DataFrame:
    """``q_row, query_id, vec_id, row, score``: per pair of shard and block the k
    nearest rows of every query that are no farther than its bound."""
    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                width = max(r.dims, r.q_dims)
                q_ids, q_rows = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_rows, np.int64)
                t = Tree.__new__(Tree)
                t.vantage, t.span = _widened(r.vantage, r.dims, width), np.frombuffer(r.span).reshape(-1, 4)
                s = Search(_widened(r.q, r.q_dims, width), q_rows, np.frombuffer(r.bound), k, factor)
                s.tree(t, _widened(r.x, r.dims, width), np.frombuffer(r.ids, np.int64), np.frombuffer(r.rows, np.int64))
                qi, ids, rows, d = s.found()
                yield pd.DataFrame({"q_row": q_rows[qi], "query_id": q_ids[qi], "vec_id": ids, "row": rows, "score": d})

    found = pairs.select("dims", "x", "ids", "rows", "vantage", "span", "q_dims", "q", "q_ids", "q_rows", "bound")
    return written(found.mapInPandas(search, "q_row long, query_id long, vec_id long, row long, score double"), purpose, PAIRS)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, factor: float = FACTOR) -> DataFrame:
    """``query_id, rank, vec_id, score`` over ``vectors`` (``id, v``): for the
    rows where ``is_query`` holds, the k nearest rows found, never the row
    itself, by Euclidean distance."""
    rows = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = max(1, -(-rows.count() // SHARD))
    shards = written(_shards(rows, n), "trees")
    queries = rows.where(is_query)
    n_blocks = max(1, -(-queries.count() // QUERIES))
    first = _blocks(queries.withColumn("bound", F.lit(float("inf"))), n_blocks).withColumn("shard", F.lit(0).cast("long"))
    first = written(first, "query-blocks")       # a stored key: a constant one would be planned as a cross join
    hits = _hits(first.join(shards, "shard"), k, factor, "hits")
    if n > 1:
        bounds = hits.groupBy("q_row").agg(F.max("score").alias("d"), F.count("*").alias("c")).where(F.col("c") == k)
        bounded = (queries.join(bounds, F.col("row") == F.col("q_row"), "left")
                   .select("id", "row", "v", F.coalesce("d", F.lit(float("inf"))).alias("bound")))
        blocks = written(_blocks(bounded, n_blocks), "query-blocks")
        rest = blocks.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(n - 1)))).withColumn("shard", F.col("shard").cast("long"))
        hits = hits.unionByName(_hits(rest.join(shards, "shard"), k, factor, "hits"))
    order = Window.partitionBy("q_row").orderBy("score", "vec_id", "row")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
