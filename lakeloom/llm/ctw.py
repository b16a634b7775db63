"""Language-model scoring by context-tree weighting over bytes.

A text is read as its tokens (runs of non-blank bytes, A-Z lower-cased), each
followed by one blank, and an end.  This sequence is coded byte by byte.  A
byte's context are the up to ``DEPTH`` bytes before it, across blanks into the
tokens before, the text's start included.  Each byte is decomposed into 8 binary
choices; every pair of a context (of each length from 0 to ``DEPTH``) and a
prefix of the byte's bits has a Krichevsky-Trofimov estimate.  Weighting mixes
the estimates of all depths: a node's probability is half its own estimate and
half the product of its children's, which after training gives each node the
share it keeps for its own estimate and the share it leaves to the longer
context.  A longer context that training never met says one half.

The model is as large as the corpus makes it, so it stays distributed, cut below
its two-symbol contexts; only the crown above the cut (at most 258 contexts of
255 nodes) is broadcast.

1. A pass over the scan packs documents into blocks (bounded in bytes): one row
   with the coded texts, and one row for each distinct key, with its number of
   training occurrences.  A key is a (context, byte) of 53 bits, or, with the
   sign set, a 63-bit digest of a token, for the base score.  Keys of all texts
   are one row per block, so no key is hotter than the number of blocks.
2. Keys are counted.
3. Parts of the tree get their node counts and weights, bottom up, then their
   mixtures, top down from the crown, and price their keys.
4. Prices (counts for tokens) go back to the blocks, where each text's are
   summed.

Defined cases: NULL text is empty (one token, the end); repeated rows count and
are scored each; without training texts every bit costs one bit and the base
score is 0 per token; ids may be NULL; an empty table gives an empty result;
other columns are ignored.  Two tokens of one digest would share their count:
expected pairs among a billion distinct tokens, 0.05.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.store import written

DEPTH = 5
#: Bytes and documents of a block, and positions worked on at once.
BLOCK_BYTES, BLOCK_DOCS, STEP = 32 << 20, 60_000, 1 << 20
#: Keys of a part of the tree, on average.
PART = 100_000
#: Context symbols take 9 bits: 0 none, byte + 1, or the text's start.
BITS, START = 9, 257
END_TEXT = b"\n"


# ------------------------------------------------------------- keys of texts

def coded(text: bytes | None) -> bytes:
    """The bytes to code: folded tokens, a blank after each, and the end."""
    words = text.lower().split() if text else []
    return b" ".join(words) + b" " + END_TEXT if words else END_TEXT


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols, each text behind ``DEPTH`` places of which the last
    is its start; and the place of each text's first byte."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + DEPTH
    first = np.cumsum(sizes) - sizes + DEPTH
    blank = bytes(DEPTH)
    out = np.frombuffer(blank.join([b"", *texts]), np.uint8).astype(np.uint16)
    out += 1
    for k in range(1, DEPTH + 1):
        out[first - k] = START if k == 1 else 0
    return out, first


def keys_between(symbol: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Key (byte and context) of the places ``lo`` to ``hi``, and which of them
    hold a byte.  ``lo`` is at least ``DEPTH``."""
    here = symbol[lo:hi]
    real = (here > 0) & (here < START)
    key = here.astype(np.int64) - 1
    for k in range(DEPTH):
        key |= symbol[lo - k - 1:hi - k - 1].astype(np.int64) << (8 + BITS * k)
    return key, real


def counted(symbol: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the places ``lo`` to ``hi`` and how often each occurs."""
    keys, counts, size = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for at in range(max(lo, DEPTH), hi, STEP):
        key, real = keys_between(symbol, at, min(at + STEP, hi))
        k, c = np.unique(key[real], return_counts=True)
        keys.append(k)
        counts.append(c)
        size += len(k)
        if size > 2 * STEP + len(keys[0]):
            k, c = merged(np.concatenate(keys), np.concatenate(counts))
            keys, counts, size = [k], [c], len(k)
    return merged(np.concatenate(keys), np.concatenate(counts))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(keys, return_inverse=True)
    return found, np.bincount(which, weights=counts, minlength=len(found)).astype(np.int64)


def token_key(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True) | -1 << 63


def token_codes(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of the distinct tokens, and each text's tokens as places in them."""
    code: dict[bytes, int] = {}
    each = [np.fromiter((code.setdefault(w, len(code)) for w in t.split()), np.int32) for t in texts]
    return np.fromiter(map(token_key, code), np.int64, len(code)), each


# ------------------------------------------------------------- blocks of texts

INDEX_SCHEMA = pa.schema([("block", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())),
                          ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())])
INDEX_TYPE = "block long, key long, n long, ids array<long>, sizes array<long>, texts binary"


def _block(number: int, docs: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of one block: the texts (key NULL, training texts first, ``n`` of
    them), then one row per distinct key."""
    docs.sort(key=lambda d: d[1])
    texts, n_train = [d[2] for d in docs], sum(not d[1] for d in docs)
    yield pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([None], pa.int64()), pa.array([n_train], pa.int64()),
        pa.array([[d[0] for d in docs]], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
        pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary())], schema=INDEX_SCHEMA)
    symbol, first = symbols(texts)
    cut = int(first[n_train]) if n_train < len(texts) else len(symbol)
    taught, n = counted(symbol, 0, cut)
    other, _ = counted(symbol, cut, len(symbol))
    words, each = token_codes(texts)
    n_words = np.bincount(np.concatenate([*each[:n_train], np.empty(0, np.int32)]), minlength=len(words))
    key, n = merged(np.concatenate([taught, other, words]),
                    np.concatenate([n, np.zeros(len(other), np.int64), n_words.astype(np.int64)]))
    for lo in range(0, len(key), 50_000):
        k = key[lo:lo + 50_000]
        none = [pa.nulls(len(k), f.type) for f in list(INDEX_SCHEMA)[3:]]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), number), pa.int64()), pa.array(k, pa.int64()),
                                          pa.array(n[lo:lo + 50_000], pa.int64()), *none], schema=INDEX_SCHEMA)


def block_index(docs: DataFrame) -> DataFrame:
    """Texts and keys of blocks of ``docs`` (``id, held, text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq, part, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for id_, held, text in zip(*(c.slice(lo, 64).to_pylist() for c in batch.columns)):
                    part.append((id_, held, coded(text)))
                    size += len(part[-1][2])
                    if size >= BLOCK_BYTES or len(part) >= BLOCK_DOCS:
                        yield from _block(base + seq, part)
                        seq, part, size = seq + 1, [], 0
        if part:
            yield from _block(base + seq, part)
    return docs.mapInArrow(run, INDEX_TYPE)


# ------------------------------------------------------------- the tree

def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5: the recurrence up to x + 7, then Stirling's series."""
    z, product = x + 7, x.copy()
    for k in range(1, 7):
        product *= x + k
    return ((z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
            - np.log(product))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with these counts under the estimator."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - float(np.log(np.pi))


def weigh(own: np.ndarray, kids: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes, and the share each keeps for its own
    estimate; a closed node has no children and keeps all."""
    keep = 1 / (1 + np.exp(np.clip(kids - own, -700, 700)))
    return (np.where(closed, own, np.logaddexp(own, kids) - float(np.log(2))), np.where(closed, 1.0, keep))


def _mask(depth: int) -> int:
    return (1 << BITS * depth) - 1


def _has(ctx: np.ndarray, depth: int) -> np.ndarray:
    """Has the context ``depth`` symbols?"""
    return ctx >> (BITS * (depth - 1)) != 0 if depth else np.ones(len(ctx), bool)


def _paths(ctx: np.ndarray, byte: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the byte's 8 bits: node ids (context, bits before) and the bit."""
    for k in range(8):
        yield ctx << 8 | (256 | byte) >> (8 - k), byte >> (7 - k) & 1


class Subtrees:
    """The nodes of depth 2 and more over some keys' contexts, complete below
    every two-symbol context it holds.  Per depth: sorted ids, counts, log
    weighted probability and kept share."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        key, n = key[n > 0], n[n > 0].astype(np.float64)
        ctx, byte = key >> 8, key & 255
        self.levels, below = {}, None
        for depth in range(DEPTH, 1, -1):
            here = _has(ctx, depth)
            pair, which = np.unique((ctx[here] & _mask(depth)) << 8 | byte[here], return_inverse=True)
            count = np.bincount(which, weights=n[here], minlength=len(pair))
            steps = list(_paths(pair >> 8, pair & 255))
            ids, which = np.unique(np.concatenate([i for i, _ in steps]), return_inverse=True)
            n1 = np.bincount(which, weights=np.concatenate([count * bit for _, bit in steps]), minlength=len(ids))
            n0 = np.bincount(which, weights=np.tile(count, 8), minlength=len(ids)) - n1
            closed = np.full(len(ids), True) if depth == DEPTH else ids >> 8 >> (BITS * (depth - 1)) == START
            kids = np.zeros(len(ids))
            if below is not None and len(below["ids"]):
                up = (below["ids"] >> 8 & _mask(depth)) << 8 | below["ids"] & 255
                kids = np.bincount(np.searchsorted(ids, up), weights=below["w"], minlength=len(ids))
            w, keep = weigh(log_kt(n0, n1), kids, closed)
            self.levels[depth] = below = {"ids": ids, "n0": n0, "n1": n1, "w": w, "keep": keep,
                                          "kt": (n1 + 0.5) / (n0 + n1 + 1)}

    def mix(self, top: dict) -> None:
        """Top down: probability of a 1 where no longer context was met."""
        above = top
        for depth in range(2, DEPTH + 1):
            level = self.levels[depth]
            up = (level["ids"] >> 8 & _mask(depth - 1)) << 8 | level["ids"] & 255
            at = np.searchsorted(above["ids"], up)
            said, left = above["said"][at], above["left"][at]
            level["p"] = said + left * (level["keep"] * level["kt"] + (1 - level["keep"]) / 2)
            level["said"], level["left"] = said + left * level["keep"] * level["kt"], left * (1 - level["keep"])
            above = level

    def costs(self, key: np.ndarray, top: dict) -> np.ndarray:
        """Natural-log probability of each key's byte in its context."""
        ctx, byte = key >> 8, key & 255
        levels = [(d, self.levels[d]["ids"], self.levels[d]["p"]) for d in range(DEPTH, 1, -1)]
        levels += [(1, top["ids"], top["p"]), (0, top["root_ids"], top["root_p"])]
        total = np.zeros(len(key))
        for at, bit in _paths(ctx, byte):
            p, u = np.full(len(key), np.nan), at & 255
            for depth, ids, known in levels:    # the longest context that has a node
                open_ = np.flatnonzero(np.isnan(p) & _has(ctx, depth))
                if len(open_) and len(ids):
                    want = (ctx[open_] & _mask(depth)) << 8 | u[open_]
                    found = np.minimum(np.searchsorted(ids, want), len(ids) - 1)
                    hit = ids[found] == want
                    p[open_[hit]] = known[found[hit]]
            p = np.where(np.isnan(p), 0.5, p)
            total += np.log(np.where(bit == 1, p, 1 - p))
        return total


def bottom(keys: DataFrame) -> DataFrame:
    """``ctx, u, n0, n1, w`` of the one-symbol contexts' nodes (at most 257
    contexts of 255 nodes), ``w`` being the sum over their children."""
    def run(pdf):
        key, n = pdf["key"].to_numpy(), pdf["n"].to_numpy()
        two = Subtrees(key, n).levels[2]
        start = (key >> 8 == START) & (n > 0)       # a text's first byte: the context ends at one symbol
        ids = [two["ids"]] + [i for i, _ in _paths(key[start] >> 8, key[start] & 255)]
        n1 = [two["n1"]] + [n[start] * bit for _, bit in _paths(key[start] >> 8, key[start] & 255)]
        n0 = [two["n0"]] + [n[start] * (1 - bit) for _, bit in _paths(key[start] >> 8, key[start] & 255)]
        ids = np.concatenate(ids)
        w = np.concatenate([two["w"], np.zeros(len(ids) - len(two["ids"]))])
        up, which = np.unique((ids >> 8 & _mask(1)) << 8 | ids & 255, return_inverse=True)
        add = lambda x: np.bincount(which, weights=x, minlength=len(up))
        return pd.DataFrame({"id": up, "n0": add(np.concatenate(n0)), "n1": add(np.concatenate(n1)), "w": add(w)})
    return (keys.groupBy("part").applyInPandas(run, "id long, n0 double, n1 double, w double")
            .groupBy("id").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("w").alias("w")))


def crown(one: pd.DataFrame) -> dict:
    """Mixtures of the depths 0 and 1 from ``bottom``'s rows."""
    one = one.sort_values("id")
    ids, n0, n1, kids = (one[c].to_numpy() for c in ("id", "n0", "n1", "w"))
    w, keep = weigh(log_kt(n0, n1), kids, ids >> 8 == START)
    kt = (n1 + 0.5) / (n0 + n1 + 1)
    root, which = np.unique(ids & 255, return_inverse=True)
    add = lambda x: np.bincount(which, weights=x, minlength=len(root))
    r0, r1 = add(n0), add(n1)
    _, r_keep = weigh(log_kt(r0, r1), add(w), np.zeros(len(root), bool))
    r_kt = (r1 + 0.5) / (r0 + r1 + 1)
    said, left = (r_keep * r_kt)[which], (1 - r_keep)[which]
    return {"ids": ids, "p": said + left * (keep * kt + (1 - keep) / 2), "said": said + left * keep * kt, "left": left * (1 - keep),
            "root_ids": root, "root_p": r_keep * r_kt + (1 - r_keep) / 2}


def key_costs(keys: DataFrame) -> DataFrame:
    """``key, lp`` for every key of ``keys`` (``key, n``).  The tree is cut below
    its two-symbol contexts; parts of several such subtrees are worked through
    on their own, once up and once down, and only the crown is shared."""
    spark = keys.sparkSession
    parts = max(1, -(-keys.count() // PART))
    two = F.shiftright("key", 8).bitwiseAND(F.lit(_mask(2)))
    keys = written(keys.withColumn("part", F.pmod(F.xxhash64(two), F.lit(parts))), "key-parts")
    # at most 257 contexts of 255 nodes reach the driver
    top = spark.sparkContext.broadcast(crown(bottom(keys).toPandas()))

    def run(pdf):
        key = pdf["key"].to_numpy()
        tree = Subtrees(key, pdf["n"].to_numpy())
        tree.mix(top.value)
        return pd.DataFrame({"key": key, "lp": tree.costs(key, top.value)})
    return keys.groupBy("part").applyInPandas(run, "key long, lp double")


# ------------------------------------------------------------- scores

def score_documents(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``
    (log10 probabilities) and ``n_coded, bits_per_byte`` (bytes coded and code
    length of each) for every row; rows where ``held`` is true teach nothing."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(held, F.lit(False)).alias("held"),
                         F.col(text_col).cast("string").cast("binary").alias("text"))
    index = written(block_index(source), "blocks")
    texts = index.where("key IS NULL").select("block", "n", "ids", "sizes", "texts")
    rows = index.where("key IS NOT NULL").select("block", "key", "n")
    keys = written(rows.groupBy("key").agg(F.sum("n").alias("n")), "keys")
    n_texts = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, kinds = keys.where("key < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    total, kinds = total + n_texts, kinds + (1 if n_texts else 0)

    # a price in single precision: its last bytes are zero and pack well
    values = (key_costs(keys.where("key >= 0")).select("key", F.col("lp").cast("float").cast("double").alias("value"))
              .unionByName(keys.where("key < 0").select("key", F.col("n").cast("double").alias("value"))))
    answers = rows.select("block", "key").join(values, "key").select(F.col("block").alias("of_block"), "key", "value")
    log_all = float(np.log10(total + 0.5 * (kinds + 1)))
    end_base = float(np.log10(n_texts + 0.5)) - log_all

    def add_up(left, right):
        r = left.iloc[0]
        cuts = np.cumsum(np.concatenate([[0], r["sizes"]])).tolist()
        packed = pa.decompress(r["texts"], cuts[-1], "zstd", asbytes=True)
        texts = [packed[a:b] for a, b in zip(cuts, cuts[1:])]
        del packed
        order = np.argsort(right["key"].to_numpy())
        key, value = right["key"].to_numpy()[order], right["value"].to_numpy()[order]
        del right, order
        words, each = token_codes(texts)
        c = value[np.searchsorted(key, words)]
        base = [float(np.log10(c[t] + 0.5).sum()) - len(t) * log_all + end_base for t in each]
        known = [int(np.count_nonzero(c[t])) + (n_texts > 0) for t in each]
        symbol, first = symbols(texts)
        cost = np.zeros(len(texts))
        for lo in range(DEPTH, len(symbol), STEP):
            hi = min(lo + STEP, len(symbol))
            k, real = keys_between(symbol, lo, hi)
            lp = np.zeros(hi - lo)
            lp[real] = value[np.searchsorted(key, k[real])]
            a, b = np.searchsorted(first, [lo, hi - 1], "right") - 1
            cost[a:b + 1] += np.add.reduceat(lp, np.maximum(first[a:b + 1], lo) - lo)
        return pd.DataFrame({
            "id": pd.array([None if i is None or i != i else int(i) for i in r["ids"]], "Int64"),
            "held_out": np.arange(len(texts)) >= r["n"], "n_tokens": np.fromiter(map(len, each), np.int64, len(each)) + 1,
            "n_known": np.array(known, np.int64), "base_score": base, "score": cost / np.log(10),
            "n_coded": np.array(r["sizes"], np.int64), "bits_per_byte": -cost / np.log(2) / np.array(r["sizes"])})

    out = (texts.groupBy("block").cogroup(answers.groupBy("of_block"))
           .applyInPandas(add_up, "id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                  "score double, n_coded long, bits_per_byte double"))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "n_coded", "bits_per_byte")
