"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a linear function of features of its text; the chance
that one document is preferred to another is the logistic function of the
difference of their worths.  Weights are learnt from preference pairs (a
document labelled 1 against one labelled 0) by minimising the logistic loss on
feature differences.  The worths of the labelled sample set the cut: the
quantile at the share of documents labelled 0.  A score is the logistic of the
worth's distance from the cut, shifted so that the cut scores ``THRESHOLD``.

Every labelled document takes part.  Their features (a few dozen numbers each)
are stored once in blocks of about ``BLOCK`` documents, dealt by a hash of the
id; each document meets ``OPPONENTS`` documents of the other label in its block.
Where a label is rare, its documents are copied to as many blocks as give each
``RARE`` of them.  A Newton step adds up gradient and Hessian over all blocks,
the cut is the exact quantile of all worths, found by narrowing ranges: what
reaches the driver is a fixed number of sums per task.  Every document is then
scored in one narrow pass over the scan.  No shuffle of texts, no id, language
or source in any score.

Defined cases: NULL text is empty and gets the score of an empty text; labels
that are NULL or neither 0 nor 1 are ignored, as are labels whose document is
missing; a document labelled several times counts with its lowest label; where
one label is missing there is nothing to compare, and every document scores 1
(or 0, if only label 0 is there); whole texts of any length; repeated rows and
extra columns change nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut_lineage

THRESHOLD = 0.7
#: Documents of a block, opponents of each, and rows of the rarer label that a block has at least.
BLOCK, OPPONENTS, RARE = 8192, 8, 64
RIDGE = 1e-3
SLICE = 256
#: Ranges a pass tells apart when the cut is looked for, and worths that are few enough to be listed.
BINS, LISTED = 1024, 4096

_BYTE = np.zeros(256, np.int64)                     # classes of bytes
_BYTE[[*range(ord("a"), ord("z") + 1)]] = 1
_BYTE[[*range(ord("A"), ord("Z") + 1)]] = 2
_BYTE[[*range(ord("0"), ord("9") + 1)]] = 3
_BYTE[[*b" \t\r"]] = 4
_BYTE[10] = 5
_BYTE[[*b".,;:'\"-()"]] = 6
_BYTE[[*b"!?"]] = 7
_BYTE[[*b"|<>{}[]=/\\_"]] = 8
_BYTE[[*b"#$%&*+@^`~"]] = 9
_BYTE[128:] = 10
N_CLASSES = 11


def features(text: bytes | None) -> np.ndarray:
    """Numbers between 0 and about 1 that describe a text's form."""
    text = text or b""
    words = text.split()
    n, lines = len(words), [x for x in text.split(b"\n") if x.strip()]
    share = np.bincount(_BYTE[np.frombuffer(text, np.uint8)], minlength=N_CLASSES) / max(1, len(text))
    seen = Counter(words)
    plain = sum(v for w, v in seen.items() if w.strip(b".,;:!?'\"()-").isalpha() or max(w) >= 128)
    upper = sum(v for w, v in seen.items() if w.isupper() and len(w) > 1)
    f = [*share, share[2] / max(1e-9, share[1] + share[2]), min(1.0, np.log1p(n) / 10), min(1.0, n / 50),
         len(seen) / max(1, n), max(seen.values(), default=0) / max(1, n), plain / max(1, n), upper / max(1, n),
         min(1.0, len(text) / max(1, n) / 20), 1 - len(set(lines)) / max(1, len(lines)),
         min(1.0, n / max(1, len(lines)) / 100), sum(1 for w in seen if len(w) > 25) / max(1, len(seen))]
    f = np.array(f)
    return np.concatenate([f, np.sqrt(f)])


N_FEATURES = len(features(b"a"))


@dataclass
class Ranker:
    """Weights, their feature scaling, and the cut worth."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    constant: float | None = None

    def score(self, f: np.ndarray) -> np.ndarray:
        """0..1 per row of ``f``; the cut scores ``THRESHOLD``."""
        if self.constant is not None:
            return np.full(len(f), self.constant)
        worth = ((f - self.mean) / self.scale) @ self.weights
        shift = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(worth - self.cut + shift, -30, 30)))


def _pairs(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Preferred and other row of each pair.  Row i of one class meets
    ``OPPONENTS`` rows of the other, spread evenly over it."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    i = np.arange(max(len(good), len(bad)))
    a = np.tile(good[i % len(good)], OPPONENTS)
    b = np.concatenate([bad[(i + k * len(bad) // OPPONENTS + i // len(bad)) % len(bad)] for k in range(OPPONENTS)])
    return a, b


def _slopes(x: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A row each: the number of pairs, the gradient of their loss, its Hessian."""
    a, b = _pairs(label)
    diff = x[a] - x[b]
    p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
    n = np.full((1, len(w)), float(len(diff)))
    return np.concatenate([n, -(diff.T @ p)[None], (diff * (p * (1 - p))[:, None]).T @ diff])


def _newton(slopes: Callable[[np.ndarray], np.ndarray], width: int, rounds: int) -> np.ndarray:
    """Newton steps on the ridge-penalised logistic loss."""
    w = np.zeros(width)
    for _ in range(rounds):
        s = slopes(w)
        n = s[0, 0]
        step = np.linalg.solve(s[2:] + RIDGE * n * np.eye(width), RIDGE * n * w + s[1])
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _quantile(values: np.ndarray, weight: np.ndarray, share: float, below: float = 0.0) -> float:
    """Middle of the value at which the weights (``below`` before the first) reach
    ``share`` and the next one; ``values`` ascend."""
    k = min(int(np.searchsorted(below + np.cumsum(weight), share - 1e-9)), len(values) - 2)
    return float((values[k] + values[k + 1]) / 2)


def fit(f: np.ndarray, label: np.ndarray, share_bad: float | None = None, rounds: int = 60) -> Ranker:
    """Learn from the features and labels (0 or 1) of one block."""
    n_good, n_bad = int((label == 1).sum()), int((label == 0).sum())
    none = np.zeros(f.shape[1])
    if not n_good or not n_bad:
        return Ranker(none, none + 1, none, 0.0, 0.0 if n_bad else 1.0)
    mean, scale = f.mean(0), np.maximum(f.std(0), 1e-6)
    x = (f - mean) / scale
    w = _newton(lambda w: _slopes(x, label, w), f.shape[1], rounds)
    share = n_bad / len(label) if share_bad is None else share_bad
    worth = x @ w
    o = np.argsort(worth)
    return Ranker(mean, scale, w, _quantile(worth[o], np.where(label[o] == 0, share / n_bad, (1 - share) / n_good), share))


def _mapped(docs: DataFrame, ranker: Ranker | None) -> DataFrame:
    """``id`` and ``out``: the features, or with a ranker the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.empty((0, N_FEATURES))]
            for lo in range(0, batch.num_rows, SLICE):
                f = np.array([features(t) for t in batch.column(1).slice(lo, SLICE).to_pylist()])
                out.append(f if ranker is None else ranker.score(f))
            if ranker is None:
                values = pa.array(list(np.concatenate(out)), pa.list_(pa.float64()))
            else:
                values = pa.array(np.concatenate(out[1:]) if len(out) > 1 else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["id", "out"])
    return docs.select("id", "text").mapInArrow(run, f"id long, out {'array<double>' if ranker is None else 'double'}")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def _blocks(docs: DataFrame, known: DataFrame, n_blocks: int, copies: dict[int, int]) -> DataFrame:
    """A row per block: its documents' labels, whether they are at home (not
    copies), and their features, in the order of their ids."""
    at = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 0, copies[0]).otherwise(copies[1]) - 1))
    rows = (_mapped(docs, None).join(known, "id").select("*", at.alias("copy"))
            .withColumn("block", F.pmod(F.xxhash64("id") + F.col("copy"), F.lit(n_blocks))))

    def pack(table: pa.Table) -> pa.Table:
        ids, label, copy = (table.column(c).to_numpy() for c in ("id", "label", "copy"))
        f = np.array(table.column("out").to_pylist()).reshape(len(ids), N_FEATURES)
        o = np.lexsort([*f.T[::-1], copy, ids])
        o = o[np.concatenate([[True], ids[o][1:] != ids[o][:-1]])]          # a repeated id counts once
        return pa.table({"label": [label[o].astype(np.int8).tobytes()], "home": [(copy[o] == 0).tobytes()],
                         "f": [f[o].tobytes()]}, pa.schema([(c, pa.binary()) for c in ("label", "home", "f")]))
    return rows.groupBy("block").applyInArrow(pack, "label binary, home binary, f binary")


def _over(blocks: DataFrame, of: Callable, join: Callable = np.add) -> np.ndarray | None:
    """``of(features, label, home)`` of every block, joined in the tasks, then
    those of the tasks (an array of one size) on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for r in batch.to_pylist():
                f = np.frombuffer(r["f"]).reshape(-1, N_FEATURES)
                new = of(f, np.frombuffer(r["label"], np.int8), np.frombuffer(r["home"], bool))
                out = new if out is None else join(out, new)
        if out is not None:
            yield pa.RecordBatch.from_pydict({"shape": [list(out.shape)], "v": [out.ravel().tolist()]},
                                             pa.schema([("shape", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))]))
    parts = blocks.mapInArrow(run, "shape array<long>, v array<double>").collect()
    return reduce(join, [np.array(r.v).reshape(r.shape) for r in parts]) if parts else None


def _cut(blocks: DataFrame, worth: Callable, n: np.ndarray, share: float) -> float:
    """The quantile of all worths at ``share``, documents of label 0 weighing
    that much together.  Passes narrow the range that holds it to few worths."""
    weight = np.array([share, 1 - share]) / n

    def spread(lo: float, hi: float) -> Callable:
        def of(f, label, home):
            v, v_label = worth(f)[home], label[home]
            at = np.clip(np.floor((v - lo) / max(hi - lo, 1e-300) * BINS), 0, BINS - 1).astype(int)
            at = np.where(v < lo, 0, np.where(v > hi, BINS + 1, at + 1))     # first and last: outside the range
            out = np.array([np.zeros(BINS + 2), np.zeros(BINS + 2), np.full(BINS + 2, np.inf), np.full(BINS + 2, -np.inf)])
            for k in (0, 1):
                out[k] = np.bincount(at[v_label == k], minlength=BINS + 2)
            np.minimum.at(out[2], at, v)
            np.maximum.at(out[3], at, v)
            return out
        return of

    def joined(a, b):
        return np.array([a[0] + b[0], a[1] + b[1], np.minimum(a[2], b[2]), np.maximum(a[3], b[3])])
    first = _over(blocks, lambda f, label, home: np.array([worth(f)[home].min(initial=np.inf), -worth(f)[home].max(initial=-np.inf)]),
                  np.minimum)
    lo, hi = first[0], -first[1]
    while True:
        s = _over(blocks, spread(lo, hi), joined)
        reached = np.cumsum(weight @ s[:2])
        k = int(np.clip(np.searchsorted(reached, share - 1e-9), 1, BINS))
        while s[:2, k].sum() == 0 and k > 1:       # past the last worth, by rounding
            k -= 1
        left, right = s[3, :k].max(), s[2, k + 1:].min()
        lo, hi, here = s[2, k], s[3, k], s[:2, k].sum()
        if here <= LISTED or lo == hi:
            break

    def listed(f, label, home):
        v = worth(f)
        keep = home & (v >= lo) & (v <= hi)
        values, at = np.unique(v[keep], return_inverse=True)
        return np.array([values, *(np.bincount(at[label[keep] == k], minlength=len(values)) for k in (0, 1))])
    v = _over(blocks, listed, lambda a, b: np.concatenate([a, b], axis=1))
    v = v[:, np.argsort(v[0], kind="stable")]
    # equal worths in a row: two places are enough to tell a pair of them from a pair with the next
    values, weights = [left], [0.0]
    for value, bad, good in v.T:
        total = weight @ (bad, good)
        last = weight[0] if bad else weight[1]
        values += [value] * (1 + (bad + good > 1))
        weights += [total - last, last] if bad + good > 1 else [total]
    values, weights = np.array([*values, right]), np.array([*weights, 0.0])
    known = np.isfinite(values)
    return _quantile(values[known], weights[known], share, float(reached[k - 1]))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", block: int = BLOCK, rounds: int = 60) -> Ranker:
    """Fit on all labelled documents (``labels``: id and label)."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).alias("label")))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    none = np.zeros(N_FEATURES)
    if not counts:
        return Ranker(none, none + 1, none, 0.0, 1.0)
    share = counts.get(0, 0) / sum(counts.values())
    n_blocks = -(-sum(counts.values()) // block)
    copies = {k: max(1, min(n_blocks, -(-RARE * n_blocks // counts[k]))) if n_blocks > 1 and counts.get(k) else 1 for k in (0, 1)}
    blocks = cut_lineage(docs.sparkSession, _blocks(_source(docs, id_col, text_col), known, n_blocks, copies))
    sums = _over(blocks, lambda f, label, home: np.array([[(label[home] == 0).sum(), (label[home] == 1).sum(), *f[home].sum(0)]]))
    n = np.zeros(2) if sums is None else sums[0, :2]
    if not n.all():
        return Ranker(none, none + 1, none, 0.0, 0.0 if n[0] else 1.0)
    mean = sums[0, 2:] / n.sum()
    scale = np.maximum(np.sqrt(_over(blocks, lambda f, label, home: ((f[home] - mean) ** 2).sum(0)) / n.sum()), 1e-6)
    w = _newton(lambda w: _over(blocks, lambda f, label, home: _slopes((f - mean) / scale, label, w)), N_FEATURES, rounds)
    return Ranker(mean, scale, w, _cut(blocks, lambda f: ((f - mean) / scale) @ w, n, share))


def score_documents(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0..1) and ``predicted`` (1 from the threshold on)."""
    scored = _mapped(_source(docs, id_col, text_col), ranker)
    return scored.select(F.col("id").alias(id_col), F.col("out").alias("score"),
                         (F.col("out") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text reaches the threshold."""
    at = docs.columns.index(text_col)

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for lo in range(0, batch.num_rows, SLICE):
                texts = batch.column(at).slice(lo, SLICE).to_pylist()
                keep.append(ranker.score(np.array([features((t or "").encode()) for t in texts])) >= THRESHOLD)
            yield batch.filter(pa.array(np.concatenate(keep)))
    return docs.mapInArrow(verdicts, docs.schema)
