"""Target-distribution importance resampling: draw the documents that look most
like a target corpus, with Gumbel noise in place of random draws.

1. Features are all runs of one to three consecutive words; a feature's bucket
   is the CRC-32 of its bytes (words joined by a blank) modulo ``BUCKETS``.  A
   worker takes the CRC of every word once and joins them with the CRC's own
   shift operator, so no run is ever spelled out.
2. One pass over each corpus adds up an array of ``BUCKETS`` counts per task;
   only these arrays are shuffled.  Their log ratio, again one array of fixed
   size, is the gain of a bucket.
3. A second pass scores every document: the sum of its features' gains
   (``weight``), plus Gumbel noise that depends on seed and id alone.
4. The draw is the ``n`` highest scores.  A quantile sketch brackets the cutoff;
   exact counts above and inside the bracket confirm it or widen it.  Only the
   bracket is sorted to find the cutoff; what lies below is never sorted, and
   what lies above is sorted only because its ranks are wanted.

Both sorts deal rows by ranges of (score, id, row), so equal scores and repeated
rows split like others; a row's rank is its place in its range plus the counts
of the ranges before.

Defined cases: NULL or wordless text has no features and weight 0; a NULL id
stands for an empty id in the noise and comes last among ties; repeated rows are
drawn one by one; an empty target gives gains from its zero counts; empty tables
give no rows; other columns are ignored.  Memory per task: one slice's words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.decontaminate import byte_words
from lakeloom.llm.store import written

BUCKETS = 10_000
#: Texts taken at a time, the longest word whose shift has a table of its own,
#: and rows of one sorted range.
SLICE, SHORT, RANGE_ROWS = 256, 64, 200_000
#: Half the first bracket's width, as a share of all rows, and the sketch's error.
MARGIN, ERROR = 0.005, 0.001


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Shift operators of the reflected CRC-32 (0xEDB88320) as tables by byte:
    over 0 to ``SHORT`` zero bytes, and over 2 ** i of them."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    short = [now]
    for _ in range(SHORT):
        now = (now >> 8) ^ step[now & 255]
        short.append(now)
    powers = [short[1]]
    for _ in range(31):
        powers.append(_over(powers[-1], powers[-1]))
    return np.stack(short), np.stack(powers)


def _over(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


SHIFTS, POWERS = _tables()


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``crc`` of some bytes carried over ``n`` more bytes, elementwise: with
    the CRC of those bytes it gives (by exclusive or) that of both together."""
    m = np.minimum(n, SHORT)
    out = (SHIFTS[m, 0, crc & 255] ^ SHIFTS[m, 1, (crc >> 8) & 255]
           ^ SHIFTS[m, 2, (crc >> 16) & 255] ^ SHIFTS[m, 3, crc >> 24])
    for at in np.flatnonzero(n > SHORT):
        one, left = crc[at:at + 1], int(n[at])
        for i in range(left.bit_length()):
            if left >> i & 1:
                one = _over(POWERS[i], one)
        out[at] = one[0]
    return out


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and for every feature its text's place and its bucket."""
    per, words = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        own = byte_words(text)
        per[i] = len(own)
        words += own
    of = np.repeat(np.arange(len(texts)), per)
    crc = np.fromiter(map(crc32, words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    blank = np.uint32(crc32(b" "))
    run, at, crcs = crc, of, [crc]
    texts_of = [of]
    for back in (1, 2):                     # runs that end ``back`` words later, within one text
        if len(run) < 2:
            break
        spaced = SHIFTS[1][0][run & 255] ^ SHIFTS[1][1][(run >> 8) & 255] ^ SHIFTS[1][2][(run >> 16) & 255] \
            ^ SHIFTS[1][3][run >> 24] ^ blank
        run = shifted(spaced[:-1], size[back:]) ^ crc[back:]
        at = of[:len(run)]
        inside = at == of[back:]
        crcs.append(run[inside])
        texts_of.append(at[inside])
    return per, np.concatenate(texts_of), np.concatenate(crcs) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: one array of ``buckets`` counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                total += np.bincount(features(batch.column(0).slice(lo, SLICE).to_pylist(), buckets)[2], minlength=buckets)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(total[on], pa.int64())], names=["bucket", "n"])

    counts = (texts.select(F.col(text_col).cast("string").cast("binary").alias("text"))
              .mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():            # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares, target to source), in doubles."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: int, key: int | None) -> int:
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 42) -> DataFrame:
    """Per row ``id, n_words, n_features, weight, score``."""
    share = docs.sparkSession.sparkContext.broadcast(gain)      # one array of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = share.value
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                per, of, bucket = features(part.column(1).to_pylist(), len(g))
                weight = np.zeros(len(per), np.int64)
                np.add.at(weight, of, g[bucket])
                add = np.array([noise(seed, i) for i in part.column(0).to_pylist()], np.int64)
                n = np.maximum(0, per) + np.maximum(0, per - 1) + np.maximum(0, per - 2)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in (per, n, weight, weight + add))],
                                                 names=["id", "n_words", "n_features", "weight", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(run, "id long, n_words long, n_features long, weight long, score long"))


def bracket(rows: DataFrame, n: int, total: int, margin: float = MARGIN) -> tuple[float, float, int]:
    """``low, high, above``: the ``n``-th highest of ``total`` scores lies in
    [low, high], and exactly ``above`` (fewer than ``n``) scores are higher."""
    while True:
        at = 1 - n / total
        low, high = rows.approxQuantile("score", [max(0.0, at - margin), min(1.0, at + margin)], ERROR)
        if at - margin <= 0:
            low = -math.inf
        if at + margin >= 1:
            high = math.inf
        c = rows.agg(F.count(F.when(F.col("score") > high, 1)).alias("above"),
                     F.count(F.when(F.col("score") >= low, 1)).alias("reach")).first()
        if c.above < n <= c.reach:
            return low, high, c.above
        margin *= 4                          # the sketch missed the cutoff: widen, in the end to all rows


def ranked(rows: DataFrame, after: int, purpose: str) -> DataFrame:
    """``rows`` with ``rank`` (from ``after`` + 1) by falling score, ties to the smaller id."""
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    parts = max(1, -(-rows.count() // RANGE_ROWS))
    dealt = written(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), purpose)
    before, starts = after, {}
    for r in dealt.groupBy("range").count().orderBy("range").collect():     # one row per range
        starts[r["range"]] = before
        before += r["count"]
    offsets = rows.sparkSession.createDataFrame(list(starts.items()), "range int, before long")
    return (dealt.join(offsets, "range")
            .withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*order)))
            .drop("range", "before"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = 5, least_words: int = 20, buckets: int = BUCKETS,
             seed: int = 42) -> DataFrame:
    """Per row of ``docs`` ``id_col, n_features, weight, score, rank``: ``rank`` is
    the place in the draw of ``percent`` in a hundred of the documents with at
    least ``least_words`` words, NULL for documents not drawn."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    rows = written(weighted(docs, gain, id_col, text_col, seed).withColumn("row", F.monotonically_increasing_id()), "weights")
    able = rows.where(F.col("n_words") >= least_words)
    total = able.count()
    n = percent * total // 100
    unranked = rows.withColumn("rank", F.lit(None).cast("long"))
    if n:
        low, high, above = bracket(able, n, total)
        top = ranked(able.where(F.col("score") > high), 0, "drawn")
        edge = ranked(able.where(F.col("score").between(low, high)), above, "bracket")
        edge = edge.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
        unranked = unranked.where((F.col("n_words") < least_words) | (F.col("score") < low))
        unranked = unranked.unionByName(top).unionByName(edge)
    return unranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
