"""Spelling variants: words one edit apart, joined over asymmetric q-chunks.

Words are near if one insertion, deletion or replacement of a code point turns
one into the other.  The longer word of a pair (either, if equal) contributes
two disjoint chunks, its front and its back; the shorter one its positional
grams: those at the places where a chunk that the edit spares can stand, which
is the chunk's own place, or one to the left behind a deletion.  One edit spares
one chunk, so every near pair meets in a join on (length, chunk, text), and the
two remainders, one edit apart, verify it.

Common endings make hot join keys.  A key whose chunks and grams would make more
than ``PAIRS`` pairs is not joined: the edit lies in the remainders, so they are
split into chunks and grams again and the finer piece is added to the key, until
the key is cold or the remainder is a single code point (then all its pairs are
near).  No pair is lost and no group's pairs are all formed.

Word counts: every worker counts the words of its documents, sums are shuffled.
A word's form is its most frequent near word if that is at least twice as
frequent; roots follow forms by pointer doubling (counts double from form to
form, so chains are short).

Defined cases: NULL and empty texts have no words; a NULL id counts as an empty
one; ties between forms go to the smaller word in code-point order; repeated
rows count again; empty tables give no rows; extra columns are ignored; words of
any length are compared whole.  Memory per task: one document's words and a
counter of ``KEEP`` words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.store import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run in so many loses a code point (the noise of the contract).
ODDS = 97
#: Words a worker counts before it hands them on; texts taken at a time; pairs of one key.
KEEP, SLICE, PAIRS = 200_000, 256, 1024


def noisy_words(key: int | None, text: bytes | None, least: int, odds: int) -> Counter:
    """Words of one text with at least ``least`` code points, counted; a run
    whose CRC-32 with the id is a multiple of ``odds`` loses one code point."""
    out: Counter = Counter()
    if not text:
        return out
    start = crc32(f"{'' if key is None else key}:".encode())
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        if len(run) >= least:
            h = crc32(run.encode(), start)
            if odds and h % odds == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < least:
                    continue
            out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5,
                odds: int = ODDS) -> DataFrame:
    """``word, n`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    c.update(noisy_words(key, text, least, odds))
                if len(c) >= KEEP:
                    yield _counted(c)
                    c.clear()
        yield _counted(c)

    def _counted(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(c.values(), pa.int64())], names=["word", "n"])

    return (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def _split(rows: DataFrame) -> DataFrame:
    """The two chunks (or grams) of every row's ``rest``: each is added to the
    key, what is left becomes the new ``rest``.  ``gap`` is by how many code
    points the longer word's rest is longer (0 in its own rows)."""
    whole = F.length("rest") + F.col("gap")
    front = F.floor(whole / 2).cast("int")
    back = (whole - front).cast("int")
    kept = (F.length("rest") - back).cast("int")
    pieces = F.array(
        F.struct(F.lit("<").alias("end"), F.expr("substring(rest, 1, front)").alias("piece"),
                 F.expr("substring(rest, front + 1)").alias("left")),
        F.struct(F.lit(">").alias("end"), F.expr("substring(rest, kept + 1)").alias("piece"),
                 F.expr("substring(rest, 1, kept)").alias("left")))
    return (rows.withColumn("whole", whole).withColumn("front", front).withColumn("kept", kept)
            .withColumn("p", F.explode(pieces))
            .select("word", "n", "chunk", "gap", F.concat("key", "p.end", "p.piece").alias("key"),
                    F.col("p.left").alias("rest")))


def near_pairs(words: DataFrame, most: int = PAIRS) -> DataFrame:
    """``a, a_n, b, b_n``: every unordered pair of near words of ``words``
    (``word, n``, distinct), once."""
    size = F.length("word")
    base = words.select("word", "n", F.col("word").alias("rest"))
    chunks = base.select("*", F.lit(True).alias("chunk"), F.lit(0).alias("gap"), F.concat(size.cast("string"), F.lit(":")).alias("key"))
    grams = (base.withColumn("gap", F.explode(F.array(F.lit(0), F.lit(1))))
             .select("word", "n", "rest", F.lit(False).alias("chunk"), "gap",
                     F.concat((size + F.col("gap")).cast("string"), F.lit(":")).alias("key")))
    rows, found = chunks.unionByName(grams), None
    while True:
        rows = written(_split(rows), "chunks")
        many = (rows.groupBy("key").agg(F.count_if("chunk").alias("c"), F.count_if(~F.col("chunk")).alias("g"),
                                        F.max(F.length("rest")).alias("left"))
                .where((F.col("c") * F.col("g") > most) & (F.col("left") > 1)))
        hot = written(many.select("key"), "hot-keys")
        last = hot.isEmpty()
        cold = rows if last else rows.join(hot, "key", "left_anti")
        a = cold.where("chunk").selectExpr("key", "word AS a", "n AS a_n", "rest AS a_rest")
        b = cold.where("NOT chunk").selectExpr("key", "word AS b", "n AS b_n", "rest AS b_rest", "gap")
        pairs = (a.join(b, "key").where("(gap = 1 OR b < a) AND levenshtein(a_rest, b_rest, 1) = 1")
                 .select("a", "a_n", "b", "b_n"))
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            return found.distinct()
        rows = rows.join(hot, "key", "left_semi")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last one."""
    now = written(forms.selectExpr("word", "form AS root", "true AS more"), "roots")
    while True:
        step = now.alias("x").join(now.selectExpr("word AS at", "root AS next").alias("y"), F.col("root") == F.col("at"), "left")
        now = written(step.selectExpr("word", "coalesce(next, root) AS root", "next IS NOT NULL AS more"), "roots")
        if now.where("more").isEmpty():
            return now.select("word", "root")


def spelling_groups(words: DataFrame, factor: int = 2, most: int = PAIRS) -> DataFrame:
    """Per row of ``words`` (``word, n``, distinct): ``word, form, root, n,
    n_near, form_n``."""
    pairs = written(near_pairs(words, most), "near-words")
    both = pairs.selectExpr("a AS word", "a_n AS n", "b AS other", "b_n AS other_n").unionAll(
        pairs.selectExpr("b", "b_n", "a", "a_n"))
    best = (both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("o"))
            .withColumn("fits", -F.col("o.m") >= factor * F.col("n"))
            .selectExpr("word", "n_near", "CASE WHEN fits THEN o.other END AS form", "CASE WHEN fits THEN -o.m END AS form_n"))
    best = written(best, "forms")
    top = roots(best.where("form IS NOT NULL").select("word", "form"))
    return (words.join(best, "word", "left").join(top, "word", "left")
            .selectExpr("word", "form", "coalesce(root, word) AS root", "n", "coalesce(n_near, 0L) AS n_near", "form_n"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5,
                      times: int = 3, odds: int = ODDS) -> DataFrame:
    """``spelling_groups`` over the words of ``docs`` with at least ``least``
    code points that occur at least ``times`` times."""
    return spelling_groups(written(word_counts(docs, id_col, text_col, least, odds).where(F.col("n") >= times), "words"))
