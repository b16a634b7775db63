"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are its runs of 10 words (an item of fewer words is
one window).  A document contains a window when all its words stand in it in
the same order, so the overlap asked for is the whole window and the prefix
that must be shared is one token: the rarest of its words.

1. Rarity: one pass over the documents counts the benchmark's words (others
   are left out by a bitmap of fixed size); counts are summed per task before
   they are shuffled.
2. Every window is filed under its rarest word, with the word's offset in it.
   Windows with a word that no document has are dropped.
3. A second pass emits only the places of such words in documents, with the
   words around them; an equi-join brings the windows filed there.  The
   positional bound (offset words before, the rest after) and the length bound
   discard a pair before its words are compared one by one.
4. Hits are united per document: a word counts once however many windows and
   items cover it.

What is broadcast are two bitmaps of fixed size.  A word in very many documents
is a hot join key with few windows on the other side; adaptive execution splits
it.  Memory per task: one document's words.

Defined cases: NULL text has no words; empty items have no windows; items
without an id are ignored; repeated items and rows give the same result as one
(each input row is reported); empty tables give empty results or no hits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.slots import bitmap, found
from lakeloom.llm.store import written

WINDOW = 10
#: Word characters are 0-9, a-z (A-Z lower-cased) and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same on UTF-8 bytes: lower-case, and a blank for all that is no word character.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLICE = 256


def byte_words(text: bytes | None) -> list[bytes]:
    return text.translate(BYTES).split() if text else []


def _crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``item``, ``words`` (array): the windows of every item."""
    words = F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), UPPER, LOWER), F.lit(WORD), F.lit(0))
    return (items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words.alias("all"))
            .where("size(all) > 0")
            .select("item", F.explode(F.expr(
                f"transform(sequence(1, greatest(1, size(all) - {width - 1})), i -> slice(all, i, {width}))")).alias("words")))


def word_counts(texts: DataFrame, bits_on) -> DataFrame:
    """``word, n`` over all texts for words in the bitmap (and a few others)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, c = bits_on.value, Counter()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(lo, SLICE).to_pylist():
                    words = byte_words(text)
                    c.update([words[i] for i in found(on, _crc(words))])
            if len(c) > 200_000:
                yield _counted(c)
                c = Counter()
        yield _counted(c)

    def _counted(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in c], pa.string()),
                                           pa.array(c.values(), pa.int64())], names=["word", "n"])
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, bits_on, width: int) -> DataFrame:
    """One row per document: ``id, key, n_words`` and ``spots``: the places of
    words in the bitmap with up to ``width - 1`` words on each side."""
    spot = pa.struct([("word", pa.string()), ("pos", pa.int64()), ("before", pa.int32()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = bits_on.value
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                count, spots = [], []
                for text in part.column(2).to_pylist():
                    words = byte_words(text)
                    count.append(len(words))
                    spots.append([{"word": words[p].decode(), "pos": p, "before": min(p, width - 1),
                                   "around": b" ".join(words[max(0, p - width + 1):p + width]).decode()}
                                  for p in found(on, _crc(words)).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count, pa.int64()), pa.array(spots, pa.list_(spot))],
                    names=["id", "key", "n_words", "spots"])

    return docs.mapInArrow(run, "id long, key long, n_words long, "
                                "spots array<struct<word:string,pos:long,before:int,around:string>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW
                  ) -> tuple[DataFrame, DataFrame]:
    """(``documents``, ``matches``): per row of ``docs`` ``id, n_words, n_hit,
    n_items, items`` (sorted ids as strings), and per occurrence of a window
    ``id, key, start, length, item`` (word positions from 0)."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("key"),
                         text.cast("binary").alias("text"))
    windows = item_windows(items, item_col, item_text_col, width).distinct()

    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = word_counts(source.select("text"), share(bitmap(vocabulary, F.col("word"))))
    ranked = (windows.select("item", "words", F.posexplode("words").alias("offset", "word"))
              .join(counts, "word", "left")
              .groupBy("item", "words")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rarest")))
    filed = written(ranked.where("rarest.n > 0")
                    .select("item", F.col("words").alias("want"), "rarest.word", "rarest.offset"), "windows")

    spots = written(places(source, share(bitmap(filed, F.col("word"))), width), "spots")
    matches = (spots.where("size(spots) > 0").select("id", "key", "n_words", F.explode("spots").alias("s"))
               .select("id", "key", "n_words", "s.*").join(filed, "word")
               .where("offset <= pos AND pos - offset + size(want) <= n_words")
               .where("slice(split(around, ' '), before - offset + 1, size(want)) = want")
               .select("id", "key", (F.col("pos") - F.col("offset")).alias("start"),
                       F.size("want").cast("long").alias("length"), "item").distinct())

    runs = matches.groupBy("id", "key", "start").agg(F.max("length").alias("length"))
    reach = F.max(F.col("start") + F.col("length")).over(
        Window.partitionBy("id", "key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    hit = (runs.withColumn("new_from", F.greatest(F.col("start"), F.coalesce(reach, F.lit(0))))
           .groupBy("id", "key")
           .agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("length") - F.col("new_from"))).alias("n_hit")))
    listed = matches.groupBy("id", "key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = listed.join(hit.withColumnsRenamed({"id": "h_id", "key": "h_key"}),
                       F.expr("id <=> h_id AND key = h_key")).drop("h_id", "h_key")
    documents = (spots.select("id", "key", "n_words").alias("d")
                 .join(both.alias("m"), F.expr("d.key = m.key AND d.id <=> m.id"), "left")
                 .select("d.id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                         F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    return documents, matches


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of any item."""
    _, matches = contamination(docs, items, id_col, text_col, item_col, item_text_col, width)
    hit = matches.select("key").distinct()
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))        # whatever the columns are called
    return rows.join(hit, "key", "left_anti").select("row.*")
