"""Near-duplicates by BagMinHash over multisets of word shingles.

A document is the multiset of its 5-word shingles.  Its signature has one
register per hash slot holding the earliest point of a Poisson process over
(shingle, weight) that falls into the slot; two documents agree in a register
with a chance of exactly their weighted Jaccard similarity.  Weights are
discretised to counts and the processes are hierarchical: the weight axis is
cut into [0,1), [1,2), [2,4), [4,8), ..., each piece an independent process
whose rate is its width, so a shingle that occurs w times needs about log2(w)
processes; in the last piece a point counts only if its place on the weight
axis lies below w.  Points come in ascending order and a process stops once its
next point is later than every register, which is what makes long documents
cheap.

Stages on Spark (only ids, 16-byte text keys and band keys are shuffled; texts
and signatures never are):

1. One pass over the scan gives each row its text key (128-bit hash of its
   words) and ``BANDS`` band keys of ``ROWS`` registers.  Rows with one key are
   copies; from here on a key stands for all of them.
2. Keys that share a band meet in a bucket.  A key whose multiset is mostly its
   own (too few elements occur in any other candidate's) cannot have a partner
   and is left out: in a large group of heavily edited copies that is most of
   them.  Each bucket takes a leader (the key with the most company over all
   bands, which is what a group's original has) and its members are verified
   against it: sizes first, then the exact overlap of the multisets.  Members
   that fail stay in the bucket and meet a few more leaders, as long as a round
   still finds partners for a tenth of them.  Pairs are members x leaders.
3. Verified pairs are links; classes are their connected components.
4. What could be missing are links between members of one bucket that are not
   yet in one class.  Every element falls into one of ``CLASSES`` hash classes;
   the sum of the class-wise minima of two keys' counts is never below their
   overlap, so it rules out pairs without losing a link.  Buckets are dealt into
   blocks, pairs of blocks are tested in a task each, and the few pairs left are
   verified: their links close the classes.

The multisets of candidates (not of all documents) are a written table keyed by
text key; bitmaps of fixed size pick the rows to read again.  With 32 bands of
6 registers a pair of similarity 0.8 meets with probability 0.9999.

Defined cases: words are lower-cased runs of letters, digits and non-ASCII
characters; a document of 1 to 4 words is one shingle of all its words; NULL
and wordless texts are alone in their class (rows without an id have class
NULL there); repeated rows are copies; the class id is the smallest id of the
class; whole texts of any length; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from lakeloom.llm.components import connected_components
from lakeloom.llm.decontaminate import byte_words
from lakeloom.llm.slots import bitmap, found
from lakeloom.llm.store import written

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS
#: Leaders a bucket gets besides the first, on average, in its first round and from then on;
#: a further round follows while the last one settled this share of the members it tried.
LEADS, WORTH = (0, 7), 0.1
#: Hash classes of the elements, members of a block, and pairs of blocks that a worker holds (step 4).
CLASSES, BLOCK, BLOCK_ROWS = 256, 512, "4"
SLICE = 128

_GOLD = np.uint64(0x9E3779B97F4A7C15)               # splitmix64's increment and multipliers
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _step(n: int, by: np.uint64) -> np.uint64:
    """``n * by`` modulo 2 ** 64."""
    return np.uint64(n * int(by) & 0xFFFFFFFFFFFFFFFF)


def mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))


def shingle_counts(words: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as 64-bit hashes, sorted, and how often each occurs."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    s = np.zeros(n, np.uint64)
    for k in range(width):
        s = mix(s + h[k:k + n] + _GOLD)
    return np.unique(s, return_counts=True)


def elements(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset as a set: one 64-bit element per shingle and occurrence."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(np.repeat(shingles, counts) + (nth.astype(np.uint64) + np.uint64(1)) * _M2).view(np.int64))


def _uniform(z: np.ndarray) -> np.ndarray:
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """Registers (documents x slots) of the given bags (shingles, counts)."""
    sig = np.full((len(bags), slots), np.inf)
    flat = sig.reshape(-1)
    doc = np.repeat(np.arange(len(bags)), [len(s) for s, _ in bags])
    shingle = np.concatenate([s for s, _ in bags]) if bags else np.empty(0, np.uint64)
    weight = np.concatenate([c for _, c in bags]) if bags else np.empty(0, np.int64)
    parts, level = [], 0
    while len(doc):                         # the pieces of the weight axis each shingle reaches
        low = 0 if level == 0 else 1 << (level - 1)
        reach = weight > low
        doc, shingle, weight = doc[reach], shingle[reach], weight[reach]
        key = mix(shingle + _step(level + 1, _GOLD))
        parts.append((doc, key, weight, np.full(len(doc), low), np.full(len(doc), max(1, low))))
        level += 1
    if not parts:
        return sig
    doc, key, weight, low, wide = (np.concatenate(c) for c in zip(*parts))
    at, nth = np.zeros(len(doc)), 0
    while len(doc):
        nth += 1
        point = mix(key + _step(nth, _M2))
        at = at - np.log(_uniform(point)) / wide
        live = at < sig.max(axis=1)[doc]    # later points than all registers change nothing
        if not live.all():
            doc, key, weight, low, wide, at, point = (c[live] for c in (doc, key, weight, low, wide, at, point))
        second = mix(point + _GOLD)
        place = low + (_uniform(mix(second + _GOLD)) * wide).astype(np.int64)
        here = place < weight
        slot = doc * slots + (second % np.uint64(slots)).astype(np.int64)
        np.minimum.at(flat, slot[here], at[here])
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """64-bit key per document and band; the band's number is part of it."""
    r = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (len(sig), bands)).copy()
    for k in range(rows):
        key = mix(key + r[:, :, k] + _GOLD)
    return key.view(np.int64)


def _text_key(words: list[bytes]) -> bytes:
    return xxh3_128_digest(b" ".join(words))


def _bytes_key(text):
    """Hash of a text's bytes; empty for NULL (never NULL: joins on it stay dealt by it)."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def signed(docs: DataFrame) -> DataFrame:
    """``id, key, filled, node, size, bands`` per row of ``id, text, key, filled``;
    no words: ``node`` is NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                words = [byte_words(t) for t in batch.column(1).slice(lo, SLICE).to_pylist()]
                bags = [shingle_counts(w) for w in words]
                keys = band_keys(signatures(bags))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(lo, SLICE) for c in (0, 2, 3)),
                    pa.array([_text_key(w) if w else None for w in words], pa.binary()),
                    pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                    pa.array([k if w else None for k, w in zip(keys, words)], pa.list_(pa.int64()))],
                    names=["id", "key", "filled", "node", "size", "bands"])
    return docs.mapInArrow(run, "id long, key binary, filled boolean, node binary, size long, bands array<long>")


def multisets(docs: DataFrame, wanted) -> DataFrame:
    """``node, elems, classes`` (elements per hash class) for the rows whose id is
    in the bitmap ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = wanted.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            crc = np.fromiter((crc32(str(i).encode()) for i in ids), np.uint32, len(ids))
            rows = found(on, crc)
            for lo in range(0, len(rows), SLICE):
                words = [byte_words(batch.column(1)[i].as_py()) for i in rows[lo:lo + SLICE].tolist()]
                words = [w for w in words if w]
                bags = [elements(*shingle_counts(w)) for w in words]
                classes = [np.bincount(e & (CLASSES - 1), minlength=CLASSES) for e in bags]
                yield pa.RecordBatch.from_arrays([
                    pa.array(map(_text_key, words), pa.binary()), pa.array(bags, pa.list_(pa.int64())),
                    pa.array(classes, pa.list_(pa.int32()))], names=["node", "elems", "classes"])
    return docs.mapInArrow(run, "node binary, elems array<long>, classes array<int>")


def _compared(pairs: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """``a, b, sim`` for the pairs (distinct ``a, b, size_a, size_b, common``) that
    their sizes and ``common`` do not rule out (the smaller of the two counts of
    elements that occur elsewhere too: it bounds the overlap)."""
    size = F.col("size_a") + F.col("size_b")
    most = F.least("size_a", "size_b", "common")
    same = F.size(F.array_intersect("x", "y"))
    return (pairs.where(most / (size - most) >= similar - 1e-9)
            .join(bags.selectExpr("node AS a", "elems AS x"), "a").join(bags.selectExpr("node AS b", "elems AS y"), "b")
            .select("a", "b", (same / (size - same)).alias("sim")))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``id_col, class_id`` for every row of ``docs``."""
    named = _classed(docs, id_col, text_col, similar)
    class_id = named.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("class_id"))
    return (named.join(class_id, "comp", "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id")))


def _classed(docs: DataFrame, id_col: str, text_col: str, similar: float) -> DataFrame:
    """``id, key, filled, comp`` per row: the hash of its bytes, whether the text
    is not empty, and its class (NULL: a text without words)."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"), _bytes_key(text).alias("key"),
                         (F.coalesce(F.length(text), F.lit(0)) > 0).alias("filled"))
    rows = written(signed(source), "signed")
    nodes = (rows.where("node IS NOT NULL").groupBy("node")
             .agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    entries = nodes.select("id", "node", "size", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    met = written(entries.join(shared, "band"), "met")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(met.select("id"), F.col("id").cast("string")))
    bags = written(multisets(source.select("id", "text"), wanted).groupBy("node").agg(F.first("elems").alias("elems"), F.first("classes").alias("classes")), "multisets")
    common = written(_common(bags), "common")
    met = met.join(common.drop("all"), "node").where(F.col("common") >= similar * F.col("size"))
    least = met.groupBy("band").agg(F.min("size").alias("least"))
    partner = F.greatest(F.col("least"), similar * F.col("size"))   # no partner in the bucket is smaller
    enough = F.col("common") >= similar / (1 + similar) * (F.col("size") + partner) - 1e-6
    met = met.join(least, "band").where(enough).drop("least")
    shared = met.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")     # already dealt by band
    met = written(met.join(shared, "band"), "shared")
    buckets = written(met.join(met.groupBy("node").agg(F.sum("n").alias("company")), "node").drop("n"), "buckets")

    links = _judge(buckets, bags, similar)
    comps = connected_components(links)
    more = _bridges(buckets, comps, bags, similar)
    if more.take(1):
        comps = connected_components(links.unionByName(more), comps)
    return (rows.join(comps, "node", "left")
            .select("id", "key", "filled", F.coalesce("comp", "node").alias("comp")))


def _common(bags: DataFrame) -> DataFrame:
    """``node, all, common``: a multiset's elements, and how many of them occur in
    another one too.  A partner's overlap consists of these (a partner is a candidate
    itself), so a node with too few of them has none, and nothing is lost by
    leaving it out."""
    each = bags.select(F.xxhash64("node").alias("h"), F.explode("elems").alias("e"))
    once = each.groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("h")).where("n = 1")
    own = once.groupBy("h").agg(F.count(F.lit(1)).alias("own"))
    return (bags.select("node", F.size("elems").alias("all")).join(own, F.xxhash64("node") == F.col("h"), "left")
            .select("node", F.col("all").cast("long").alias("all"), (F.col("all") - F.coalesce("own", F.lit(0))).alias("common")))


def _judge(open_: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Step 2 for the buckets ``open_`` (``band, node, size, common, company``):
    the links found, ``a, b``."""
    turn, links = 0, None
    while True:
        # the member with the most company, and about LEADS[turn] more by hash
        top = open_.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(-F.col("company"), "node")).alias("top"))
        by_hash = F.pmod(F.xxhash64("band", "node", F.lit(turn)), F.col("n")) < LEADS[min(turn, len(LEADS) - 1)]
        members = (open_.join(top, "band").withColumn("leading", (F.col("node") == F.col("top.node")) | by_hash)
                   .select("band", "company", "node", "size", "common", "leading"))      # stays dealt by band
        lead = members.where("leading").select("band", F.col("node").alias("lead"), F.col("size").alias("size_b"),
                                               F.col("common").alias("common_b"))
        tried = (members.join(lead, "band")
                 .where("node <> lead AND (NOT leading OR node < lead)")         # two leaders meet once
                 .withColumn("a", F.least("node", "lead")).withColumn("b", F.greatest("node", "lead")))
        tried = written(tried, "tried")
        size_a = F.when(F.col("a") == F.col("node"), F.col("size")).otherwise(F.col("size_b"))
        pairs = tried.select("a", "b", size_a.alias("size_a"), (F.col("size") + F.col("size_b") - size_a).alias("size_b"),
                             F.least("common", "common_b").alias("common")).distinct()
        near = written(_compared(pairs, bags, similar).where(F.col("sim") >= similar).select("a", "b"), "near")
        links = near if links is None else links.unionByName(near)
        judged = tried.join(near.withColumn("near", F.lit(True)), ["a", "b"], "left")
        rest = (judged.where(~F.col("leading")).groupBy("band", "node")
                .agg(F.first("company").alias("company"), F.first("size").alias("size"), F.first("common").alias("common"),
                     F.max(F.coalesce("near", F.lit(False))).alias("settled")))
        rest = written(rest, "open")
        count = rest.agg(F.count(F.lit(1)).alias("n"), F.count_if("settled").alias("settled")).first()
        open_ = rest.where(~F.col("settled")).drop("settled")
        if count.settled == count.n or (turn and count.settled < WORTH * count.n):
            return links
        turn += 1


def _bridges(buckets: DataFrame, comps: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Step 4: links (``a, b``) between members of one bucket that are in no
    common class yet.  A bucket is dealt into blocks of about ``BLOCK`` members
    by hash; two blocks at a time meet in a task, which hands on only the pairs
    that the class-wise bound leaves."""
    sides = (buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
             .select("band", "node", "size", "common", "comp"))
    mixed = (sides.groupBy("band").agg((F.min("comp") != F.max("comp")).alias("mixed"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
             .where("mixed").select("band", "blocks"))
    member = F.struct("node", "comp", "size", "common", "classes", "block")
    met = (sides.join(mixed, "band").join(bags.select("node", "classes"), "node")
           .withColumn("block", F.pmod(F.xxhash64("node", "band"), F.col("blocks")))
           .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .groupBy("band", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
           .agg(F.collect_list(member).alias("members")).select("x", "y", "members"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _block_pairs(batch, similar)

    pairs = written(met.mapInArrow(search, "a binary, b binary, size_a long, size_b long, common long"), "open-pairs", BLOCK_ROWS)
    return written(_compared(pairs.distinct(), bags, similar).where(F.col("sim") >= similar).select("a", "b"), "bridges")


def _block_pairs(batch: pa.RecordBatch, similar: float) -> Iterator[pa.RecordBatch]:
    """Pairs of ``members`` of the blocks ``x`` and ``y`` that are in different
    classes and that no bound rules out, the smaller key as ``a``."""
    ends, flat = np.asarray(batch.column(2).offsets), batch.column(2).values
    comp = np.asarray(flat.field("comp").dictionary_encode().indices)
    size, common, block = (flat.field(n).to_numpy() for n in ("size", "common", "block"))
    classes = np.asarray(flat.field("classes").flatten()).reshape(-1, CLASSES)
    node = flat.field("node")
    for x, y, start, stop in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends, ends[1:]):
        here = np.arange(start, stop)
        one, two = here[block[here] == x], here[block[here] == y]
        need = similar / (1 + similar) * (size[one][:, None] + size[two][None]) - 1e-6      # the overlap a link needs
        hope = (comp[one][:, None] != comp[two][None]) & (np.minimum(
            np.minimum(size, common)[one][:, None], np.minimum(size, common)[two][None]) >= need)
        i, j = np.nonzero(np.triu(hope, 1) if x == y else hope)
        left = [np.empty(0, np.int64)]
        for lo in range(0, len(i), 4096):
            p, q = i[lo:lo + 4096], j[lo:lo + 4096]
            left.append(lo + np.flatnonzero(np.minimum(classes[one[p]], classes[two[q]]).sum(1) >= need[p, q]))
        keep = np.concatenate(left)
        if len(keep):
            i, j = one[i[keep]], two[j[keep]]
            pairs = list(zip(node.take(pa.array(i)).to_pylist(), node.take(pa.array(j)).to_pylist()))
            swap = np.fromiter((u > v for u, v in pairs), bool, len(i))
            yield pa.RecordBatch.from_arrays([
                pa.array(map(min, pairs), pa.binary()), pa.array(map(max, pairs), pa.binary()),
                pa.array(np.where(swap, size[j], size[i])), pa.array(np.where(swap, size[i], size[j])),
                pa.array(np.minimum(common[i], common[j]))], names=["a", "b", "size_a", "size_b", "common"])


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of every group of copies and near copies: the one with
    the smallest id, of its texts under that id the one with the smallest hash.
    Wordless texts (punctuation only) are copies if equal byte by byte; empty
    and NULL texts are nobody's copy.  Repeated rows (id and text) stay once;
    rows without an id cannot name a class and all stay.  All columns pass
    through, whatever their names."""
    text = F.col(text_col).cast("string")
    named = _classed(docs, id_col, text_col, SIMILAR).where("id IS NOT NULL")
    group = F.coalesce("comp", F.when(F.col("filled"), F.concat(F.lit("-").cast("binary"), "key")))
    named = written(named.select("id", "key", group.alias("comp")), "grouped")
    keep = (named.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("id", "key")).alias("k")).select("k.*")
            .unionByName(named.where("comp IS NULL").select("id", "key"))
            .selectExpr("id AS keep_id", "key AS keep_key").distinct())
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), _bytes_key(text).alias("key"))
    kept = keyed.join(keep, (F.col("id") == F.col("keep_id")) & (F.col("key") == F.col("keep_key")), "left_semi")
    return kept.dropDuplicates(["id", "key"]).unionByName(keyed.where("id IS NULL")).select("row.*")
