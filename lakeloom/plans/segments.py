"""Facts stored in segments, and their incremental compaction.

Every load appends one segment (a folder, a partition of a ``LocatedTable``) per
month.  A compaction reads the stored files' sizes and the ranges of the first
cluster column, chooses the segments worth rewriting, and switches them for new
ones by location; all others keep their files and names.  Chosen are, in a
month:

* small segments (under half of ``target_bytes``), packed in the order of their
  ranges into bins of about the target, where a bin holds two or more;
* the members of a stretch of overlapping ranges that is more than
  ``max_depth`` deep at some place: a lookup there would open all of them.

New segments are disjoint ranges of the first cluster column of about the
target's size, each sorted by z-value over all cluster columns.  So what one
compaction has laid well, the next leaves alone.

Defined cases: rows without a month form segments of their own; a segment whose
first cluster column is NULL throughout overlaps nothing; an empty load and a
compaction with nothing to choose publish nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import layout, scd1
from lakeloom.plans.located import LocatedTable

SEGMENT = "_segment"


class SegmentedTable:
    def __init__(self, spark: SparkSession, name: str, struct: T.StructType, base: str, month_col: str, columns: list[str],
                 target_bytes: int = 256 << 20, max_depth: int = 4):
        self.table = LocatedTable(spark, name, T.StructType([*struct, T.StructField(SEGMENT, T.StringType())]), SEGMENT, base)
        self.names, self.month_col, self.columns = struct.names, month_col, columns
        self.target, self.max_depth = target_bytes, max_depth

    def read(self) -> DataFrame:
        return self.table.read().select(*self.names)

    def append(self, rows: DataFrame, run: int) -> None:
        """A segment for each month of ``rows``; nothing stored is read."""
        self.table.before(run)
        self.table.publish(rows.select(*self.names, self._name(run, F.lit(0)).alias(SEGMENT)), run)

    def segments(self) -> DataFrame:
        """``segment, month, bytes, n, lo, hi`` of every stored segment: a scan
        of two columns and of the files' sizes."""
        first = self.columns[0]
        files = (self.table.read()
                 .select(SEGMENT, self.month_col, first, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
                 .groupBy(SEGMENT, "file").agg(F.min(self.month_col).alias("month"), F.max("size").alias("size"),
                                               F.count(F.lit(1)).alias("n"), F.min(first).alias("lo"), F.max(first).alias("hi")))
        return (files.groupBy(F.col(SEGMENT).alias("segment"))
                .agg(F.min("month").alias("month"), F.sum("size").alias("bytes"), F.sum("n").alias("n"),
                     F.min("lo").alias("lo"), F.max("hi").alias("hi")))

    def chosen(self) -> DataFrame:
        """``segments`` to rewrite, one row each."""
        by_range = Window.partitionBy("month").orderBy(F.col("lo").asc_nulls_first(), "segment")
        # small ones: bins of a running size
        small = self.segments().withColumn("small", F.col("bytes") * 2 < self.target)
        fill = F.sum(F.when(F.col("small"), F.col("bytes"))).over(by_range.rowsBetween(Window.unboundedPreceding, 0))
        binned = small.withColumn("bin", F.when(F.col("small"), F.floor((fill - F.col("bytes")) / self.target)))
        in_bin = F.count("bin").over(Window.partitionBy("month", "bin"))
        # stretches of overlapping ranges
        reach = F.max("hi").over(by_range.rowsBetween(Window.unboundedPreceding, -1))
        stretch = F.sum(F.when((F.col("lo") <= F.col("reach")), 0).otherwise(1)).over(by_range)
        marked = (binned.withColumn("packs", F.col("small") & (in_bin > 1)).withColumn("reach", reach)
                  .withColumn("stretch", stretch))
        # depth at each start: ranges begun so far less those that ended before it
        ends = marked.select("month", "stretch", F.explode(F.array(
            F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")),
            F.struct(F.col("hi").alias("at"), F.lit(-1).alias("step")))).alias("e")).select("month", "stretch", "e.*")
        depth = F.sum("step").over(Window.partitionBy("month", "stretch").orderBy("at", F.desc("step"))
                                   .rowsBetween(Window.unboundedPreceding, 0))
        deep = (ends.where("at IS NOT NULL").withColumn("depth", depth).groupBy("month", "stretch")
                .agg((F.max("depth") > self.max_depth).alias("deep"))
                .select(F.col("month").alias("_m"), F.col("stretch").alias("_s"), "deep"))
        return (marked.join(deep, F.col("month").eqNullSafe(F.col("_m")) & (F.col("stretch") == F.col("_s")), "left")
                .where(F.col("packs") | F.coalesce("deep", F.lit(False)))
                .select("segment", "month", "bytes", "n", "lo", "hi"))

    def compact(self, run: int) -> list[str]:
        """Rewrite the chosen segments; returns their names."""
        self.table.before(run)
        chosen = self.chosen().collect()        # a row per segment to rewrite: names and sizes
        if not chosen:
            return []
        sizes: dict = {}
        for r in chosen:
            sizes[r.month] = sizes.get(r.month, 0) + r.bytes
        ranges = {m: max(1, -(-b // self.target)) for m, b in sizes.items()}
        most = max(ranges.values())
        rows = scd1.restrict_to(self.table.read(), SEGMENT, [r.segment for r in chosen]).select(*self.names)
        counts = self.table.spark.createDataFrame([(None if m is None else str(m), n) for m, n in ranges.items()], "_m string, _n int")
        bounds = layout.sample_bounds(rows, self.columns[:1], most)[self.columns[0]]
        dealt = (layout.with_bucket(rows, self.columns[0], bounds, "_b")
                 .join(counts, F.col(self.month_col).cast("string").eqNullSafe(F.col("_m")))
                 .withColumn(SEGMENT, self._name(run, F.floor(F.col("_b") * F.col("_n") / most))))
        keyed = layout.with_zorder(dealt, self.columns, layout.bits_for(sum(ranges.values()), len(self.columns)))
        stored = keyed.hint("rebalance", F.col(SEGMENT)).sortWithinPartitions(SEGMENT, "_z").select(*self.names, SEGMENT)
        self.table.publish(stored, run, [r.segment for r in chosen], arranged=True)
        return sorted(r.segment for r in chosen)

    def _name(self, run: int, number: Column) -> Column:
        month = F.coalesce(F.col(self.month_col).cast("string"), F.lit("none"))
        return F.concat_ws("_", month, F.lit(run).cast("string"), number.cast("string"))
