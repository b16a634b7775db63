"""Incremental compaction: which segments are rewritten, which keep their files."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeloom.plans.segments import SEGMENT, SegmentedTable

JAN, FEB, MAR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


@pytest.fixture()
def make(spark, tmpdir_path):
    schema = "segments_" + os.path.basename(tmpdir_path).replace("-", "_")

    def build(**kw):
        struct = spark.createDataFrame([], "line string, customer long, product string, month date").schema
        return SegmentedTable(spark, f"{schema}.t", struct, tmpdir_path + "/t", "month", ["customer", "product"], **kw)
    yield build
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def load(spark, month, n, lo=0, hi=1000, tag=""):
    return spark.range(n).select(F.concat(F.lit(f"{month}{tag}-"), "id").alias("line"),
                                 (F.col("id") % (hi - lo) + lo).alias("customer"),
                                 F.md5(F.col("id").cast("string")).alias("product"), F.lit(month).cast("date").alias("month"))


def test_small_segments_are_packed_and_others_kept(spark, make):
    t = make()
    t.append(load(spark, JAN, 5000).unionByName(load(spark, FEB, 300)), 1)
    big = t.segments().where(F.col("month") == JAN).first().bytes
    t.target = big          # January's segment is of the target's size
    t.append(load(spark, FEB, 300, tag="b").unionByName(load(spark, None, 10)), 2)
    t.append(load(spark, FEB, 300, tag="c").unionByName(load(spark, MAR, 20)), 3)
    want, before = rows(t.read()), t.table.locations()
    assert len(before) == 6
    assert t.compact(4) == [f"{FEB}_{r}_0" for r in (1, 2, 3)]
    after = t.table.locations()
    assert set(after) == {f"{JAN}_1_0", f"{FEB}_4_0", f"{MAR}_3_0", "none_2_0"}     # single small ones have no company
    assert all(after[s] == before[s] for s in after if s in before)
    assert rows(t.read()) == want
    assert t.compact(5) == [] and t.table.locations() == after


def test_deep_stretches_become_disjoint_ranges(spark, make):
    t = make(max_depth=3)
    for run in range(1, 6):
        t.append(load(spark, JAN, 2000, tag=str(run)), run)
    t.append(load(spark, JAN, 2000, 5000, 6000, tag="far"), 6)     # overlaps nothing: stays
    t.target = t.segments().agg(F.min("bytes")).first()[0]
    want = rows(t.read())
    assert t.compact(7) == [f"{JAN}_{r}_0" for r in range(1, 6)]
    assert f"{JAN}_6_0" in t.table.locations() and rows(t.read()) == want
    spans = sorted((r.lo, r.hi) for r in t.segments().collect())
    assert len(spans) >= 5 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert not t.chosen().where(F.col("segment").startswith(f"{JAN}_6")).count()


def test_repeated_runs_and_empty_loads(spark, make):
    t = make()
    assert t.compact(1) == [] and t.read().count() == 0
    t.append(load(spark, JAN, 100), 2)
    t.append(load(spark, JAN, 100, tag="b"), 3)
    want = rows(t.read())
    assert t.compact(4) == t.compact(4) == [f"{JAN}_2_0", f"{JAN}_3_0"]     # taken back and done again
    assert rows(t.read()) == want and set(t.table.locations()) == {f"{JAN}_4_0"}
    t.append(load(spark, JAN, 0), 5)
    assert rows(t.read()) == want and SEGMENT not in t.read().columns


def test_null_cluster_values(spark, make):
    t = make()
    for run in (1, 2):
        t.append(load(spark, JAN, 50, tag=str(run)).withColumn("customer", F.lit(None).cast("long")), run)
    want = rows(t.read())
    assert len(t.compact(3)) == 2 and rows(t.read()) == want
