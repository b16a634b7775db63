"""Values a run needs are taken while it writes: no job for each."""
import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.plans.harmonize import log_once
from lakeloom.session import cut_lineage, cut_observed


def jobs(spark, f):
    """Spark jobs that ``f`` runs, and its result."""
    sc = spark.sparkContext
    group = f"count-{id(f)}"
    sc.setJobGroup(group, group)
    try:
        out = f()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group)), out


def test_one_job_less_for_each_value(spark):
    df = spark.range(1000).withColumn("t", F.lit("2024-01-02").cast("timestamp_ntz"))

    def apart():
        out = cut_lineage(spark, df)
        return out.isEmpty(), out.agg(F.max("t")).first()[0]

    def together():
        _, seen = cut_observed(spark, df, n=F.count(F.lit(1)), newest=F.max("t"))
        return not seen["n"], seen["newest"]

    (n_apart, a), (n_together, b) = jobs(spark, apart), jobs(spark, together)
    assert a == b == (False, dt.datetime(2024, 1, 2)) and n_together <= n_apart - 2


def test_observed_values_of_empty_input(spark):
    df, seen = cut_observed(spark, spark.range(10).where("id > 100"), n=F.count(F.lit(1)), newest=F.max("id"))
    assert seen == {"n": 0, "newest": None} and df.count() == 0


def test_log_counts_what_it_appends(spark, tmpdir_path):
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), "bad"), ("1", dt.datetime(2024, 1, 1), "bad"), ("2", dt.datetime(2024, 1, 1), "3")],
                               "id string, ts timestamp_ntz, price string")
    findings = quality.dq_format(df, "id", "ts", "price")
    assert log_once(findings, "2025-01-01", tmpdir_path + "/log") == 2        # the bag: both equal findings
    assert log_once(findings, "2025-01-02", tmpdir_path + "/log") == 0
    assert spark.read.parquet(tmpdir_path + "/log").count() == 2
