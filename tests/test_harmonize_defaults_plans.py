import datetime as dt

import pytest

import __spark_entry__ as E
from lakeloom import specs
from lakeloom.operators import defaults, quality
from lakeloom.plans.harmonize import TableJob, harmonize
from lakeloom.sources import retail as R


def test_defaults_apply_when_omitted_not_when_null(spark):
    df = spark.createDataFrame([("1", None), ("2", 5)], "customer_id string, loyalty_points int")
    out = {r.customer_id: r for r in defaults.apply_defaults(df, specs.CUSTOMERS, as_of="2025-01-01").collect()}
    assert out["1"].loyalty_points is None and out["2"].loyalty_points == 5
    assert out["1"].membership_status == "Bronze" and out["1"].active_flag is True
    assert out["1"].begin_effective_date == dt.date(2025, 1, 1)
    assert out["1"].end_effective_date == dt.date(9999, 12, 31)
    filled = defaults.apply_defaults(df, specs.CUSTOMERS, as_of="2025-01-01", fill_nulls=True)
    assert {r.loyalty_points for r in filled.collect()} == {0, 5}


def test_harmonize_abort_stops_dirty_batch(spark):
    sf = "/root/testdata/sf0.001"
    job = TableJob(specs.PRODUCTS, rules=(quality.Duplicate(), quality.Format("price")), mode="abort")
    with pytest.raises(quality.DataQualityError):
        harmonize(job, R.raw_products(spark, sf), None, "2025-01-01 00:00:00", "j")


def test_harmonize_nothing_new(spark):
    sf = "/root/testdata/sf0.001"
    job = TableJob(specs.STORES)
    raw = R.raw_stores(spark, sf)
    first = harmonize(job, raw, None, "2025-01-01 00:00:00", "j")
    second = harmonize(job, raw, first.state, "2025-01-02 00:00:00", "j")
    assert second.batch.count() == 0
    assert second.state.count() == first.state.count() == raw.count()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_nested_loop_or_cartesian(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # every expression stays JVM-side: no Python (row or Arrow) evaluation node
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_kpi_scans_read_only_the_columns_they_need(spark):
    import re
    schemas = {}
    for name in ("customer_store_loyalty", "product_sales_summary"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        schemas[name] = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas["customer_store_loyalty"] == ["l_orderkey:bigint", "o_orderkey:bigint,o_custkey:bigint"]
    assert schemas["product_sales_summary"] == [
        "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double",
        "o_orderkey:bigint", "p_partkey:bigint,p_name:string"]


def test_bucketed_facts_join_has_no_shuffle(spark):
    from lakeloom.operators.facts import build_sales_facts
    from lakeloom.plans.publish import save_bucketed
    sf = "/root/testdata/sf0.001"
    spark.sql("CREATE SCHEMA IF NOT EXISTS lakeloom_bucket_test")
    # inputs spread over several tasks: still one file per bucket, not one per bucket and task
    save_bucketed(R.harmonized_line_items(spark, sf).repartition(5), "lakeloom_bucket_test.lines",
                  "invoice_id", 8)
    save_bucketed(R.harmonized_transactions(spark, sf).repartition(3), "lakeloom_bucket_test.headers",
                  "invoice_id", 8, files_per_bucket=2)
    assert len(spark.table("lakeloom_bucket_test.lines").inputFiles()) == 8
    assert len(spark.table("lakeloom_bucket_test.headers").inputFiles()) == 16
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # force the sort-merge plan
    try:
        f = build_sales_facts(spark.table("lakeloom_bucket_test.lines"),
                              spark.table("lakeloom_bucket_test.headers"))
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert f.count() == build_sales_facts(R.harmonized_line_items(spark, sf),
                                              R.harmonized_transactions(spark, sf)).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP SCHEMA lakeloom_bucket_test CASCADE")


def test_catalog_ddl_and_views(spark):
    from lakeloom.plans import catalog
    spec = specs.TableSpec("lakeloom_ddl_test", "t_x", (specs.Column("id", "string", required=True),
                                                          specs.Column("n", "int", default="0")),
                           tags={"sensitivity": "PII"})
    catalog.create_table(spark, spec)
    try:
        assert catalog.table_exists(spark, "lakeloom_ddl_test.t_x")
        spark.sql("INSERT INTO lakeloom_ddl_test.t_x (id) VALUES ('a')")
        assert spark.table("lakeloom_ddl_test.t_x").collect()[0].n == 0      # DEFAULT on omitted column
        from lakeloom.operators.governance import catalog_tags, tagged_tables
        got = [r.table_name for r in tagged_tables(catalog_tags(spark, "lakeloom_ddl_test")).collect()]
        assert got == ["t_x"]
    finally:
        spark.sql("DROP SCHEMA lakeloom_ddl_test CASCADE")


def test_run_log_gives_the_same_watermark_without_scanning_the_target(spark, tmpdir_path):
    from lakeloom.plans.harmonize import RunLog
    from lakeloom.plans.publish import cut_lineage
    from tests.conftest import rows
    sf = "/root/testdata/sf0.001"
    job = TableJob(specs.PRODUCTS, rules=(quality.Duplicate(), quality.Format("price"),
                                          quality.NotNull(("product_name", "price"))), mode="quarantine")
    raw = R.raw_products(spark, sf)
    log = RunLog(spark, tmpdir_path + "/runlog")
    assert log.watermark("p") is None
    first = harmonize(job, raw, None, "2025-01-01 00:00:00", "j", upper=R.SEED_TS, run_log=log, table_name="p")
    state = cut_lineage(spark, first.state)
    log.record("p", first, "2025-01-01 00:00:00")
    assert log.watermark("p") == increment_max(state)
    second = harmonize(job, raw, state, "2025-01-02 00:00:00", "j", run_log=log, table_name="p")
    plain = harmonize(job, raw, state, "2025-01-02 00:00:00", "j")
    assert second.watermark == plain.watermark
    assert rows(second.state) == rows(plain.state)


def increment_max(df):
    from lakeloom.operators.increment import max_watermark
    return max_watermark(df)


def test_persistent_curated_views_and_snapshots(spark, tmpdir_path):
    from lakeloom.operators import curated
    from lakeloom.plans import catalog
    from lakeloom.plans.publish import VersionedTable, publish_snapshot
    from lakeloom.plans.queries import sales_facts_df
    from tests.conftest import rows
    sf = "/root/testdata/sf0.001"
    catalog.ensure_schema(spark, "lakeloom_views_test")
    try:
        sales_facts_df(spark, sf).write.saveAsTable("lakeloom_views_test.t_sales_facts")
        R.harmonized_products(spark, sf).write.saveAsTable("lakeloom_views_test.t_products")
        R.harmonized_customers(spark, sf).write.saveAsTable("lakeloom_views_test.t_customers")
        names = catalog.create_curated_views(spark, "lakeloom_views_test.t_sales_facts",
                                             "lakeloom_views_test.t_customers",
                                             "lakeloom_views_test.t_products", schema="lakeloom_views_test")
        assert names[1] == "lakeloom_views_test.v_product_sales_summary"
        want = curated.product_sales_summary(spark.table("lakeloom_views_test.t_sales_facts"),
                                             spark.table("lakeloom_views_test.t_products"), ordered=False)
        assert rows(spark.table(names[1])) == rows(want)
    finally:
        spark.sql("DROP SCHEMA lakeloom_views_test CASCADE")
    # snapshots: a new folder per version, the view follows the newest
    base = tmpdir_path + "/snap"
    p1 = publish_snapshot(spark, spark.range(3), base, view="lakeloom_snap")
    p2 = publish_snapshot(spark, spark.range(5), base, view="lakeloom_snap")
    assert p1 != p2 and spark.table("lakeloom_snap").count() == 5 and spark.read.parquet(p1).count() == 3
    vt = VersionedTable(spark, tmpdir_path + "/vt")
    assert vt.current() is None
    vt.commit(spark.range(2), 0)
    vt.commit(spark.range(4), 1)
    vt.commit(spark.range(4), 1)               # a replayed epoch rewrites its own version
    assert vt.versions() == [0, 1] and vt.current().count() == 4
    assert vt.current(before=1).count() == 2 and vt.current(before=0) is None
    # replaying epoch 1 from the state below it, written over its own folder: same result
    vt.commit(vt.current(before=1).union(spark.range(2, 4)), 1)
    assert sorted(r.id for r in vt.current().collect()) == [0, 1, 2, 3]


def test_abort_logs_findings_once_then_stops(spark, tmpdir_path):
    sf = "/root/testdata/sf0.001"
    job = TableJob(specs.PRODUCTS, rules=(quality.Duplicate(), quality.Format("price")), mode="abort")
    raw = R.raw_products(spark, sf)
    log = tmpdir_path + "/dq_logs"
    for run_ts in ("2025-01-01 00:00:00", "2025-01-02 00:00:00"):     # a re-run does not re-log
        with pytest.raises(quality.DataQualityError):
            harmonize(job, raw, None, run_ts, "j", dq_log_path=log)
    logged = spark.read.parquet(log)
    expected = quality.dq_findings(raw, "product_id", "r_insert_timestamp", job.rules)
    assert logged.count() == expected.distinct().count() > 0
    assert {r.logged_at.day for r in logged.select("logged_at").distinct().collect()} == {1}


def test_hot_invoice_is_split_by_aqe_skew_join(spark):
    from pyspark.sql import functions as F
    from lakeloom.operators.facts import build_sales_facts
    sf = "/root/testdata/sf0.01"
    li = R.harmonized_line_items(spark, sf)
    # a third of all lines moved onto one invoice
    li = li.withColumn("invoice_id", F.when(F.pmod(F.crc32("line_item_id"), F.lit(3)) == 0, F.lit("0"))
                       .otherwise(F.col("invoice_id")))
    # the skew split cuts a reduce partition along map outputs, so it needs
    # several map tasks; the sf0.01 file is a single split
    li = li.repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
            "spark.sql.shuffle.partitions": "16"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        f = build_sales_facts(li, R.harmonized_transactions(spark, sf))
        # an action on ``f`` itself, so its adaptive plan is the final one
        n = len(f.collect())
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert n == li.count()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_shared_checkpoint_folder_required_off_local(spark):
    from lakeloom.session import ensure_checkpoint_dir, is_local
    assert is_local("local[8]") and is_local("local[*, 4]") and is_local("local")
    assert not is_local("spark://master:7077") and not is_local("yarn") and not is_local("k8s://h:443")
    assert ensure_checkpoint_dir(spark)          # the test session names one (set where unset)


def test_daily_run_gates_products_and_clusters_facts(spark):
    from pyspark.sql import functions as F

    from lakeloom.operators import increment
    from lakeloom.plans import queries as Q
    from lakeloom.plans.daily import CLUSTER_COLUMNS, JOBS
    from tests.conftest import rows
    sf = "/root/testdata/sf0.001"
    base, out = Q.daily_runs(spark, sf)
    job, cols = JOBS["t_products"], specs.RAW_COLUMNS["t_products"]
    held, found, passed = [], 0, set()
    for lo, hi in ((None, Q.CUT), (Q.CUT, None)):       # a run's rows have one ingest stamp
        batch = increment.incremental_batch(R.raw_products(spark, sf), lo, hi)
        # CSV has no empty text: it is read as NULL
        batch = batch.select(*[F.expr(f"nullif({c}, '')").alias(c) for c in cols]).withColumn(job.ts_col, F.lit(Q.RUN))
        good, bad = quality.dq_split(batch, job.key, job.ts_col, job.rules)
        held += rows(bad.select(*cols))
        passed |= {r[0] for r in good.select("product_id").collect()}
        found += quality.dq_findings(batch, job.key, job.ts_col, job.rules).distinct().count()
    stored = spark.read.parquet(base + "/quarantine/t_products")
    assert {r[0] for r in stored.select("run").distinct().collect()} <= {1, 2}
    assert rows(stored.select(*cols)) == sorted(held, key=lambda t: tuple((x is None, str(x)) for x in t)) != []
    log = spark.read.parquet(base + "/dq_log")
    taken = F.col("issue").contains("belongs to another")        # of customers, against stored ones
    assert log.where(~taken).select(*quality.FINDING_COLUMNS).distinct().count() == found > 0
    assert log.where(taken).count() > 0
    assert {r[0] for r in out["t_products"].select("product_id").collect()} == passed
    assert out["t_products"].where("price IS NULL").count() == 0
    assert set(CLUSTER_COLUMNS) <= set(out["t_sales_facts"].columns)
    months = {r[0] for r in out["t_sales_facts"].select("transaction_month").distinct().collect()}
    folders = {f.partition("transaction_month=")[2].partition("/")[0] for f in out["t_sales_facts"].inputFiles()}
    assert folders == {"__HIVE_DEFAULT_PARTITION__" if m is None else str(m) for m in months} and all("/run=" in f for f in out["t_sales_facts"].inputFiles())
