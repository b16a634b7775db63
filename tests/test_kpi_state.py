"""Monthly KPI state against the views over the facts."""
import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom import specs as S
from lakeloom.operators import curated
from lakeloom.plans import daily
from lakeloom.plans.kpi_state import KpiState
from lakeloom.plans.located import LocatedTable
from tests.conftest import rows

COLS = "customer_id string, product_id string, store_id string, invoice_id string, quantity int, unit_price decimal(10,2), transaction_month date"


def facts_of(spark, n, seed):
    out = []
    for i in range(n):
        h = (i * 7919 + seed * 104729) % 1009
        out.append((None if h % 17 == 0 else f"c{h % 40}", f"p{h % 9}", None if h % 5 == 0 else f"s{h % 11}", None if h % 13 == 0 else str(i),
                    None if h % 19 == 0 else h % 7, Decimal(h) / 4, None if h % 50 == 0 else dt.date(2024, 1 + h % 6, 1)))
    return spark.createDataFrame(out, COLS)


@pytest.fixture()
def schema(spark, tmpdir_path):
    out = "kpi_" + os.path.basename(tmpdir_path).replace("-", "_")
    yield out
    spark.sql(f"DROP SCHEMA IF EXISTS {out} CASCADE")


def test_state_follows_changed_months_only(spark, tmpdir_path, schema):
    products = spark.createDataFrame([(f"p{i}", f"n{i % 4}") for i in range(9)], "product_id string, product_name string")
    people = spark.createDataFrame([(f"c{i}", f"f{i % 7}", "l", i, "Gold", v) for i in range(40) for v in (True, False) if v or i % 3],
                                   "customer_id string, first_name string, last_name string, loyalty_points int, membership_status string, active_flag boolean")
    kpis = KpiState(spark, schema, tmpdir_path + "/kpi")
    one, two = facts_of(spark, 3000, 1), facts_of(spark, 3000, 2)
    kpis.refresh(one, None, 1)
    march, none = dt.date(2024, 3, 1), None
    in_two = F.col("transaction_month").eqNullSafe(F.lit(march)) | F.col("transaction_month").isNull()
    mixed = one.where(~in_two).unionByName(two.where(in_two))
    before = {n: t.locations() for n, t in kpis.tables.items()}
    for _ in range(2):                                             # the repeat gives the same state
        kpis.refresh(mixed, [march, none], 2)
        assert rows(kpis.product_sales_summary(products)) == rows(curated.product_sales_summary(mixed, products))
        for current in (False, True):
            assert rows(kpis.customer_summary(people, current)) == rows(curated.customer_summary(mixed, people, current))
        assert rows(kpis.customer_store_loyalty()) == rows(curated.customer_store_loyalty(mixed))
    for n, t in kpis.tables.items():
        assert {v for v, p in t.locations().items() if before[n].get(v) != p} == {"2024-03-01", None}
    kpis.refresh(mixed, [], 3)                                     # nothing changed
    assert rows(kpis.customer_store_loyalty()) == rows(curated.customer_store_loyalty(mixed))


def test_refresh_reads_touched_months_only(spark, tmpdir_path, schema):
    t = LocatedTable(spark, f"{schema}.f", facts_of(spark, 1, 1).schema, "transaction_month", tmpdir_path + "/f")
    t.publish(facts_of(spark, 2000, 1), 1)
    from lakeloom.operators import scd1
    read = scd1.restrict_to(t.read(), "transaction_month", [dt.date(2024, 3, 1)]).inputFiles()
    assert read and all("transaction_month=2024-03-01" in f for f in read)


def test_store_numbers_are_stable_and_bitmaps_span_buckets(spark, tmpdir_path, schema):
    kpis = KpiState(spark, schema, tmpdir_path + "/kpi", ("stores",))
    month = F.lit("2024-01-01").cast("date")
    base = spark.range(40_000).selectExpr("concat('c', id % 2) AS customer_id", "concat('s', id) AS store_id").withColumn("transaction_month", month)
    kpis.refresh(base, None, 1)
    first = {r.store_id: r.number for r in kpis.numbers.read().collect()}
    assert len(set(first.values())) == 40_000 and min(first.values()) >= 1
    counts = curated.store_counts(kpis.tables["stores"].read())
    assert rows(counts) == [("c0", 20_000), ("c1", 20_000)]
    assert kpis.tables["stores"].read().select("bucket").distinct().count() > 1
    more = spark.range(39_990, 40_010).selectExpr("'c0' AS customer_id", "concat('s', id) AS store_id").withColumn(
        "transaction_month", F.lit("2024-02-01").cast("date"))
    kpis.refresh(base.unionByName(more), [dt.date(2024, 2, 1)], 2)
    second = {r.store_id: r.number for r in kpis.numbers.read().collect()}
    assert len(set(second.values())) == 40_010 and all(second[k] == v for k, v in first.items())
    assert rows(curated.store_counts(kpis.tables["stores"].read())) == [("c0", 20_015), ("c1", 20_000)]


def test_facts_of_untouched_months_keep_their_files(spark, tmpdir_path, schema):
    """``refresh_facts`` for one month: others keep their files, and months of
    changed lines are found through their invoices."""
    def lines(qty):
        return spark.createDataFrame([(f"l{i}", f"i{i % 6}", "p1", qty if i == 3 else 1, Decimal(1), Decimal(1), None) for i in range(12)],
                                     "line_item_id string, invoice_id string, product_id string, quantity int, unit_price decimal(10,2), "
                                     "total_price decimal(10,2), discount_applied decimal(10,2)")
    heads = spark.createDataFrame([(f"i{i}", "s", "c", None, "cash", dt.datetime(2024, 1 + i, 5), dt.date(2024, 1 + i, 1), Decimal(2)) for i in range(6)],
                                  "invoice_id string, store_id string, customer_id string, employee_id string, payment_type string, "
                                  "transaction_date_time timestamp_ntz, transaction_month date, total_amount decimal(10,2)")
    t = LocatedTable(spark, f"{schema}.t_sales_facts", S.SALES_FACTS.struct(), "transaction_month", tmpdir_path + "/facts")
    daily.refresh_facts(spark, t, lines(1), heads, [dt.date(2024, 1 + i, 1) for i in range(6)], 1)
    first = set(t.read().inputFiles())
    batch = lines(9).where("line_item_id = 'l3'")
    months = daily.changed_months(lines(9), heads, batch, batch.withColumn("invoice_id", F.lit("i5")), [])
    assert months == [dt.date(2024, 4, 1), dt.date(2024, 6, 1)]
    daily.refresh_facts(spark, t, lines(9), heads, months, 2)
    second = set(t.read().inputFiles())
    assert len(first & second) == 4 and all("04-01" in f or "06-01" in f for f in first ^ second)
    assert t.read().agg(F.sum("quantity")).first()[0] == 20
    daily.refresh_facts(spark, t, lines(9), heads, [], 3)
    assert set(t.read().inputFiles()) == second


def test_facts_are_dealt_to_a_task_per_month(spark, tmpdir_path, schema):
    """A small table's months are written by several tasks, each in one file; a
    month that holds nearly all rows of several files is dealt by z-range."""
    lines = spark.range(600).selectExpr("concat('l', id) AS line_item_id", "concat('i', id % 24) AS invoice_id", "concat('p', id % 9) AS product_id",
                                        "1 AS quantity", "1.00BD AS unit_price", "1.00BD AS total_price", "0.00BD AS discount_applied")
    heads = spark.range(24).selectExpr("concat('i', id) AS invoice_id", "'s' AS store_id", "concat('c', id) AS customer_id", "'e' AS employee_id",
                                       "'cash' AS payment_type", "timestamp_ntz'2024-01-05 00:00:00' AS transaction_date_time",
                                       "if(id = 23, NULL, add_months(date'2024-01-01', id % 12)) AS transaction_month", "2.00BD AS total_amount")
    t = LocatedTable(spark, f"{schema}.t_sales_facts", S.SALES_FACTS.struct(), "transaction_month", tmpdir_path + "/facts")
    months = [r[0] for r in heads.select("transaction_month").distinct().collect()]
    daily.refresh_facts(spark, t, lines, heads, months, 1)
    files = t.read().inputFiles()
    assert len(files) == len(months) == 13 and len({f.rpartition("/")[2][:10] for f in files}) > 2
    assert t.read().count() == 600 and t.read().where("transaction_month IS NULL").count() == 25


def test_invoices_are_looked_up_in_other_months_only(spark):
    """Where every stored month changes anyway, the changed lines are not read."""
    heads = spark.createDataFrame([("i1", dt.date(2024, 1, 1)), ("i2", None)], "invoice_id string, transaction_month date")
    unread = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("invoice_id"))
    assert daily.changed_months(None, heads, unread, unread, [None, dt.date(2024, 1, 1)]) == [dt.date(2024, 1, 1), None]
    batch = spark.createDataFrame([("i2",)], "invoice_id string")
    assert daily.changed_months(None, heads, batch, None, [dt.date(2024, 1, 1)]) == [dt.date(2024, 1, 1), None]


def test_facts_of_many_files_are_clustered_by_period(spark, tmpdir_path, schema, monkeypatch):
    """Only a period's rows are shuffled at once; every row and month is there, the stage is not."""
    from lakeloom import session
    from lakeloom.operators import facts, layout
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: tmpdir_path + "/kept")
    lines = spark.range(600).selectExpr("concat('l', id) AS line_item_id", "concat('i', id % 24) AS invoice_id", "concat('p', id % 9) AS product_id",
                                        "1 AS quantity", "1.00BD AS unit_price", "1.00BD AS total_price", "0.00BD AS discount_applied")
    heads = spark.range(24).selectExpr("concat('i', id) AS invoice_id", "'s' AS store_id", "concat('c', id) AS customer_id", "'e' AS employee_id",
                                       "'cash' AS payment_type", "timestamp_ntz'2024-01-05 00:00:00' AS transaction_date_time",
                                       "if(id = 23, NULL, add_months(date'2024-01-01', id % 12)) AS transaction_month", "2.00BD AS total_amount")
    dealt, cluster = [], layout.cluster_by_zorder
    monkeypatch.setattr(layout, "files_for", lambda *a: 5)
    monkeypatch.setattr(layout, "cluster_by_zorder", lambda df, *a, **kw: (dealt.append(df.count()), cluster(df, *a, **kw))[1])
    t = LocatedTable(spark, f"{schema}.t_sales_facts", S.SALES_FACTS.struct(), "transaction_month", tmpdir_path + "/facts")
    months = [r[0] for r in heads.select("transaction_month").distinct().collect()]
    daily.refresh_facts(spark, t, lines, heads, months, 1)
    assert len(dealt) == 5 and sum(dealt) == 600 and max(dealt) <= 200
    expected = facts.build_sales_facts(lines, heads)
    assert rows(t.read().select(*expected.columns)) == rows(expected) and t.read().where("transaction_month IS NULL").count() == 25
    assert os.listdir(tmpdir_path + "/kept") == []
    daily.refresh_facts(spark, t, lines.where("false"), heads, months, 2)
    assert t.read().count() == 0 and os.listdir(tmpdir_path + "/kept") == []


def test_a_daily_run_leaves_neither_copies_nor_shuffles(spark, tmpdir_path, schema, monkeypatch):
    """On disk a run keeps its tables only."""
    import time

    from lakeloom import session
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: tmpdir_path + "/kept")
    jobs = {n: daily.JOBS[n] for n in ("t_sales_transactions", "t_sales_line_items")}
    data = {"t_sales_transactions": [(f"i{i}", f"2024-0{1 + i % 3}-05 00:00:00", "s", f"c{i}", "e", "cash", "2.00", "x", "y") for i in range(30)],
            "t_sales_line_items": [(f"l{i}", f"i{i % 30}", "p", "1", "1.00", "1.00", "0.00", "x", "y") for i in range(90)]}
    for name, some in data.items():
        os.makedirs(f"{tmpdir_path}/landing/{name}")
        with open(f"{tmpdir_path}/landing/{name}/1.csv", "w") as fh:
            fh.write("\n".join(",".join(r) for r in [S.RAW_COLUMNS[name], *some]) + "\n")
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager
    shuffles = lambda: {f.split("/shuffle_")[1].split("_")[0] for f in blocks().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files, conf = shuffles(), spark.conf.get(name)
    out = daily.daily_run(spark, f"{tmpdir_path}/landing", f"{tmpdir_path}/tables", "2025-01-01 00:00:00", "job", "2025-01-01", 1, jobs,
                          {n: f"{n}/*.csv" for n in jobs}, schema=schema)
    for _ in range(50):                 # they are removed in the background
        if shuffles() <= files:
            break
        time.sleep(0.2)
    assert shuffles() <= files and os.listdir(tmpdir_path + "/kept") == []
    assert out["t_sales_facts"].count() == 90 and spark.conf.get(name) == conf
