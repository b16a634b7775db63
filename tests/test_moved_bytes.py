"""What is shuffled and written on the way: digest ids packed, each side of a merge once."""
import datetime as dt
import hashlib

from pyspark.sql import functions as F

from lakeloom.functions.hashing import dealt_packed, pack_hex, unpack_hex
from lakeloom.operators import layout, scd1
from lakeloom.operators.facts import build_sales_facts
from lakeloom.plans.located import ByInsertRun, LocatedTable
from lakeloom.plans.publish import write_partitioned
from tests.conftest import rows


def test_pack_hex_gives_every_text_back(spark):
    texts = ["", "a", "ab", "abc", "AB", "00", "\x01ab", "é", "ab\n", "g0", hashlib.md5(b"x").hexdigest(), "f" * 9998, None]
    df = spark.createDataFrame([(t,) for t in texts], "line_item_id string")
    back = df.select("line_item_id", pack_hex("line_item_id").alias("p")).select(
        "line_item_id", F.length("p").alias("n"), unpack_hex("p").alias("t")).collect()
    assert all(r.t == r.line_item_id for r in back)
    assert {r.line_item_id: r.n for r in back}[hashlib.md5(b"x").hexdigest()] == 17
    raw = spark.createDataFrame([(b"\x01a",)], "line_item_id binary")
    assert dealt_packed(raw, lambda t: t.repartition(2)).collect() == raw.collect()


def test_facts_cross_the_join_packed_and_come_out_whole(spark):
    ids = [hashlib.md5(b"1").hexdigest(), "not hex", None, "ff"]
    li = spark.createDataFrame([(i, "7", "p", 1, 1.0, 1.0, 0.0) for i in ids],
                               "line_item_id string, invoice_id string, product_id string, quantity int, unit_price double, "
                               "total_price double, discount_applied double")
    tx = spark.createDataFrame([("7", "s", "c", "e", "t", dt.datetime(2024, 1, 2), dt.date(2024, 1, 1), 2.0)],
                               "invoice_id string, store_id string, customer_id string, employee_id string, payment_type string, "
                               "transaction_date_time timestamp_ntz, transaction_month date, total_amount double")
    out = build_sales_facts(li, tx)
    assert "unhex" in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.line_item_id for r in out.collect()} == set(ids) and out.count() == 4
    assert out.schema["line_item_id"].dataType.simpleString() == "string"


def test_upsert_shuffles_each_side_once(spark, tmpdir_path):
    """Both joins read one shuffle of the batch; NULL and repeated target keys stay rows of their own."""
    audit = [f"timestamp_ntz '2024-01-01' AS {c}" for c in ("batch_r_timestamp", "h_insert_timestamp", "h_update_timestamp")] + ["'j' AS job_id"]
    base = spark.range(60).selectExpr("if(id % 10 = 9, NULL, string(id % 40)) AS k", "int(id) AS v", *audit)
    base.write.parquet(tmpdir_path + "/t")
    new = spark.range(20, 80).selectExpr("if(id % 10 = 3, NULL, string(id)) AS k", "if(id % 7 = 0, NULL, int(-id)) AS v", *audit)
    new.write.parquet(tmpdir_path + "/s")
    t, s = spark.read.parquet(tmpdir_path + "/t"), spark.read.parquet(tmpdir_path + "/s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scd1.scd1_upsert(t, s, "k", run_ts="2025-01-01 00:00:00", cut=False)
        state = rows(out.select("k", "v"))
        plan = out._jdf.queryExecution().executedPlan()
        out.collect()
        assert "ReusedExchange" in plan.toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    of = {r.k: r.v for r in s.collect() if r.k is not None}
    old = [(r.k, r.v) for r in t.collect()]
    want = [(k, of[k] if k in of else v) for k, v in old] + [(k, v) for k, v in of.items() if k not in {k for k, _ in old}]
    want += [(None, r.v) for r in s.collect() if r.k is None]
    assert state == sorted(want, key=lambda x: tuple((c is None, str(c)) for c in x))


def test_few_partitions_are_written_where_their_rows_are(spark, tmpdir_path):
    t = LocatedTable(spark, "moved_bytes_t", ByInsertRun().struct(spark.range(1).selectExpr("string(id) AS k").schema), "_run",
                     tmpdir_path + "/t", "k")
    try:
        first = spark.range(100).selectExpr("string(id) AS k", "1 AS _run").repartition(3)
        t.publish(first, 1, [1])
        assert t.read().count() == 100 and len(t.read().inputFiles()) == 3          # no new deal
        assert scd1.holding(t.read(), spark.createDataFrame([("5",), ("x",), (None,)], "k string"), "k", "_run") == [1]
        assert scd1.holding(t.read(), spark.createDataFrame([("x",), (None,)], "k string"), "k", "_run", most=0) == []
    finally:
        spark.sql("DROP TABLE moved_bytes_t")


def test_files_are_zstd_and_keep_an_invoice_together(spark, tmpdir_path):
    df = spark.range(400).selectExpr("date '2024-01-01' AS m", "string(id % 100) AS invoice_id", "md5(string(id)) AS line_item_id")
    write_partitioned(df, tmpdir_path + "/p", "m", ("invoice_id", "line_item_id"), n_tasks=4)
    back = spark.read.parquet(tmpdir_path + "/p")
    assert all(f.endswith(".zstd.parquet") for f in back.inputFiles())
    assert rows(back.select("invoice_id", "line_item_id")) == rows(df.select("invoice_id", "line_item_id"))
    spans = layout.file_spans(spark, tmpdir_path + "/p", "invoice_id").orderBy("lo").collect()
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
