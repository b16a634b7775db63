"""Seeded random batches against brute-force expectations."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import quality as Q
from lakeloom.operators import scd1, scd2
from tests.conftest import rows

KEYS = st.sampled_from(["a", "b", "c", "d", "e", None])
VALS = st.sampled_from(["x", "y", "z", None])
DAYS = st.sampled_from([dt.datetime(2024, 1, d) for d in (1, 2, 3)])
PRICES = st.sampled_from(["1", "2.50", "-1", "1e3", "", None, "7."])
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(KEYS, DAYS, PRICES, VALS), min_size=1, max_size=12))
def test_findings_equal_brute_force(spark, batch):
    df = spark.createDataFrame(batch, "id string, ts timestamp_ntz, price string, a string")
    got = Counter((r[0], r[1], r[2]) for r in Q.dq_findings(
        df, "id", "ts", [Q.Duplicate(), Q.Format("price"), Q.NotNull(("a", "price"))]).collect())
    import re
    want = Counter()
    for (k, t), n in Counter((k, t) for k, t, _, _ in batch).items():
        if n > 1:
            want[(k, t, "Duplicate id")] += 1
    for k, t, p, a in batch:
        if p is not None and not re.fullmatch(r"[0-9]+(\.[0-9]+)?", p):
            want[(k, t, "Invalid price format")] += 1
        if p is None or a is None:
            want[(k, t, "Null value in one or more columns")] += 1
    assert got == want


@settings(**SETTINGS)
@given(st.dictionaries(st.sampled_from("abcdef"), VALS, max_size=5),
       st.dictionaries(st.sampled_from("abcdefgh"), VALS, max_size=5))
def test_upsert_key_union_and_idempotence(spark, tgt, src):
    t0 = dt.datetime(2024, 1, 1)
    T = spark.createDataFrame([(k, v, t0, t0, t0, "s") for k, v in tgt.items()],
                              "id string, v string, batch_r_timestamp timestamp_ntz, "
                              "h_insert_timestamp timestamp_ntz, h_update_timestamp timestamp_ntz, job_id string")
    S = spark.createDataFrame([(k, v, dt.datetime(2024, 1, 2)) for k, v in src.items()],
                              "id string, v string, batch_r_timestamp timestamp_ntz")
    once = scd1.scd1_upsert(T, S, "id", run_ts="2025-01-01 00:00:00", job_id="j")
    got = {r.id: r.v for r in once.collect()}
    assert got == {**tgt, **src}
    twice = scd1.scd1_upsert(once, S, "id", run_ts="2025-01-01 00:00:00", job_id="j")
    assert rows(twice) == rows(once)


@settings(**SETTINGS)
@given(st.lists(st.dictionaries(st.sampled_from("abcd"), VALS, max_size=4), min_size=1, max_size=3))
def test_scd2_sequential_batches_keep_history_consistent(spark, batches):
    from lakeloom.specs import CUSTOMERS
    tracked = ("customer_id", "first_name")
    hist = spark.createDataFrame([], CUSTOMERS.struct()).select("customer_id", "first_name", "active_flag",
                                                                "begin_effective_date", "end_effective_date",
                                                                "s_customer_key", "batch_r_timestamp",
                                                                "h_insert_timestamp", "h_update_timestamp", "job_id")
    total_before = 0
    for i, b in enumerate(batches):
        src = spark.createDataFrame([(k, v, dt.datetime(2024, 1, 1 + i)) for k, v in b.items()],
                                    "customer_id string, first_name string, batch_r_timestamp timestamp_ntz")
        hist = scd2.scd2_merge(hist, src, "customer_id", tracked, as_of=f"2025-01-0{i + 1}",
                               run_ts=f"2025-01-0{i + 1} 00:00:00")
        rs = hist.collect()
        assert len(rs) >= total_before                                   # history is never deleted
        total_before = len(rs)
        by = {}
        for r in rs:
            by.setdefault(r.customer_id, []).append(r)
        for k, versions in by.items():
            assert sum(v.active_flag for v in versions) == 1            # exactly one open version
            spans = sorted((v.begin_effective_date, v.end_effective_date) for v in versions)
            for (b1, e1), (b2, _) in zip(spans, spans[1:]):
                assert e1 <= b2                                          # no overlapping intervals
        for k, v in b.items():
            assert [x.first_name for x in by[k] if x.active_flag] == [v]   # latest batch wins


PARTS = st.sampled_from([1, 2, 3])


@settings(**SETTINGS)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.tuples(VALS, PARTS), min_size=1, max_size=6),
       st.dictionaries(st.sampled_from("abcdefgh"), st.tuples(VALS, PARTS), min_size=1, max_size=5))
def test_partition_restricted_upsert_equals_whole_table_upsert(spark, target, source):
    """Rewriting only the touched partitions (keys may move between them)
    leaves the same table as upserting the whole table."""
    import tempfile
    from lakeloom.plans.publish import overwrite_partitions
    t0 = dt.datetime(2024, 1, 1)
    tschema = ("id string, a string, p int, batch_r_timestamp timestamp_ntz, "
               "h_insert_timestamp timestamp_ntz, h_update_timestamp timestamp_ntz, job_id string")
    t = spark.createDataFrame([(k, a, p, t0, t0, t0, "s") for k, (a, p) in target.items()], tschema)
    s = spark.createDataFrame([(k, a, p, dt.datetime(2024, 1, 2)) for k, (a, p) in source.items()],
                              "id string, a string, p int, batch_r_timestamp timestamp_ntz")
    path = tempfile.mkdtemp(prefix="lakeloom-prop-") + "/t"
    t.write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    touched = scd1.touched_partitions(table, s, "id", "p")
    new_parts = scd1.scd1_upsert(scd1.restrict_to(table, "p", touched), s, "id", run_ts="2025-01-01 00:00:00",
                                 job_id="j")
    overwrite_partitions(spark, new_parts, path, "p", touched=touched)
    got = spark.read.parquet(path).select(*t.columns)
    want = scd1.scd1_upsert(t, s, "id", run_ts="2025-01-01 00:00:00", job_id="j")
    assert rows(got) == rows(want)
    assert sorted(r.id for r in got.collect()) == sorted(set(target) | set(source))
