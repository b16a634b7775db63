import datetime as dt

from lakeloom import specs
from lakeloom.operators import scd2

AS_OF = "2025-01-01"
D0, D1, OPEN = dt.date(2020, 1, 1), dt.date(2025, 1, 1), dt.date(9999, 12, 31)
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
TRACK = ("customer_id", "first_name", "last_name")
SSCHEMA = "customer_id string, first_name string, last_name string, batch_r_timestamp timestamp_ntz"


def _target(spark, data):
    from pyspark.sql import functions as F
    from lakeloom.functions.hashing import row_hash
    cols = "customer_id string, first_name string, last_name string, active_flag boolean, " \
           "begin_effective_date date, end_effective_date date"
    df = spark.createDataFrame(data, cols)
    return df.withColumns({"s_customer_key": row_hash(*TRACK), "batch_r_timestamp": F.lit(T0),
                           "h_insert_timestamp": F.lit(T0), "h_update_timestamp": F.lit(T0),
                           "job_id": F.lit("seed")})


def _merge(t, s, **kw):
    return scd2.scd2_merge(t, s, "customer_id", TRACK, as_of=AS_OF, run_ts="2025-01-01 00:00:00", **kw)


def test_scd2_cases(spark):
    t = _target(spark, [
        ("same", "a", "b", True, D0, OPEN),
        ("chg", "a", "b", True, D0, OPEN),
        ("nul", "a", "b", True, D0, OPEN),
        ("shift", "ab", "c", True, D0, OPEN),
        ("gone", "a", "b", False, D0, D0),
        ("hist", "a", "x", False, dt.date(2019, 1, 1), D0), ("hist", "a", "b", True, D0, OPEN),
    ])
    s = spark.createDataFrame([
        ("same", "a", "b", T1), ("chg", "a", "z", T1), ("nul", "a", None, T1), ("shift", "a", "bc", T1),
        ("gone", "a", "q", T1), ("hist", "a", "c", T1), ("new", "n", "m", T1),
    ], SSCHEMA)
    out = _merge(t, s)
    by = {}
    for r in out.collect():
        by.setdefault(r.customer_id, []).append(r)
    assert len(by["same"]) == 1 and by["same"][0].active_flag
    for k in ("chg", "nul", "shift", "hist"):
        active = [r for r in by[k] if r.active_flag]
        closed = [r for r in by[k] if not r.active_flag and r.end_effective_date == D1]
        assert len(active) == 1 and active[0].begin_effective_date == D1 and active[0].end_effective_date == OPEN
        assert len(closed) == 1 and closed[0].end_effective_date == active[0].begin_effective_date
    assert len(by["hist"]) == 3
    assert [r.last_name for r in by["nul"] if r.active_flag] == [None]
    assert len(by["gone"]) == 1 and not by["gone"][0].active_flag      # not re-opened by default
    assert len(by["new"]) == 1 and by["new"][0].active_flag
    # invariant: at most one active row per key, history never deleted
    for k, rs in by.items():
        assert sum(r.active_flag for r in rs) <= 1
    assert out.count() == t.count() + 5
    # replay of the same batch is a no-op
    again = _merge(out, s)
    from tests.conftest import rows
    assert rows(again) == rows(out)


def test_reopen_option_and_empty_target(spark):
    t = _target(spark, [("gone", "a", "b", False, D0, D0)])
    s = spark.createDataFrame([("gone", "a", "q", T1)], SSCHEMA)
    assert _merge(t, s, reopen=True).where("active_flag").count() == 1
    empty = spark.createDataFrame([], t.schema)
    out = _merge(empty, s).collect()
    assert len(out) == 1 and out[0].active_flag and out[0].begin_effective_date == D1


def test_change_set_classes(spark):
    t = _target(spark, [("a", "x", "y", True, D0, OPEN), ("b", "x", "y", True, D0, OPEN),
                        ("c", "x", "y", False, D0, D0)])
    s = spark.createDataFrame([("a", "x", "y", T1), ("b", "x", "z", T1), ("c", "x", "y", T1),
                               ("d", "x", "y", T1)], SSCHEMA)
    ch = {r.customer_id: (r.change_type, r.merge_key)
          for r in scd2.scd2_change_set(t, s, "customer_id", TRACK).collect()}
    assert ch == {"a": ("unchanged", None), "b": ("changed", None), "c": ("inactive_only", None),
                  "d": ("new", "d")}


def test_customers_spec_has_hash_column():
    assert "s_customer_key" in specs.CUSTOMERS.names
