import datetime as dt

import pytest

from lakeloom.operators import quality as Q
from tests.conftest import rows

B1 = dt.datetime(2024, 1, 1)
B2 = dt.datetime(2024, 1, 2)
SCHEMA = "id string, ts timestamp_ntz, price string, a string, b string"


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_duplicates_same_batch_other_batch_and_null_key(spark):
    df = _df(spark, [("1", B1, "1", "x", "y"), ("1", B1, "1", "x", "y"),   # twice in one batch
                     ("2", B1, "1", "x", "y"), ("2", B2, "1", "x", "y"),   # two batches: fine
                     (None, B1, "1", "x", "y"), (None, B1, "1", "x", "y")])  # NULL key twice
    out = rows(Q.dq_duplicates(df, "id", "ts"))
    assert out == [("1", B1, "Duplicate id"), (None, B1, "Duplicate id")]


def test_format_rule_edge_values(spark):
    vals = ["10", "10.5", "-1", ".5", "1.", "1e3", " 1", "", None]
    df = _df(spark, [(str(i), B1, v, "x", "y") for i, v in enumerate(vals)])
    bad = {r[0] for r in Q.dq_format(df, "id", "ts", "price").collect()}
    assert bad == {"2", "3", "4", "5", "6", "7"}          # NULL is not a format finding


def test_nulls_one_finding_per_row(spark):
    df = _df(spark, [("1", B1, "1", None, "y"), ("2", B1, "1", None, None), ("3", B1, "1", "x", "y")])
    out = rows(Q.dq_nulls(df, "id", "ts", ["a", "b"]))
    assert [r[0] for r in out] == ["1", "2"]


def test_gate_abort_and_quarantine(spark):
    rules = [Q.Duplicate(), Q.Format("price"), Q.NotNull(("a", "b"))]
    clean = _df(spark, [("1", B1, "1", "x", "y"), ("2", B1, "2.5", "x", "y")])
    passed, findings = Q.dq_gate(clean, "id", "ts", rules, "abort")
    assert passed.count() == 2 and findings.count() == 0
    dirty = _df(spark, [("1", B1, "1", "x", "y"), ("2", B1, "bad", "x", "y"),
                        ("3", B1, "1", None, "y"), ("4", B1, "1", "x", "y"), ("4", B1, "1", "x", "y")])
    with pytest.raises(Q.DataQualityError):
        Q.dq_gate(dirty, "id", "ts", rules, "abort")
    passed, findings = Q.dq_gate(dirty, "id", "ts", rules, "quarantine")
    assert [r[0] for r in passed.collect()] == ["1"]
    assert findings.count() == 3


def test_constraint_rules_from_spec(spark):
    from lakeloom import specs
    rules = Q.constraint_rules(specs.CUSTOMERS, ["customer_id", "first_name", "last_name", "email",
                                                 "phone_number", "membership_status"])
    kinds = {type(r).__name__ for r in rules}
    assert kinds == {"NotNull", "Duplicate", "Unique", "InSet"}


def test_log_findings_dedupes_reruns(spark, tmpdir_path):
    df = _df(spark, [("1", B1, "bad", "x", "y")])
    f = Q.dq_format(df, "id", "ts", "price")
    path = tmpdir_path + "/dq_logs"
    Q.log_findings(f, "2025-01-01 00:00:00", path=path)
    again = Q.log_findings(f, "2025-01-02 00:00:00", path=path,
                           dedupe_against=spark.read.parquet(path))
    assert again.count() == 0
    assert spark.read.parquet(path).count() == 1
    # the same row in a later batch is a new finding; other batches' log entries do not hide it
    f2 = Q.dq_format(_df(spark, [("1", B2, "bad", "x", "y")]), "id", "ts", "price")
    later = Q.log_findings(f2, "2025-01-03 00:00:00", path=path, dedupe_against=spark.read.parquet(path))
    assert [(r.unique_identifier, r.r_batch_timestamp) for r in later.collect()] == [("1", B2)]


def test_unique_history(spark):
    import datetime as dt
    day = [dt.datetime(2024, 1, i) for i in range(1, 5)]
    df = spark.createDataFrame(
        [("1", "x", day[1]), ("2", "x", day[2]), ("1", "x", day[3]),     # 2 takes 1's value; 1 then meets 2's
         ("3", "s", day[1]), ("4", "own", day[1]), ("4", "own", day[2]),  # s is stored for 9; own stays with its key
         ("5", None, day[1]), (None, "n", day[2]), ("6", "n", day[3]), ("9", "s", day[2]),
         ("7", "same", day[1]), ("8", "same", day[1])], "k string, v string, ts timestamp_ntz")
    stored = spark.createDataFrame([("9", "s"), ("4", "own"), ("5", None), ("z", "unused")], "k string, v string")
    found = sorted(tuple(r)[:2] for r in Q.dq_unique_history(df, stored, "k", "ts", "v").collect())
    # 3 meets stored 9; stored 9 itself meets 3 of the day before; equal values of one batch are dq_unique's
    assert found == [("1", day[3]), ("2", day[2]), ("3", day[1]), ("6", day[3]), ("9", day[2])]
    without = sorted(tuple(r)[0] for r in Q.dq_unique_history(df, None, "k", "ts", "v").collect())
    assert without == ["1", "2", "6", "9"]
    assert Q.dq_unique_history(df.limit(0), stored, "k", "ts", "v").count() == 0


def test_unique_history_of_a_hot_value(spark):
    df = spark.range(20_000).selectExpr("cast(id AS string) k", "'hot' v", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 2 AS int)) ts")
    assert Q.dq_unique_history(df, None, "k", "ts", "v").count() == 10_000


def test_conflicting_rows_of_one_key(spark):
    sent = [("a", B1, "x"), ("a", B1, "y"), ("b", B1, "x"), ("b", B1, "x"), ("c", B1, "x"), ("c", B2, "y"), ("d", B1, None), ("d", B1, ""),
            (None, B1, "x"), (None, B1, "y"), ("e", B1, None), ("e", B1, None)]
    df = spark.createDataFrame(sent, "k string, at timestamp_ntz, v string")
    rule = Q.Conflict(("v",))
    found = Q.dq_findings(df, "k", "at", [rule]).collect()
    assert sorted((r.unique_identifier, r.issue) for r in found) == [(k, "Conflicting rows for k") for k in "ad"]
    passed, held = Q.dq_split(df, "k", "at", [rule])
    assert sorted(r.k for r in held.collect()) == ["a", "a", "d", "d"] and passed.count() == 8
    assert Q.dq_findings(df.where("false"), "k", "at", [rule]).count() == 0
