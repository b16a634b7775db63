"""Every registered query against its DuckDB oracle (sf0.001, fast)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakeloom.plans.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(rs, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name](spark, SF)
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _bag(srows, df.columns) == _bag(orows, ocols)


@pytest.mark.parametrize("name", ["harmonize_stream_products", "incremental_batch", "typed_transactions",
                                  "scd1_partitioned_transactions", "zorder_facts"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = REGISTRY[name](spark, SF)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert _bag(srows, df.columns) == _bag(cur.fetchall(), ocols)
