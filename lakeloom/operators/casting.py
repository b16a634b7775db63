"""Typed projection of raw (all-string) rows onto a harmonized TableSpec."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.predicates import month_of
from lakeloom.specs import AUDIT, TableSpec

AUDIT_NAMES = tuple(c.name for c in AUDIT)
# Columns a harmonized table derives instead of receiving them as raw text.
DERIVED = {"transaction_month": lambda: month_of("transaction_date_time")}


def ts_literal(value) -> Column:
    """A zone-free timestamp literal (``timestamp_ntz``) from text or datetime."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def typed_lit(value) -> Column:
    """A literal that never depends on a time zone: datetimes become
    ``timestamp_ntz`` (wall-clock), everything else ``F.lit``."""
    if isinstance(value, datetime):
        return ts_literal(value)
    return F.lit(value)


def parse(c: str | Column, dtype: str, fmt: str | None = None) -> Column:
    """Text -> typed value; unparseable text becomes NULL (never an error)."""
    col = F.col(c) if isinstance(c, str) else c
    t = dtype.lower()
    if t == "string":
        return col.cast("string")
    if t == "date" and fmt:
        return F.try_to_date(col, fmt)
    if t.startswith("timestamp") and fmt:
        return F.try_to_timestamp(col, F.lit(fmt)).cast(t)
    return col.try_cast(t)


def cast_to_spec(raw: DataFrame, spec: TableSpec, run_ts, job_id: str,
                 batch_col: str = "r_insert_timestamp") -> DataFrame:
    """Project raw text onto the spec's typed business columns plus the audit
    tail (``batch_r_timestamp`` from the ingest stamp, both harmonized
    stamps = ``run_ts``, ``job_id``).  Spec columns the raw table does not
    carry are either derived (``transaction_month``) or left out for the
    merge operator to fill (SCD2 bookkeeping)."""
    out, derived, order = [], [], []
    for c in spec.columns:
        if c.name in AUDIT_NAMES:
            continue
        if c.name in raw.columns:
            out.append(parse(c.name, c.dtype, c.fmt).alias(c.name))
            order.append(c.name)
        elif c.name in DERIVED:
            derived.append(c.name)
            order.append(c.name)
    stamp = ts_literal(run_ts)
    out += [
        F.col(batch_col).cast("timestamp_ntz").alias("batch_r_timestamp"),
        stamp.alias("h_insert_timestamp"),
        stamp.alias("h_update_timestamp"),
        F.lit(job_id).alias("job_id"),
    ]
    df = raw.select(*out)
    # derived columns come from the *typed* values (e.g. month of the parsed time)
    for name in derived:
        df = df.withColumn(name, DERIVED[name]())
    return df.select(*order, *AUDIT_NAMES)


def cast_failures(raw: DataFrame, spec: TableSpec) -> Column:
    """Predicate: some raw value is non-NULL but does not parse to its type."""
    preds = [F.col(c.name).isNotNull() & parse(c.name, c.dtype, c.fmt).isNull()
             for c in spec.columns
             if c.name in raw.columns and c.name not in AUDIT_NAMES and c.dtype != "string"]
    if not preds:
        return F.lit(False)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out
