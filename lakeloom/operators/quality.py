"""Declarative data-quality rules, findings, audit log and the batch gate.

A finding is ``(unique_identifier, r_batch_timestamp, issue)``.  Row rules
(format, nulls, allowed values, cast failures) are plain filters; group rules
(duplicate key within a batch, non-unique column) are partial-aggregated
``groupBy(...).count()`` so a hot key collapses map-side before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeloom.functions.hashing import FIELD_SEP, NULL_MARK, row_hash
from lakeloom.functions.predicates import NUMBER_PATTERN, any_null, invalid_number
from lakeloom.operators.casting import cast_failures, ts_literal

FINDING_COLUMNS = ("unique_identifier", "r_batch_timestamp", "issue")


class DataQualityError(RuntimeError):
    """Raised by the gate in ``abort`` mode when a batch has findings."""


# ------------------------------------------------------------------ rules

@dataclass(frozen=True)
class Duplicate:
    """Same key more than once within one batch -> one finding per group."""
    issue: str | None = None


@dataclass(frozen=True)
class Format:
    column: str
    pattern: str = NUMBER_PATTERN
    issue: str | None = None


@dataclass(frozen=True)
class NotNull:
    columns: tuple
    issue: str = "Null value in one or more columns"


@dataclass(frozen=True)
class InSet:
    column: str
    allowed: tuple
    issue: str | None = None


@dataclass(frozen=True)
class Unique:
    """Value of ``column`` shared by several rows of one batch -> one finding per row."""
    column: str
    issue: str | None = None


@dataclass(frozen=True)
class Conflict:
    """Rows of one key in one batch that differ in ``columns`` -> one finding per
    group.  Equal rows sent twice are no conflict; a row without a key has none."""
    columns: tuple
    issue: str | None = None


@dataclass(frozen=True)
class Castable:
    """Raw text that does not parse to the declared type."""
    spec: object
    issue: str = "Value does not parse to its declared type"


def _ident(key) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    # the delimiter and NULL mark of the row hash keep different keys apart
    return F.concat_ws(FIELD_SEP, *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_MARK)) for k in keys])


def _finding(df: DataFrame, key, audit: str, issue) -> DataFrame:
    return df.select(_ident(key).alias("unique_identifier"),
                     F.col(audit).cast("timestamp_ntz").alias("r_batch_timestamp"),
                     (issue if isinstance(issue, Column) else F.lit(issue)).alias("issue"))


def dq_duplicates(df: DataFrame, key, audit: str, issue: str | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    issue = issue or f"Duplicate {'_'.join(keys)}"
    groups = df.groupBy(*keys, audit).count().where(F.col("count") > 1)
    return _finding(groups, keys, audit, issue)


def _conflicting(df: DataFrame, key, audit: str, columns) -> DataFrame:
    """Key and stamp of the groups that hold different rows (two hashes per group
    and task, so a key sent very often collapses before the shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    content = row_hash(*columns)
    return (df.where(known).groupBy(*keys, audit).agg(F.min(content).alias("_least"), F.max(content).alias("_most"))
            .where("_least <> _most").drop("_least", "_most"))


def dq_conflicts(df: DataFrame, key, audit: str, columns, issue: str | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return _finding(_conflicting(df, keys, audit, columns), keys, audit, issue or f"Conflicting rows for {'_'.join(keys)}")


def dq_format(df: DataFrame, key, audit: str, column: str, pattern: str = NUMBER_PATTERN,
              issue: str | None = None) -> DataFrame:
    issue = issue or f"Invalid {column} format"
    return _finding(df.where(invalid_number(column, pattern)), key, audit, issue)


def dq_nulls(df: DataFrame, key, audit: str, columns, issue: str = NotNull.issue) -> DataFrame:
    return _finding(df.where(any_null(columns)), key, audit, issue)


def dq_in_set(df: DataFrame, key, audit: str, column: str, allowed, issue: str | None = None) -> DataFrame:
    issue = issue or f"Invalid {column} value"
    # NULL passes, as in a SQL CHECK constraint
    return _finding(df.where(~F.col(column).isin(*allowed)), key, audit, issue)


def dq_unique(df: DataFrame, key, audit: str, column: str, issue: str | None = None) -> DataFrame:
    issue = issue or f"Duplicate {column}"
    shared = (df.where(F.col(column).isNotNull()).groupBy(audit, column).count()
              .where(F.col("count") > 1).select(audit, column))
    rows = df.join(shared, [audit, column], "left_semi")
    return _finding(rows, key, audit, issue)


def dq_unique_history(df: DataFrame, stored: DataFrame | None, key: str, audit: str, column: str,
                      issue: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` value belongs to another key already: one
    in ``stored``, or one of an earlier batch of ``df`` (equal values inside one
    batch are ``dq_unique``'s).  Of ``stored`` only the key and the column are
    read.  Per value only the first batch and the first batch of any other key
    are kept, so a value that very many rows share pairs nothing with nothing."""
    issue = issue or f"{column} belongs to another {key}"
    owned = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v"), F.col(key).alias("_k")).agg(F.min(audit).alias("_at"))
    if stored is not None:
        before = stored.where(F.col(column).isNotNull()).select(F.col(column).alias("_v"), F.col(key).alias("_k")).distinct()
        before = before.join(owned.select("_v").distinct(), "_v", "left_semi")
        owned = owned.unionByName(before.withColumn("_at", F.lit(None).cast(dict(df.dtypes)[audit])))
    # a NULL stamp sorts first: what is stored is older than any batch
    first = owned.groupBy("_v").agg(F.min(F.struct("_at", "_k")).alias("_first"))
    other = (owned.join(first, "_v").where(~F.col("_k").eqNullSafe(F.col("_first._k")))
             .groupBy("_v").agg(F.min(F.struct("_at")).alias("_other")))
    seen = first.join(other, "_v").select("_v", "_first", "_other._at")     # values of one key only are no finding
    own = F.col(key).eqNullSafe(F.col("_first._k"))
    since = F.when(own, F.col("_at")).otherwise(F.col("_first._at"))
    rows = df.join(seen, F.col(column) == F.col("_v")).where(since.isNull() | (since < F.col(audit)))
    return _finding(rows, key, audit, issue)


def history_findings(df: DataFrame, stored: DataFrame | None, key: str, audit: str, spec) -> DataFrame | None:
    """``dq_unique_history`` for every UNIQUE column of ``spec`` that ``df`` has."""
    parts = [dq_unique_history(df, stored, key, audit, c) for c in spec.unique if c in df.columns]
    return reduce(DataFrame.unionByName, parts) if parts else None


def dq_castable(df: DataFrame, key, audit: str, spec, issue: str = Castable.issue) -> DataFrame:
    return _finding(df.where(cast_failures(df, spec)), key, audit, issue)


def _rule_findings(df, key, audit, rule) -> DataFrame:
    if isinstance(rule, Duplicate):
        return dq_duplicates(df, key, audit, rule.issue)
    if isinstance(rule, Format):
        return dq_format(df, key, audit, rule.column, rule.pattern, rule.issue)
    if isinstance(rule, NotNull):
        return dq_nulls(df, key, audit, rule.columns, rule.issue)
    if isinstance(rule, InSet):
        return dq_in_set(df, key, audit, rule.column, rule.allowed, rule.issue)
    if isinstance(rule, Unique):
        return dq_unique(df, key, audit, rule.column, rule.issue)
    if isinstance(rule, Conflict):
        return dq_conflicts(df, key, audit, rule.columns, rule.issue)
    if isinstance(rule, Castable):
        return dq_castable(df, key, audit, rule.spec, rule.issue)
    raise TypeError(f"unknown rule {rule!r}")


def dq_findings(df: DataFrame, key, audit: str, rules) -> DataFrame:
    """Union (bag semantics) of every rule's findings."""
    parts = [_rule_findings(df, key, audit, r) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def constraint_rules(spec, raw_columns=None) -> list:
    """Rules implied by a TableSpec: NOT NULL, key uniqueness per batch,
    UNIQUE columns and allowed-value sets."""
    cols = set(raw_columns) if raw_columns is not None else set(spec.names)
    rules: list = []
    required = [c for c in spec.required if c in cols and c not in ("job_id",)]
    if required:
        rules.append(NotNull(tuple(required)))
    if spec.key:
        rules.append(Duplicate())
    for c in spec.unique:
        if c in cols:
            rules.append(Unique(c))
    for c, allowed in spec.allowed.items():
        if c in cols:
            rules.append(InSet(c, tuple(allowed)))
    return rules


# ------------------------------------------------------------------- gate

def bad_rows(df: DataFrame, key, audit: str, rules) -> DataFrame:
    """Rows of ``df`` that any rule flags (row rules by predicate, group rules
    by a semi-join with the offending groups)."""
    keys = [key] if isinstance(key, str) else list(key)
    row_preds = []
    flagged = []
    for r in rules:
        if isinstance(r, Format):
            row_preds.append(F.coalesce(invalid_number(r.column, r.pattern), F.lit(False)))
        elif isinstance(r, NotNull):
            row_preds.append(any_null(r.columns))
        elif isinstance(r, InSet):
            row_preds.append(F.coalesce(~F.col(r.column).isin(*r.allowed), F.lit(False)))
        elif isinstance(r, Castable):
            row_preds.append(cast_failures(df, r.spec))
        elif isinstance(r, Duplicate):
            flagged.append(("dup", keys + [audit],
                            df.groupBy(*keys, audit).count().where(F.col("count") > 1).drop("count")))
        elif isinstance(r, Conflict):
            flagged.append(("conflict", keys + [audit], _conflicting(df, keys, audit, r.columns)))
        elif isinstance(r, Unique):
            flagged.append(("uniq", [audit, r.column],
                            df.where(F.col(r.column).isNotNull()).groupBy(audit, r.column).count()
                            .where(F.col("count") > 1).drop("count")))
    marked = df
    for i, (_, cols, groups) in enumerate(flagged):
        flag = f"_bad{i}"
        # fresh names on the group side: the keys share lineage with ``df``
        g = groups.select(*[F.col(c).alias(f"_g{i}_{c}") for c in cols], F.lit(True).alias(flag))
        cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}_{c}")) for c in cols])
        marked = marked.join(g, cond, "left").drop(*[f"_g{i}_{c}" for c in cols])
        row_preds.append(F.col(flag).isNotNull())
    pred = reduce(lambda a, b: a | b, row_preds) if row_preds else F.lit(False)
    return marked.withColumn("_dq_bad", pred)


def dq_gate(df: DataFrame, key, audit: str, rules, mode: str = "abort"):
    """Return ``(passed_rows, findings)``.

    ``abort`` (the reference behaviour): any finding stops the whole batch —
    raises :class:`DataQualityError` carrying the findings DataFrame.
    ``quarantine``: rows with findings are held back, the rest pass."""
    findings = dq_findings(df, key, audit, rules)
    if mode == "abort":
        if not findings.isEmpty():
            err = DataQualityError("data quality checks failed; batch stopped")
            err.findings = findings
            raise err
        return df, findings
    if mode != "quarantine":
        raise ValueError(mode)
    return dq_split(df, key, audit, rules)[0], findings


def dq_split(df: DataFrame, key, audit: str, rules) -> tuple[DataFrame, DataFrame]:
    """``(passed, held back)``: every row of ``df`` is in exactly one of them."""
    marked = bad_rows(df, key, audit, rules)
    return (marked.where(~F.col("_dq_bad")).select(*df.columns), marked.where(F.col("_dq_bad")).select(*df.columns))


def with_logged_at(findings: DataFrame, run_ts) -> DataFrame:
    return findings.withColumn("logged_at", ts_literal(run_ts))


def log_findings(findings: DataFrame, run_ts, path: str | None = None, table: str | None = None,
                 dedupe_against: DataFrame | None = None, observed: Observation | None = None) -> DataFrame:
    """Append findings (stamped ``logged_at``) to the audit log sink.

    ``dedupe_against`` (the existing log) keeps a re-run from logging the
    same (id, batch, issue) twice."""
    out = with_logged_at(findings, run_ts)
    if dedupe_against is not None:
        # only the log entries of this run's batch stamps can repeat a finding:
        # a semi-join on the few stamps filters the ever-growing log before its
        # de-duplicating shuffle
        stamps = findings.select(F.col("r_batch_timestamp").alias("_stamp")).distinct()
        seen = (dedupe_against.join(stamps, F.col("r_batch_timestamp").eqNullSafe(F.col("_stamp")),
                                    "left_semi")
                .select(*FINDING_COLUMNS).distinct())
        cond = reduce(lambda a, b: a & b, [out[c].eqNullSafe(seen[c]) for c in FINDING_COLUMNS])
        out = out.join(seen, cond, "left_anti")
    if observed is not None:
        out = out.observe(observed, F.count(F.lit(1)).alias("n"))
    if table:
        out.write.mode("append").saveAsTable(table)
    elif path:
        out.write.mode("append").parquet(path)
    return out
