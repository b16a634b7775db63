"""SCD1 upsert: MERGE (update matched, insert unmatched) as a DataFrame rewrite.

The new table state is ``target LEFT JOIN source`` on the key, plus the source
rows that match no target row (``LEFT ANTI``): a matched or new key takes every
mapped column from the source (a source NULL overwrites, as MERGE's ``SET t.c =
s.c`` does), an untouched key keeps its target row unchanged.  The batch is
written once and read by every step, and both joins read one shuffle of it;
whether a side is broadcast is left to adaptive execution, which knows measured
sizes, and which can split a hot key's partition in either join.  NULL keys never
match, as in MERGE: target rows stay, source rows are all inserted beside the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.casting import ts_literal, typed_lit
from lakeloom.session import cut_lineage

#: Batches of up to so many keys are looked up by literals (see ``locate``).
LITERAL_KEYS = 1000
AUDIT_TAIL = ("batch_r_timestamp", "h_insert_timestamp", "h_update_timestamp", "job_id")


class DuplicateKeyError(RuntimeError):
    """The source holds more than one row for a key (MERGE would be ambiguous)."""


def dedupe_source(source: DataFrame, key, order_col: str = "batch_r_timestamp",
                  on_duplicate: str = "error") -> DataFrame:
    """At most one source row per key.

    ``error``: raise if any key repeats (keys are counted by their hash; only
    where a hash repeats, by themselves).
    ``latest``: keep the row with the greatest ``order_col`` (ties broken by
    the remaining columns), via ``max(struct(...))`` per key — a partial
    aggregate, so a hot key is reduced map-side instead of sorted in one task.
    ``unique``: the caller has seen to it that no key repeats.
    Rows whose key is NULL match nothing, so none is a duplicate of another:
    all of them are kept in every mode.
    """
    keys = [key] if isinstance(key, str) else list(key)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if on_duplicate == "error":
        for by in ([F.xxhash64(*keys)], keys):
            most = source.where(~no_key).groupBy(*by).count().agg(F.max("count")).first()[0]
            if most is None or most < 2:
                return source
        raise DuplicateKeyError(f"source has repeated keys {keys}")
        return source
    if on_duplicate == "unique":
        return source
    if on_duplicate != "latest":
        raise ValueError(on_duplicate)
    rest = [c for c in source.columns if c not in keys and c != order_col]
    best = F.max(F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in rest])).alias("_best")
    return (source.where(~no_key).groupBy(*keys).agg(best)
            .select(*keys, F.col("_best._o").alias(order_col), *[F.col(f"_best.{c}") for c in rest])
            .select(*source.columns).unionByName(source.where(no_key)))


def latest_of_stored(source: DataFrame, key, order_col: str = "batch_r_timestamp") -> DataFrame:
    """``dedupe_source(source, key, order_col, "latest")`` for a stored ``source``.

    The hashes of the keys are counted first (one column is read, and eight bytes
    a key shuffled) and those that repeat are stored: only their rows are grouped
    by key.  All others are passed on as they are stored, neither sorted nor, as
    long as the hashes that repeat are small enough to be sent to them, shuffled."""
    keys = [key] if isinstance(key, str) else list(key)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own = F.xxhash64(*keys)
    several = source.where(~no_key).groupBy(own.alias("_several")).count().where("count > 1").select("_several")
    several = cut_lineage(source.sparkSession, several)
    found = own == F.col("_several")
    return (source.join(several, found, "left_anti")
            .unionByName(dedupe_source(source.join(several, found, "left_semi"), keys, order_col, "latest")))


def scd1_upsert(target: DataFrame, source: DataFrame, key, columns=None, run_ts=None,
                job_id: str | None = None, on_duplicate: str = "error", defaults: dict | None = None,
                cut: bool = True) -> DataFrame:
    """New state of ``target`` after merging ``source``.

    ``columns``: mapped business columns (default: source columns that are in
    the target, minus key and audit tail).  Audit semantics: inserted rows get
    ``h_insert_timestamp = h_update_timestamp = run_ts``; updated rows keep
    ``h_insert_timestamp`` and get ``h_update_timestamp = run_ts``; both take
    ``batch_r_timestamp`` from the source; ``job_id`` from the parameter.
    ``defaults``: expressions for columns the source lacks, used on insert.
    ``cut``: write the source once before it is read (off when the caller's
    source is a stored table already).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if columns is None:
        columns = [c for c in source.columns if c in target.columns and c not in keys
                   and c not in AUDIT_TAIL]
    if cut:
        source = cut_lineage(source.sparkSession, source)   # read by the check and both joins
    src = dedupe_source(source, keys, on_duplicate=on_duplicate)
    stamp = ts_literal(run_ts) if run_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    s = src.select(*[F.col(k) for k in keys],
                   *[F.col(c).alias(f"_s_{c}") for c in columns],
                   F.col("batch_r_timestamp").alias("_s_batch") if "batch_r_timestamp" in src.columns
                   else F.lit(None).cast("timestamp_ntz").alias("_s_batch"),
                   # no literal, which the optimizer would take out of one join's side only
                   (F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(1)) == 0).alias("_s_here"))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    keyed = s.where(~no_key)                # the same rows for both joins, so that one shuffle serves them
    new = keyed.join(target.select(*keys), keys, "left_anti").unionByName(s.where(no_key))
    j = (target.withColumn("_t_here", F.lit(True)).join(keyed, keys, "left")
         .unionByName(new, allowMissingColumns=True))
    from_src = F.col("_s_here").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(from_src, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "batch_r_timestamp":
            out.append(F.when(from_src, F.col("_s_batch")).otherwise(F.col(c)).alias(c))
        elif c == "h_insert_timestamp":
            out.append(F.when(F.col("_t_here").isNotNull(), F.col(c)).otherwise(stamp).alias(c))
        elif c == "h_update_timestamp":
            out.append(F.when(from_src, stamp).otherwise(F.col(c)).alias(c))
        elif c == "job_id" and job_id is not None:
            out.append(F.when(from_src, F.lit(job_id)).otherwise(F.col(c)).alias(c))
        elif defaults and c in defaults:
            out.append(F.when(F.col("_t_here").isNotNull(), F.col(c)).otherwise(defaults[c]).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def key_bucket(key, buckets: int):
    """Stable bucket of a key, for bucket-partitioned dimension tables."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def merge_partitions(target: DataFrame, source: DataFrame, key, part_col: str, **kw) -> DataFrame:
    """Upsert restricted to the target partitions the source touches.

    Returns only the rewritten partitions' new contents; untouched partitions
    are left as they are by a dynamic partition overwrite (see
    ``lakeloom.plans.publish``).  ``part_col`` must be present in both."""
    touched = touched_partitions(target, source, key, part_col)
    return scd1_upsert(restrict_to(target, part_col, touched), source, key, **kw)


def touched_partitions(target: DataFrame, source: DataFrame, key, part_col: str) -> list:
    """Partition values a merge of ``source`` rewrites: those the new rows
    land in, plus those holding the current rows of the same keys (a key whose
    partition value changes moves between them).  One value per partition, so
    what reaches the driver is bounded by the partition count."""
    keys = [key] if isinstance(key, str) else list(key)
    moved_from = holding(target, source, keys, part_col)
    return list(dict.fromkeys([*(r[0] for r in source.select(part_col).distinct().collect()), *moved_from]))


def locate(target: DataFrame, source: DataFrame, key, part_col: str, most: int = LITERAL_KEYS) -> DataFrame:
    """Keys of ``target`` that ``source`` holds, with their ``part_col``.

    Reads the key column only, and of that the row groups that may hold a batch
    key: the batch's least and greatest key bound the scan, and a batch of at
    most ``most`` keys is stated as literals, which Parquet tests against the
    files' Bloom filters.  Both only skip row groups without a match; the join
    decides, so a larger batch gives the same rows from a longer read."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = source.select(*keys).dropna()
    rows = _near(target, wanted, keys, most)
    if rows is None:
        return target.select(*keys, part_col).limit(0)
    return rows.select(*dict.fromkeys([*keys, part_col])).join(wanted, keys, "left_semi")


def holding(target: DataFrame, source: DataFrame, key, part_col: str, most: int = LITERAL_KEYS) -> list:
    """Values of ``part_col`` whose partitions hold a key of ``source``: one value
    per partition.  Hashes of the keys are joined instead of the keys, so two
    keys of one 64-bit hash may name a partition too many, never one too few."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = source.select(*keys).dropna()
    rows = _near(target, wanted, keys, most)
    if rows is None:
        return []
    found = (rows.dropna(subset=keys).select(F.xxhash64(*keys).alias("_h"), part_col)
             .join(wanted.select(F.xxhash64(*keys).alias("_h")), "_h", "left_semi"))
    return [r[0] for r in found.select(part_col).distinct().collect()]


def _near(target: DataFrame, wanted: DataFrame, keys: list, most: int) -> DataFrame | None:
    """``target`` less what Parquet can tell to hold no wanted key (None: none wanted)."""
    few = wanted.limit(most + 1).collect()
    if not few:
        return None
    rows = target
    if len(keys) == 1 and len(few) <= most:
        values = list({r[0] for r in few})
        tens = [F.col(keys[0]).isin(*map(typed_lit, values[i:i + 10])) for i in range(0, len(values), 10)]
        rows = rows.where(reduce(lambda a, b: a | b, tens))     # ten at a time: longer lists become a range
    else:
        ends = wanted.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for i, k in enumerate(keys):
            rows = rows.where(F.col(k).between(typed_lit(ends[f"lo_{i}"]), typed_lit(ends[f"hi_{i}"])))
    return rows


def restrict_to(df: DataFrame, part_col: str, values) -> DataFrame:
    """Rows of the given partitions; NULL is a partition value too (null-safe)."""
    if not values:
        return df.limit(0)
    conds = []
    non_null = [v for v in values if v is not None]
    if non_null:
        conds.append(F.col(part_col).isin(*[typed_lit(v) for v in non_null]))
    if any(v is None for v in values):
        conds.append(F.col(part_col).isNull())
    return df.where(reduce(lambda a, b: a | b, conds))


__all__ = ["scd1_upsert", "dedupe_source", "latest_of_stored", "DuplicateKeyError", "key_bucket", "merge_partitions",
           "touched_partitions", "restrict_to", "locate", "holding"]
