"""SCD2 history merge: close changed versions, insert new versions.

For a source batch S and target history T (several rows per key, at most one
active), the new history is

1. every T row, where an *active* row whose hash differs from the S row of
   its key gets ``active_flag=false, end_effective_date=as_of`` (nothing
   else changes, in particular not ``h_update_timestamp``);
2. plus one new active row ``[as_of, 9999-12-31)`` for every S row whose key
   is absent from T, or whose key's active T row has a different hash;
   keys with only inactive T rows are re-opened only when ``reopen=True``.

Unchanged keys produce nothing, so replaying a batch is a no-op.  T is joined
with the batch's keys only; adaptive execution decides from measured sizes
whether they are broadcast.

With ``on_duplicate="history"`` S may hold several batches of one key: they are
applied in stamp order, as runs one after another on the same day would: every
row that differs from the one before it is a version of its own, each but the
last closed by its successor.  Rows with a NULL key match nothing and are all
inserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.functions.hashing import row_hash
from lakeloom.operators.casting import ts_literal
from lakeloom.operators.scd1 import dedupe_source
from lakeloom.session import cut_lineage

TRACKED_CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email", "phone_number",
                            "loyalty_points", "membership_status", "address")
OPEN_END = "9999-12-31"


def with_hash(source: DataFrame, tracked=TRACKED_CUSTOMER_COLUMNS, name: str = "hash_value") -> DataFrame:
    return source.withColumn(name, row_hash(*tracked))


def _one_per_batch(source: DataFrame, key: str, batch_col: str) -> DataFrame:
    """One row per key and batch (the greatest, where a batch repeats a key)."""
    rest = [c for c in source.columns if c not in (key, batch_col)]
    known = source.where(F.col(key).isNotNull())
    best = known.groupBy(key, batch_col).agg(F.max(F.struct(*rest)).alias("_best"))
    return (best.select(key, batch_col, "_best.*").select(*source.columns)
            .unionByName(source.where(F.col(key).isNull())))


def scd2_change_set(target: DataFrame, source: DataFrame, key: str = "customer_id",
                    tracked=TRACKED_CUSTOMER_COLUMNS, hash_col: str = "s_customer_key",
                    reopen: bool = False, on_duplicate: str = "error",
                    batch_col: str = "batch_r_timestamp") -> DataFrame:
    """Classify each source row: ``new`` (key unseen), ``changed`` (active
    version differs), ``unchanged``, ``inactive_only`` (key has no active
    version; re-opened only with ``reopen``).  Columns: source columns,
    ``hash_value``, ``change_type``, ``merge_key`` (the key for rows to insert
    with no match, NULL for new versions of changed keys — the MERGE trick)."""
    several = on_duplicate == "history" and batch_col in source.columns
    if several:
        src = _one_per_batch(source, key, batch_col)
    elif batch_col in source.columns:
        src = dedupe_source(source, key, order_col=batch_col, on_duplicate=on_duplicate)
    else:
        src = source
    src = with_hash(src, tracked)
    # only the history of keys present in the batch is summarised
    hist = (target.join(src.select(key).distinct(), key, "left_semi")
            .groupBy(key).agg(
                F.max(F.col("active_flag").cast("int")).alias("_has_active"),
                F.max(F.when(F.col("active_flag"), F.col(hash_col))).alias("_active_hash")))
    j = src.join(hist, key, "left").withColumn("_before", F.col("_active_hash")).withColumn("_nth", F.lit(1))
    if several:
        in_order = Window.partitionBy(key).orderBy(batch_col)
        known = j.where(F.col(key).isNotNull())
        known = (known.withColumn("_nth", F.row_number().over(in_order))
                 .withColumn("_before", F.when(F.col("_nth") == 1, F.col("_active_hash"))
                             .otherwise(F.lag("hash_value").over(in_order))))
        j = known.unionByName(j.where(F.col(key).isNull()))
    closed = F.col("_has_active") == 0
    change = (F.when(closed & ((F.col("_nth") == 1) | F.lit(not reopen)), "inactive_only")
              .when(F.col("_has_active").isNull() & (F.col("_nth") == 1), "new")
              .when(F.col("_before").eqNullSafe(F.col("hash_value")), "unchanged")
              .otherwise("changed"))
    out = j.withColumn("change_type", change).drop("_has_active", "_active_hash", "_before", "_nth")
    merge_key = F.when(F.col("change_type") == "new", F.col(key))
    return out.withColumn("merge_key", merge_key)


def scd2_merge(target: DataFrame, source: DataFrame, key: str = "customer_id",
               tracked=TRACKED_CUSTOMER_COLUMNS, as_of=None, run_ts=None, job_id: str = "scd2",
               hash_col: str = "s_customer_key", reopen: bool = False,
               on_duplicate: str = "error", batch_col: str = "batch_r_timestamp") -> DataFrame:
    """New SCD2 history (see module doc).  ``source`` carries the key, the
    tracked columns and ``batch_col``; ``as_of`` is the effective date of the
    run (the reference's ``current_date()``), ``run_ts`` its timestamp."""
    as_of_col = F.lit(str(as_of)).cast("date") if as_of is not None else F.current_date()
    stamp = ts_literal(run_ts) if run_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    changes = scd2_change_set(target, source, key, tracked, hash_col, reopen, on_duplicate, batch_col)
    # the change set feeds both the closing join and the inserts: write it once
    # to the shared checkpoint folder instead of recomputing the history scan
    changes = cut_lineage(changes.sparkSession, changes)

    insert_types = ["new", "changed"] + (["inactive_only"] if reopen else [])
    ins = changes.where(F.col("change_type").isin(*insert_types)).withColumn("_last", F.lit(True))
    if on_duplicate == "history":           # all but a key's last version are closed by the next one
        later = F.lead(F.lit(True)).over(Window.partitionBy(key).orderBy(batch_col))
        ins = (ins.where(F.col(key).isNotNull()).withColumn("_last", later.isNull())
               .unionByName(ins.where(F.col(key).isNull())))
    inserted = ins.select(
        *[F.col(c) if c in ins.columns else F.lit(None).alias(c) for c in tracked],
        F.col("_last").alias("active_flag"),
        as_of_col.alias("begin_effective_date"),
        F.when(F.col("_last"), F.lit(OPEN_END).cast("date")).otherwise(as_of_col).alias("end_effective_date"),
        F.col("hash_value").alias(hash_col),
        F.col(batch_col).cast("timestamp_ntz").alias("batch_r_timestamp") if batch_col in ins.columns
        else F.lit(None).cast("timestamp_ntz").alias("batch_r_timestamp"),
        stamp.alias("h_insert_timestamp"),
        stamp.alias("h_update_timestamp"),
        F.lit(job_id).alias("job_id"),
    )

    # keys whose active version must close
    closing = (changes.where(F.col("change_type") == "changed")
               .select(F.col(key).alias("_close_key"), F.lit(True).alias("_close")).distinct())
    t = target.join(closing, target[key] == closing["_close_key"], "left")
    close = F.col("_close").isNotNull() & F.col("active_flag")
    kept = t.select(*[
        F.when(close, F.lit(False)).otherwise(F.col(c)).alias(c) if c == "active_flag" else
        F.when(close, as_of_col).otherwise(F.col(c)).alias(c) if c == "end_effective_date" else
        F.col(c)
        for c in target.columns
    ])
    inserted = inserted.select(*[F.col(c) if c in inserted.columns else F.lit(None).alias(c)
                                 for c in target.columns])
    return kept.unionByName(inserted.select(*[inserted[c].cast(dict(target.dtypes)[c])
                                              for c in target.columns]))
