"""Writing table states without a transactional table format.

A merge produces a *new state* DataFrame; Spark refuses to overwrite a path
it is reading, so a state is published as a new versioned folder and the
table name is pointed at it (readers of a snapshot see the old or the new
version, never a mix).  For large month-partitioned tables only the touched
partitions are rewritten: stage them, then dynamic-partition-overwrite from the
stage; that overwrite is per partition, so a reader during it can see some
partitions new and others old.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.hashing import dealt_packed
from lakeloom.session import cut_lineage, path_exists, scratch_path


def write_partitioned(df: DataFrame, path: str, partition_col: str, order_col: str | tuple | None = None,
                      n_tasks: int | None = None, mode: str = "overwrite") -> None:
    """Partitioned write with few files per partition and no hot task.

    Range-partitioning on (partition value, row key) lets a big month spread
    over several tasks while each task writes to few months — unlike
    ``repartition(partition_col)``, which sends a whole month to one task.
    Several ``order_col`` (invoice, line): rows that repeat each other's header
    stay side by side, which shuffle blocks and files store once.  Files are
    zstd: keys such as md5 texts take half the room."""
    order = [partition_col] + ([] if order_col is None else [order_col] if isinstance(order_col, str) else list(order_col))
    out = dealt_packed(df, lambda t: t.repartitionByRange(n_tasks, *order) if n_tasks else t.repartitionByRange(*order))
    out.sortWithinPartitions(*order).write.mode(mode).option("compression", "zstd").partitionBy(partition_col).parquet(path)


def publish_snapshot(spark: SparkSession, state: DataFrame, base: str, view: str | None = None,
                     partition_col: str | None = None) -> str:
    """Write ``state`` to a new version folder under ``base``; return its path
    and (optionally) point a temp view at it."""
    path = scratch_path(spark, "snapshot") if base is None else f"{base.rstrip('/')}/v-{_stamp()}"
    w = state.write.mode("errorifexists")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
    if view:
        spark.read.parquet(path).createOrReplaceTempView(view)
    return path


def overwrite_partitions(spark: SparkSession, new_parts: DataFrame, path: str, partition_col: str,
                         touched=None, stage: str | None = None) -> None:
    """Replace only the partitions present in ``new_parts`` at ``path``.

    ``new_parts`` usually reads ``path`` itself (a merge), so it is staged to
    a shared folder first, together with the ``touched`` partition values;
    everything after reads the stage only.  Partitions listed in ``touched``
    that end up with no rows (all their keys moved away) are removed — after
    the overwrite, so no row is ever only in a deleted folder.

    Crash safety: ``path`` is not modified before the stage is complete (its
    ``_touched`` list is written last).  With a stable ``stage`` (for example
    ``<shared folder>/<table>/upper=<batch bound>``), a re-run after a failure
    finds the finished stage and resumes from it instead of re-merging a
    half-updated table; the two remaining steps are idempotent."""
    stage = (stage or scratch_path(spark, "stage")).rstrip("/")
    done = f"{stage}/_touched"          # hidden from the stage's own file listing
    if not path_exists(spark, f"{done}/_SUCCESS"):
        # Rows arrive partitioned by the merge key, so every task would write
        # a file into every touched partition.  A rebalance on the partition
        # value gives each task about one partition, and adaptive execution
        # splits a large one over several tasks by its measured size.
        new_parts.hint("rebalance", F.col(partition_col)) \
            .write.mode("overwrite").partitionBy(partition_col).parquet(stage)
        ptype = dict(new_parts.dtypes)[partition_col]
        spark.createDataFrame([(v,) for v in (touched or [])], f"`{partition_col}` {ptype}") \
            .write.mode("overwrite").parquet(done)
    touched = [r[0] for r in spark.read.parquet(done).collect()]   # one row per partition
    # the merge's own schema, not inferred partition types: a string partition
    # value such as "01" must not come back as the number 1.  An empty stage
    # (every touched partition emptied) reads as no rows: nothing overwritten.
    staged = spark.read.schema(new_parts.schema).parquet(stage)
    (staged.select(*[c for c in staged.columns if c != partition_col], partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    present = {r[0] for r in staged.select(partition_col).distinct().collect()}
    for value in touched:
        if value not in present:
            _drop_partition_dir(spark, path, partition_col, value)


# Characters Spark percent-escapes in partition folder names
# (besides control characters).
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^')


def partition_dir_name(value) -> str:
    """The folder name Spark gives a partition value: NULL as the Hive default
    partition, booleans in lower case, special characters as ``%XX``."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED or ord(ch) < 0x20 else ch for ch in text)


def _drop_partition_dir(spark: SparkSession, path: str, partition_col: str, value) -> None:
    """Delete one Hive-style partition folder through the Hadoop FileSystem API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={partition_dir_name(value)}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


class VersionedTable:
    """A table kept as immutable version folders ``<base>/v=<n>``.

    ``commit(df, n)`` writes version ``n`` (overwriting a half-written
    attempt of the same ``n``, so a replayed stream epoch is idempotent);
    ``current()`` reads the highest complete version (Spark's ``_SUCCESS``
    marker), or None before the first commit."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.base)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        p, fs = self._fs()
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def current(self, before: int | None = None) -> DataFrame | None:
        """The newest complete version (below ``before`` when given: the state
        a replayed epoch ``before`` must start from, never its own output)."""
        vs = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.base}/v={vs[-1]}") if vs else None

    def commit(self, df: DataFrame, version: int) -> str:
        path = f"{self.base}/v={version}"
        df.write.mode("overwrite").parquet(path)
        return path


def _stamp() -> str:
    import time
    import uuid
    return f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:6]}"


__all__ = ["write_partitioned", "publish_snapshot", "overwrite_partitions", "cut_lineage", "save_bucketed", "VersionedTable"]


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite",
                  partition_col: str | None = None, files_per_bucket: int = 1) -> None:
    """Save ``df`` as a catalog table hash-bucketed (and sorted) on ``key``.

    Two tables bucketed on the join key with the same bucket count join
    without any shuffle (each task reads bucket i of both sides): the facts
    build over bucketed headers and lines is then a map-only job.  Buckets
    are written by a shuffle on ``key`` once, at load time, instead of on
    every join.

    The rows are first hash-partitioned on ``key`` into ``buckets *
    files_per_bucket`` tasks.  Spark's bucket id is the same hash modulo
    ``buckets``, which divides the task count, so every task holds rows of
    exactly one bucket: the table gets ``files_per_bucket`` files per bucket
    (per partition value), not one file per bucket from every task."""
    out = df.repartition(buckets * max(1, files_per_bucket), key)
    w = out.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.saveAsTable(table)
