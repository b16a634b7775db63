"""Session construction and shared-folder helpers.

Everything that needs durable scratch space (checkpoints, staged snapshots,
stream ledgers) asks the session for ``spark.checkpoint.dir``.  On a cluster
that setting names a shared folder; only when it is unset (local runs, tests)
do we fall back to a fresh folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Observation, SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins and
# coalesces small shuffle partitions, the skew-join split handles a hot key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "lakeloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a local one
    only when the cluster names none (tests, laptops)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not is_local(spark.sparkContext.master):
            # executors on other machines cannot share a driver-local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
        current = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - some deployments lock core settings
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def is_local(master: str) -> bool:
    """True for a single-machine master (``local``, ``local[8]``, ``local[*, 4]``)."""
    return master.startswith("local")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique (not yet existing) path under the shared checkpoint
    folder; the writer that uses it creates it, on any file system."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{purpose}-{uuid.uuid4().hex[:12]}"


#: Folders that cuts of the surrounding ``cuts_removed`` have written.
_CUTS: ContextVar[list | None] = ContextVar("cuts", default=None)


def _cut_path(spark: SparkSession) -> str:
    path = scratch_path(spark, "cut")
    if _CUTS.get() is not None:
        _CUTS.get().append(path)
    return path


@contextmanager
def cuts_removed(spark: SparkSession):
    """Remove the copies that ``cut_lineage`` and ``cut_observed`` make inside,
    at the end: for a job whose results are all stored by then.  After an error
    they stay, as what it carries may read them."""
    token = _CUTS.set([])
    try:
        yield
        for path in _CUTS.get():
            remove_path(spark, path)
    finally:
        _CUTS.reset(token)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Remove the shuffle files of every action inside as soon as it has ended,
    not when the driver happens to collect its garbage: a job of many actions
    otherwise keeps all of them on disk.  An action repeated on the same
    DataFrame writes them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(spark: SparkSession, df):
    """Materialise ``df`` in the shared checkpoint folder (survives executor
    loss, unlike a local checkpoint) and continue from the written copy."""
    path = _cut_path(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_observed(spark: SparkSession, df, **metrics):
    """``cut_lineage``, and aggregates of the rows taken while they are written:
    no job of their own.  Returns the written copy and ``{name: value}``."""
    seen, path = Observation(), _cut_path(spark)
    df.observe(seen, *[m.alias(n) for n, m in metrics.items()]).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(seen.get)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its file system?  Any other failure is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on its file system, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized for a job reading ``input_bytes`` on ``cores`` cores.

    Shuffle partitions are chosen so an average shuffle partition is about
    ``target_partition_bytes`` (fits executor memory without spilling much),
    never fewer than two waves of tasks; AQE then coalesces small partitions
    and splits skewed ones.  Example: 100 TB on 8,000 cores -> 400k shuffle
    partitions, 256 MB file splits."""
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
