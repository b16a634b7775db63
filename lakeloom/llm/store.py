"""Intermediate tables in the cluster's shared folder, and code for the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

from lakeloom.session import scratch_path


#: Rows of one Arrow batch: a few MB of texts, so that a Python worker and the
#: JVM's copy of its input stay small beside the executor's heap.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = "1000"


def written(df: DataFrame, purpose: str, rows: str = ROWS) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read
    back: later uses read files every executor shares instead of computing it
    again, and a lost executor costs no lineage.  ``rows``: of one Arrow batch."""
    spark = df.sparkSession
    path, before = scratch_path(spark, purpose), spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, rows)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark) -> None:
    """Give this package to the Python workers (once per session): they may
    run where the repository is not on the path."""
    sc = spark.sparkContext
    if getattr(sc, "_lakeloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="lakeloom-code-")      # Spark copies it to the executors from the driver
    with zipfile.ZipFile(f"{folder}/lakeloom_code.zip", "w") as z:
        for p in sorted((root / "lakeloom").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(f"{folder}/lakeloom_code.zip")
    sc._lakeloom_shipped = True
