"""Catalog tables whose partitions are switched by location.

A run writes the new contents of the partitions it touches into a folder of its
own (``<base>/run=<n>/<column>=<value>``) and then points the catalog at them
with ``ALTER TABLE ... PARTITION ... SET LOCATION``.  The live files are never
overwritten or emptied: until a partition is switched, readers see all of its
old files, after that all of its new ones.

Between write and switch a small record of the run (partition value, new
location) is stored.  A run that dies before the record leaves the table as it
was; one that dies after it is finished by the next ``open``, which applies the
records the catalog has not seen.  The same records restore the partitions in a
catalog that lost them.  A run repeated under its number starts from the state
below it.  Folders that neither this state nor the one before it uses are
removed after the switch, so a reader that began before it can end.

A placement says which partition a row belongs to and which partitions a batch
touches:

* ``ByInsertRun``: by the run that first inserted the key; a batch touches its
  own new partition and those that hold keys it updates;
* ``ByColumn``: by a column of the row (a month); updated keys may move;
* ``ByHistory``: SCD2 versions, the active ones in hash buckets of the key, the
  closed ones in a partition per run, which is never written again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.hashing import dealt_packed
from lakeloom.operators import scd1
from lakeloom.plans.catalog import ensure_schema
from lakeloom.plans.publish import partition_dir_name
from lakeloom.session import path_exists, remove_path

RUN_PROPERTY = "lakeloom.run"
#: Rows of up to so many partitions are written by the tasks that hold them.
FEW = 4


class LocatedTable:
    def __init__(self, spark: SparkSession, name: str, struct: T.StructType, part_col: str, base: str,
                 key: str | None = None):
        """``struct`` holds ``part_col`` too.  With ``key`` files are sorted on
        it and carry Bloom filters, which ``scd1.locate`` uses."""
        self.spark, self.name, self.part_col, self.base, self.key = spark, name, part_col, base.rstrip("/"), key
        self.struct = T.StructType([f for f in struct if f.name != part_col] + [struct[part_col]])
        if "." in name:
            ensure_schema(spark, name.rpartition(".")[0])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.struct)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{part_col}`) "
                  f"LOCATION '{self.base}/live'")
        self.recover()

    # ------------------------------------------------------------------ reading
    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def current(self, before: int | None = None) -> DataFrame | None:
        """The table (None: no run yet), or as it was below the run ``before``."""
        if before is not None:
            return self.before(before)
        return self.read() if self._runs() else None

    def before(self, run: int) -> DataFrame | None:
        """The table as it was below ``run`` (None: no run yet); a state that a
        run of this number or a later one left is taken back."""
        if any(r >= run for r in self._runs()):
            lost = [p for p in self.locations(run).values() if not path_exists(self.spark, p)]
            if lost:
                raise ValueError(f"{self.name}: the state before run {run} is no longer kept ({lost[0]})")
            self._apply(self._wanted(run), self._all_values())
            for r in self._runs():
                if r >= run:
                    remove_path(self.spark, f"{self.base}/_commits/run={r}")
            self._mark(max(self._runs(), default=-1))
        return self.read() if self._runs() else None

    def locations(self, before: int | None = None) -> dict[str | None, str]:
        """Partition value (as text) to folder: one entry per partition."""
        return {v: p for v, p in self._wanted(before).items() if p is not None}

    # ------------------------------------------------------------------ writing
    def publish(self, rows: DataFrame | Iterable[DataFrame], run: int, touched: Iterable = (), arranged: bool = False) -> None:
        """Make ``rows`` the whole contents of their partitions, and empty the
        partitions in ``touched`` that have none.  Rows may come as several
        DataFrames (one at least), which are stored one after another before the
        switch.  ``arranged``: rows are already dealt and sorted as they shall be
        stored.  Where ``touched``
        names few partitions, rows are sorted but not dealt anew: a task adds
        one file to each of them at most."""
        self.write(rows, run, touched, arranged)
        self.switch()

    def write(self, rows: DataFrame | Iterable[DataFrame], run: int, touched: Iterable = (), arranged: bool = False) -> None:
        """The run's folder, then its record; the catalog is not changed."""
        folder = f"{self.base}/run={run}"
        touched, mode = list(touched), "overwrite"
        for part in [rows] if isinstance(rows, DataFrame) else rows:
            if not arranged:
                if not 0 < len(touched) <= FEW:     # about one partition a task, a large one split by its measured size
                    part = dealt_packed(part, lambda t: t.hint("rebalance", F.col(self.part_col)))
                part = part.sortWithinPartitions(self.part_col, *([self.key] if self.key else []))
            w = part.select(*self.struct.names).write.mode(mode).option("compression", "zstd")
            if self.key:
                w = (w.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
                     .option("parquet.bloom.filter.adaptive.enabled", "true"))
            w.partitionBy(self.part_col).parquet(folder)
            mode = "append"
        part = F.col(self.part_col).cast("string")
        have = {r[0] for r in self.spark.read.schema(self.struct).parquet(folder).select(part).distinct().collect()}
        gone = {None if v is None else _text(v) for v in touched} - have
        records = [(v, f"{folder}/{self.part_col}={partition_dir_name(v)}") for v in have] + [(v, None) for v in gone]
        (self.spark.createDataFrame(records, "value string, location string").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.base}/_commits/run={run}"))

    def switch(self) -> None:
        """Point the catalog at what the records say, then remove old folders."""
        self.recover()
        runs = self._runs()
        if len(runs) > 1:
            self._remove_unused({*self.locations().values(), *self.locations(before=runs[-1]).values()})

    def recover(self) -> None:
        newest = max(self._runs(), default=-1)
        if self._marked() != newest:
            self._apply(self._wanted(), self._all_values())
            self._mark(newest)

    # ------------------------------------------------------------------ inside
    def _runs(self) -> list[int]:
        path = f"{self.base}/_commits"
        if not path_exists(self.spark, path):
            return []
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()[4:]) for s in fs.listStatus(p)
                      if fs.exists(s.getPath().suffix("/_SUCCESS")))

    def _records(self, before: int | None = None) -> list:
        paths = [f"{self.base}/_commits/run={r}" for r in self._runs() if before is None or r < before]
        if not paths:
            return []
        return (self.spark.read.schema("value string, location string, run int").option("basePath", f"{self.base}/_commits")
                .parquet(*paths).orderBy("run").collect())

    def _wanted(self, before: int | None = None) -> dict[str | None, str | None]:
        return {r.value: r.location for r in self._records(before)}       # later runs win

    def _all_values(self) -> set:
        return {r.value for r in self._records()}

    def _apply(self, wanted: dict, values: set) -> None:
        """Set, add or drop the partitions of ``values`` as ``wanted`` says."""
        there = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        add = []
        for v in sorted(values, key=lambda v: (v is None, v)):
            spec, location = self._spec(v), wanted.get(v)
            known = f"{self.part_col}={partition_dir_name(v)}" in there
            if location is None and known:
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {spec}")
            elif location is not None and known:
                self.spark.sql(f"ALTER TABLE {self.name} {spec} SET LOCATION '{location}'")
            elif location is not None:
                add.append(f"{spec} LOCATION '{location}'")
        if add:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(add)}")
        self.spark.catalog.refreshTable(self.name)

    def _spec(self, value: str | None) -> str:
        text = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"PARTITION (`{self.part_col}` = {text})"

    def _marked(self) -> int:
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return int(props.get(RUN_PROPERTY, -1))

    def _mark(self, run: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{RUN_PROPERTY}' = '{run}')")

    def _remove_unused(self, used: set) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.base)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = {u[len(self.base):] for u in used}
        for run in fs.listStatus(p):
            if run.getPath().getName().startswith("run="):
                for part in fs.listStatus(run.getPath()):
                    if part.isDirectory() and f"/{run.getPath().getName()}/{part.getPath().getName()}" not in names:
                        fs.delete(part.getPath(), True)


def _text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


# ---------------------------------------------------------------- placements
@dataclass(frozen=True)
class ByInsertRun:
    column: str = "_run"

    def struct(self, spec) -> T.StructType:
        return T.StructType([*spec, T.StructField(self.column, T.IntegerType())])

    def first(self, run: int) -> list:
        """The partitions of a first load, where they are known."""
        return [run]

    def scope(self, target: DataFrame, source: DataFrame, key, run: int) -> tuple[DataFrame, list]:
        """The rows a merge of ``source`` must see, and the partitions it rewrites."""
        where = scd1.holding(target, source, key, self.column)
        return scd1.restrict_to(target, self.column, where), [*where, run]

    def place(self, rows: DataFrame, run: int) -> DataFrame:
        old = F.col(self.column) if self.column in rows.columns else F.lit(None).cast("int")
        return rows.withColumn(self.column, F.coalesce(old, F.lit(run)))


@dataclass(frozen=True)
class ByColumn:
    column: str

    def struct(self, spec) -> T.StructType:
        return T.StructType(list(spec))

    def first(self, run: int) -> list:
        return []

    def scope(self, target: DataFrame, source: DataFrame, key, run: int) -> tuple[DataFrame, list]:
        moved = scd1.holding(target, source, key, self.column)
        where = list(dict.fromkeys([*(r[0] for r in source.select(self.column).distinct().collect()), *moved]))
        return scd1.restrict_to(target, self.column, where), where

    def place(self, rows: DataFrame, run: int) -> DataFrame:
        return rows


@dataclass(frozen=True)
class ByHistory:
    key: str
    buckets: int = 16
    column: str = "_part"

    def struct(self, spec) -> T.StructType:
        return T.StructType([*spec, T.StructField(self.column, T.StringType())])

    def _bucket(self):
        return F.concat(F.lit("active-"), scd1.key_bucket(self.key, self.buckets).cast("string"))

    def first(self, run: int) -> list:
        return []

    def scope(self, target: DataFrame, source: DataFrame, key, run: int) -> tuple[DataFrame, list]:
        """Active buckets of the batch's keys, and the closed versions of these
        keys (they tell a key that is closed from a new one)."""
        where = [r[0] for r in source.select(self._bucket()).distinct().collect()]      # at most ``buckets``
        closed = F.col(self.column).startswith("closed-")
        old = target.where(closed).join(source.select(self.key).distinct(), self.key, "left_semi")
        return scd1.restrict_to(target, self.column, where).unionByName(old.select(*target.columns)), [*where, f"closed-{run}"]

    def place(self, rows: DataFrame, run: int) -> DataFrame:
        """Closed versions of earlier runs stay where they are."""
        if self.column in rows.columns:
            rows = rows.where(F.col(self.column).isNull() | ~F.col(self.column).startswith("closed-"))
        return rows.withColumn(self.column, F.when(F.col("active_flag"), self._bucket()).otherwise(F.lit(f"closed-{run}")))
