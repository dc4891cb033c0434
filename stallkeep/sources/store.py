"""Published tables: written to fresh paths, made visible by one small append."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_MANIFEST_SCHEMA = "published_at long, run string, table string, path string, part string"
# The folder level that tells the parts of a table apart; not a column of the table.
_PART = "_part"


class Store:
    """Tables under one root folder that all executors can reach.

    A run writes each table once, under its own folder. ``publish`` appends
    the run's paths to the manifest in one commit; readers always follow the
    newest commit that names a table. A run that fails publishes nothing, so
    the previous tables stay visible whole.

    A table may also be kept in parts (months, say). A run then writes only the
    parts it replaces; every other part stays the file it is, and the newest
    commit that names a part decides where it lies.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def new_run(self) -> str:
        return f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"

    def path(self, run: str, table: str) -> str:
        return f"{self.root}/runs/{run}/{table}"

    def write(self, run: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table of this run (never over an existing one) and read it back."""
        path = self.path(run, table)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.parquet(path)

    def write_parts(self, run: str, table: str, df: DataFrame, part: Column) -> dict[str, str]:
        """Write the parts of a table that df has rows of; ``part`` names each row's part.

        Returns where each part lies. Rows without a part go to the part ``none``.
        """
        path = self.path(run, table)
        named = df.withColumn(_PART, F.coalesce(part.cast("string"), F.lit("none")))
        named.hint("rebalance", _PART).write.mode("errorifexists").partitionBy(_PART).parquet(path)
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        found = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
        names = [s.getPath().getName() for s in found]
        return {n.partition("=")[2]: f"{path}/{n}" for n in names if n.startswith(f"{_PART}=")}

    def publish(
        self,
        run: str,
        tables: Mapping[str, str] | Sequence[str] = (),
        parts: Mapping[str, Mapping[str, str | None]] | None = None,
    ) -> None:
        """Make tables, and parts of tables, visible in one commit; a part without a path is gone."""
        paths = tables if isinstance(tables, Mapping) else {t: self.path(run, t) for t in tables}
        now = time.time_ns()
        rows = [(now, run, table, path, None) for table, path in paths.items()]
        rows += [(now, run, table, path, part) for table, some in (parts or {}).items() for part, path in some.items()]
        if rows:
            entries = self.spark.createDataFrame(rows, _MANIFEST_SCHEMA).coalesce(1)
            entries.write.mode("append").parquet(f"{self.root}/manifest")

    def _entries(self) -> list[Row]:
        """The newest entry of every table and part; as many as there are tables and parts."""
        try:
            entries = self.spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        newest = entries.groupBy("table", "part").agg(F.max(F.struct("published_at", "run", "path")).alias("x"))
        return newest.select("table", "part", "x.path").collect()

    def _manifest(self) -> dict[str, str]:
        return {r.table: r.path for r in self._entries() if r.part is None}

    def parts(self, table: str) -> dict[str, str]:
        """Where each published part of a table lies."""
        return {r.part: r.path for r in self._entries() if r.table == table and r.part is not None and r.path}

    def read_parts(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*paths)

    def retire(self, keep: int = 2) -> list[str]:
        """Remove the folders of runs whose tables nobody can reach any more; returns the runs removed.

        Kept are all runs that a published table lies in, and the newest
        ``keep`` others, of which one may still be writing or being read.
        """
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/runs")
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        runs = sorted(s.getPath().getName() for s in files.listStatus(root))
        start = len(f"{self.root}/runs/")
        used = {r.path[start:].split("/")[0] for r in self._entries() if r.path}
        idle = [run for run in runs if run not in used]
        removed = idle[: max(0, len(idle) - keep)]
        for run in removed:
            files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/runs/{run}"), True)
        return removed

    def paths(self) -> dict[str, str]:
        """Where each published table lies."""
        return self._manifest()

    def published(self) -> list[str]:
        return sorted(self._manifest())

    def table(self, name: str) -> DataFrame:
        paths = self._manifest()
        if name in paths:
            return self.spark.read.parquet(paths[name])
        parts = self.parts(name)
        if not parts:
            raise LookupError(f"table {name!r} is not published under {self.root}")
        return self.read_parts(list(parts.values()))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(path) for name, path in self._manifest().items()}
