"""Run tables for many runs, in buckets by month.

A run's rows are a partition of its month. Writing them replaces that partition and nothing else, so a
run that is appended again after a failure leaves the same rows. ``compact`` puts the runs of a month
into few files; it writes them before it removes the single partitions, and a run that is found in both
places counts once, so a reader sees the same rows before, during and after. A run counts as complete
when its record is in ``execution_metadata``, which is written last.

Readers name months: the newest runs are found from the newest buckets, without listing any other.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from accesstally import schema
from accesstally.operators.history import SHOWN_ROWS, run_history
from accesstally.sources.scratch import discard, scratch_path, written
from accesstally.sources.tables import RunTables

_MONTH = "yyyy-MM"


class MonthlyRunTables(RunTables):
    """``RunTables`` whose rows lie in the month of ``at``, the start of the run that writes them."""

    def __init__(self, spark: SparkSession, root: str, at: datetime | None = None):
        super().__init__(spark, root)
        self.at = at

    def append(self, table: str, rows: DataFrame) -> None:
        """Add a run's rows, or replace those of an earlier attempt."""
        if self.at is None:
            raise ValueError("a run is appended with the time of its start")
        self._write(table, rows.withColumn("month", F.lit(self.at.strftime("%Y-%m"))), "single", ["month", "run_id"])

    def load(self, table: str, rows: DataFrame, created: Column) -> None:
        """Many runs at once, each in the month of ``created``, whose compacted rows must not be there yet."""
        self._write(table, rows.withColumn("month", F.date_format(created, _MONTH)), "compacted", ["month"])

    def _write(self, table: str, rows: DataFrame, kind: str, partitions: list[str]) -> None:
        columns = [F.col(f.name).cast(f.dataType) for f in schema.TABLES[table].fields]
        typed = rows.select(*columns, "month")
        if kind == "compacted":
            typed = typed.hint("rebalance", "month")
        replaced = typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy(*partitions).parquet(f"{self.root}/{table}/{kind}")

    def months(self, table: str) -> list[str]:
        """The months that a table has rows of, newest first; two listings of one level."""
        found = set()
        for kind in ("single", "compacted"):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/{kind}")
            system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if system.exists(path):
                names = [status.getPath().getName() for status in system.listStatus(path)]
                found |= {name[6:] for name in names if re.fullmatch(r"month=\d{4}-\d{2}", name)}
        return sorted(found, reverse=True)

    def _bucket(self, table: str, kind: str, month: str) -> DataFrame | None:
        folder = f"{self.root}/{table}/{kind}/month={month}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        columns = schema.TABLES[table]
        return self.spark.read.schema(columns).parquet(folder).select(*columns.names)

    def month(self, table: str, month: str) -> DataFrame:
        """The rows of one bucket; of a run that is in both forms the compacted ones."""
        single, compacted = (self._bucket(table, kind, month) for kind in ("single", "compacted"))
        if single is None or compacted is None:
            found = compacted if single is None else single
            return self.spark.createDataFrame([], schema.TABLES[table]) if found is None else found
        return compacted.unionByName(single.join(compacted.select("run_id").distinct(), "run_id", "left_anti"))

    def read(self, table: str, run_id: str | None = None, months: list[str] | None = None) -> DataFrame:
        """The rows of the given months, or of all; of one run with ``run_id``."""
        rows = self.spark.createDataFrame([], schema.TABLES[table])
        for month in self.months(table) if months is None else months:
            rows = rows.unionByName(self.month(table, month))
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)

    def compact(self, table: str, month: str) -> None:
        """Put the single runs of a month into its compacted files."""
        if self._bucket(table, "single", month) is None:
            return
        path = scratch_path(self.spark, "compacted")
        rows = written(self.month(table, month), path)
        self._write(table, rows.withColumn("month", F.lit(month)), "compacted", ["month"])
        discard(self.spark, f"{self.root}/{table}/single/month={month}")
        discard(self.spark, path)

    def newest(self, rows: int = SHOWN_ROWS) -> DataFrame:
        """The history of the newest runs, from as many of the newest months as hold them."""
        chosen, held = [], 0
        for month in self.months("execution_metadata"):
            chosen.append(month)
            held += self.month("execution_metadata", month).limit(rows).count()
            if held >= rows:
                break
        return run_history(self.read("execution_metadata", months=chosen), self.read("query_results", months=chosen), rows)
