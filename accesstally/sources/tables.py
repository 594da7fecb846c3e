"""Parsed store, delimited and JSON sinks, and run-keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from accesstally import schema


def _delimited(io):
    """Tabs without quoting or escaping, so every character of a field survives."""
    return (
        io.option("sep", "\t")
        .option("header", False)
        .option("quote", "")
        .option("escape", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def export_records(records: DataFrame, path: str) -> None:
    """Nine tab-separated fields per record, no header."""
    write_tsv(records.select(*schema.RECORD_FIELDS), path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark.read.schema(schema.RECORD)).csv(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    _delimited(rows.write.mode("overwrite")).csv(path)


def read_tsv(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Typed rows back from a TSV sink: short or unreadable rows are skipped, rates rounded.

    Fields are read as text and converted here. The reader would convert only
    those a query asks for, and the rows it skips would depend on the query.
    """
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in columns.names])
    reader = _delimited(spark.read.schema(as_text)).option("mode", "DROPMALFORMED")
    rows = reader.option("columnPruning", False).csv(path)
    typed = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in columns.fields])
    converted = [f.name for f in columns.fields if f.dataType != T.StringType()]
    return _rounded(typed.dropna(subset=converted))


def write_json(results: dict[str, DataFrame], path: str) -> None:
    """One directory of JSON lines per report name."""
    for name, rows in results.items():
        rows.write.mode("overwrite").json(f"{path}/{name}")


def read_json(spark: SparkSession, path: str, name: str, columns: T.StructType) -> DataFrame:
    """One report back from the JSON sink; lines that are no JSON are skipped."""
    return _rounded(spark.read.schema(columns).option("mode", "DROPMALFORMED").json(f"{path}/{name}"))


def _rounded(rows: DataFrame) -> DataFrame:
    if "error_rate" not in rows.columns:
        return rows
    return rows.withColumn("error_rate", F.round("error_rate", 4))


#: Bits of each column in the interleaved key, and bytes of a row group of a clustered store.
CLUSTER_BITS, GROUP_BYTES = 6, 32 << 20


def cluster_key() -> Column:
    """Rows that are alike in host, path, hour and status get near numbers.

    Bits of the four columns take turns. Hour and status keep their order, so ranges of row groups and
    pages are narrow; hosts and paths are hashed, so that each is in few row groups, and their bloom
    filters say in which.
    """
    top = 1 << CLUSTER_BITS
    scaled = lambda value, low, high: F.least(F.greatest(F.floor((value - low) * top / (high - low)), F.lit(0)), F.lit(top - 1))
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(top))
    sides = [hashed("host"), hashed("resource_path"), scaled(F.col("log_hour"), 0, 24), scaled(F.col("status_code"), 100, 600)]
    sides = [F.coalesce(side.cast("long"), F.lit(0).cast("long")) for side in sides]
    bits = [F.shiftleft(F.shiftright(side, bit) % 2, bit * len(sides) + i) for bit in range(CLUSTER_BITS) for i, side in enumerate(reversed(sides))]
    return reduce(lambda a, b: a + b, bits)


def write_store(parsed: DataFrame, path: str, balance: bool = True, clustered: bool = False, group_bytes: int = GROUP_BYTES) -> None:
    """Replace the parsed store: Parquet by date, all lines, valid or not.

    Malformed lines keep their text and reason and have no date, so they form a
    partition of their own; one parse feeds every later read. ``balance`` adds a
    rebalancing shuffle, so a date has as many files as its size needs; without
    it every task writes a file for each date it holds, which suits logs in time
    order that no reader has dealt out. The whole store is replaced, whatever the
    session's mode of overwriting partitions.

    ``clustered`` sorts the rows of a date by ``cluster_key`` inside each task and adds bloom filters on
    host and path, with row groups of ``group_bytes``: lookups by host, path, hour and status then read a
    small part of a date. Tasks sort what they have; nothing more is shuffled.
    """
    stored = parsed.withColumns(
        {
            "value": F.when(F.col("malformed_reason").isNotNull(), F.col("value")),
            "log_date": F.when(F.col("malformed_reason").isNull(), F.col("log_date")),
        }
    )
    if balance:
        stored = stored.hint("rebalance", "log_date")
    if clustered:
        stored = stored.withColumn("_near", cluster_key()).sortWithinPartitions("log_date", "_near", "host", "resource_path").drop("_near")
    replaced = stored.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if clustered:
        replaced = replaced.option("parquet.block.size", group_bytes).option("parquet.bloom.filter.adaptive.enabled", True)
        for column in ("host", "resource_path"):
            replaced = replaced.option(f"parquet.bloom.filter.enabled#{column}", True)
    replaced.partitionBy("log_date").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All stored lines with ``malformed_reason``."""
    fields = [f for f in schema.RECORD.fields if f.name != "log_date"]
    stored = T.StructType(
        [T.StructField("value", T.StringType()), T.StructField("file_path", T.StringType())]
        + [T.StructField("batch_id", T.IntegerType())]
        + fields
        + [
            T.StructField("event_time", T.TimestampType()),
            T.StructField("malformed_reason", T.StringType()),
            T.StructField("log_date", T.DateType()),
        ]
    )
    return spark.read.schema(stored).parquet(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Where each stored line stood, valid or not; for a store of numbered lines."""
    stored = "file_path string, batch_id int, split_start long, line_seq long, malformed_reason string"
    return spark.read.schema(stored).parquet(path)


def stored_records(spark: SparkSession, path: str) -> DataFrame:
    """Valid records of the store; malformed ones are cut off as a partition."""
    return read_store(spark, path).filter(F.col("log_date").isNotNull()).drop("value", "malformed_reason")


class RunTables:
    """Append-only tables of results and run logs under one root, partitioned by run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows; an empty input adds nothing."""
        columns = schema.TABLES[table]
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in columns.fields])
        typed.write.mode("append").partitionBy("run_id").parquet(f"{self.root}/{table}")

    def append_results(self, table: str, rows: DataFrame, run_id: str, pipeline_name: str) -> None:
        self.append(table, with_run(rows, run_id, pipeline_name))

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A table, or one run of it; a table nobody wrote yet is empty."""
        columns = schema.TABLES[table]
        try:
            rows = self.spark.read.schema(columns).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], columns)
        rows = rows.select(*columns.names)
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)


def with_run(rows: DataFrame, run_id: str, pipeline_name: str) -> DataFrame:
    return rows.select(F.lit(run_id).alias("run_id"), F.lit(pipeline_name).alias("pipeline_name"), "*")
