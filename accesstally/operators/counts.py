"""Row counts: whole input, per batch, and summaries over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _valid() -> Column:
    return F.col("malformed_reason").isNull()


def record_counts(parsed: DataFrame) -> DataFrame:
    """One row with valid and malformed lines; zeros for an empty input."""
    return parsed.agg(
        F.count_if(_valid()).alias("total_records"),
        F.count_if(~_valid()).alias("malformed_records"),
    )


def row_count(table) -> DataFrame:
    """Rows of a table, or of each group of a grouped one."""
    return table.agg(F.count("*").alias("row_count"))


def batch_counts(parsed: DataFrame, batches: int | None = None) -> DataFrame:
    """Exact valid and malformed lines per batch; of batches 1 to ``batches`` also those without lines."""
    counted = parsed.groupBy("batch_id").agg(
        F.count_if(_valid()).alias("records_processed"),
        F.count_if(~_valid()).alias("malformed_records"),
    )
    if batches is None:
        return counted
    number = F.col("id").cast("int").alias("batch_id")
    none = parsed.sparkSession.range(1, batches + 1).select(
        number, F.lit(0).cast("bigint").alias("records_processed"), F.lit(0).cast("bigint").alias("malformed_records")
    )
    sums = [F.sum(c).alias(c) for c in ("records_processed", "malformed_records")]
    return counted.unionByName(none).groupBy("batch_id").agg(*sums)


def batch_size_summary(batches: DataFrame) -> DataFrame:
    """Totals, average and largest batch over per-batch counts."""
    return batches.agg(
        F.count("*").alias("total_batches"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("malformed_records"), F.lit(0)).alias("malformed_records"),
        F.coalesce(F.avg("records_processed"), F.lit(0.0)).alias("avg_batch_size"),
        F.coalesce(F.max("records_processed"), F.lit(0)).alias("largest_batch_size"),
    )
