"""Reports over the stored result and run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from accesstally.operators.reports import MAX_SHOWN

# Rows shown per report, length of a path in a report.
SHOWN_ROWS = 20
SHOWN_PATH = 50


def stored_traffic(traffic: DataFrame, run_id: str) -> DataFrame:
    """Stored daily traffic of one run, summed again over its rows."""
    return (
        traffic.filter(F.col("run_id") == run_id)
        .groupBy("pipeline_name", "log_date", "status_code")
        .agg(F.sum("request_count").alias("request_count"), F.sum("total_bytes").alias("total_bytes"))
        .orderBy("log_date", "status_code")
    )


def report_traffic(traffic: DataFrame, run_id: str, rows: int = SHOWN_ROWS) -> DataFrame:
    return (
        traffic.filter(F.col("run_id") == run_id)
        .groupBy("log_date", "status_code")
        .agg(F.sum("request_count").alias("request_count"), F.sum("total_bytes").alias("total_bytes"))
        .orderBy("log_date", "status_code")
        .limit(rows)
    )


def report_top_resources(top: DataFrame, run_id: str, rows: int = SHOWN_ROWS) -> DataFrame:
    columns = ["resource_path", "request_count", "total_bytes", "distinct_host_count", "rank"]
    return (
        top.filter(F.col("run_id") == run_id)
        .select(*columns, F.left("resource_path", F.lit(SHOWN_PATH)).alias("shown_path"))
        .orderBy("rank")
        .limit(rows)
    )


def report_hourly_errors(hourly: DataFrame, run_id: str, rows: int = SHOWN_ROWS) -> DataFrame:
    return (
        hourly.filter(F.col("run_id") == run_id)
        .drop("run_id", "pipeline_name")
        .orderBy("log_date", "log_hour")
        .limit(rows)
    )


def report_batches(batches: DataFrame, run_id: str) -> DataFrame:
    return (
        batches.filter(F.col("run_id") == run_id)
        .select("batch_id", "batch_size", "records_processed", "malformed_records")
        .orderBy("batch_id")
    )


def malformed_summary(batches: DataFrame) -> DataFrame:
    """Malformed lines per run and batch."""
    return batches.select(
        "run_id",
        "pipeline_name",
        "batch_id",
        F.col("malformed_records").alias("malformed_record_count"),
        "execution_timestamp",
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("created_at"), "run_id").select("run_id").limit(1)


def stored_top_resources(top: DataFrame, run_id: str) -> DataFrame:
    """The stored top list of one run, whole and in order."""
    return top.filter(F.col("run_id") == run_id).drop("run_id").orderBy("rank")


def stored_hourly_errors(hourly: DataFrame, run_id: str) -> DataFrame:
    """The stored hourly errors of one run, whole and in order."""
    return hourly.filter(F.col("run_id") == run_id).drop("run_id").orderBy("log_date", "log_hour")


def run_history(runs: DataFrame, results: DataFrame, rows: int = SHOWN_ROWS) -> DataFrame:
    """The newest runs with the query each one answered, ``all`` where none is recorded.

    A left join keeps every run, so the first ``rows`` rows can only come from
    the first ``rows`` runs. Runs are cut down first; results meet them in a
    map-side join whose build side has ``rows`` rows, and are cut down as well.
    Neither table is shuffled.
    """
    if not 0 < rows <= MAX_SHOWN:
        raise ValueError(f"a history has 1 to {MAX_SHOWN} rows")
    columns = [
        "run_id",
        "pipeline_name",
        "total_records",
        "malformed_records",
        "execution_time_ms",
        "avg_batch_size",
        "created_at",
    ]
    newest = runs.select(*columns).orderBy(F.desc("created_at"), "run_id").limit(rows)
    answered = (
        results.select("run_id", "query_name")
        .join(F.broadcast(newest.select("run_id", "created_at")), "run_id")
        .orderBy(F.desc("created_at"), "run_id", "query_name")
        .limit(rows)
        .select("run_id", "query_name")
    )
    return (
        newest.join(answered, "run_id", "left")
        .withColumn("query_name", F.coalesce("query_name", F.lit("all")))
        .orderBy(F.desc("created_at"), "run_id", "query_name")
        .limit(rows)
    )


def compare_runs(runs: DataFrame) -> DataFrame:
    """Number of runs and their times per pipeline, fastest average first."""
    return (
        runs.groupBy("pipeline_name")
        .agg(
            F.count("*").alias("runs"),
            F.round(F.avg("execution_time_ms")).cast("bigint").alias("avg_ms"),
            F.min("execution_time_ms").alias("min_ms"),
            F.max("execution_time_ms").alias("max_ms"),
            F.sum("total_records").alias("total_records"),
        )
        .orderBy("avg_ms", "pipeline_name")
    )


def run_report(tables, run_id: str) -> dict[str, DataFrame]:
    """Everything stored about one run; empty when the run is unknown."""
    metadata = tables.read("execution_metadata", run_id)
    if metadata.isEmpty():
        return {}
    named = tables.read("query_results", run_id).select("query_name").first()
    query = named["query_name"] if named else "all"
    parts = {
        "query1": ("daily_traffic_summary", report_traffic),
        "query2": ("top_resources", report_top_resources),
        "query3": ("hourly_error_analysis", report_hourly_errors),
    }
    report = {
        "metadata": metadata.withColumn("query_name", F.lit(query)),
        "batches": report_batches(tables.read("batch_metadata"), run_id),
    }
    for name, (table, build) in parts.items():
        if query in (name, "all"):
            report[name] = build(tables.read(table), run_id)
    return report
