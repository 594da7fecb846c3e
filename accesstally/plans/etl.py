"""A whole run: load files, store parsed lines, compute reports, log the run."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesstally.functions.clf import parse_lines
from accesstally.operators.chunks import chunk_stats, numbered_chunks
from accesstally.operators.counts import batch_counts, batch_size_summary
from accesstally.operators.host_sets import hour_hosts, resource_hosts
from accesstally.operators.reports import QUERY_IDS, loose_resource_lines, selected_reports, top_resources
from accesstally.schema import TABLES
from accesstally.sources.run_months import MonthlyRunTables
from accesstally.sources.scratch import scratch_path, written
from accesstally.sources.tables import RunTables, read_positions, read_store, stored_records, with_run, write_store
from accesstally.sources.text import batch_paths, read_lines, read_numbered_lines

_RESULT_TABLES = {
    "query1": "daily_traffic_summary",
    "query2": "top_resources",
    "query3": "hourly_error_analysis",
}


def new_run_id() -> str:
    return str(uuid.uuid4())


def batch_rows(batches: DataFrame, run_id: str, pipeline_name: str, at: datetime) -> DataFrame:
    """Per-batch counts as rows of the batch table; a batch's size is its valid records."""
    sized = batches.withColumns(
        {"batch_size": F.col("records_processed"), "execution_timestamp": F.lit(at)}
    )
    return with_run(sized, run_id, pipeline_name)


def line_batches(spark: SparkSession, store: str, batch_size: int) -> DataFrame:
    """Counts of every ``batch_size`` consecutive lines of the files in a store of numbered lines."""
    positions = read_positions(spark, store)
    found = written(chunk_stats(positions, batch_size, scratch_path(spark, "blocks")), scratch_path(spark, "chunks"))
    numbered = numbered_chunks(found, positions.select("file_path", "batch_id").distinct())
    return numbered.withColumnsRenamed({"good_records": "records_processed"})


def run(
    spark: SparkSession,
    paths: Sequence[str],
    store: str,
    tables_root: str,
    query: str = "all",
    pipeline_name: str = "Spark",
    batch_size: int = 5000,
    dialect: str = "clf",
    extra: dict | None = None,
    balance: bool = True,
    encoding: str = "UTF-8",
    batch_by: str = "path",
    clustered: bool = True,
    host_states: bool = False,
    monthly: bool = False,
    run_id: str | None = None,
) -> str:
    """Process the files and return the run id.

    Lines are parsed once, into the store. The reports read two to four columns
    of it each, and only the selected ones run. The run record is the last thing
    written, so a run that fails half way never shows up in the history.

    Each path is one batch, and ``batch_size`` a label of the run record, unless ``batch_by`` is "lines":
    then ``batch_size`` consecutive lines of a file are a batch, the last of a file may be short, and
    batches are numbered through all files. The store holds the lines' positions, written with them, so
    the log is neither read nor parsed again. ``clustered`` is how the store is written. ``host_states``
    also keeps the sets of hosts, from which reports over several runs are merged. ``monthly`` keeps the
    run tables in buckets by month; there, a run that is given its ``run_id`` can be repeated.
    """
    if batch_by not in ("path", "lines"):
        raise ValueError(f"batches are by path or by lines, not by {batch_by!r}")
    if query not in QUERY_IDS:
        raise ValueError(f"invalid query name {query!r}, expected one of {sorted(QUERY_IDS)}")
    started, clock = datetime.now(timezone.utc), time.monotonic()
    run_id = run_id or new_run_id()
    tables = MonthlyRunTables(spark, tables_root, started) if monthly else RunTables(spark, tables_root)
    paths = batch_paths(spark, paths)

    by_lines = batch_by == "lines"
    lines = (read_numbered_lines if by_lines else read_lines)(spark, paths, encoding)
    write_store(parse_lines(lines, dialect), store, balance, clustered)

    if by_lines:
        batches = line_batches(spark, store, batch_size)
    else:
        batches = batch_counts(read_store(spark, store), len(paths))
    tables.append("batch_metadata", batch_rows(batches, run_id, pipeline_name, started))
    logged = tables.read("batch_metadata", run_id)

    reports = selected_reports(stored_records(spark, store), query, hosts_after_top=True)
    if dialect == "loose" and "query2" in reports:
        reports["query2"] = top_resources(loose_resource_lines(read_store(spark, store)), hosts_after_top=True)
    for name, rows in reports.items():
        tables.append_results(_RESULT_TABLES[name], rows, run_id, pipeline_name)

    if host_states:
        records = stored_records(spark, store)
        known = loose_resource_lines(read_store(spark, store)) if dialect == "loose" else records
        tables.append_results("resource_host_state", resource_hosts(known), run_id, pipeline_name)
        tables.append_results("hour_host_state", hour_hosts(records), run_id, pipeline_name)

    answer = [(run_id, pipeline_name, QUERY_IDS[query], query, started, json.dumps(extra or {}))]
    tables.append("query_results", spark.createDataFrame(answer, TABLES["query_results"]))

    total = batch_size_summary(logged).first()
    ended = datetime.now(timezone.utc)
    record = (
        run_id,
        pipeline_name,
        batch_size,
        total["total_batches"],
        total["total_records"],
        total["malformed_records"],
        total["avg_batch_size"],
        started,
        ended,
        int((time.monotonic() - clock) * 1000),
        ", ".join(paths),
        ended,
    )
    tables.append("execution_metadata", spark.createDataFrame([record], TABLES["execution_metadata"]))
    return run_id
