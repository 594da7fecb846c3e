"""Queries of the engine, each with an independent SQL statement of its result."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries
from accesstally import schema
from accesstally.functions.clf import malformed_lines, parse_lines, request_parts, valid_records
from accesstally.operators import chunks, counts, history, host_sets, lookups, reports
from accesstally.plans import combined, etl, sql_reports
from accesstally.sources import event_lines as derived, tables, text
from accesstally.sources.run_months import MonthlyRunTables
from accesstally.sources.scratch import scratch_path

try:
    import corpus_pipeline
    from accesstally.llm import queries as corpus
except ImportError as missing:  # these parts of the library are optional
    if not (missing.name or "").startswith(("corpus_pipeline", "accesstally.llm")):
        raise
    corpus = None


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.event_lines(_events(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _parsed(spark: SparkSession, sf_dir: str, dialect: str = "clf") -> DataFrame:
    return parse_lines(_lines(spark, sf_dir), dialect)


def _records(spark: SparkSession, sf_dir: str, dialect: str = "clf") -> DataFrame:
    return valid_records(_parsed(spark, sf_dir, dialect))


# Parsing


def parse_clf(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.select("event_id", *schema.RECORD_FIELDS, F.unix_seconds("event_time").alias("event_epoch"))


def parse_clf_loose(spark, sf_dir):
    return _records(spark, sf_dir, "loose").select("event_id", *schema.RECORD_FIELDS)


def parse_path_prefix(spark, sf_dir):
    return _records(spark, sf_dir, "prefix").select("event_id", "resource_path")


def request_split(spark, sf_dir):
    requests = derived.event_requests(_events(spark, sf_dir))
    method, path, protocol = request_parts(F.col("request"))
    return requests.select(
        "event_id",
        method.alias("http_method"),
        path.alias("resource_path"),
        protocol.alias("protocol_version"),
    )


def malformed(spark, sf_dir):
    return malformed_lines(_parsed(spark, sf_dir)).select("event_id", "value", "malformed_reason")


def error_tag(spark, sf_dir):
    return reports.with_error_tag(_records(spark, sf_dir)).select("event_id", "status_code", "is_error")


# Counts and batches


def record_counts(spark, sf_dir):
    return counts.record_counts(_parsed(spark, sf_dir))


def row_count(spark, sf_dir):
    return sql_reports.run_sql(spark, sql_reports.ROW_COUNT, _records(spark, sf_dir))


def union_batches(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("event_id", "batch_id", "value")
    first, second = (lines.filter(F.col("batch_id") == i).drop("batch_id") for i in (1, 2))
    return counts.row_count(text.union_batches(first, second).groupBy("batch_id"))


def batch_stats(spark, sf_dir):
    return counts.batch_counts(_parsed(spark, sf_dir))


def batch_size_summary(spark, sf_dir):
    return counts.batch_size_summary(batch_stats(spark, sf_dir))


def chunk_stats(spark, sf_dir):
    parsed = _parsed(spark, sf_dir).select("batch_id", "event_id", "malformed_reason")
    numbered = chunks.number_rows(parsed, scratch_path(spark, "numbered"), "batch_id", "event_id")
    return chunks.chunk_stats(numbered, 1000, scratch_path(spark, "blocks"), file="batch_id")


def _file_chunks(size):
    """Chunks of text files: 2000 consecutive events of a batch are a file, in order."""

    def query(spark, sf_dir):
        key = ["batch_id", "part"]
        lines = _lines(spark, sf_dir).withColumn("part", F.expr("event_id DIV 2000"))
        root = scratch_path(spark, "chunk-logs")
        lines.repartition(*key).sortWithinPartitions(*key, "event_id").select(*key, "value").write.partitionBy(*key).text(root)
        parsed = parse_lines(text.read_numbered_lines(spark, [root]))
        found = chunks.chunk_stats(parsed, size, scratch_path(spark, "blocks"))
        named = [F.regexp_extract("file_path", f"/{k}=([0-9]+)/", 1).cast(t).alias(k) for k, t in (("batch_id", "int"), ("part", "bigint"))]
        return found.select(*named, "chunk_id", "good_records", "malformed_records")

    return query


def _written_batches(spark, sf_dir):
    """The two batches as log files, in two folders."""
    root = scratch_path(spark, "logs")
    paths = []
    for i in (1, 2):
        batch = _lines(spark, sf_dir).filter(F.col("batch_id") == i).select("value")
        batch.write.text(f"{root}/batch{i}")
        paths.append(f"{root}/batch{i}")
    return paths


def file_batch_stats(spark, sf_dir):
    """The second path is given twice, in two spellings."""
    first, second = _written_batches(spark, sf_dir)
    other = second.removeprefix("file://") if second.startswith("file:///") else second + "/"
    return counts.batch_counts(parse_lines(text.read_lines(spark, [first, second, other])))


def empty_file_batches(spark, sf_dir):
    """A third path holds a file without lines."""
    empty = scratch_path(spark, "empty-log")
    spark.createDataFrame([], "value string").coalesce(1).write.text(empty)
    paths = [*_written_batches(spark, sf_dir), empty]
    return counts.batch_counts(parse_lines(text.read_lines(spark, paths)), len(paths))


def q2_latin1(spark, sf_dir):
    """The top list over files in ISO-8859-1; characters it lacks are written as question marks."""
    root = scratch_path(spark, "latin1")
    lines = _lines(spark, sf_dir).select("value")
    lines.write.option("encoding", "ISO-8859-1").text(root)
    return reports.top_resources(valid_records(parse_lines(text.read_lines(spark, [root], "ISO-8859-1"))))


# Reports


def q1_daily_traffic(spark, sf_dir):
    return reports.daily_traffic(_records(spark, sf_dir))


def q2_top_resources(spark, sf_dir):
    return reports.top_resources(_records(spark, sf_dir))


def q2_top_resources_two_pass(spark, sf_dir):
    records = tables.stored_records(spark, _store(spark, sf_dir))
    return reports.top_resources(records, hosts_after_top=True)


def q3_hourly_errors(spark, sf_dir):
    return reports.hourly_errors(_records(spark, sf_dir))


def q1_sql(spark, sf_dir):
    return sql_reports.run_sql(spark, sql_reports.Q1, _records(spark, sf_dir))


def q2_sql(spark, sf_dir):
    return sql_reports.run_sql(spark, sql_reports.Q2, _records(spark, sf_dir))


def q3_sql(spark, sf_dir):
    return sql_reports.run_sql(spark, sql_reports.Q3, _records(spark, sf_dir))


def q1_prefix(spark, sf_dir):
    return reports.daily_traffic(_records(spark, sf_dir, "prefix"))


def q2_prefix(spark, sf_dir):
    return reports.top_resources(_records(spark, sf_dir, "prefix"))


def q3_prefix(spark, sf_dir):
    return reports.hourly_errors(_records(spark, sf_dir, "prefix"))


def q1_loose(spark, sf_dir):
    return reports.daily_traffic(_records(spark, sf_dir, "loose"))


def q2_loose(spark, sf_dir):
    return reports.top_resources(reports.loose_resource_lines(_parsed(spark, sf_dir, "loose")))


def q3_loose(spark, sf_dir):
    return reports.hourly_errors(_records(spark, sf_dir, "loose"))


# Sinks and stores


def tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "records")
    tables.export_records(_records(spark, sf_dir), path)
    return tables.read_records(spark, path)


def _tsv_result(build, columns):
    def query(spark, sf_dir):
        path = scratch_path(spark, "tsv")
        tables.write_tsv(build(spark, sf_dir), path)
        return tables.read_tsv(spark, path, columns)

    return query


def _json_result(name, columns):
    def query(spark, sf_dir):
        path = scratch_path(spark, "json")
        tables.write_json(reports.selected_reports(_records(spark, sf_dir), name), path)
        return tables.read_json(spark, path, name, columns)

    return query


def _combined(spark, sf_dir):
    path = _store(spark, sf_dir)
    chosen = reports.selected_reports(tables.stored_records(spark, path), hosts_after_top=True)
    total = counts.batch_size_summary(counts.batch_counts(tables.read_store(spark, path)))
    total = total.select("total_records", "malformed_records", F.col("total_batches").alias("batch_count"))
    return combined.combined_json(chosen, total)


def combined_json_pieces(spark, sf_dir):
    """The document as it is written in pieces."""
    path, pieces = _store(spark, sf_dir), scratch_path(spark, "pieces")
    chosen = reports.selected_reports(tables.stored_records(spark, path), hosts_after_top=True)
    total = counts.batch_size_summary(counts.batch_counts(tables.read_store(spark, path)))
    total = total.select("total_records", "malformed_records", F.col("total_batches").alias("batch_count"))
    combined.write_combined(chosen, total, pieces)
    return combined.read_written(spark, pieces)


def combined_json_totals(spark, sf_dir):
    return combined.read_totals(_combined(spark, sf_dir))


def _combined_part(tag):
    return lambda spark, sf_dir: combined.read_combined(_combined(spark, sf_dir), tag)


def _store(spark, sf_dir):
    path = scratch_path(spark, "store")
    parsed = _parsed(spark, sf_dir).withColumn("file_path", F.lit("events")).drop("event_id")
    tables.write_store(parsed, path)
    return path


def parsed_store_q1(spark, sf_dir):
    return reports.daily_traffic(tables.stored_records(spark, _store(spark, sf_dir)))


def parsed_store_q2(spark, sf_dir):
    records = tables.stored_records(spark, _store(spark, sf_dir))
    return reports.top_resources(records, hosts_after_top=True)


def parsed_store_q3(spark, sf_dir):
    return reports.hourly_errors(tables.stored_records(spark, _store(spark, sf_dir)))


def parsed_store_batches(spark, sf_dir):
    return counts.batch_counts(tables.read_store(spark, _store(spark, sf_dir)))


# Lookups

SHOWN = ("host", "timestamp", "resource_path", "status_code", "bytes_transferred")


def _lookup(**wanted):
    """Single requests out of a clustered store."""

    def query(spark, sf_dir):
        path = scratch_path(spark, "clustered")
        parsed = _parsed(spark, sf_dir).withColumn("file_path", F.lit("events")).drop("event_id")
        tables.write_store(parsed, path, clustered=True)
        return lookups.find_requests(tables.stored_records(spark, path), **wanted).select(*SHOWN)

    return query


# Run tables


def _two_runs(spark, sf_dir, table, build):
    """One report stored for each batch as a run of its own."""
    stored = tables.RunTables(spark, scratch_path(spark, "runs"))
    records = _records(spark, sf_dir)
    for i in (1, 2):
        rows = build(records.filter(F.col("batch_id") == i))
        stored.append_results(table, rows, f"run-{i}", "Spark")
    return stored.read(table)


def _merged(table, build, merge):
    """A report over two runs, from what they stored alone."""
    return lambda spark, sf_dir: merge(_two_runs(spark, sf_dir, table, build))


def stored_q1_rollup(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "daily_traffic_summary", reports.daily_traffic)
    return history.stored_traffic(stored, "run-2")


def stored_top_resources(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "top_resources", reports.top_resources)
    return history.stored_top_resources(stored, "run-2")


def stored_hourly_errors(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "hourly_error_analysis", reports.hourly_errors)
    return history.stored_hourly_errors(stored, "run-2")


def report_traffic(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "daily_traffic_summary", reports.daily_traffic)
    return history.report_traffic(stored, "run-2")


def report_top_resources(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "top_resources", reports.top_resources)
    return history.report_top_resources(stored, "run-2")


def report_hourly_errors(spark, sf_dir):
    stored = _two_runs(spark, sf_dir, "hourly_error_analysis", reports.hourly_errors)
    return history.report_hourly_errors(stored, "run-2")


def _ordered_files(spark, sf_dir):
    """Log files of 2000 consecutive events of a batch each, in order, all below one path."""
    key = ["batch_id", "part"]
    lines = _lines(spark, sf_dir).withColumn("part", F.expr("event_id DIV 2000"))
    root = scratch_path(spark, "ordered-logs")
    lines.repartition(*key).sortWithinPartitions(*key, "event_id").select(*key, "value").write.partitionBy(*key).text(root)
    return root


def run_line_batches(spark, sf_dir):
    """Batches of 1000 consecutive lines of the files of a run."""
    root = scratch_path(spark, "etl")
    paths = [_ordered_files(spark, sf_dir)]
    run_id = etl.run(spark, paths, f"{root}/store", f"{root}/tables", "query1", batch_size=1000, batch_by="lines")
    return history.run_report(tables.RunTables(spark, f"{root}/tables"), run_id)["batches"]


def _etl_run(spark, sf_dir, query="all"):
    root = scratch_path(spark, "etl")
    run_id = etl.run(spark, _written_batches(spark, sf_dir), f"{root}/store", f"{root}/tables", query)
    return tables.RunTables(spark, f"{root}/tables"), run_id


def run_record(spark, sf_dir):
    stored, run_id = _etl_run(spark, sf_dir)
    columns = ["pipeline_name", "batch_size", "total_batches", "total_records"]
    columns += ["malformed_records", "avg_batch_size", "query_name"]
    return history.run_report(stored, run_id)["metadata"].select(*columns)


def run_batches(spark, sf_dir):
    stored, run_id = _etl_run(spark, sf_dir, "query1")
    return history.run_report(stored, run_id)["batches"]


def run_malformed_summary(spark, sf_dir):
    stored, run_id = _etl_run(spark, sf_dir, "query1")
    summary = history.malformed_summary(stored.read("batch_metadata", run_id))
    return summary.select("pipeline_name", "batch_id", "malformed_record_count")


def run_query_result(spark, sf_dir):
    stored, run_id = _etl_run(spark, sf_dir, "query3")
    answered = stored.read("query_results", run_id).select("run_id", "query_id", "query_name", "result_json")
    rows = stored.read("hourly_error_analysis", run_id).groupBy("run_id").agg(F.count("*").alias("stored_rows"))
    return answered.join(rows, "run_id").drop("run_id")


def latest_run(spark, sf_dir):
    return history.latest_run(derived.order_runs(_orders(spark, sf_dir)))


def run_history(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return history.run_history(derived.order_runs(orders), derived.order_results(orders))


def monthly_history(spark, sf_dir):
    """The history from run tables in buckets by month, of which the newest is read."""
    stored = MonthlyRunTables(spark, scratch_path(spark, "months"))
    orders = _orders(spark, sf_dir)
    runs = derived.order_runs(orders)
    answers = derived.order_results(orders).join(runs.select("run_id", "created_at"), "run_id")
    for table, rows in (("execution_metadata", runs), ("query_results", answers)):
        absent = {f.name: F.lit(None) for f in schema.TABLES[table].fields if f.name not in rows.columns}
        stored.load(table, rows.withColumns(absent), F.col("created_at"))
    return stored.newest()


def run_comparison(spark, sf_dir):
    return history.compare_runs(derived.order_runs(_orders(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Hourly error analysis over raw log lines."""
    return q3_hourly_errors(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q2_stored = schema.T.StructType([f for f in schema.Q2_RESULT.fields if f.name != "rank"])
    found = {
        "parse_clf": parse_clf,
        "parse_clf_loose": parse_clf_loose,
        "parse_path_prefix": parse_path_prefix,
        "request_split": request_split,
        "malformed_lines": malformed,
        "error_tag": error_tag,
        "record_counts": record_counts,
        "row_count": row_count,
        "union_batches": union_batches,
        "batch_stats": batch_stats,
        "batch_size_summary": batch_size_summary,
        "chunk_stats": chunk_stats,
        "file_batch_stats": file_batch_stats,
        "empty_file_batches": empty_file_batches,
        "file_chunk_stats": _file_chunks(300),
        "file_chunk_stats_single": _file_chunks(1),
        "q1_daily_traffic": q1_daily_traffic,
        "q2_top_resources": q2_top_resources,
        "q2_top_resources_two_pass": q2_top_resources_two_pass,
        "q3_hourly_errors": q3_hourly_errors,
        "q1_sql": q1_sql,
        "q2_sql": q2_sql,
        "q3_sql": q3_sql,
        "q1_prefix": q1_prefix,
        "q2_prefix": q2_prefix,
        "q3_prefix": q3_prefix,
        "q2_latin1": q2_latin1,
        "q1_loose": q1_loose,
        "q2_loose": q2_loose,
        "q3_loose": q3_loose,
        "tsv_roundtrip": tsv_roundtrip,
        "tsv_roundtrip_q1": _tsv_result(q1_daily_traffic, schema.Q1_RESULT),
        "tsv_roundtrip_q2": _tsv_result(lambda s, d: q2_top_resources(s, d).drop("rank"), q2_stored),
        "tsv_roundtrip_q3": _tsv_result(q3_hourly_errors, schema.Q3_RESULT),
        "tsv_roundtrip_counts": _tsv_result(record_counts, schema.COUNTS_RESULT),
        "json_roundtrip_q1": _json_result("query1", schema.Q1_RESULT),
        "json_roundtrip_q2": _json_result("query2", schema.Q2_RESULT),
        "json_roundtrip_q3": _json_result("query3", schema.Q3_RESULT),
        "combined_json": _combined,
        "combined_json_pieces": combined_json_pieces,
        "combined_json_totals": combined_json_totals,
        "combined_json_q1": _combined_part("q1"),
        "combined_json_q2": _combined_part("q2"),
        "combined_json_q3": _combined_part("q3"),
        "parsed_store_q1": parsed_store_q1,
        "parsed_store_q2": parsed_store_q2,
        "parsed_store_q3": parsed_store_q3,
        "parsed_store_batches": parsed_store_batches,
        "lookup_host": _lookup(hosts="h7.example.com"),
        "lookup_path": _lookup(paths=["/big", "/é/日"], hours=[0, 1, 2, 3, 4, 5]),
        "lookup_status": _lookup(statuses=500, dates=("2024-01-05", "2024-01-12")),
        "merged_q1": _merged("daily_traffic_summary", reports.daily_traffic, host_sets.merged_traffic),
        "merged_q2": _merged("resource_host_state", host_sets.resource_hosts, host_sets.merged_top_resources),
        "merged_q3": _merged("hour_host_state", host_sets.hour_hosts, host_sets.merged_hourly_errors),
        "merged_hosts": _merged("hour_host_state", host_sets.hour_hosts, lambda state: host_sets.merged_hosts(state, "log_date")),
        "stored_q1_rollup": stored_q1_rollup,
        "stored_top_resources": stored_top_resources,
        "stored_hourly_errors": stored_hourly_errors,
        "report_traffic": report_traffic,
        "report_top_resources": report_top_resources,
        "report_hourly_errors": report_hourly_errors,
        "run_record": run_record,
        "run_batches": run_batches,
        "run_line_batches": run_line_batches,
        "run_malformed_summary": run_malformed_summary,
        "run_query_result": run_query_result,
        "latest_run": latest_run,
        "run_history": run_history,
        "monthly_history": monthly_history,
        "run_comparison": run_comparison,
    }
    if corpus:
        found |= {**corpus.queries(), "pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if corpus:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
