"""Exact sets of hosts that merge across batches and runs without the log.

A state has one row for each key and host, with what the reports add up. States of any number of batches
or runs are stacked and aggregated again: counts and bytes are sums, and a host that several of them saw
under one key counts once. A state has as many rows as a report's own first shuffle, (key, host) pairs,
and merging shuffles those pairs and nothing else, so a key that most of the log falls under is spread
over its hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from accesstally.operators.reports import ERROR_MAX, ERROR_MIN, TOP_N, error_rate, is_error, ranked, total_bytes


def resource_hosts(records: DataFrame) -> DataFrame:
    """Requests and bytes per path and host."""
    known = records.filter(F.col("resource_path").isNotNull())
    return known.groupBy("resource_path", "host").agg(F.count("*").alias("request_count"), total_bytes())


def hour_hosts(records: DataFrame, low: int = ERROR_MIN, high: int = ERROR_MAX) -> DataFrame:
    """Requests and errors per date, hour and host."""
    error = is_error(F.col("status_code"), low, high)
    counts = [F.count_if(error).alias("error_request_count"), F.count("*").alias("total_request_count")]
    return records.groupBy("log_date", "log_hour", "host").agg(*counts)


def merged_traffic(results: DataFrame) -> DataFrame:
    """Daily traffic over all runs whose results are given."""
    sums = [F.sum(c).cast(t).alias(c) for c, t in (("request_count", "long"), ("total_bytes", "decimal(30,0)"))]
    return results.groupBy("log_date", "status_code").agg(*sums).orderBy("log_date", "status_code")


def merged_top_resources(state: DataFrame, n: int = TOP_N) -> DataFrame:
    """The top list over all runs whose states are given."""
    top = state.groupBy("resource_path").agg(
        F.sum("request_count").alias("request_count"),
        F.sum("total_bytes").cast("decimal(30,0)").alias("total_bytes"),
        F.countDistinct("host").alias("distinct_host_count"),
    )
    return ranked(top.orderBy(F.desc("request_count"), "resource_path").limit(n))


def merged_hourly_errors(state: DataFrame) -> DataFrame:
    """Hourly errors over all runs whose states are given."""
    seen = F.when(F.col("error_request_count") > 0, F.col("host"))
    merged = state.groupBy("log_date", "log_hour").agg(
        F.sum("error_request_count").alias("error_request_count"),
        F.sum("total_request_count").alias("total_request_count"),
        F.countDistinct(seen).alias("distinct_error_hosts"),
    )
    rate = error_rate("error_request_count", "total_request_count").alias("error_rate")
    columns = ["log_date", "log_hour", "error_request_count", "total_request_count", rate, "distinct_error_hosts"]
    return merged.select(*columns).orderBy("log_date", "log_hour")


def merged_hosts(state: DataFrame, *keys: str) -> DataFrame:
    """Exact distinct hosts per ``keys`` (of all, without any) over all states given."""
    return state.groupBy(*keys).agg(F.countDistinct("host").alias("distinct_hosts"))
