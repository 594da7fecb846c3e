"""The three reports over valid records.

Every report keeps one distinct count, so the plan shuffles on (key, host) with
map-side combine and only then on the key: a key that holds a large share of the
log is spread over its hosts and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Inclusive bounds of an error status, length of the top list.
ERROR_MIN, ERROR_MAX = 400, 599
TOP_N = 20

# Rows of a list at most; such lists are broadcast.
MAX_SHOWN = 10_000

QUERY_IDS = {"all": 0, "query1": 1, "query2": 2, "query3": 3}


def is_error(status: Column, low: int = ERROR_MIN, high: int = ERROR_MAX) -> Column:
    return status.between(low, high)


def with_error_tag(records: DataFrame, low: int = ERROR_MIN, high: int = ERROR_MAX) -> DataFrame:
    return records.withColumn("is_error", is_error(F.col("status_code"), low, high).cast("int"))


# Bits of a limb. Sums of limbs stay in 64 bits for 2**41 lines of a group.
LIMB_BITS = 22


def exact_sum(value: str, kind: str = "decimal(30,0)") -> str:
    """SQL of the exact sum of a 64-bit column, which may not fit 64 bits itself.

    The column is cut into three limbs of ``LIMB_BITS`` bits, the highest with the sign. Tasks add limbs
    as integers; only the sums of a whole group become a decimal.
    """
    mask = (1 << LIMB_BITS) - 1
    limbs = [f"{value} & {mask}L", f"shiftright({value}, {LIMB_BITS}) & {mask}L", f"shiftright({value}, {2 * LIMB_BITS})"]
    weighed = [f"cast(sum({limb}) AS decimal(20,0)) * {1 << (i * LIMB_BITS)}BD" for i, limb in enumerate(limbs)]
    return f"cast({' + '.join(weighed)} AS {kind})"


def total_bytes() -> Column:
    """Bytes summed exactly: one line can carry the largest integer."""
    return F.expr(exact_sum("bytes_transferred")).alias("total_bytes")


def daily_traffic(records: DataFrame) -> DataFrame:
    """Requests and bytes per date and status."""
    return (
        records.groupBy("log_date", "status_code")
        .agg(
            F.count("*").alias("request_count"),
            total_bytes(),
        )
        .orderBy("log_date", "status_code")
    )


def ranked(top: DataFrame) -> DataFrame:
    """Positions 1..N of an already limited list; equal counts keep distinct ranks."""
    order = Window.orderBy(F.desc("request_count"), "resource_path")
    return top.withColumn("rank", F.row_number().over(order))


def top_resources(records: DataFrame, n: int = TOP_N, hosts_after_top: bool = False) -> DataFrame:
    """The ``n`` most requested paths with bytes and exact distinct hosts.

    Ties are broken by path. With ``hosts_after_top`` the list is settled first
    and hosts are counted for its ``n`` paths only: the records are read twice,
    and (path, host) pairs of all other paths are never shuffled. That pays on a
    columnar store of parsed records; from raw text the single pass does.
    """
    if not 0 < n <= MAX_SHOWN:
        raise ValueError(f"a top list has 1 to {MAX_SHOWN} rows")
    known = records.filter(F.col("resource_path").isNotNull())
    measures = [F.count("*").alias("request_count"), total_bytes()]
    hosts = F.countDistinct("host").alias("distinct_host_count")
    order = (F.desc("request_count"), F.col("resource_path"))

    if not hosts_after_top:
        top = known.groupBy("resource_path").agg(*measures, hosts).orderBy(*order).limit(n)
        return ranked(top)

    top = known.groupBy("resource_path").agg(*measures).orderBy(*order).limit(n)
    # The broadcast side has n rows whatever the log's size.
    listed = known.select("resource_path", "host").join(F.broadcast(top), "resource_path")
    return ranked(listed.groupBy("resource_path", "request_count", "total_bytes").agg(hosts))


def hourly_errors(records: DataFrame, low: int = ERROR_MIN, high: int = ERROR_MAX) -> DataFrame:
    """Errors, requests, error rate and distinct hosts with errors per date and hour."""
    error = is_error(F.col("status_code"), low, high)
    return (
        records.groupBy("log_date", "log_hour")
        .agg(
            F.count_if(error).alias("error_request_count"),
            F.count("*").alias("total_request_count"),
            F.countDistinct(F.when(error, F.col("host"))).alias("distinct_error_hosts"),
        )
        .select(
            "log_date",
            "log_hour",
            "error_request_count",
            "total_request_count",
            error_rate("error_request_count", "total_request_count").alias("error_rate"),
            "distinct_error_hosts",
        )
        .orderBy("log_date", "log_hour")
    )


def error_rate(errors: str, total: str) -> Column:
    return F.round(F.coalesce(F.try_divide(F.col(errors), F.col(total)), F.lit(0.0)), 4)


def selected_reports(records: DataFrame, query: str = "all", **options) -> dict[str, DataFrame]:
    """The chosen reports by name; what is not chosen is never planned."""
    if query not in QUERY_IDS:
        raise ValueError(f"invalid query name {query!r}, expected one of {sorted(QUERY_IDS)}")
    builders = {
        "query1": daily_traffic,
        "query2": lambda r: top_resources(r, **options),
        "query3": hourly_errors,
    }
    return {name: build(records) for name, build in builders.items() if query in (name, "all")}


def loose_resource_lines(parsed: DataFrame) -> DataFrame:
    """Input of the top list in the loose dialect, which does not look at the timestamp."""
    reason = F.col("malformed_reason")
    return parsed.filter(
        (reason.isNull() | (reason == "bad_timestamp")) & F.col("resource_path").isNotNull()
    )
