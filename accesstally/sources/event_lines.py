"""Access-log lines and run logs derived from the given tables.

None of the given tables is an access log. Every row of ``events`` becomes one
log line by fixed rules, a share of them malformed in each way a line can be;
every row of ``orders`` becomes one entry of a run log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


_REQUEST = """
    CASE WHEN event_id % 109 = 0 THEN ''
         WHEN event_id % 149 = 0 THEN 'GET /big HTTP/1.0'
         WHEN event_id % 193 = 0 THEN 'GET /é/日 HTTP/1.0'
         WHEN event_id % 197 = 0 THEN concat('GET', char(160), '/nb HTTP/1.0')
         WHEN event_id % 199 = 0 THEN concat('GET', char(28), '/fs HTTP/1.0')
         WHEN event_id % 211 = 0 THEN concat('GET', char(9), '/tab  HTTP/1.0 ')
         WHEN event_id % 113 = 0 THEN 'GET /a b HTTP/1.0'
         WHEN event_id % 139 = 0 THEN concat('GET /', event_type)
         ELSE concat('GET /', event_type, '/', event_id % 37, ' HTTP/1.0') END"""

_STAMP = """
    CASE WHEN event_id % 127 = 0 THEN replace(stamp, 'Jan', 'Foo')
         WHEN event_id % 131 = 0 THEN concat('31/Feb/', substring(stamp, 8))
         WHEN event_id % 173 = 0 THEN date_format(ts, 'd/MMM/yyyy:H:m:s')
         WHEN event_id % 179 = 0 THEN lower(stamp)
         ELSE stamp END"""

_ZONE = """
    CASE WHEN event_id % 157 = 0 THEN 'Z'
         WHEN event_id % 163 = 0 THEN '+05:30'
         WHEN event_id % 167 = 0 THEN '-0000'
         ELSE '-0400' END"""

_STATUS = """
    CASE WHEN event_id % 103 = 0 THEN '-'
         WHEN event_type = 'error' THEN if(event_id % 3 = 0, '500', '404')
         WHEN event_type = 'click' THEN '304'
         WHEN event_type = 'signup' THEN '302'
         ELSE '200' END"""

_SIZE = """
    CASE WHEN event_id % 107 = 0 THEN 'abc'
         WHEN event_id % 149 = 0 THEN '9223372036854775807'
         WHEN event_id % 151 = 0 THEN '-7'
         WHEN event_type = 'click' THEN '-'
         ELSE cast(floor(value) AS string) END"""


def event_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr("event_id", f"{_REQUEST} AS request")


def event_lines(events: DataFrame) -> DataFrame:
    """One line per event: ``event_id``, ``batch_id`` (half of the month) and ``value``."""
    stamped = events.selectExpr("*", "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss') AS stamp")
    host = "concat(if(event_id % 191 = 0, 'hü', 'h'), user_id, '.example.com')"
    names = "if(event_id % 181 = 0, ' bob alice [', ' - - [')"
    line = f"""concat({host}, {names}, {_STAMP}, ' ', {_ZONE}, '] "', {_REQUEST}, '" ',
                      {_STATUS}, ' ', {_SIZE})"""
    return stamped.selectExpr(
        "event_id",
        "if(dayofmonth(ts) <= 15, 1, 2) AS batch_id",
        f"if(event_id % 101 = 0, 'alyssa.p', {line}) AS value",
    )


def order_runs(orders: DataFrame) -> DataFrame:
    """A run log with one run per order."""
    key = F.col("o_orderkey")
    return orders.select(
        F.concat(F.lit("r"), key.cast("string")).alias("run_id"),
        F.col("o_orderpriority").alias("pipeline_name"),
        F.lit(5000).alias("batch_size"),
        F.lit(2).alias("total_batches"),
        (key % 1000).alias("total_records"),
        (key % 7).alias("malformed_records"),
        ((key % 1000) / 2).alias("avg_batch_size"),
        F.floor("o_totalprice").alias("execution_time_ms"),
        F.col("o_orderdate").alias("created_at"),
    )


def order_results(orders: DataFrame) -> DataFrame:
    """Answered queries of two thirds of those runs."""
    names = F.array(*[F.lit(n) for n in ("all", "query1", "query2", "query3")])
    return orders.filter(F.col("o_orderkey") % 3 != 0).select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("run_id"),
        names[(F.col("o_orderkey") % 4).cast("int")].alias("query_name"),
    )
