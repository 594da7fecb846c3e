"""The reports as SQL text over a temporary view of parsed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accesstally.operators.reports import ERROR_MAX, ERROR_MIN, TOP_N, exact_sum

_BYTES = exact_sum("bytes_transferred")

Q1 = f"""
SELECT log_date, status_code, count(*) AS request_count, {_BYTES} AS total_bytes
FROM {{records}}
GROUP BY log_date, status_code
ORDER BY log_date, status_code
"""

Q2 = f"""
SELECT resource_path, count(*) AS request_count, {_BYTES} AS total_bytes,
       count(DISTINCT host) AS distinct_host_count
FROM {{records}}
WHERE resource_path IS NOT NULL
GROUP BY resource_path
ORDER BY request_count DESC, resource_path
LIMIT {TOP_N}
"""

# The rate stays unrounded here. A distinct count over a condition, not a filter
# clause: that one doubles every row before it is aggregated.
Q3 = f"""
SELECT log_date, log_hour,
       count_if(status_code BETWEEN {ERROR_MIN} AND {ERROR_MAX}) AS error_request_count,
       count(*) AS total_request_count,
       count_if(status_code BETWEEN {ERROR_MIN} AND {ERROR_MAX}) / count(*) AS error_rate,
       count(DISTINCT CASE WHEN status_code BETWEEN {ERROR_MIN} AND {ERROR_MAX} THEN host END)
           AS distinct_error_hosts
FROM {{records}}
WHERE log_date IS NOT NULL AND log_hour IS NOT NULL
GROUP BY log_date, log_hour
ORDER BY log_date, log_hour
"""

ROW_COUNT = "SELECT count(*) AS row_count FROM {records}"


def run_sql(spark: SparkSession, text: str, records: DataFrame) -> DataFrame:
    """Run a report text; ``{records}`` stands for the given relation."""
    return spark.sql(text, records=records)
