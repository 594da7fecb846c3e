"""Lookups of single requests in the parsed store.

The filters are plain comparisons, so they reach the Parquet scan: dates pick folders, hours and statuses
are compared with the ranges of row groups and pages, hosts and paths with their dictionaries and bloom
filters. A store written with ``clustered`` has like rows side by side, which is what makes them skip.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _among(column: str, wanted) -> Column:
    values = [wanted] if isinstance(wanted, str) or not isinstance(wanted, Iterable) else list(wanted)
    return F.col(column).isin(values) if len(values) != 1 else F.col(column) == F.lit(values[0])


def find_requests(records: DataFrame, *, hosts=None, paths=None, statuses=None, hours=None, dates=None) -> DataFrame:
    """The records that have one of the given values in every column that is asked for.

    Each argument is a value or several; ``dates`` is a first and a last day.
    """
    asked = {"host": hosts, "resource_path": paths, "status_code": statuses, "log_hour": hours}
    for column, wanted in asked.items():
        if wanted is not None:
            records = records.filter(_among(column, wanted))
    if dates is not None:
        records = records.filter(F.col("log_date").between(*[F.lit(d).cast("date") for d in dates]))
    return records
