"""Python workers that can import this library."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Put this library's place on the workers' path, which an installed library does not need."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in known:
        environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, known)])
    return spark


def released(function: Callable) -> Callable:
    """A function of batches that gives memory it has freed back to the system when its task ends.

    Workers serve one task after the other; without this each keeps the most that any of them took.
    """

    def over(batches):
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # other C libraries have no such function
                pass

    return over
