"""Positions of rows in a total order, without any task that sees them all.

Rows are sorted by range and written once, each with the number of its partition and its place there.
One row of totals for each partition then gives every partition its offset; that table has as many rows
as the sort has partitions, whatever the data's size, and it is what a prefix sum runs over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesstally.sources.scratch import scratch_path, written

#: Bits of a generated row number that hold the place inside a partition.
PLACE_BITS = 33


def in_order(rows: DataFrame, order: Sequence[Column], size: Column | None = None) -> DataFrame:
    """``part``, ``place`` and ``size`` of every row, and the row itself as the struct ``own``.

    Keys are expressions that rise, nulls first. Rows that ``order`` does not tell apart are in the order of their scan: a number taken there is the
    last key of the sort, so that a value which a third of all rows share is still cut into many ranges.
    """
    keys = {f"key{i}": k for i, k in enumerate(order)}
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("own"),
        (F.lit(1) if size is None else size).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("scanned"),
        *[k.alias(name) for name, k in keys.items()],
    )
    ordered = packed.orderBy(*keys, "scanned")
    place = F.monotonically_increasing_id()
    numbered = ordered.select("own", "size", F.shiftright(place, PLACE_BITS).alias("part"), (place % (1 << PLACE_BITS)).alias("place"))
    return written(numbered, scratch_path(rows.sparkSession, "in-order"))


def offsets(ordered: DataFrame) -> DataFrame:
    """For every partition its rows and size, those of all partitions before it, and those of all."""
    totals = ordered.groupBy("part").agg(F.count("*").alias("part_rows"), F.sum("size").alias("part_size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = {f"{name}_before": F.coalesce(F.sum(f"part_{name}").over(earlier), F.lit(0)) for name in ("rows", "size")}
    whole = {f"all_{name}": F.sum(f"part_{name}").over(every) for name in ("rows", "size")}
    return totals.withColumns(before | whole)
