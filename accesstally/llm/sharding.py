"""Balanced contiguous shards by global prefix sums of sizes.

Rows are sorted by range. The sizes of all partitions, one total each, are summed up in order, so every
partition knows how many bytes lie before it. Shard ``k`` of ``n`` starts at the row boundary nearest to
``k / n`` of all bytes. Only the partitions that hold such a target are looked into row by row, at most
one for each cut; all other rows learn their shard from their partition's offsets, in a map-side join.
A cut is at most half a row's size away from its target, however sizes and numbers are distributed.

The sort is the one shuffle of rows. ``sharded`` takes any columns: with digests only, as the query does,
no text is moved; ``write_shards`` moves the texts once and writes files by shard. What is broadcast has
a row for each partition of the sort; the cuts, one number for each shard, pass through the driver.

Cases: a null text counts one byte, as an empty one does. Null numbers come first; rows with equal keys
stand in the order of their scan. One row larger than a shard leaves shards beside it empty. An empty
table has no shards. Columns named ``shard`` or ``slot`` are replaced, all others pass, whatever their
names. All sizes together may reach 2**62 divided by the number of shards; beyond that Spark raises an
overflow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesstally.llm.ordered import in_order, offsets
from accesstally.sources.scratch import scratch_path, written

SHARDS = 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def cuts(ordered: DataFrame, parts: DataFrame, shards: int) -> list[int]:
    """The position of the first row of each shard but the first; empty shards start where the next one does."""
    unit = 2 * shards  # targets and middles of rows are whole numbers in units of 1 / unit bytes
    target_of = lambda k: k * F.col("all_size") * 2
    begin, end = F.col("size_before") * unit, (F.col("size_before") + F.col("part_size")) * unit
    inside = F.filter(F.sequence(F.lit(1), F.lit(shards - 1)), lambda k: (begin <= target_of(k)) & (target_of(k) < end))
    targets = parts.select("part", "rows_before", "size_before", F.transform(inside, target_of).alias("targets")).filter("size(targets) > 0")

    near = ordered.select("part", "place", "size").join(F.broadcast(targets), "part")
    running = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    row_begin = (F.col("size_before") + F.coalesce(F.sum("size").over(running), F.lit(0))) * unit
    near = near.select("part", "place", "rows_before", "targets", row_begin.alias("begin"), (F.col("size") * shards).alias("half"))
    covered = F.filter("targets", lambda t: (F.col("begin") <= t) & (t < F.col("begin") + F.col("half") * 2))
    found = near.select("place", "rows_before", "begin", "half", F.explode(covered).alias("target"))
    # the row over a target starts the shard if its middle is not before the target, else the next row does
    late = (F.col("begin") + F.col("half") < F.col("target")).cast("long")
    return sorted(r["start"] for r in found.select((F.col("rows_before") + F.col("place") + late).alias("start")).collect())


def sharded(rows: DataFrame, size: Column, order: Sequence[Column], shards: int = SHARDS) -> DataFrame:
    """All rows with ``shard`` (from 0) and ``slot`` (from 0 in each shard, in order)."""
    if shards < 1:
        raise ValueError("there is at least one shard")
    spark = rows.sparkSession
    ordered = in_order(rows, order, size)
    parts = written(offsets(ordered), scratch_path(spark, "offsets"))
    starts = cuts(ordered, parts, shards) if shards > 1 else []
    known = F.array(*[F.lit(s).cast("long") for s in starts]) if starts else F.array().cast("array<bigint>")
    # a partition knows the shard that it begins in, where that one starts, and the shards that start inside it
    first = F.size(F.filter(known, lambda s: s <= F.col("rows_before")))
    inner = F.filter(known, lambda s: (s > F.col("rows_before")) & (s < F.col("rows_before") + F.col("part_rows")))
    begun = F.when(first > 0, F.get(known, first - 1)).otherwise(F.lit(0).cast("long"))
    places = parts.select("part", "rows_before", first.alias("first"), F.concat(F.array(begun), inner).alias("starts"))

    position = F.col("rows_before") + F.col("place")
    passed = F.size(F.filter("starts", lambda s: s <= position)) - 1
    placed = ordered.join(F.broadcast(places), "part").select(
        "own", (F.col("first") + passed).cast("int").alias("shard"), (position - F.get("starts", passed)).alias("slot")
    )
    kept = [F.col(f"own.`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*kept, "shard", "slot")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> None:
    """All documents as Parquet by shard, in order of their numbers, with balanced bytes of text.

    A task writes consecutive rows, so it has a file for each shard that it reaches into.
    """
    placed = sharded(documents, text_size(F.col(text)), [F.col(doc_id), F.col(text)], shards)
    placed.write.partitionBy("shard").parquet(path)


def op11_sharding(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = documents.select("doc_id", text_size(F.col("text")).alias("size"), digest.alias("text_crc32"))
    placed = sharded(rows, F.col("size"), [F.col("doc_id"), F.col("size"), F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The bytes' checksum in SQL: a table of 256 remainders by its rule, then one step for each byte.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; column ``t`` holds the table."""
    each = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    steps = f"list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


OP11_SQL = f"""
WITH k AS ({CRC_TABLE}),
d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc_sql("coalesce(text, '')")} AS text_crc32 FROM documents, k),
o AS (SELECT *, row_number() OVER w AS position,
        sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS earlier, sum(size) OVER () AS total
      FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)),
s AS (SELECT *, (({SHARDS} * (2 * earlier + size)) // (2 * total))::INT AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY position) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""
