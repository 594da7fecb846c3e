"""Statistics over chunks of N consecutive input lines of one file.

Lines are numbered without a window over lines and without shuffling them. A
scan hands out increasing sequence numbers that are consecutive inside a split,
so each task folds its lines into blocks (count, first number, numbers of the
malformed lines). Only blocks are shuffled; a running sum over splits places
them in their file, and a block is then cut at the chunk borders it crosses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from accesstally.sources.scratch import written

# Lines folded into one block; also bounds the list of malformed line numbers.
BLOCK_LINES = 32768
# Rows of chunk pieces that one task cuts and counts at most.
ROWS_PER_TASK = 1_000_000


def number_rows(rows: DataFrame, path: str, file: str, *order: str) -> DataFrame:
    """Sequence columns for rows that are no text file but have an order of their own.

    A range sort plays the part of the file: its partitions are the splits. Where
    it cuts may change from one execution to the next, so the numbered rows are
    written to ``path`` once and everyone reads the same numbers.
    """
    numbered = (
        rows.orderBy(file, *order)
        .withColumn("line_seq", F.monotonically_increasing_id())
        .withColumn("split_start", F.shiftright("line_seq", 33))
    )
    return written(numbered, path)


def chunk_stats(
    parsed: DataFrame,
    chunk_size: int,
    path: str,
    file: str = "file_path",
    split: str = "split_start",
    seq: str = "line_seq",
) -> DataFrame:
    """Good and malformed lines per (file, chunk); chunks count from 1, the last may be short.

    Blocks are written to ``path``: they are needed twice, and so the log is read once.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    bad = F.col("malformed_reason").isNotNull()
    blocks = (
        parsed.groupBy(file, split, F.expr(f"{seq} DIV {BLOCK_LINES}").alias("block"))
        .agg(
            F.count("*").alias("lines"),
            F.min(seq).alias("first_seq"),
            F.collect_list(F.when(bad, F.col(seq))).alias("bad_seqs"),
        )
    )
    blocks = written(blocks, path)
    # a chunk piece for each chunk a block touches and one for each malformed line; they are dealt over tasks by
    # number, which adaptive execution keeps, as the few block rows would otherwise fill one task with all of them
    pieces = blocks.agg(F.sum(F.col("lines") / chunk_size + 2 + F.size("bad_seqs"))).first()[0] or 0
    tasks = max(1, -(-int(pieces) // ROWS_PER_TASK))
    before = Window.partitionBy(file).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy(file, split)
        .agg(F.sum("lines").alias("split_lines"), F.min("first_seq").alias("split_seq"))
        .select(
            file,
            split,
            (F.coalesce(F.sum("split_lines").over(before), F.lit(0)) - F.col("split_seq")).alias("shift"),
        )
    )
    start = F.col("first_seq") + F.col("shift")
    placed = blocks.join(offsets, [file, split]).select(
        file,
        start.alias("start"),
        (start + F.col("lines")).alias("stop"),
        F.transform("bad_seqs", lambda s: s + F.col("shift")).alias("bad_lines"),
    )
    return _cut(placed, file, chunk_size, tasks)


def _cut(placed: DataFrame, file: str, size: int, tasks: int = 1) -> DataFrame:
    """Lines of a block by chunk from its borders, malformed ones each by its own number, over ``tasks`` tasks."""

    spans = F.transform(
        F.expr(f"sequence(start DIV {size}, (stop - 1) DIV {size})"),
        lambda c: F.struct(
            c.alias("chunk"),
            (F.least("stop", (c + 1) * size) - F.greatest("start", c * size)).alias("lines"),
            F.lit(0).cast("bigint").alias("bad"),
        ),
    )
    bad = F.expr(f"transform(bad_lines, n -> named_struct('chunk', n DIV {size}, 'lines', 0L, 'bad', 1L))")
    return (
        placed.repartition(tasks, file, "start")
        .select(file, F.inline(F.concat(spans, bad)))
        .select(file, (F.col("chunk") + 1).alias("chunk_id"), "lines", "bad")
        .repartition(tasks, file, "chunk_id")
        .groupBy(file, "chunk_id")
        .agg(
            (F.sum("lines") - F.sum("bad")).alias("good_records"),
            F.sum("bad").alias("malformed_records"),
        )
    )


def numbered_chunks(chunks: DataFrame, files: DataFrame, file: str = "file_path") -> DataFrame:
    """Chunks numbered through all files, from 1: ``batch_id``, good and malformed lines.

    ``files`` has ``file`` and the ``batch_id`` of its path, in whose order the files come, and by name
    within a path. A running sum over files, a row for each, says how many chunks stand before.
    """
    counted = chunks.groupBy(file).agg(F.max("chunk_id").alias("chunks")).join(files, file)
    before = Window.orderBy("batch_id", file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(file, F.coalesce(F.sum("chunks").over(before), F.lit(0)).alias("earlier"))
    number = (F.col("earlier") + F.col("chunk_id")).alias("batch_id")
    return chunks.join(offsets, file).select(number, "good_records", "malformed_records")
