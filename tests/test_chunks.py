"""Chunk statistics against line-by-line counting."""

import gzip
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from accesstally.functions.clf import parse_lines
from accesstally.operators import chunks
from accesstally.sources.text import read_numbered_lines

GOOD = 'h - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 10'


def brute(flags, size):
    found = defaultdict(lambda: [0, 0])
    for i, good in enumerate(flags):
        found[i // size + 1][0 if good else 1] += 1
    return {k: tuple(v) for k, v in found.items()}


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("block", [7, 32768])
@pytest.mark.parametrize("size", [1, 10, 64, 1000])
def test_text_files(spark, tmp_path, small_splits, exchange_reuse, monkeypatch, size, block):
    monkeypatch.setattr(chunks, "BLOCK_LINES", block)
    rng = random.Random(size)
    want = {}
    for name, count, share in [("a", 700, 0.1), ("b", 40, 0.9), ("c", 1, 0.0), ("d", 128, 1.0), ("e", 300, 0.0)]:
        flags = [rng.random() >= share for _ in range(count)]
        texts = [GOOD + " " * rng.randrange(30) if good else "x" * rng.randrange(90) for good in flags]
        ending = "\r\n" if name == "b" else "\n"
        (tmp_path / name).write_bytes((ending.join(texts) + (ending if name != "a" else "")).encode())
        if name == "a" and texts[-1] == "":
            flags.pop()
        want[name] = brute(flags, size)
    lines = read_numbered_lines(spark, [str(tmp_path / n) for n in want])
    got = defaultdict(dict)
    for row in chunks.chunk_stats(parse_lines(lines), size, str(tmp_path / "blocks")).collect():
        got[row.file_path.rsplit("/", 1)[1]][row.chunk_id] = (row.good_records, row.malformed_records)
    assert dict(got) == want


@pytest.fixture(params=["true", "false"])
def exchange_reuse(spark, request):
    """Numbers must agree even where Spark does not share the shuffle of blocks."""
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield
    spark.conf.set("spark.sql.exchange.reuse", "true")


@pytest.mark.parametrize("size", [3, 100])
def test_ordered_rows(spark, tmp_path, exchange_reuse, size):
    rng = random.Random(size)
    rows = [("hot" if i % 3 else f"f{i % 5}", i, rng.random() > 0.2) for i in range(2000)]
    want = {f: brute([g for name, _, g in rows if name == f], size) for f in {r[0] for r in rows}}
    frame = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "f string, i long, good boolean")
    numbered = chunks.number_rows(frame.repartition(9), str(tmp_path / "numbered"), "f", "i").withColumn(
        "malformed_reason", F.when(~F.col("good"), "no_match")
    )
    got = defaultdict(dict)
    for row in chunks.chunk_stats(numbered, size, str(tmp_path / "blocks"), file="f").collect():
        got[row.f][row.chunk_id] = (row.good_records, row.malformed_records)
    assert dict(got) == want


def test_compressed_file_is_spread_and_keeps_its_order(spark, tmp_path):
    flags = [i % 7 != 0 and i > 50 for i in range(500)]
    with gzip.open(tmp_path / "a.gz", "wt") as out:
        out.writelines((GOOD if good else "x") + "\n" for good in flags)
    (tmp_path / "logs").mkdir()
    for i in range(20):
        (tmp_path / "logs" / f"{i}.log").write_text(GOOD + "\n")
    lines = read_numbered_lines(spark, [str(tmp_path / "logs"), str(tmp_path / "a.gz")])
    # the compressed file is dealt out evenly however many others there are
    tasks = lines.filter("file_path like '%gz'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == spark.sparkContext.defaultParallelism and max(r["count"] for r in tasks) < 100
    lines = lines.filter("batch_id = 2")
    got = {
        r.chunk_id: (r.good_records, r.malformed_records)
        for r in chunks.chunk_stats(parse_lines(lines), 60, str(tmp_path / "blocks")).collect()
    }
    assert got == brute(flags, 60)


def test_log_is_read_once(spark, tmp_path):
    (tmp_path / "a").write_text((GOOD + "\n") * 10)
    lines = parse_lines(read_numbered_lines(spark, [str(tmp_path / "a")]))
    frame = chunks.chunk_stats(lines, 4, str(tmp_path / "blocks"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "blocks" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert frame.agg(F.sum("good_records")).first()[0] == 10


def test_many_malformed_lines_in_small_chunks(spark, tmp_path):
    flags = [i % 2 == 0 for i in range(40_000)]
    (tmp_path / "a").write_text("".join((GOOD if good else "x") + "\n" for good in flags))
    lines = parse_lines(read_numbered_lines(spark, [str(tmp_path / "a")]))
    took = {}
    for size in (1000, 1):
        began = time.monotonic()
        found = chunks.chunk_stats(lines, size, str(tmp_path / f"blocks{size}"))
        totals = found.agg(F.sum("good_records"), F.sum("malformed_records"), F.count("*")).first()
        took[size] = time.monotonic() - began
        assert tuple(totals) == (20_000, 20_000, 40_000 // size)
    assert took[1] < 10 * took[1000] + 5


def test_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        chunks.chunk_stats(spark.range(1), 0, "unused")


def test_small_chunks_are_spread_over_tasks_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunks, "ROWS_PER_TASK", 1000)
    flags = [i % 3 != 0 for i in range(5000)]
    (tmp_path / "a").write_text("".join((GOOD if good else "x") + "\n" for good in flags))
    lines = parse_lines(read_numbered_lines(spark, [str(tmp_path / "a")]))
    found = chunks.chunk_stats(lines, 1, str(tmp_path / "blocks"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # one row of blocks must not make one task cut and count every line; adaptive execution keeps a count by number
    assert plan.count("REPARTITION_BY_NUM") == 2 and "hashpartitioning(file_path#" in plan
    assert found.rdd.getNumPartitions() >= 7
    got = {r.chunk_id: (r.good_records, r.malformed_records) for r in found.collect()}
    assert got == brute(flags, 1)
