"""Run tables in buckets by month, and the combined document in pieces."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from accesstally import schema
from accesstally.operators import history
from accesstally.plans import combined, etl
from accesstally.sources.run_months import MonthlyRunTables
from tests.test_sources import log_line


def shown(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture()
def many(spark, tmp_path):
    """10,000 runs over 20 months, loaded at once."""
    stored = MonthlyRunTables(spark, str(tmp_path / "tables"))
    created = F.to_timestamp(F.concat(F.lit("20"), F.lpad((F.col("id") % 20 + 5).cast("string"), 2, "0"), F.lit("-03-01 00:00:00"))) + F.make_interval(secs=F.col("id"))
    runs = spark.range(10_000).select(
        F.concat(F.lit("r"), "id").alias("run_id"), F.lit("Spark").alias("pipeline_name"), F.col("id").alias("total_records"), created.alias("created_at")
    )
    runs = runs.withColumns({f.name: F.lit(None) for f in schema.TABLES["execution_metadata"].fields if f.name not in runs.columns})
    stored.load("execution_metadata", runs, F.col("created_at"))
    return stored, runs


def test_newest_runs_come_from_the_newest_months(spark, many):
    stored, runs = many
    assert len(stored.months("execution_metadata")) == 20
    newest = stored.newest()
    want = history.run_history(runs, spark.createDataFrame([], schema.TABLES["query_results"]))
    assert shown(newest) == shown(want.select(newest.columns))
    assert {Path(f).parent.name for f in newest.inputFiles()} == {"month=2024-03"}
    over = stored.newest(1200)  # two months hold 500 each
    assert {Path(f).parent.name for f in over.inputFiles()} == {"month=2024-03", "month=2023-03", "month=2022-03"}


def test_a_repeated_append_changes_nothing(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join([log_line(), log_line(2, 3, "/b", 404), "broken"]))
    root = str(tmp_path / "tables")
    names = ("daily_traffic_summary", "top_resources", "hourly_error_analysis", "batch_metadata")
    for _ in range(2):
        assert etl.run(spark, [str(tmp_path / "a.log")], str(tmp_path / "store"), root, monthly=True, run_id="one") == "one"
    stored = MonthlyRunTables(spark, root)
    assert {t: stored.read(t).count() for t in names} == dict(zip(names, (2, 2, 2, 1), strict=True))
    assert stored.read("execution_metadata").count() == 1
    etl.run(spark, [str(tmp_path / "a.log")], str(tmp_path / "store"), root, monthly=True)
    assert stored.newest().count() == 2
    report = history.run_report(stored, "one")
    assert report["metadata"].first().total_records == 2 and report["query1"].count() == 2


def test_compacting_keeps_the_rows(spark, many):
    stored, _ = many
    for i, name in enumerate(("x", "y", "z")):
        later = MonthlyRunTables(spark, stored.root, datetime(2024, 3, 2 + i))
        row = [(name, "Spark") + (None,) * 9 + (datetime(2024, 3, 2 + i),)]
        later.append("execution_metadata", spark.createDataFrame(row, schema.TABLES["execution_metadata"]))
    before = sorted(shown(stored.month("execution_metadata", "2024-03")), key=repr)
    assert len(before) == 503 and [r.run_id for r in stored.newest(3).collect()] == ["z", "y", "x"]
    single = Path(stored.root, "execution_metadata/single/month=2024-03")
    kept = {f: f.read_bytes() for f in single.rglob("*") if f.is_file()}
    stored.compact("execution_metadata", "2024-03")
    assert not single.exists()
    assert sorted(shown(stored.month("execution_metadata", "2024-03")), key=repr) == before
    for file, content in kept.items():  # as if the compaction had stopped half way
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    spark.catalog.clearCache()
    assert sorted(shown(stored.month("execution_metadata", "2024-03")), key=repr) == before
    stored.compact("execution_metadata", "2024-03")
    stored.compact("execution_metadata", "2024-03")
    assert sorted(shown(stored.month("execution_metadata", "2024-03")), key=repr) == before
    assert stored.read("execution_metadata").count() == 10_003


def reports_of(spark, n):
    days = spark.range(n).select(
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") % 30_000).cast("int")).alias("log_date"), (F.col("id") % 500).cast("int").alias("status_code"),
        F.col("id").alias("request_count"), F.lit(Decimal(7)).cast("decimal(30,0)").alias("total_bytes")
    ).distinct()
    top = spark.createDataFrame([("/a,]}\n\"x", 2, Decimal(3), 1, 1), ("/é", 1, Decimal(2**70), 1, 2)], schema.Q2_RESULT)
    return {"query1": days, "query2": top, "query3": spark.createDataFrame([], schema.Q3_RESULT)}


@pytest.mark.parametrize("chosen", [("query1", "query2", "query3"), ("query2",), ()])
def test_pieces_are_the_document(spark, tmp_path, monkeypatch, chosen):
    found = {name: rows for name, rows in reports_of(spark, 3000).items() if name in chosen}
    total = spark.createDataFrame([(5, 1, 2)], "total_records long, malformed_records long, batch_count long")
    whole = combined.combined_json(found, total).first().result_json
    monkeypatch.setattr(combined, "MAX_ROWS", 1)  # the pieces have no bound
    combined.write_combined(found, total, str(tmp_path / "pieces"))
    files = [*sorted((tmp_path / "pieces/body").glob("part-*")), *sorted((tmp_path / "pieces/tail").glob("part-*"))]
    assert b"".join(f.read_bytes() for f in files).decode().rstrip("\n") == whole
    assert combined.read_written(spark, str(tmp_path / "pieces")).first().result_json == whole
    assert not chosen or len(files) > 2
