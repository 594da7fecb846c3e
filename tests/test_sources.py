"""Files, sinks, stores and whole runs."""

import gzip
import json
import random
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accesstally import schema
from accesstally.functions.clf import parse_lines, valid_records
from accesstally.operators import counts, history, reports
from accesstally.plans import combined, etl
from accesstally.sources import tables, text
from accesstally.sources.scratch import may_hold_scratch, scratch_path


def log_line(day=1, hour=0, path="/a", status=200, host="h", size="5"):
    return f'{host} - - [{day:02d}/Jul/1995:{hour:02d}:00:01 -0400] "GET {path} HTTP/1.0" {status} {size}'


@pytest.fixture()
def logs(tmp_path):
    july, august = tmp_path / "ju ly%41é.log", tmp_path / "august.log"
    july.write_text("\n".join([log_line(), log_line(2, 5, "/b", 404, "x"), "broken", log_line(2, 10, "/a", 500)]))
    august.write_text("\n".join([log_line(3, 2, "/a", 404, "y"), "", log_line(3, 2, "/a", 404, "y", "-")]) + "\n")
    return [str(july), str(august)]


def test_batches_follow_the_order_of_paths(spark, logs):
    for paths in (logs, logs[::-1], logs + logs, [logs[0], "file:" + logs[1], logs[1].replace("/august", "/./august")]):
        lines = text.read_lines(spark, paths)
        found = {r.batch_id: (r.records_processed, r.malformed_records)
                 for r in counts.batch_counts(parse_lines(lines)).collect()}
        first, second = ((3, 1), (2, 1)) if paths[0] == logs[0] else ((2, 1), (3, 1))
        assert found == {1: first, 2: second}
        assert "Join" not in lines._jdf.queryExecution().executedPlan().toString()


def test_paths_that_share_files_are_refused(spark, logs, tmp_path):
    folder = str(tmp_path)
    for paths in ([folder, logs[0]], [logs[1], "file://" + folder + "/"], [folder + "/*.log", logs[1]], [folder + "/*.log", folder]):
        with pytest.raises(ValueError):
            text.read_lines(spark, paths)
    assert len(text.batch_paths(spark, [folder + "/a*.log", folder + "/j*.log"])) == 2


def test_files_without_lines_are_batches(spark, logs, tmp_path):
    (tmp_path / "none.log").write_text("")
    paths = [str(tmp_path / "none.log"), *logs]
    found = counts.batch_counts(parse_lines(text.read_lines(spark, paths)), len(paths))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, 0), (2, 3, 1), (3, 2, 1)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    run_id = etl.run(spark, paths, str(tmp_path / "store"), str(tmp_path / "tables"), "query1")
    meta = tables.RunTables(spark, str(tmp_path / "tables")).read("execution_metadata", run_id).first()
    assert (meta.total_batches, meta.total_records) == (3, 5)


def test_encoding(spark, tmp_path):
    (tmp_path / "a").write_bytes("\n".join([log_line(path="/caf\xe9"), log_line(path="/caf\xe8")]).encode("latin1"))
    rows = parse_lines(text.read_lines(spark, [str(tmp_path / "a")], "ISO-8859-1")).collect()
    assert sorted(r.resource_path for r in rows) == ["/caf\xe8", "/caf\xe9"]


def test_bad_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "a").write_bytes(log_line(host="HOST").encode().replace(b"HOST", b"h\xff\xfe") + b"\r" + b"\xff\n")
    rows = parse_lines(text.read_lines(spark, [str(tmp_path / "a")])).collect()
    assert sorted(str(r.host) for r in rows) == ["None", "h��"]


def test_union(spark):
    a = spark.createDataFrame([("x",), ("y",)], "value string")
    got = text.union_batches(a, a.limit(1)).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in got] == [(1, 2), (2, 1)]
    with pytest.raises(ValueError):
        text.union_batches()


def test_record_export_keeps_every_character(spark, tmp_path):
    paths = ["/a", '/q\'x', "/back\\slash", "/comma,semi;", "/#hash", "/n\\N", "/é’"]
    requests = [log_line(path=p) for p in paths] + [
        'h - - [01/Jul/1995:00:00:01 -0400] " lead and\ttab " 200 1',
        '" - - [01/Jul/1995:00:00:01 -0400] "" 200 1',
    ]
    records = valid_records(parse_lines(spark.createDataFrame([(r,) for r in requests], "value string")))
    tables.export_records(records, str(tmp_path / "t"))
    want = sorted(map(tuple, records.select(*schema.RECORD_FIELDS).collect()))
    assert sorted(map(tuple, tables.read_records(spark, str(tmp_path / "t")).collect())) == want


def test_tsv_read_back_skips_short_rows_and_rounds(spark, tmp_path):
    (tmp_path / "part-0").write_text(
        "1995-07-01\t5\t1\t3\t0.33333333\t1\n"
        "1995-07-01\t6\t1\n"
        "\n"
        "1995-07-01\tx\t1\t3\t0.5\t1\n"
        "1995-07-02\t0\t0\t2\t0.0\t0\n"
    )
    rows = tables.read_tsv(spark, str(tmp_path), schema.Q3_RESULT)
    assert [tuple(r) for r in rows.orderBy("log_date").collect()] == [
        (date(1995, 7, 1), 5, 1, 3, 0.3333, 1),
        (date(1995, 7, 2), 0, 0, 2, 0.0, 0),
    ]
    assert rows.count() == 2
    assert rows.select("log_date").count() == 2


def test_json_read_back_skips_bad_lines(spark, tmp_path):
    (tmp_path / "query1").mkdir()
    (tmp_path / "query1" / "part-0").write_text(
        '{"log_date":"1995-07-01","status_code":200,"request_count":3,"total_bytes":9}\n'
        '{"log_date":"1995-\n'
        "\n"
    )
    rows = tables.read_json(spark, str(tmp_path), "query1", schema.Q1_RESULT)
    assert [tuple(r) for r in rows.collect()] == [(date(1995, 7, 1), 200, 3, 9)]
    assert rows.count() == 1


def test_combined_document(spark):
    lines = [log_line(2, 10, "/a", 404), log_line(2, 2, "/b"), log_line(1, 3, "/a"), "broken"]
    parsed = parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
    records = valid_records(parsed)
    total = counts.record_counts(parsed).withColumn("batch_count", F.lit(1))
    document = combined.combined_json(reports.selected_reports(records), total).collect()
    assert len(document) == 1
    found = json.loads(document[0].result_json)
    assert (found["total_records"], found["malformed_records"], found["batch_count"]) == (3, 1, 1)
    assert [r["log_hour"] for r in found["q3"]] == [3, 2, 10]
    assert [r["resource_path"] for r in found["q2"]] == ["/a", "/b"]
    assert list(found["q2"][0]) == schema.Q2_RESULT.names
    assert found["q1"][0] == {"log_date": "1995-07-01", "status_code": 200, "request_count": 1, "total_bytes": 5}
    only = combined.combined_json(reports.selected_reports(records, "query1"), total)
    found = json.loads(only.first().result_json)
    assert found["q2"] == found["q3"] == [] and len(found["q1"]) == 3
    assert [tuple(r) for r in combined.read_totals(only).collect()] == [(3, 1, 1)]


def test_combined_document_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(combined, "MAX_ROWS", 2)
    parsed = parse_lines(spark.createDataFrame([(log_line(d),) for d in (1, 2, 3)], "value string"))
    total = counts.record_counts(parsed).withColumn("batch_count", F.lit(1))
    with pytest.raises(Exception, match="at most 2 rows"):
        combined.combined_json(reports.selected_reports(valid_records(parsed)), total).collect()


@pytest.mark.parametrize("balance", [False, True])
def test_store_keeps_every_line_and_is_replaced(spark, logs, tmp_path, balance):
    store = str(tmp_path / "store")
    for paths in (logs, logs[:1]):
        tables.write_store(parse_lines(text.read_lines(spark, paths)), store, balance)
    everything = tables.read_store(spark, store)
    assert everything.count() == 4
    assert [r.value for r in everything.filter("malformed_reason is not null").collect()] == ["broken"]
    records = tables.stored_records(spark, store)
    assert records.count() == 3
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_store_is_replaced_in_dynamic_mode_and_has_few_files(spark, tmp_path):
    store = str(tmp_path / "store")
    with gzip.open(tmp_path / "a.gz", "wt") as out:
        out.writelines(log_line(1 + i % 28) + "\n" for i in range(2000))
    (tmp_path / "b.log").write_text(log_line(3) + "\n")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for name in ("a.gz", "b.log"):
            tables.write_store(parse_lines(text.read_lines(spark, [str(tmp_path / name)])), store)
            if name == "a.gz":
                assert len(tables.read_store(spark, store).inputFiles()) == 28
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert tables.read_store(spark, store).count() == 1


def test_run_tables(spark, tmp_path):
    stored = tables.RunTables(spark, str(tmp_path / "t"))
    assert stored.read("top_resources").count() == 0
    rows = spark.createDataFrame([(date(1995, 7, 1), 200, 2, Decimal(10))], schema.Q1_RESULT)
    stored.append_results("daily_traffic_summary", rows, "7", "Spark")
    stored.append_results("daily_traffic_summary", rows, "07", "Spark")
    stored.append_results("daily_traffic_summary", rows.limit(0), "8", "Spark")
    assert sorted(r.run_id for r in stored.read("daily_traffic_summary").collect()) == ["07", "7"]
    one = stored.read("daily_traffic_summary", "07")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().executedPlan().toString()


def test_whole_run(spark, logs, tmp_path):
    store, root = str(tmp_path / "store"), str(tmp_path / "tables")
    first = etl.run(spark, logs, store, root, batch_size=1000, extra={"mode": "test"})
    second = etl.run(spark, logs[:1], store, root, "query2", "Other")
    stored = tables.RunTables(spark, root)
    assert len(first) == 36 and first != second

    report = history.run_report(stored, first)
    assert set(report) == {"metadata", "batches", "query1", "query2", "query3"}
    meta = report["metadata"].first()
    assert (meta.total_records, meta.malformed_records, meta.total_batches) == (5, 2, 2)
    assert (meta.avg_batch_size, meta.batch_size, meta.query_name) == (2.5, 1000, "all")
    assert meta.data_file == ", ".join(text.batch_paths(spark, logs)) and meta.execution_time_ms > 0
    assert meta.execution_start <= meta.execution_end
    assert [tuple(r) for r in report["batches"].collect()] == [(1, 3, 3, 1), (2, 2, 2, 1)]
    assert [(r.rank, r.resource_path, r.request_count, r.total_bytes, r.distinct_host_count)
            for r in report["query2"].collect()] == [(1, "/a", 4, 15, 2), (2, "/b", 1, 5, 1)]
    assert [(r.log_hour, r.error_request_count, r.error_rate) for r in report["query3"].collect()] == [
        (0, 0, 0.0), (5, 1, 1.0), (10, 1, 1.0), (2, 2, 1.0),
    ]
    assert stored.read("query_results", first).first().result_json == '{"mode": "test"}'

    assert set(history.run_report(stored, second)) == {"metadata", "batches", "query2"}
    assert history.run_report(stored, "unknown") == {}
    runs, results = stored.read("execution_metadata"), stored.read("query_results")
    assert [(r.run_id, r.query_name) for r in history.run_history(runs, results).collect()] == [
        (second, "query2"), (first, "all"),
    ]
    assert history.latest_run(runs).first().run_id == second
    assert {r.pipeline_name: r.runs for r in history.compare_runs(runs).collect()} == {"Spark": 1, "Other": 1}
    summary = history.malformed_summary(stored.read("batch_metadata", first)).orderBy("batch_id").collect()
    assert [r.malformed_record_count for r in summary] == [1, 1]
    with pytest.raises(ValueError):
        etl.run(spark, logs, store, root, "query9")


def test_whole_run_in_the_loose_dialect(spark, tmp_path):
    lines = [log_line(), log_line().replace("Jul", "Foo"), log_line().replace("- -", "bob -"), "broken"]
    (tmp_path / "a.log").write_text("\n".join(lines))
    root = str(tmp_path / "tables")
    run_id = etl.run(spark, [str(tmp_path / "a.log")], str(tmp_path / "store"), root, dialect="loose", balance=True)
    report = history.run_report(tables.RunTables(spark, root), run_id)
    assert [(r.resource_path, r.request_count) for r in report["query2"].collect()] == [("/a", 3)]
    assert [r.request_count for r in report["query1"].collect()] == [2]
    assert report["metadata"].first().malformed_records == 2


def test_history_with_many_answers_per_run(spark):
    """A run that owns most answers, runs without any, and ties in time."""
    runs = [(f"r{i:02d}", "p", 1, 0, 10, 1.0, datetime(2024, 1, 1 + i // 4)) for i in range(40)]
    answers = [("r39", f"q{i:03d}") for i in range(15)] + [("r36", "query1")]
    answers += [(f"r{i:02d}", "query3") for i in range(0, 36, 3)]
    columns = "run_id string, pipeline_name string, total_records long, malformed_records long, "
    columns += "execution_time_ms long, avg_batch_size double, created_at timestamp"
    run_rows = spark.createDataFrame(runs, columns)
    answer_rows = spark.createDataFrame(answers, "run_id string, query_name string")
    named = {}
    for run_id, name in answers:
        named.setdefault(run_id, []).append(name)
    want = []
    for run in sorted(runs, key=lambda r: (-r[6].toordinal(), r[0])):
        want += [(run[0], name) for name in sorted(named.get(run[0], ["all"]))]
    got = history.run_history(run_rows, answer_rows).select("run_id", "query_name").collect()
    assert [tuple(r) for r in got] == want[:20]


def test_average_time_is_rounded(spark):
    runs = spark.createDataFrame([("p", 1, 5), ("p", 2, 5)], "pipeline_name string, execution_time_ms long, total_records long")
    assert history.compare_runs(runs).first().avg_ms == 2


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(root + "/") and one != two


def test_many_paths_are_one_scan(spark, tmp_path):
    """Paths that begin alike, odd names, folders in folders, and a thousand of them."""
    rng = random.Random(5)
    names = ["a", "a-2", "a.b", "a2", "ju ly%41é.log", "z#1", "sub/x=1/deep.log", "sub.log", "日/本.log"]
    names += [f"many/f{i}.log" for i in range(1000)]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"{name}\n")
    paths = ["sub" if n.startswith("sub/") else n for n in names]
    rng.shuffle(paths)
    start = time.perf_counter()
    lines = text.read_lines(spark, [f"{tmp_path}/{p}" for p in paths])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 20
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan and "Join" not in plan
    found = {r.value: r.batch_id for r in lines.collect()}
    assert found == {n: paths.index("sub" if n.startswith("sub/") else n) + 1 for n in names}
    number = found["many/f7.log"]
    assert [r.value for r in lines.filter(F.col("batch_id") == number).collect()] == ["many/f7.log"]


def test_packed_files_are_dealt_out_and_others_are_not(spark, logs, tmp_path):
    with gzip.open(tmp_path / "p.log.gz", "wt") as file:
        file.write("\n".join([log_line()] * 3))
    lines = text.read_lines(spark, [*logs, str(tmp_path / "p.log.gz")])
    assert {r.batch_id: r["count"] for r in lines.groupBy("batch_id").count().collect()} == {1: 4, 2: 3, 3: 3}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2 and plan.count("Exchange RoundRobin") == 1


def test_scratch_needs_a_shared_folder():
    assert may_hold_scratch("file", "local[8]") and may_hold_scratch("hdfs", "yarn")
    assert not may_hold_scratch("file", "yarn") and not may_hold_scratch("file", "spark://host:7077")
