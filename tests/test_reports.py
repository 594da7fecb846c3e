"""Reports against brute force on skewed data, and their invariants."""

from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from accesstally.functions.clf import parse_lines, valid_records
from accesstally.operators import counts, reports
from accesstally.plans import sql_reports
from accesstally.sources.event_lines import event_lines

FIELDS = "host string, resource_path string, log_date date, log_hour int, status_code int, bytes_transferred long"


def skewed(spark):
    """A third of all rows on one path, one hour and one host; many ties behind it."""
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append(
            (
                "hot" if i % 6 == 0 else f"h{i % 41}",
                "/hot" if hot else f"/p{i % 50:02d}",
                date(2024, 1, 1 if hot else 1 + i % 4),
                0 if hot else i % 24,
                (200, 404, 500, 302, 399, 400, 599, 600)[i % 8],
                i,
            )
        )
    rows.append(("h", None, date(2024, 1, 1), 0, 200, 1))
    return rows, spark.createDataFrame(rows, FIELDS)


def brute_top(rows, n):
    groups = defaultdict(list)
    for r in rows:
        if r[1] is not None:
            groups[r[1]].append(r)
    found = [(p, len(g), sum(r[5] for r in g), len({r[0] for r in g})) for p, g in groups.items()]
    found.sort(key=lambda r: (-r[1], r[0]))
    return [row + (i,) for i, row in enumerate(found[:n], 1)]


@pytest.mark.parametrize("two_pass", [False, True])
@pytest.mark.parametrize("n", [1, 20, 100])
def test_top_resources(spark, two_pass, n):
    rows, frame = skewed(spark)
    got = reports.top_resources(frame.repartition(13), n, hosts_after_top=two_pass).orderBy("rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, n)


def test_hourly_errors(spark):
    rows, frame = skewed(spark)
    groups = defaultdict(list)
    for r in rows:
        groups[r[2], r[3]].append(r)
    want = []
    for key, group in sorted(groups.items()):
        bad = [r for r in group if 400 <= r[4] <= 599]
        rate = round(len(bad) / len(group) + 1e-12, 4)
        want.append((*key, len(bad), len(group), rate, len({r[0] for r in bad})))
    assert [tuple(r) for r in reports.hourly_errors(frame.repartition(7)).collect()] == want


def test_error_bounds_are_parameters(spark):
    _, frame = skewed(spark)
    tagged = reports.with_error_tag(frame, 500, 600).filter("is_error = 1")
    assert {r[0] for r in tagged.select("status_code").distinct().collect()} == {500, 599, 600}


def test_rate_rounds_half_up_and_survives_no_rows(spark):
    frame = spark.createDataFrame([(1, 32), (0, 0)], "e long, t long")
    assert [r[0] for r in frame.select(reports.error_rate("e", "t")).collect()] == [0.0313, 0.0]


def test_invariants(spark):
    lines = event_lines(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    parsed = parse_lines(lines).cache()
    records = valid_records(parsed)
    total = counts.record_counts(parsed).first()
    assert total.total_records + total.malformed_records == lines.count()
    assert (total.total_records, total.malformed_records) == (9594, 406)
    q1 = reports.daily_traffic(records).cache()
    q3 = reports.hourly_errors(records).cache()
    assert q1.agg(F.sum("request_count")).first()[0] == total.total_records
    assert q3.agg(F.sum("total_request_count")).first()[0] == total.total_records
    assert (
        q1.filter("status_code between 400 and 599").agg(F.sum("request_count")).first()[0]
        == q3.agg(F.sum("error_request_count")).first()[0]
    )
    q2 = reports.top_resources(records)
    assert q2.filter("distinct_host_count > request_count").count() == 0
    parsed.unpersist()


@pytest.mark.parametrize("parts", [1, 3, 32])
def test_results_do_not_depend_on_partitioning(spark, parts):
    lines = event_lines(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    for build in (reports.daily_traffic, reports.top_resources, reports.hourly_errors):
        want = build(valid_records(parse_lines(lines))).collect()
        assert build(valid_records(parse_lines(lines.repartition(parts)))).collect() == want


def test_sql_texts_equal_the_functions(spark):
    _, frame = skewed(spark)
    q1 = sql_reports.run_sql(spark, sql_reports.Q1, frame)
    q2 = sql_reports.run_sql(spark, sql_reports.Q2, frame)
    q3 = sql_reports.run_sql(spark, sql_reports.Q3, frame).withColumn("error_rate", F.round("error_rate", 4))
    assert q1.collect() == reports.daily_traffic(frame).collect()
    assert sorted(q2.collect()) == sorted(reports.top_resources(frame).drop("rank").collect())
    assert q3.collect() == reports.hourly_errors(frame).collect()


def test_selection(spark):
    _, frame = skewed(spark)
    assert list(reports.selected_reports(frame)) == ["query1", "query2", "query3"]
    assert list(reports.selected_reports(frame, "query2")) == ["query2"]
    with pytest.raises(ValueError):
        reports.selected_reports(frame, "query4")


def test_counts_of_nothing_are_zero(spark):
    empty = parse_lines(spark.createDataFrame([], "value string, batch_id int"))
    assert tuple(counts.record_counts(empty).first()) == (0, 0)
    assert tuple(counts.batch_size_summary(counts.batch_counts(empty)).first()) == (0, 0, 0, 0.0, 0)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    _, frame = skewed(spark)
    assert "TakeOrderedAndProject" in plan_of(reports.top_resources(frame))
    for build in (reports.top_resources, reports.hourly_errors):
        plan = plan_of(build(frame))
        assert "Expand" not in plan
        assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    for text in (sql_reports.Q1, sql_reports.Q2, sql_reports.Q3):
        plan = plan_of(sql_reports.run_sql(spark, text, frame))
        assert "Expand" not in plan and "Cartesian" not in plan


def test_largest_sizes_are_summed(spark):
    rows = [("h", "/a", date(2024, 1, 1), 1, 200, 2**63 - 1)] * 3
    frame = spark.createDataFrame(rows, FIELDS)
    for found in (reports.daily_traffic(frame), reports.top_resources(frame), reports.top_resources(frame, hosts_after_top=True),
                  sql_reports.run_sql(spark, sql_reports.Q1, frame), sql_reports.run_sql(spark, sql_reports.Q2, frame)):
        assert [int(r.total_bytes) for r in found.collect()] == [3 * (2**63 - 1)]


@pytest.mark.parametrize("n", [0, reports.MAX_SHOWN + 1])
def test_list_lengths_are_checked(spark, n):
    with pytest.raises(ValueError):
        reports.top_resources(skewed(spark)[1], n)
