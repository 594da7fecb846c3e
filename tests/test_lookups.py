"""Lookups that skip row groups, sets of hosts that merge, batches of lines in a run."""

import random

import pytest
from pyspark.sql import functions as F

from accesstally.functions.clf import parse_lines, valid_records
from accesstally.operators import counts, history, host_sets, lookups, reports
from accesstally.plans import etl
from accesstally.sources import tables
from tests.compare import rows as comparable
from tests.test_sources import log_line


@pytest.fixture(scope="module")
def parsed(spark):
    rng = random.Random(2)
    lines = [log_line(rng.choice([1, 2]), rng.randrange(24), f"/p{rng.randrange(400)}", rng.choice([200, 200, 304, 404, 500]), f"h{rng.randrange(300)}", str(rng.randrange(10**6)))
             for _ in range(40_000)]
    frame = spark.createDataFrame([(v, 1, "f") for v in [*lines, "broken"]], "value string, batch_id int, file_path string")
    return parse_lines(frame.repartition(4))


def scanned(frame):
    """Rows that the scan of a lookup handed on."""
    found = frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return len(found), scan.metrics().apply("numOutputRows").value()


def test_lookups_skip_what_cannot_match(spark, parsed, tmp_path):
    for name, clustered in (("plain", False), ("clustered", True)):
        tables.write_store(parsed, f"{tmp_path}/{name}", clustered=clustered, group_bytes=1 << 13)
    plain, clustered = (tables.stored_records(spark, f"{tmp_path}/{n}") for n in ("plain", "clustered"))
    assert comparable(plain.columns, plain.collect()) == comparable(clustered.columns, clustered.collect())
    most = {"hosts": 0.3, "paths": 0.3, "hours": 0.5, "statuses": 0.6, "dates": 0.6}
    for wanted in ({"hosts": "h7"}, {"paths": "/p7"}, {"hours": [3]}, {"statuses": 404}, {"dates": ("1995-07-02", "1995-07-02")}, {"hosts": ["none"]}):
        want = lookups.find_requests(valid_records(parsed), **wanted).count()
        found, read = scanned(lookups.find_requests(clustered, **wanted))
        assert found == want
        assert read <= most[next(iter(wanted))] * 40_000, (wanted, read)
    assert scanned(lookups.find_requests(clustered, hosts=["none"], hours=5))[1] == 0
    assert scanned(lookups.find_requests(clustered, hosts="h7", paths="/p7"))[1] <= 0.1 * 40_000
    assert scanned(lookups.find_requests(plain, hosts="h7"))[1] == 40_000


def test_states_merge_across_runs(spark, tmp_path):
    """Hosts that several runs saw count once, without the log."""
    days = {"a": [(1, 0, "/a", 200, "x"), (1, 0, "/a", 404, "y"), (2, 3, "/b", 500, "x")],
            "b": [(1, 0, "/a", 404, "y"), (1, 0, "/a", 200, "z"), (2, 3, "/b", 200, "x")],
            "c": []}
    root, everything = str(tmp_path / "tables"), []
    for name, lines in days.items():
        (tmp_path / f"{name}.log").write_text("\n".join(log_line(*line, "9223372036854775807") for line in lines))
        everything += [log_line(*line, "9223372036854775807") for line in lines]
        etl.run(spark, [str(tmp_path / f"{name}.log")], str(tmp_path / f"store-{name}"), root, host_states=True)
    stored = tables.RunTables(spark, root)
    records = valid_records(parse_lines(spark.createDataFrame([(v,) for v in everything], "value string")))
    resources, hours = stored.read("resource_host_state"), stored.read("hour_host_state")
    pairs = [(host_sets.merged_traffic(stored.read("daily_traffic_summary")), reports.daily_traffic(records)),
             (host_sets.merged_top_resources(resources), reports.top_resources(records)),
             (host_sets.merged_hourly_errors(hours), reports.hourly_errors(records)),
             (host_sets.merged_hosts(hours), records.agg(F.countDistinct("host").alias("distinct_hosts")))]
    for merged, direct in pairs:
        assert [tuple(r) for r in merged.collect()] == [tuple(r) for r in direct.select(merged.columns).collect()]
        assert merged.schema.simpleString() == direct.select(merged.columns).schema.simpleString()


@pytest.mark.parametrize("size", [1, 3, 100])
def test_batches_of_lines(spark, tmp_path, size):
    sizes = {"m.log": 7, "n.log": 0, "a.log": 4}
    for name, n in sizes.items():
        (tmp_path / name).write_text("".join((log_line() if i % 3 else "broken") + "\n" for i in range(n)))
    paths = [str(tmp_path / name) for name in sizes]
    run_id = etl.run(spark, paths, str(tmp_path / "store"), str(tmp_path / "tables"), "query1", batch_size=size, batch_by="lines")
    want, number = [], 0
    for n in sizes.values():
        for at in range(0, n, size):
            good = sum(bool(i % 3) for i in range(at, min(n, at + size)))
            number += 1
            want.append((number, good, good, min(n, at + size) - at - good))
    report = history.run_report(tables.RunTables(spark, str(tmp_path / "tables")), run_id)
    assert [tuple(r) for r in report["batches"].collect()] == want
    meta = report["metadata"].first()
    assert (meta.total_batches, meta.batch_size, meta.total_records) == (len(want), size, sum(w[1] for w in want))
    total = counts.record_counts(tables.read_store(spark, str(tmp_path / "store"))).first()
    assert total.total_records + total.malformed_records == 11


def test_batches_are_by_path_or_lines(spark, tmp_path):
    with pytest.raises(ValueError):
        etl.run(spark, ["x"], "s", "t", batch_by="size")
