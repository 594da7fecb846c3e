"""Line grammar: literal lines, lenient timestamps, dialects."""

import itertools
import random
import re
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from accesstally.functions.clf import malformed_lines, parse_lines, request_parts, valid_records

STAMP = "01/Jul/1995:00:00:01 -0400"


def line(stamp=STAMP, request="GET /a HTTP/1.0", status="200", size="10", host="h", ident="- -", tail=""):
    return f'{host} {ident} [{stamp}] "{request}" {status} {size}{tail}'


def parse(spark, lines, dialect="clf"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    return parse_lines(frame, dialect).orderBy("i").collect()


VALID = [
    (line("19/Dec/2031:18:59:59 +0100", "DELETE /api/items/7?force=1 HTTP/2", "204", "0"), dict(
        host="h", timestamp="2031-12-19T18:59:59+01:00", log_date=date(2031, 12, 19), log_hour=18, http_method="DELETE",
        resource_path="/api/items/7?force=1", protocol_version="HTTP/2", status_code=204, bytes_transferred=0,
    )),
    (line("31/Mar/2024:22:15:30 -0200", host="2001:db8::7"), dict(host="2001:db8::7", event_time=datetime(2024, 4, 1, 0, 15, 30))),
    (line(request="HEAD   /wide   HTTP/1.1"), dict(http_method="HEAD", resource_path="/wide", protocol_version="HTTP/1.1")),
    (line(request="GET https://proxy.test/x", status="599", size="-"), dict(resource_path="https://proxy.test/x", status_code=599, bytes_transferred=0)),
    (line("01/Jan/1601:23:00:00 +0000"), dict(log_hour=23, log_date=date(1601, 1, 1))),
    (
        line("1/jul/1995:3:4:5 -04:00"),
        dict(timestamp="1995-07-01T03:04:05-04:00", log_hour=3, log_date=date(1995, 7, 1)),
    ),
    (line("01/JUL/1995:03:04:05 Z"), dict(timestamp="1995-07-01T03:04:05+00:00")),
    (line(" 1/Jul/1995:03:04:05 -0000"), dict(timestamp="1995-07-01T03:04:05+00:00")),
    (line("29/Feb/1996:03:04:05   +2359"), dict(log_date=date(1996, 2, 29), event_time=None)),
    (line("01/Jul/1995:00:00:01 +053015"), dict(timestamp="1995-07-01T00:00:01+05:30:15")),
    (line(size="abc"), dict(bytes_transferred=0)),
    (line(size="1.5"), dict(bytes_transferred=0)),
    (line(size="-7"), dict(bytes_transferred=-7)),
    (line(size="99999999999999999999"), dict(bytes_transferred=0)),
    (line(request=""), dict(http_method="UNKNOWN", resource_path="/", protocol_version="UNKNOWN")),
    (line(request="  "), dict(http_method="UNKNOWN", resource_path="  ")),
    (line(request="GET /a"), dict(http_method="GET", resource_path="/a", protocol_version="UNKNOWN")),
    (line(request=" GET /a HTTP/1.1 "), dict(http_method="GET", resource_path="/a", protocol_version="HTTP/1.1")),
    (
        line(request="GET /a b HTTP/1.0"),
        dict(http_method="UNKNOWN", resource_path="GET /a b HTTP/1.0", protocol_version="UNKNOWN"),
    ),
    (line(request="get /a HTTP/1.0"), dict(http_method="UNKNOWN", resource_path="get /a HTTP/1.0")),
    (line(request="GET HTTP/1.0"), dict(http_method="GET", resource_path="HTTP/1.0", protocol_version="UNKNOWN")),
    (line(request="GET /a HTTP/"), dict(http_method="UNKNOWN", resource_path="GET /a HTTP/")),
    (line(tail=" extra text"), dict(bytes_transferred=10)),
    ("  \t" + line() + "  \r", dict(host="h", bytes_transferred=10)),
    (line(ident="-\t -"), dict(host="h")),
    (line(ident=" - -"), dict(host="h")),
    (line(host="hôte’s"), dict(host="hôte’s")),
    (line(request="GET /café HTTP/1.0"), dict(resource_path="/café")),
    (line(request="GET /a b HTTP/1.0"), dict(http_method="UNKNOWN")),
    (line(host='a"b]c['), dict(host='a"b]c[')),
]

MALFORMED = [
    ("", "no_match"),
    ("   ", "no_match"),
    ("this is not a log line at all", "no_match"),
    ("alyssa.p", "no_match"),
    ("\n" * 20, "no_match"),
    (line(ident="bob -"), "no_match"),
    (line(status="20"), "no_match"),
    (line(status="2000"), "no_match"),
    (line(request='GET /"x" HTTP/1.0'), "no_match"),
    (line(size=""), "no_match"),
    (line(status="-"), "no_status"),
    (line("01/Foo/1995:00:00:01 -0400"), "bad_timestamp"),
    (line("31/Feb/1995:00:00:01 -0400"), "bad_timestamp"),
    (line("29/Feb/1995:00:00:01 -0400"), "bad_timestamp"),
    (line("01/Jul/1995:00:00:60 -0400"), "bad_timestamp"),
    (line("01/Jul/1995:24:00:00 -0400"), "bad_timestamp"),
    (line("01/Jul/1995:00:00:01"), "bad_timestamp"),
    (line("01/Jul/0000:00:00:01 -0400"), "bad_timestamp"),
    (line("01/Jul/1995:00:00:01 -2400"), "bad_timestamp"),
    (line("01/Jul/1995:00:00:01 z"), "bad_timestamp"),
    (line("  1/Jul/1995:00:00:01 -0400"), "bad_timestamp"),
    (None, "no_match"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    return parse(spark, [text for text, _ in VALID] + [text for text, _ in MALFORMED])


@pytest.mark.parametrize("i", range(len(VALID)))
def test_valid(parsed, i):
    row = parsed[i]
    assert row.malformed_reason is None, row.value
    for field, want in VALID[i][1].items():
        assert row[field] == want, (row.value, field)


@pytest.mark.parametrize("i", range(len(MALFORMED)))
def test_malformed(parsed, i):
    assert parsed[len(VALID) + i].malformed_reason == MALFORMED[i][1]


def test_every_line_is_valid_or_malformed(spark):
    texts = [text for text, _ in VALID + MALFORMED]
    frame = parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert frame.count() == len(texts)
    assert valid_records(frame).count() == len(VALID)
    assert malformed_lines(frame).count() == len(MALFORMED)


def test_very_long_lines(spark):
    path = "/" + "a" * 2_000_000
    texts = [
        line(request=f"GET {path} HTTP/1.0"),
        line(request="GET " + "b " * 500_000),
        "x " * 1_000_000,
        "A" * 1_000_000 + " - - [" + "1" * 1_000_000,
    ]
    rows = parse(spark, texts)
    assert rows[0].resource_path == path and rows[0].bytes_transferred == 10
    assert len(rows[1].resource_path) == 1_000_004 and rows[1].http_method == "UNKNOWN"
    assert [r.malformed_reason for r in rows[2:]] == ["no_match", "no_match"]


def test_timestamps_agree_with_strptime(spark):
    days = ["1", " 1", "01", "31", "32", "00", "9", "30"]
    months = ["Jan", "feb", "APR", "Jux", "Dec"]
    clocks = ["0:0:0", "23:59:59", "24:00:00", "12:60:00", "12:00:61", "7:08:9", "007:00:00"]
    zones = [" -0400", " +05:30", " Z", "", " +9", " -2360", " +2400", "  +0000", " -0000", " +00:0000", " UTC"]
    stamps = [
        f"{d}/{m}/{y}:{c}{z}"
        for d, m, c, z in itertools.product(days, months, clocks, zones)
        for y in ("1995", "1996")
    ]
    rows = parse(spark, [line(s) for s in stamps])
    for stamp, row in zip(stamps, rows):
        try:
            want = datetime.strptime(stamp, "%d/%b/%Y:%H:%M:%S %z")
        except ValueError:
            assert row.malformed_reason == "bad_timestamp", stamp
            continue
        assert row.malformed_reason is None, stamp
        assert (row.log_date, row.log_hour) == (want.date(), want.hour), stamp
        assert row.timestamp == want.isoformat(), stamp


def test_prefix_dialect(spark):
    requests = ["GET /a HTTP/1.0", "GET /a b c", "", "get /a", " GET /a", "GET  //x"]
    rows = parse(spark, [line(request=r) for r in requests], "prefix")
    assert [r.resource_path for r in rows] == ["/a", "/a", None, None, None, "//x"]


def test_loose_dialect(spark):
    lines = [
        line(ident="bob alice"),
        line(request="GET /a"),
        line(request=""),
        line("01/jul/1995:00:00:01 -0400"),
        line("01/Jul/1995:05:00:01 EST"),
        line(status="-"),
        line(size="-"),
        line("1/Jul/1995:00:00:01 -0400"),
    ]
    rows = parse(spark, lines, "loose")
    assert [r.malformed_reason for r in rows] == [
        None, None, None, "bad_timestamp", None, "no_match", None, "no_match",
    ]
    assert [r.resource_path for r in rows[:3]] == ["/a", "/a", None]
    assert rows[4].log_hour == 5 and rows[4].timestamp is None
    assert rows[3].resource_path == "/a"


def test_unknown_dialect(spark):
    with pytest.raises(ValueError):
        parse_lines(spark.createDataFrame([("x",)], "value string"), "other")


def test_request_parts_agree_with_line_parser(spark):
    requests = [
        "GET /a HTTP/1.0", "GET /a", "", "  ", "GET /a b", " POST /x HTTP/1.1 ", "GET", "GET /a http/1.0", " GET /a",
    ]
    from_lines = parse(spark, [line(request=r) for r in requests])
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(requests)], "i int, request string")
    alone = frame.select("i", *request_parts(F.col("request"))).orderBy("i").collect()
    assert [tuple(r)[1:] for r in alone] == [
        (r.http_method, r.resource_path, r.protocol_version) for r in from_lines
    ]


def test_session_time_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        frame = parse_lines(spark.createDataFrame([(line(),)], "value string"))
        row = frame.select("log_date", "log_hour", F.unix_seconds("event_time").alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.log_date, row.log_hour, row.s) == (date(1995, 7, 1), 0, 804571201)


def test_filters_stay_above_the_regular_expression(spark):
    frame = parse_lines(spark.createDataFrame([("x",)], "value string"))
    wanted = valid_records(frame).filter("status_code >= 400 and log_hour = 3 and host like 'h%'")
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 4  # one expression, ASCII and Unicode form, clock padding
    assert "regexp_replace" not in plan[: plan.index("Generate")].split("Filter", 1)[1]


def test_parse_works_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text(line() + "\nalyssa.p\n")
    stream = parse_lines(spark.readStream.text(str(tmp_path / "in")))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).select("malformed_reason").collect()
    assert sorted(str(r[0]) for r in rows) == ["None", "no_match"]


# Fixed value: the request of the loose dialect as a grammar that tries every way to share it out.
_LOOSE_REQUEST = r'(?P<method>[A-Z]+)? ?(?P<path>[^"\s]+)? ?(?P<protocol>HTTP[^"\s]*)?'


def test_loose_requests_agree_with_the_free_grammar(spark):
    rng = random.Random(11)
    requests = ["".join(rng.choice(["GET", "P", "HTTP", "HTTP/1.0", " ", " ", " ", "/a", "x", "\t", "1", "hTTP", ""]) for _ in range(rng.randint(0, 7))) for _ in range(4000)]
    lines = [f'h - - [01/Jul/1995:00:00:01 -0400] "{r}" 200 1' for r in requests]
    found = [(r.value, r.http_method, r.resource_path, r.protocol_version) for r in parse(spark, lines, "loose") if r.malformed_reason is None]
    want = []
    for request, line in zip(requests, lines, strict=True):
        if m := re.fullmatch(_LOOSE_REQUEST, request):
            want.append((line, m["method"] or "UNKNOWN", m["path"], m["protocol"] or "UNKNOWN"))
    assert len(want) > 1000
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("dialect", ["clf", "prefix", "loose"])
def test_hostile_lines_take_linear_time(spark, dialect):
    bodies = ["A" * 40_000, "HTTP" * 10_000, "GET " + "HTTP" * 10_000, "a" + "HTTP" * 10_000 + " ", "GET /" + "HTTP " * 8_000, " " * 40_000]
    lines = [f'h - - [01/Jul/1995:00:00:01 -0400] "{b}{end}' for b in bodies for end in ('" 200 1', '" 200', "", '" x 1')]
    lines += ["h" * 40_000, "h - - [" + "1" * 40_000, "h " * 20_000]
    parse(spark, lines[:1], dialect)
    start = time.perf_counter()
    assert len(parse(spark, lines, dialect)) == len(lines)
    assert time.perf_counter() - start < 0.3 * len(lines)
