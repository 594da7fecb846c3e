"""Access-log parsing with native columns.

One regular expression per line yields every piece of the record at once, so a
line is scanned once no matter how many fields a query asks for. The pieces
travel as an array through a one-element ``explode``: the optimizer does not
move a filter below a generator, so a filter on a parsed field never makes
Spark run the regular expression a second time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Whitespace as the log grammar understands it. The long class is
# many times slower to match; it serves only lines that hold a space beyond ASCII.
ASCII_SPACE = r"\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20"
WIDE_SPACE = r"\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNICODE_SPACE = ASCII_SPACE + WIDE_SPACE

# English month abbreviations of the log timestamp.
MONTHS = {
    "Jan": "01",
    "Feb": "02",
    "Mar": "03",
    "Apr": "04",
    "May": "05",
    "Jun": "06",
    "Jul": "07",
    "Aug": "08",
    "Sep": "09",
    "Oct": "10",
    "Nov": "11",
    "Dec": "12",
}

# Fixed value: stands for a method or protocol the request does not carry.
UNKNOWN = "UNKNOWN"

DIALECTS = ("clf", "prefix", "loose")

# Reasons a line is rejected, in the order they are tested.
NO_MATCH, NO_STATUS, BAD_TIMESTAMP = "no_match", "no_status", "bad_timestamp"

# Offset of local time: Z, or sign, hours below 24, minutes and optional seconds
# with a fraction; colons in all places or in none.
_SECONDS = r"[0-5]\d(?:\.\d{1,6})?"
_HOURS = r"(?:[01]\d|2[0-3])"
_ZONE = rf"Z|[+-]{_HOURS}[0-5]\d(?:{_SECONDS})?|[+-]{_HOURS}:[0-5]\d(?::{_SECONDS})?"

# Array positions of the pieces. The request comes last: it alone may hold a
# line break, and the split that builds the array is limited to this many parts.
_PIECES = [
    "host",
    "day",
    "month",
    "year",
    "clock",
    "hour",
    "zone",
    "method",
    "path",
    "protocol",
    "status",
    "bytes",
    "request",
]


# Columns added by the parser, in order.
_PARSED = [
    "host",
    "timestamp",
    "event_time",
    "log_date",
    "log_hour",
    "http_method",
    "resource_path",
    "protocol_version",
    "status_code",
    "bytes_transferred",
    "malformed_reason",
]


def _request_pattern(space: str, part: str) -> str:
    """Method, path and perhaps protocol; ``part`` is a character of the latter two."""
    s = f"[{space}]"
    return (
        rf"{s}*+(?<method>[A-Z]++){s}++(?<path>{part}++)"
        rf"(?:{s}++(?<protocol>HTTP/{part}++))?{s}*+"
    )


def _standard_pattern(space: str) -> str:
    """host - - [timestamp] "request" status bytes, anything after it ignored.

    Timestamp and request each have a strict form, whose parts are captured, and
    a free form that only keeps the line matching. Quantifiers are possessive
    where what follows cannot start inside them, which rules out backtracking.
    """
    s, n = f"[{space}]", f"[^{space}]"
    in_quotes = f'[^"{space}]'
    stamp = (
        r"(?: (?=[1-9]/))?(?<day>3[01]|[12]\d|0[1-9]|[1-9])/(?<month>[A-Za-z]{3})/(?<year>\d{4})"
        r":(?<clock>(?<hour>2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d)"
        rf"{s}++(?<zone>{_ZONE})"
    )
    request = _request_pattern(space, in_quotes)
    return (
        rf"{s}*+(?<host>{n}++){s}++-{s}++-{s}++"
        rf"\[(?:{stamp}(?=\])|[^\]]++)\]{s}++"
        rf'"(?<request>(?:{request}(?=")|[^"]*+))"{s}++'
        rf"(?<status>\d{{3}}|-){s}++(?<bytes>{n}++)"
    )


def _loose_pattern(space: str) -> str:
    """Any ident and auth, single blanks, numeric status, optional request parts.

    The request holds up to three parts. Capitals at its start are the method; a blank directly after
    them, or at the very start, opens the path; what follows the path's blank is the protocol. So each
    part ends where its characters end, no other way to share them out can match a request that this
    one does not, and nothing is tried twice: a line takes time in proportion to its length.
    """
    s, n = f"[{space}]", f"[^{space}]"
    in_quotes = f'[^"{space}]'
    request = rf"(?<method>[A-Z]++)?+ ?+(?<path>{in_quotes}++)?+(?: (?<protocol>HTTP{in_quotes}*+)?+)?+"
    return (
        rf"{s}*+(?<host>{n}++) {n}++ {n}++ "
        r"\[(?<day>\d{2})/(?<month>\w{3})/(?<year>\d{4}):(?<clock>(?<hour>\d{2}):\d{2}:\d{2}) "
        rf"(?:(?<zone>{_ZONE})(?=\])|[^\]]++)\] "
        rf'"(?<request>{request})" '
        rf"(?<status>\d{{3}}) (?<bytes>{n}++)"
    )


def _pieces(line: Column, pattern_for) -> Column:
    """The captured pieces of a line as an array; all of them empty without a match."""

    def replaced(space: str) -> Column:
        pattern = pattern_for(space)
        # Numbered references cost a third less than named ones, per line.
        order = re.findall(r"\?<([a-z]+)>", pattern)
        joined = "\n".join(f"${order.index(name) + 1}" for name in _PIECES)
        numbered = re.sub(r"\?<[a-z]+>", "", pattern)
        return F.regexp_replace(line, rf"(?s)^(?:{numbered}.*|.*)", joined)

    wide = (F.octet_length(line) != F.length(line)) & line.rlike(f"[{WIDE_SPACE}]")
    text = F.when(wide, replaced(UNICODE_SPACE)).otherwise(replaced(ASCII_SPACE))
    return F.split(text, "\n", len(_PIECES))


def _iso_text(day: str, clock: str, zone: str) -> str:
    """Local time with its offset as SQL: ``yyyy-MM-ddTHH:mm:ss+hh:mm``.

    One-digit clock fields are rare; only they pay for the padding. Seconds of
    an offset, where the log has them, stay as written.
    """
    full_clock = rf"if(length({clock}) = 8, {clock}, regexp_replace({clock}, r'\b(\d)\b', '0$1'))"
    digits = f"replace({zone}, ':', '')"
    offset = f"""
        CASE WHEN {zone} IN ('Z', '-0000', '-00:00') THEN '+00:00'
             ELSE concat(substring({digits}, 1, 3), ':', substring({digits}, 4, 2),
                         if(length({digits}) > 5, concat(':', substring({digits}, 6)), '')) END"""
    return f"concat({day}, 'T', {full_clock}, {offset})"


def request_parts(request: Column) -> tuple[Column, Column, Column]:
    """Method, path and protocol of a bare request text, by the line's own grammar and in one match."""

    def replaced(space: str) -> Column:
        numbered = re.sub(r"\?<[a-z]+>", "", _request_pattern(space, f"[^{space}]"))
        return F.regexp_replace(request, rf"(?s)^(?:{numbered}|.*)$", "$1\n$2\n$3")

    wide = (F.octet_length(request) != F.length(request)) & request.rlike(f"[{WIDE_SPACE}]")
    parts = F.split(F.when(wide, replaced(UNICODE_SPACE)).otherwise(replaced(ASCII_SPACE)), "\n")
    method, path, protocol = (F.nullif(parts[i], F.lit("")) for i in range(3))
    whole = F.coalesce(path, F.nullif(request, F.lit("")), F.lit("/"))
    return F.coalesce(method, F.lit(UNKNOWN)), whole, F.coalesce(protocol, F.lit(UNKNOWN))


def parse_lines(lines: DataFrame, dialect: str = "clf", value: str = "value") -> DataFrame:
    """Add the record fields, ``event_time`` and ``malformed_reason`` to every line.

    No line is dropped: ``malformed_reason`` is null for a valid line and names
    the failed rule otherwise. Date and hour are wall clock of the logged zone,
    ``event_time`` is the instant. Works on batch and streaming input alike.

    Dialects: ``clf`` is the standard grammar; ``prefix`` takes the second word
    of the request as path and leaves it null without one; ``loose`` accepts any
    ident and auth and an incomplete request.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}, expected one of {DIALECTS}")
    loose = dialect == "loose"
    passed = [F.col(f"`{name}`") for name in lines.columns]
    text = _pieces(F.col(value), _loose_pattern if loose else _standard_pattern)
    split_lines = lines.select(*passed, text.alias("_split"))

    def at(name: str) -> str:
        return f"_split[{_PIECES.index(name)}]"

    names = ", ".join(f"'{m if loose else m.lower()}', '{number}'" for m, number in MONTHS.items())
    month = f"try_element_at(map({names}), {at('month') if loose else 'lower(' + at('month') + ')'})"
    day_text = f"concat({at('year')}, '-', {month}, '-', lpad({at('day')}, 2, '0'))"
    in_range = f"{at('year')} != '0000' AND try_cast({at('hour')} AS int) < 24"
    held = (
        split_lines.select(*passed, "_split", F.expr(day_text).alias("_day"))
        .select(*passed, "_split", "_day", F.expr(f"if({in_range}, try_cast(_day AS date), NULL)").alias("_date"))
        .select(*passed, F.expr("explode(array(struct(_split, _day, _date)))").alias("_line"))
    )

    piece = {name: f"_line._split[{i}]" for i, name in enumerate(_PIECES)}
    matched = f"coalesce({piece['host']}, '') != ''"
    dated = "_line._date IS NOT NULL"
    stamp = f"if({dated} AND {piece['zone']} != '', {_iso_text('_line._day', piece['clock'], piece['zone'])}, NULL)"
    paths = {
        "clf": f"""CASE WHEN {piece['path']} != '' THEN {piece['path']}
                        WHEN {piece['request']} != '' THEN {piece['request']} ELSE '/' END""",
        "prefix": rf"nullif(regexp_extract({piece['request']}, r'^[A-Z]+\s+(\S+)', 1), '')",
        "loose": f"nullif({piece['path']}, '')",
    }
    fields = {
        "host": piece["host"],
        "http_method": f"if({piece['method']} != '', {piece['method']}, '{UNKNOWN}')",
        "resource_path": paths[dialect],
        "protocol_version": f"if({piece['protocol']} != '', {piece['protocol']}, '{UNKNOWN}')",
        # A failed cast costs far more than a comparison, and a dash is common.
        "bytes_transferred": f"if({piece['bytes']} = '-', 0L, coalesce(try_cast({piece['bytes']} AS bigint), 0L))",
    }
    fields = {name: f"if({matched}, {text}, NULL)" for name, text in fields.items()}
    fields |= {
        "timestamp": stamp,
        "event_time": f"try_cast({stamp} AS timestamp)",
        "log_date": "_line._date",
        "log_hour": f"try_cast({piece['hour']} AS int)",
        "status_code": f"try_cast({piece['status']} AS int)",
        "malformed_reason": f"""CASE WHEN NOT ({matched}) THEN '{NO_MATCH}'
                                     WHEN {piece['status']} = '-' THEN '{NO_STATUS}'
                                     WHEN NOT ({dated}) THEN '{BAD_TIMESTAMP}' END""",
    }
    return held.select(*passed, *[F.expr(fields[name]).alias(name) for name in _PARSED])


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("malformed_reason").isNull()).drop("malformed_reason")


def malformed_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("malformed_reason").isNotNull())
