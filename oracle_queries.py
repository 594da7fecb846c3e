"""DuckDB statements of every query's result, written apart from the Spark code.

They build the same log lines from ``events`` and parse them step by step.
"""

from __future__ import annotations

LINES = r"""
stamped AS (
  SELECT *, CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS batch_id,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') AS t,
    CASE WHEN event_id % 109 = 0 THEN ''
         WHEN event_id % 149 = 0 THEN 'GET /big HTTP/1.0'
         WHEN event_id % 193 = 0 THEN 'GET /é/日 HTTP/1.0'
         WHEN event_id % 197 = 0 THEN 'GET' || chr(160) || '/nb HTTP/1.0'
         WHEN event_id % 199 = 0 THEN 'GET' || chr(28) || '/fs HTTP/1.0'
         WHEN event_id % 211 = 0 THEN 'GET' || chr(9) || '/tab  HTTP/1.0 '
         WHEN event_id % 113 = 0 THEN 'GET /a b HTTP/1.0'
         WHEN event_id % 139 = 0 THEN 'GET /' || event_type
         ELSE 'GET /' || event_type || '/' || (event_id % 37) || ' HTTP/1.0' END AS request_text
  FROM events
),
lines AS (
  SELECT event_id, batch_id, request_text,
    CASE WHEN event_id % 101 = 0 THEN 'alyssa.p' ELSE
      CASE WHEN event_id % 191 = 0 THEN 'hü' ELSE 'h' END || user_id || '.example.com'
      || CASE WHEN event_id % 181 = 0 THEN ' bob alice [' ELSE ' - - [' END
      || CASE WHEN event_id % 127 = 0 THEN replace(t, 'Jan', 'Foo')
              WHEN event_id % 131 = 0 THEN '31/Feb/' || substr(t, 8)
              WHEN event_id % 173 = 0 THEN strftime(ts, '%-d/%b/%Y:%-H:%-M:%-S')
              WHEN event_id % 179 = 0 THEN lower(t) ELSE t END
      || CASE WHEN event_id % 157 = 0 THEN ' Z' WHEN event_id % 163 = 0 THEN ' +05:30'
              WHEN event_id % 167 = 0 THEN ' -0000' ELSE ' -0400' END
      || '] "' || request_text || '" '
      || CASE WHEN event_id % 103 = 0 THEN '-'
              WHEN event_type = 'error' AND event_id % 3 = 0 THEN '500'
              WHEN event_type = 'error' THEN '404'
              WHEN event_type = 'click' THEN '304'
              WHEN event_type = 'signup' THEN '302' ELSE '200' END
      || ' '
      || CASE WHEN event_id % 107 = 0 THEN 'abc' WHEN event_id % 149 = 0 THEN '9223372036854775807'
              WHEN event_id % 151 = 0 THEN '-7' WHEN event_type = 'click' THEN '-'
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
    END AS line
  FROM stamped
)
"""

# Fixed value: white space as the log grammar understands it.
_S = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _words(text: str) -> str:
    """The words of a text as a list, parted by any white space."""
    return f"list_filter(regexp_split_to_array({text}, '{_S}+'), lambda x: x <> '')"


# A request is known if it is two or three words, in capitals, any, HTTP/ and more.
_SPLIT = f"""
  CASE WHEN known THEN w[1] ELSE 'UNKNOWN' END AS http_method,
  CASE WHEN known THEN w[2] ELSE coalesce(nullif(request_text, ''), '/') END AS resource_path,
  CASE WHEN known AND len(w) = 3 THEN w[3] ELSE 'UNKNOWN' END AS protocol_version
"""
_KNOWN = """(len(w) = 2 OR len(w) = 3 AND starts_with(w[3], 'HTTP/') AND length(w[3]) > 5)
  AND w[1] = upper(w[1]) AND regexp_full_match(w[1], '[A-Z]+')"""

_MONTHS = "['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec']"

_OFFSET = "CASE WHEN zone IN ('Z', '-0000') THEN '+00:00' ELSE left(zone, 3) || ':' || right(zone, 2) END"

# Lines are taken apart at quotes and brackets, and these parts at white space.
CLF = rf"""
WITH {LINES},
cut AS (
  SELECT event_id, batch_id, line, {_words("split_part(split_part(line, '\"', 1), '[', 1)")} AS before,
    split_part(split_part(line, '[', 2), ']', 1) AS stamp,
    split_part(line, '"', 2) AS request_text,
    {_words("split_part(line, '\"', 3)")} AS after
  FROM lines
),
pieces AS (
  SELECT *, {_words("request_text")} AS w, string_split(split_part(stamp, ' ', 1), ':') AS c,
    split_part(stamp, ' ', 2) AS zone, string_split(split_part(stamp, ':', 1), '/') AS d,
    len(before) = 3 AND before[2] = '-' AND before[3] = '-' AND len(after) = 2 AND stamp <> ''
      AND (after[1] = '-' OR regexp_full_match(after[1], '[0-9]{{3}}')) AS matched
  FROM cut
),
dated AS (
  SELECT *, {_KNOWN} AS known, TRY_CAST(after[1] AS INTEGER) AS status_code,
    TRY_CAST(d[3] || '-' || lpad(CAST(list_position({_MONTHS}, lower(d[2])) AS VARCHAR), 2, '0')
      || '-' || lpad(d[1], 2, '0') AS DATE) AS log_date
  FROM pieces
),
parsed AS (
  SELECT event_id, batch_id, line, before[1] AS host, {_SPLIT}, request_text, zone, status_code, log_date,
    TRY_CAST(c[2] AS INTEGER) AS log_hour,
    log_date + to_hours(TRY_CAST(c[2] AS INTEGER)) + to_minutes(TRY_CAST(c[3] AS INTEGER))
      + to_seconds(TRY_CAST(c[4] AS INTEGER)) AS wall,
    coalesce(TRY_CAST(after[2] AS BIGINT), 0) AS bytes_transferred,
    CASE WHEN NOT matched THEN 'no_match' WHEN after[1] = '-' THEN 'no_status'
         WHEN log_date IS NULL THEN 'bad_timestamp' END AS reason
  FROM dated
),
records AS (
  SELECT *, strftime(wall, '%Y-%m-%dT%H:%M:%S') || {_OFFSET} AS "timestamp"
  FROM parsed WHERE reason IS NULL
)
"""

# Fixed value: the second word of a request as the prefix dialect finds it, with ASCII white space only.
_SECOND = r"nullif(regexp_extract(request_text, '^[A-Z]+\s+(\S+)', 1), '')"

PREFIX = f"""{CLF},
prefixed AS (SELECT * REPLACE ({_SECOND} AS resource_path) FROM records)
"""

# Fixed value: the loose dialect's line. It has ten groups and DuckDB extracts nine, so it is matched twice,
# once for the first five (_HEAD with a group each) and once for the others.
_N, _Q = "[^" + _S[1:], '[^"' + _S[1:]
_HEAD = rf"^({_N}+) {_N}+ {_N}+ \[(\d{{2}})/(\w{{3}})/(\d{{4}}):(\d{{2}}):\d{{2}}:\d{{2}} [^\]]+\]"
_PLAIN_HEAD = rf"^{_N}+ {_N}+ {_N}+ \[\d{{2}}/\w{{3}}/\d{{4}}:\d{{2}}:\d{{2}}:\d{{2}} [^\]]+\]"
_TAIL = rf' "([A-Z]+)? ?({_Q}+)? ?(HTTP{_Q}*)?" (\d{{3}}) ({_N}+)'

LOOSE = f"""
WITH {LINES},
pieces AS (
  SELECT event_id, batch_id, line,
    regexp_extract(line, '{_HEAD}', 1) AS host,
    regexp_extract(line, '{_HEAD}', 2) AS d,
    regexp_extract(line, '{_HEAD}', 3) AS m,
    regexp_extract(line, '{_HEAD}', 4) AS y,
    regexp_extract(line, '{_HEAD}', 5) AS h,
    coalesce(nullif(regexp_extract(line, '{_PLAIN_HEAD}{_TAIL}', 1), ''), 'UNKNOWN') AS http_method,
    nullif(regexp_extract(line, '{_PLAIN_HEAD}{_TAIL}', 2), '') AS resource_path,
    coalesce(nullif(regexp_extract(line, '{_PLAIN_HEAD}{_TAIL}', 3), ''), 'UNKNOWN') AS protocol_version,
    CAST(regexp_extract(line, '{_PLAIN_HEAD}{_TAIL}', 4) AS INTEGER) AS status_code,
    coalesce(TRY_CAST(regexp_extract(line, '{_PLAIN_HEAD}{_TAIL}', 5) AS BIGINT), 0) AS bytes_transferred,
    split_part(split_part(line, '[', 2), ']', 1) AS stamp
  FROM lines WHERE regexp_matches(line, '{_PLAIN_HEAD}{_TAIL}')
),
dated AS (
  SELECT *, CASE WHEN m = upper(m[1]) || lower(m[2:]) THEN
      CAST(try_strptime(d || '/' || m || '/' || y, '%d/%b/%Y') AS DATE) END AS log_date,
    CAST(h AS INTEGER) AS log_hour, split_part(stamp, ' ', 2) AS zone FROM pieces
),
records AS (
  SELECT *, strftime(log_date, '%Y-%m-%d') || 'T' || substr(stamp, 13, 8) || {_OFFSET} AS "timestamp"
  FROM dated WHERE log_date IS NOT NULL
)
"""

_RECORD = """host, "timestamp", log_date, log_hour, http_method, resource_path, protocol_version,
  status_code, bytes_transferred"""


def _q1(source: str = "records") -> str:
    return f"""SELECT log_date, status_code, count(*) AS request_count,
  CAST(sum(bytes_transferred) AS DECIMAL(30, 0)) AS total_bytes FROM {source} GROUP BY log_date, status_code"""


def _q2(source: str = "records", rank: bool = True) -> str:
    position = (
        ", CAST(row_number() OVER (ORDER BY request_count DESC, resource_path) AS INTEGER) AS rank"
        if rank
        else ""
    )
    return f"""SELECT *{position} FROM (
  SELECT resource_path, count(*) AS request_count, CAST(sum(bytes_transferred) AS DECIMAL(30, 0)) AS total_bytes,
    count(DISTINCT host) AS distinct_host_count
  FROM {source} WHERE resource_path IS NOT NULL GROUP BY resource_path
  ORDER BY request_count DESC, resource_path LIMIT 20)"""


def _q3(source: str = "records", digits: bool = True) -> str:
    errors = "CAST(count(*) FILTER (WHERE status_code BETWEEN 400 AND 599) AS DOUBLE) / count(*)"
    rate = f"round({errors}, 4)" if digits else errors
    return f"""SELECT log_date, log_hour,
  count(*) FILTER (WHERE status_code BETWEEN 400 AND 599) AS error_request_count,
  count(*) AS total_request_count, {rate} AS error_rate,
  count(DISTINCT host) FILTER (WHERE status_code BETWEEN 400 AND 599) AS distinct_error_hosts
  FROM {source} GROUP BY log_date, log_hour"""


_BATCHES = """SELECT CAST(batch_id AS INTEGER) AS batch_id,
  count(*) FILTER (WHERE reason IS NULL) AS records_processed,
  count(*) FILTER (WHERE reason IS NOT NULL) AS malformed_records FROM parsed GROUP BY batch_id"""

_COUNTS = """SELECT count(*) FILTER (WHERE reason IS NULL) AS total_records,
  count(*) FILTER (WHERE reason IS NOT NULL) AS malformed_records FROM parsed"""

_RUN_2 = "(SELECT * FROM records WHERE batch_id = 2)"

_RUNS = """WITH runs AS (
  SELECT 'r' || o_orderkey AS run_id, o_orderpriority AS pipeline_name, o_orderkey % 1000 AS total_records,
    o_orderkey % 7 AS malformed_records, (o_orderkey % 1000) / 2.0::DOUBLE AS avg_batch_size,
    CAST(floor(o_totalprice) AS BIGINT) AS execution_time_ms, o_orderdate AS created_at, o_orderkey
  FROM orders)
"""


_SHOWN = 'SELECT host, "timestamp", resource_path, status_code, bytes_transferred FROM records'


def oracle_sql() -> dict[str, str]:
    q1, q2, q3 = CLF + _q1(), CLF + _q2(), CLF + _q3()
    batches = CLF + _BATCHES
    combined = (
        CLF
        + f"""SELECT CAST(to_json({{
            q1: (SELECT list({{log_date: log_date, status_code: status_code, request_count: request_count,
                   total_bytes: total_bytes}} ORDER BY log_date, status_code) FROM ({_q1()})),
            q2: (SELECT list({{resource_path: resource_path, request_count: request_count, total_bytes: total_bytes,
                   distinct_host_count: distinct_host_count, rank: rank}} ORDER BY rank) FROM ({_q2()})),
            q3: (SELECT list({{log_date: log_date, log_hour: log_hour, error_request_count: error_request_count,
                   total_request_count: total_request_count, error_rate: error_rate,
                   distinct_error_hosts: distinct_error_hosts}} ORDER BY log_date, log_hour) FROM ({_q3()})),
            total_records: (SELECT count(*) FROM records),
            malformed_records: (SELECT count(*) FROM parsed WHERE reason IS NOT NULL),
            batch_count: (SELECT count(DISTINCT batch_id) FROM parsed)}}) AS VARCHAR) AS result_json"""
    )
    return {
        "parse_clf": CLF
        + f"""SELECT event_id, {_RECORD}, CAST(epoch(wall) AS BIGINT)
          - CASE WHEN zone = '-0400' THEN -14400 WHEN zone = '+05:30' THEN 19800 ELSE 0 END AS event_epoch FROM records""",
        "parse_clf_loose": LOOSE + f"SELECT event_id, {_RECORD} FROM records",
        "parse_path_prefix": PREFIX + "SELECT event_id, resource_path FROM prefixed",
        "request_split": f"""WITH {LINES},
          w AS (SELECT *, {_words("request_text")} AS w FROM lines), k AS (SELECT *, {_KNOWN} AS known FROM w)
          SELECT event_id, {_SPLIT} FROM k""",
        "malformed_lines": CLF
        + "SELECT event_id, line AS value, reason AS malformed_reason FROM parsed WHERE reason IS NOT NULL",
        "error_tag": CLF
        + """SELECT event_id, status_code,
          CASE WHEN status_code >= 400 AND status_code < 600 THEN 1 ELSE 0 END AS is_error FROM records""",
        "record_counts": CLF + _COUNTS,
        "row_count": CLF + "SELECT count(*) AS row_count FROM records",
        "union_batches": f"""WITH {LINES}
          SELECT CAST(batch_id AS INTEGER) AS batch_id, count(*) AS row_count FROM lines GROUP BY batch_id""",
        "batch_stats": batches,
        "file_batch_stats": batches,
        "empty_file_batches": batches + " UNION ALL SELECT 3, 0, 0",
        "parsed_store_batches": batches,
        "batch_size_summary": CLF
        + f"""SELECT count(*) AS total_batches, CAST(sum(records_processed) AS BIGINT) AS total_records,
          CAST(sum(malformed_records) AS BIGINT) AS malformed_records,
          avg(records_processed) AS avg_batch_size, max(records_processed) AS largest_batch_size
          FROM ({_BATCHES})""",
        "chunk_stats": CLF
        + """SELECT CAST(batch_id AS INTEGER) AS batch_id, (n - 1) // 1000 + 1 AS chunk_id,
          count(*) FILTER (WHERE reason IS NULL) AS good_records,
          count(*) FILTER (WHERE reason IS NOT NULL) AS malformed_records
          FROM (SELECT batch_id, reason, row_number() OVER (PARTITION BY batch_id ORDER BY event_id) AS n
                FROM parsed) GROUP BY 1, 2""",
        "file_chunk_stats": CLF
        + """SELECT CAST(batch_id AS INTEGER) AS batch_id, event_id // 2000 AS part, (n - 1) // 300 + 1 AS chunk_id,
          count(*) FILTER (WHERE reason IS NULL) AS good_records,
          count(*) FILTER (WHERE reason IS NOT NULL) AS malformed_records
          FROM (SELECT batch_id, event_id, reason,
                  row_number() OVER (PARTITION BY batch_id, event_id // 2000 ORDER BY event_id) AS n
                FROM parsed) GROUP BY 1, 2, 3""",
        "file_chunk_stats_single": CLF
        + """SELECT CAST(batch_id AS INTEGER) AS batch_id, event_id // 2000 AS part,
          row_number() OVER (PARTITION BY batch_id, event_id // 2000 ORDER BY event_id) AS chunk_id,
          CAST(reason IS NULL AS BIGINT) AS good_records, CAST(reason IS NOT NULL AS BIGINT) AS malformed_records
          FROM parsed""",
        "q1_daily_traffic": q1,
        "q2_top_resources": q2,
        "q2_top_resources_two_pass": q2,
        "q3_hourly_errors": q3,
        "q1_sql": q1,
        "q2_sql": CLF + _q2(rank=False),
        "q3_sql": CLF + _q3(digits=False),
        "q1_prefix": PREFIX + _q1("prefixed"),
        "q2_prefix": PREFIX + _q2("prefixed"),
        "q3_prefix": PREFIX + _q3("prefixed"),
        "q2_latin1": CLF + _q2("(SELECT * REPLACE (replace(resource_path, '日', '?') AS resource_path) FROM records)"),
        "q1_loose": LOOSE + _q1(),
        "q2_loose": LOOSE + _q2("dated"),
        "q3_loose": LOOSE + _q3(),
        "tsv_roundtrip": CLF + f"SELECT {_RECORD} FROM records",
        "tsv_roundtrip_q1": q1,
        "tsv_roundtrip_q2": CLF + _q2(rank=False),
        "tsv_roundtrip_q3": q3,
        "tsv_roundtrip_counts": CLF + _COUNTS,
        "json_roundtrip_q1": q1,
        "json_roundtrip_q2": q2,
        "json_roundtrip_q3": q3,
        "combined_json": combined,
        "combined_json_pieces": combined,
        "combined_json_totals": CLF + f"""SELECT CAST(sum(records_processed) AS BIGINT) AS total_records,
          CAST(sum(malformed_records) AS BIGINT) AS malformed_records, count(*) AS batch_count FROM ({_BATCHES})""",
        "combined_json_q1": q1,
        "combined_json_q2": q2,
        "combined_json_q3": q3,
        "parsed_store_q1": q1,
        "parsed_store_q2": q2,
        "parsed_store_q3": q3,
        "lookup_host": CLF + _SHOWN + " WHERE host = 'h7.example.com'",
        "lookup_path": CLF + _SHOWN + " WHERE resource_path IN ('/big', '/é/日') AND log_hour < 6",
        "lookup_status": CLF + _SHOWN + " WHERE status_code = 500 AND log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'",
        "merged_q1": q1,
        "merged_q2": q2,
        "merged_q3": q3,
        "merged_hosts": CLF + "SELECT log_date, count(DISTINCT host) AS distinct_hosts FROM records GROUP BY log_date",
        "stored_q1_rollup": CLF + f"SELECT 'Spark' AS pipeline_name, * FROM ({_q1(_RUN_2)})",
        "report_traffic": CLF + _q1(_RUN_2) + " ORDER BY log_date, status_code LIMIT 20",
        "report_top_resources": CLF + f"SELECT *, left(resource_path, 50) AS shown_path FROM ({_q2(_RUN_2)})",
        "report_hourly_errors": CLF + _q3(_RUN_2) + " ORDER BY log_date, log_hour LIMIT 20",
        "stored_top_resources": CLF + f"SELECT 'Spark' AS pipeline_name, * FROM ({_q2(_RUN_2)})",
        "stored_hourly_errors": CLF + f"SELECT 'Spark' AS pipeline_name, * FROM ({_q3(_RUN_2)})",
        "run_record": CLF
        + f"""SELECT 'Spark' AS pipeline_name, 5000 AS batch_size, CAST(count(*) AS INTEGER) AS total_batches,
          CAST(sum(records_processed) AS BIGINT) AS total_records,
          CAST(sum(malformed_records) AS BIGINT) AS malformed_records,
          avg(records_processed) AS avg_batch_size, 'all' AS query_name FROM ({_BATCHES})""",
        "run_batches": CLF
        + f"""SELECT batch_id, records_processed AS batch_size, records_processed, malformed_records
          FROM ({_BATCHES})""",
        "run_line_batches": CLF
        + """SELECT row_number() OVER (ORDER BY b, p, chunk)::INT AS batch_id, records_processed AS batch_size, records_processed, malformed_records
          FROM (SELECT b, p, (n - 1) // 1000 AS chunk, count(*) FILTER (WHERE reason IS NULL) AS records_processed,
                  count(*) FILTER (WHERE reason IS NOT NULL) AS malformed_records
                FROM (SELECT batch_id::VARCHAR AS b, (event_id // 2000)::VARCHAR AS p, reason,
                        row_number() OVER (PARTITION BY batch_id, event_id // 2000 ORDER BY event_id) AS n FROM parsed) GROUP BY ALL)""",
        "run_malformed_summary": CLF
        + f"""SELECT 'Spark' AS pipeline_name, batch_id, malformed_records AS malformed_record_count
          FROM ({_BATCHES})""",
        "run_query_result": CLF
        + f"""SELECT 3 AS query_id, 'query3' AS query_name, '{{}}' AS result_json,
          count(*) AS stored_rows FROM ({_q3()})""",
        "latest_run": _RUNS + "SELECT run_id FROM runs ORDER BY created_at DESC, run_id LIMIT 1",
        "run_history": _RUNS
        + """SELECT run_id, pipeline_name, total_records, malformed_records, execution_time_ms, avg_batch_size,
          created_at, coalesce(query_name, 'all') AS query_name
          FROM runs LEFT JOIN (
            SELECT 'r' || o_orderkey AS run_id,
              ['all', 'query1', 'query2', 'query3'][o_orderkey % 4 + 1] AS query_name
            FROM orders WHERE o_orderkey % 3 <> 0) USING (run_id)
          ORDER BY created_at DESC, run_id LIMIT 20""",
        "monthly_history": _RUNS
        + """SELECT run_id, pipeline_name, total_records, malformed_records, execution_time_ms, avg_batch_size,
          created_at, coalesce(query_name, 'all') AS query_name
          FROM runs LEFT JOIN (
            SELECT 'r' || o_orderkey AS run_id,
              ['all', 'query1', 'query2', 'query3'][o_orderkey % 4 + 1] AS query_name
            FROM orders WHERE o_orderkey % 3 <> 0) USING (run_id)
          ORDER BY created_at DESC, run_id LIMIT 20""",
        "run_comparison": _RUNS
        + """SELECT pipeline_name, count(*) AS runs, CAST(round(avg(execution_time_ms)) AS BIGINT) AS avg_ms,
          min(execution_time_ms) AS min_ms, max(execution_time_ms) AS max_ms,
          CAST(sum(total_records) AS BIGINT) AS total_records FROM runs GROUP BY pipeline_name""",
    }
