"""The registered queries in SQL, written from the tables and not from the Spark code; only the
names of the query-log fields are shared with it."""

from logweir.fixed_values import QUERY_LOG_FIELDS

EVENT_FIELDS = ["event_id", "user_id", "event_type", "value"]
ORDER_FIELDS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderpriority",
    "c_name",
    "c_acctbal",
    "c_mktsegment",
]

USAGE = """
  strftime(ts, '%d/%b/%Y') AS start_date, strftime(ts, '%H:%M') AS start_time,
  'np' || user_id AS id, 'onto_' || (user_id * 20) AS ontology,
  CASE event_type WHEN 'purchase' THEN 'Download' WHEN 'click' THEN 'Login'
    WHEN 'view' THEN 'Data Query' WHEN 'error' THEN 'API Access' ELSE 'Upload' END AS activity
"""

ENRICHED = f"""
  WITH usage AS (SELECT {USAGE} FROM events)
  SELECT usage.*, 'file_' || p_partkey || '.owl' AS filename, CAST(p_size AS VARCHAR) AS size_in_kb
  FROM usage LEFT JOIN part
    ON usage.ontology = 'onto_' || p_partkey AND usage.activity = 'Download'
"""

NOW = "TIMESTAMP '2024-02-01 12:34:56'"

BRONZE = f"""
  SELECT {USAGE}, {NOW} AS TimeGenerated, 'bus-1' AS input_file_path
  FROM events WHERE event_id % 10 <> 0
"""

SILVER = f"""
  SELECT {USAGE}, 'logm.omp.metadata' AS MetadataLogType, {NOW} AS MetadataLogTimeGenerated,
    20240201123456000 AS MetadataLogDate, '2024-02-01 12:34:56' AS TimeGenerated,
    'bus-1' AS MetadataLogFileName, 'tenant-1' AS TenantId, 'LOGM_OMP_MEATADATA_CL' AS Type
  FROM events WHERE event_id % 10 <> 0
"""


def _json(pairs):
    return " || ',' || ".join([f"""'"{name}":' || {value}""" for name, value in pairs])


def _quoted(text):
    return f"""'"' || {text} || '"'"""


_SILVER_BODY = "'{' || " + _json(
    [(name, _quoted(name)) for name in ("start_date", "start_time", "id", "ontology", "activity")]
    + [
        ("MetadataLogType", _quoted("MetadataLogType")),
        ("MetadataLogTimeGenerated", """'"2024-02-01T12:34:56.000"'"""),
        ("MetadataLogDate", "CAST(MetadataLogDate AS VARCHAR)"),
        ("TimeGenerated", _quoted("TimeGenerated")),
        ("MetadataLogFileName", _quoted("MetadataLogFileName")),
        ("TenantId", _quoted("TenantId")),
        ("Type", _quoted("Type")),
    ]
) + " || '}'"

_TAGS = """'tenant-1' AS TenantId, 'LOGM_DENODO_QUERIES_CL' AS "Type" """

_ORDER_PATH = "'/logs/AVDP' || (o_orderkey % 4 + 1) || '/queries.log.' || strftime(o_orderdate, '%m%d%Y')"


def _order_values(short):
    return [
        f"CAST({ORDER_FIELDS[at % 8]} AS VARCHAR)"
        if at < 3 or not short
        else f"CASE WHEN o_orderkey % 7 <> 0 THEN CAST({ORDER_FIELDS[at % 8]} AS VARCHAR) END"
        for at in range(24)
    ]


_ORDER_COLUMNS = ", ".join(
    f'{value} AS "{name}"' for value, name in zip(_order_values(True), QUERY_LOG_FIELDS)
)
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey"


def _order_body():
    ahead = """'{"TimeGenerated":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '",' || """
    three = _json([(n, _quoted(v)) for n, v in zip(QUERY_LOG_FIELDS[:3], _order_values(False))])
    rest = _json([(n, _quoted(v)) for n, v in zip(QUERY_LOG_FIELDS[3:], _order_values(False)[3:])])
    more = f"CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ',' || {rest} END"
    return f"""{ahead}{three} || {more} || ',"input_file_path":"' || {_ORDER_PATH} || '"' || '}}'"""


_LOG = "concat_ws(chr(9), " + ", ".join(
    f"CAST({EVENT_FIELDS[at % 4]} AS VARCHAR)" for at in range(24)
) + ")"
_LOG_ESCAPED = f"replace({_LOG}, chr(9), '\\t')"
_LINE = f"""
  CASE WHEN event_id % 50 = 1 THEN '{{"log":"' || {_LOG_ESCAPED} || '"}}'
    ELSE '{{"@timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","log":"'
      || {_LOG_ESCAPED} || '"}}' END
"""

_LATEST_UPDATE = """
  SELECT 'onto_' || (l_partkey * 2) AS ontology, 'file_' || l_orderkey || '.owl' AS filename,
    CAST(l_linenumber AS VARCHAR) AS size_in_kb,
    row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS place
  FROM lineitem
"""

_PART_METADATA = """
  SELECT 'onto_' || p_partkey AS ontology, 'file_' || p_partkey || '.owl' AS filename,
    CAST(p_size AS VARCHAR) AS size_in_kb
  FROM part
"""

UPSERTED = f"""
  WITH source AS ({_LATEST_UPDATE}), target AS ({_PART_METADATA})
  SELECT ontology, filename, size_in_kb FROM source WHERE place = 1
  UNION ALL
  SELECT * FROM target WHERE ontology NOT IN (SELECT ontology FROM source)
"""

PRICES = """
  WITH watched AS (
    SELECT p_name || ' ' || p_partkey AS Model, 'https://shop.example/item/' || p_partkey AS URL,
      CAST(11000 + p_size * 40 AS INTEGER) AS target,
      CASE WHEN p_partkey % 3 <> 2 THEN round(p_retailprice * 13, 2) END AS amount
    FROM part),
  judged AS (
    SELECT *, CASE WHEN amount IS NULL THEN 'Price not found'
      WHEN amount < target THEN 'Available at your price' ELSE 'Still at same price' END AS status
    FROM watched)
  SELECT Model, URL, target, CAST(amount AS DECIMAL(20, 6)) AS price, status,
    Model || ' Present Price: Rs.' || coalesce(CAST(amount AS VARCHAR), 'unknown')
      || ' Status:' || status AS line
  FROM judged
"""

STORED_LINES = f"""
  SELECT {", ".join(f'CAST({EVENT_FIELDS[at % 4]} AS VARCHAR) AS "{name}"' for at, name in enumerate(QUERY_LOG_FIELDS))},
    ts AS MetadataLogTimeGenerated,
    CAST(strftime(ts, '%Y%m%d%H%M%S%g') AS BIGINT) AS MetadataLogDate, 'tenant-1' AS TenantId
  FROM events WHERE event_id % 50 > 1
"""



def _streamed_gold(grown):
    """Gold as a stream; `grown` says which rows have the later metadata."""
    return f"""
      WITH usage AS (
        SELECT {USAGE}, event_id > (SELECT avg(event_id) FROM events) AS late FROM events)
      SELECT start_date, start_time, id, ontology, activity,
        'file_' || p_partkey || '.owl' AS filename,
        CASE WHEN {grown} AND p_partkey % 3 = 0 THEN p_size || '0'
          ELSE CAST(p_size AS VARCHAR) END AS size_in_kb
      FROM usage LEFT JOIN part
        ON usage.ontology = 'onto_' || p_partkey AND usage.activity = 'Download'"""


SQL = {
    "usage_parse_json": f"SELECT event_id, {USAGE} FROM events",
    "usage_props_json": "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events",
    "usage_other_fields": """
      SELECT event_id, 'np' || user_id AS id,
        CASE WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) ELSE 'Login' END AS activity,
        CASE event_id % 3
          WHEN 0 THEN '{"extra":{"kinds":["' || event_type || '",null],"n":' || event_id || '}}'
          WHEN 1 THEN '{"activity":' || user_id || ',"seen":[1,"' || event_type || '"]}' END AS rest
      FROM events""",
    "page_nested_element": """
      SELECT page_id, CASE WHEN contains(html, '</body>') THEN 'a' || page_id || 'bcd'
        || CASE WHEN page_id % 3 = 0 THEN '' ELSE 'ef' END END AS offer
      FROM pages""",
    "malformed_split": f"""
      SELECT event_id, event_id % 10 = 0 AS malformed,
        CASE WHEN event_id % 10 <> 0 THEN id END AS id,
        CASE WHEN event_id % 10 <> 0 THEN activity END AS activity
      FROM (SELECT event_id, {USAGE} FROM events)""",
    "log_split_24": f"""
      SELECT o_orderkey, {_ORDER_COLUMNS},
        CAST(CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 24 END AS INTEGER) AS n_fields
      FROM {_ORDERS}""",
    "file_date_extract": """
      SELECT o_orderkey,
        CASE WHEN o_orderkey % 4 < 3 THEN 'AVDP' || (o_orderkey % 4 + 1) ELSE '' END AS source_dir,
        CAST(o_orderdate AS DATE) AS file_day
      FROM orders""",
    "page_title_extract": r"""
      SELECT page_id, trim(regexp_replace(
        regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\s*>', 1), '<[^>]*>', '', 'g')) AS title
      FROM pages""",
    "json_log_scan": f"""
      SELECT CASE WHEN event_id % 50 > 1 THEN ts END AS event_time,
        CASE WHEN event_id % 50 > 0 THEN {_LOG} END AS log,
        CASE WHEN event_id % 50 = 0 THEN substr({_LINE}, 1, 40) END AS raw,
        'AVDP' || (event_id % 2 + 1) AS server, CAST(ts AS DATE) AS file_day
      FROM events""",
    "envelope_core": f"""
      SELECT event_id, user_id, event_type,
        sha256('{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
          || event_type || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
          || '","source":"bus-1"}}') AS MetadataLogId,
        'logm.denodo.queries' AS MetadataLogType, ts AS MetadataLogTimeGenerated,
        CAST(strftime(ts, '%Y%m%d%H%M%S%g') AS BIGINT) AS MetadataLogDate,
        '2024-02-01 12:34:56' AS TimeGenerated, 'bus-1' AS MetadataLogFileName, {_TAGS},
        CAST(strftime(ts, '%y%m%d%H%M') AS BIGINT) AS minute
      FROM events""",
    "query_log_envelope": f"""
      SELECT {_ORDER_COLUMNS}, sha256({_order_body()}) AS MetadataLogId,
        'logm.denodo.queries' AS MetadataLogType, o_orderdate AS MetadataLogTimeGenerated,
        CAST(strftime(o_orderdate, '%Y%m%d%H%M%S%g') AS BIGINT) AS MetadataLogDate,
        '2024-02-01 12:34:56' AS TimeGenerated, {_ORDER_PATH} AS MetadataLogFileName, {_TAGS}
      FROM {_ORDERS}""",
    "content_id_256": """
      SELECT event_id, sha256('{"event_type":"' || event_type || '","user_id":' || user_id
        || ',"props":"' || replace(props, '"', '\\"') || '"}') AS content_id
      FROM events""".replace("\\\\", "\\"),
    "log_guid_dense": """
      SELECT CAST(strftime(ts, '%y%m%d%H%M') AS BIGINT) AS minute,
        row_number() OVER (PARTITION BY date_trunc('minute', ts)) - 1 AS place
      FROM events""",
    "ingest_clock": "SELECT event_id, TRUE AS within_run FROM events",
    "log_guid_stable": """
      SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids,
        count(DISTINCT event_id) AS n_content_ids
      FROM events""",
    "log_since_watermark": """
      SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    "next_checkpoint": """
      SELECT strftime(max(ts), '%Y%m%d') AS file_date, max(ts) AS last_timegenerated FROM events""",
    "latest_checkpoint": """
      SELECT strftime(ts, '%Y%m%d') AS file_date, CAST(ts AS DATE) AS day,
        strftime(ts, '%m%d%Y') AS file_day, ts AS last_timegenerated
      FROM events ORDER BY ts DESC LIMIT 1""",
    "candidate_files": """
      WITH span AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders),
      days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
      SELECT day, 'AVDP' || n AS directory,
        '/logs/AVDP' || n || '/dev_azure_vdp' || n || '-queries.log.' || strftime(day, '%m%d%Y')
          AS path
      FROM days, (VALUES (1), (2)) AS servers(n)""",
    "late_rows_unseen": """
      SELECT event_id, sha256('{"event_id":' || event_id || ',"user_id":' || user_id
        || ',"event_type":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
        || '","source":"bus-1"}') AS MetadataLogId
      FROM events
      WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts <= TIMESTAMP '2024-01-15 00:00:00'
        AND event_type NOT IN ('view', 'click')""",
    "metadata_upsert": UPSERTED,
    "metadata_upsert_shuffled": UPSERTED,
    "metadata_upsert_bucketed": UPSERTED,
    "metadata_capture": f"""
      WITH source AS (
        SELECT 'onto_' || (user_id * 20) AS ontology, 'file_' || event_id || '.owl' AS filename,
          CAST(value AS VARCHAR) AS size_in_kb,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
        FROM events),
      target AS ({_PART_METADATA})
      SELECT ontology, filename, size_in_kb, 'bus-1' AS MetadataLogFileName,
        'LOGM_OMP_MEATADATA_CL' AS Type
      FROM source WHERE place = 1
      UNION ALL
      SELECT *, 'load', 'LOGM_DENODO_QUERIES_CL' FROM target
      WHERE ontology NOT IN (SELECT ontology FROM source)""",
    "usage_enrich": ENRICHED,
    "usage_enrich_shuffled": ENRICHED,
    "usage_enrich_concat": ENRICHED,
    "usage_bronze_rows": BRONZE,
    "usage_bronze_null_rows": f"""
      SELECT * FROM ({BRONZE}) UNION ALL
      SELECT NULL, NULL, NULL, NULL, NULL, {NOW}, 'bus-1' FROM events WHERE event_id % 10 = 0""",
    "usage_silver_rows": SILVER,
    "usage_gold_rows": f"""
      WITH silver AS ({SILVER})
      SELECT silver.*, sha256({_SILVER_BODY}) AS MetadataLogId,
        'file_' || p_partkey || '.owl' AS filename, CAST(p_size AS VARCHAR) AS size_in_kb
      FROM silver LEFT JOIN part
        ON ontology = 'onto_' || p_partkey AND activity = 'Download'""",
    "usage_stream_gold": ENRICHED,
    "usage_bronze_stream": f"""
      SELECT {USAGE}, 'bus-1-2024-02-01 12:34:56' AS input_file_path
      FROM events WHERE event_id % 10 <> 0""",
    "usage_quarantine": """
      SELECT substr('{"start_date":"' || strftime(ts, '%d/%b/%Y') || '"', 1, 20) AS body
      FROM events WHERE event_id % 10 = 0""",
    "usage_split_bronze": f"""
      SELECT {USAGE}, 'bus-1' AS input_file_path FROM events WHERE event_id % 10 <> 0""",
    "usage_split_quarantine": """
      SELECT substr('{"start_date":"' || strftime(ts, '%d/%b/%Y') || '"', 1, 20) AS body
      FROM events WHERE event_id % 10 = 0""",
    "metadata_capture_timed": """
      SELECT 'onto_' || (user_id * 20) AS ontology, 'file_' || max(event_id) || '.owl' AS filename,
        CAST(arg_max(value, event_id) AS VARCHAR) AS size_in_kb
      FROM events GROUP BY user_id""",
    "usage_stream_outcomes": """
      WITH marked AS (
        SELECT event_id % 10 = 0 AS broken,
          CAST(event_id > (SELECT avg(event_id) FROM events) AS BIGINT) AS batch_id FROM events)
      SELECT batch_id, 'OK' AS status, count(*) FILTER (NOT broken) AS n_good,
        count(*) FILTER (broken) AS n_malformed FROM marked GROUP BY batch_id
      UNION ALL SELECT NULL, 'EMPTY', 0, 0""",
    "usage_stream_clock": """
      SELECT count(*) AS n_rows, CAST(2 AS BIGINT) AS n_stamps, count(*) AS n_within FROM events""",
    "usage_stream_once": f"SELECT DISTINCT {USAGE} FROM events",
    "usage_gold_stream": _streamed_gold("late"),
    "usage_gold_corrected": _streamed_gold("TRUE"),
    "metadata_changes": f"""
      WITH updated AS ({UPSERTED}), part_metadata AS ({_PART_METADATA})
      SELECT ontology, CASE WHEN p.ontology IS NULL THEN 'added'
        WHEN u.ontology IS NULL THEN 'removed' ELSE 'updated' END AS change
      FROM updated u FULL JOIN part_metadata p USING (ontology)
      WHERE (u.filename, u.size_in_kb) IS DISTINCT FROM (p.filename, p.size_in_kb)""",
    "captured_rows": """
      SELECT CASE event_type WHEN 'purchase' THEN 'Download' WHEN 'click' THEN 'Login'
        WHEN 'view' THEN 'Data Query' WHEN 'error' THEN 'API Access' END AS activity,
        count(*) AS n_events
      FROM events GROUP BY 1""",
    "layer_checksums": """
      WITH marked AS (
        SELECT CAST(ts AS DATE) AS day, event_id % 997 = 5 AS lost, event_id % 997 = 505 AS again
        FROM events)
      SELECT day, count(*) AS n_upper, count(*) - count(*) FILTER (lost) + count(*) FILTER (again) AS n_lower
      FROM marked GROUP BY day HAVING bool_or(lost) OR bool_or(again)""",
    "layer_reconcile": """
      SELECT CAST(ts AS DATE) AS day,
        sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') AS content,
        CAST(1 AS BIGINT) AS n_upper, CAST(CASE WHEN event_id % 997 = 5 THEN 0 ELSE 2 END AS BIGINT) AS n_lower
      FROM events WHERE event_id % 997 IN (5, 505)""",
    "layer_validation": """
      WITH good AS (SELECT * FROM events WHERE event_id % 10 <> 0)
      SELECT 0 AS position, 'bronze' AS layer, count(*) AS n_rows,
        count(*) FILTER (event_id % 10 = 0) AS n_null_keys, TRUE AS schema_matches,
        CAST(NULL AS VARCHAR) AS follows, CAST(NULL AS BIGINT) AS row_delta FROM events
      UNION ALL
      SELECT 1, 'silver', count(*), 0, FALSE, 'bronze',
        count(*) - (SELECT count(*) FROM events) FROM good
      UNION ALL
      SELECT 2, 'metadata', count(*), 0, NULL, NULL, NULL FROM part
      UNION ALL
      SELECT 3, 'gold', count(*),
        count(*) FILTER (event_type <> 'purchase' OR user_id * 20 NOT IN (SELECT p_partkey FROM part)),
        NULL, 'silver', 0 FROM good""",
    "layer_preview": "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC LIMIT 20",
    "incremental_two_runs": STORED_LINES,
    "incremental_late_runs": STORED_LINES,
    "query_log_quarantine": f"""
      SELECT CASE WHEN event_id % 50 = 0 THEN substr({_LINE}, 1, 40) ELSE {_LINE} END AS raw,
        CASE WHEN event_id % 50 = 0 THEN 'unreadable' ELSE 'no event time' END AS reason
      FROM events WHERE event_id % 50 <= 1""",
    "query_log_checkpoint": """
      SELECT strftime(max(ts), '%Y%m%d') AS file_date, max(ts) AS last_timegenerated
      FROM events WHERE event_id % 50 > 1""",
    "query_log_status": """
      SELECT CAST(0 AS INTEGER) AS run, 'EMPTY' AS status, CAST(0 AS BIGINT) AS n_rows
      UNION ALL SELECT 1, 'OK', count(*) FROM events WHERE event_id % 50 > 1
      UNION ALL SELECT 2, 'EMPTY', 0""",
    "table_append": "SELECT event_id, ts, event_type, value FROM events",
    "table_replace": """
      SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders""",
    "price_status": PRICES,
    "price_status_shuffled": PRICES,
    "price_top_n": f"SELECT Model, status, line FROM ({PRICES}) ORDER BY Model LIMIT 5",
    "page_prices": """
      WITH newest AS (
        SELECT url, CASE WHEN contains(html, '</body>')
          THEN CAST(page_id % 5000 * 13 + 0.25 AS DOUBLE) END AS amount
        FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1),
      watched AS (
        SELECT 'item ' || page_id || '-' || k AS Model, pages.url AS URL,
          CAST(k * 20000 + 500 AS INTEGER) AS target, amount
        FROM pages CROSS JOIN range(3) AS products(k) LEFT JOIN newest ON pages.url = newest.url),
      judged AS (
        SELECT *, CASE WHEN amount IS NULL THEN 'Price not found'
          WHEN amount < target THEN 'Available at your price' ELSE 'Still at same price' END AS status
        FROM watched)
      SELECT Model, URL, target, CAST(amount AS DECIMAL(20, 6)) AS price, status,
        Model || ' Present Price: Rs.' || coalesce(CAST(amount AS VARCHAR), 'unknown')
          || ' Status:' || status AS line
      FROM judged""",
    "watchlist_csv": """
      SELECT p_name || ' ' || p_partkey AS Model, 'https://shop.example/item/' || p_partkey AS URL,
        CAST(11000 + p_size * 40 AS INTEGER) AS "Target Price"
      FROM part""",
    "price_report_lines": f"SELECT line FROM ({PRICES})",
}

# The same rows by another way.
SQL["metadata_capture_bucketed"] = SQL["metadata_capture"]
SQL["log_guid_dense_stream"] = SQL["log_guid_dense"]
SQL["query_log_stream"] = SQL["incremental_two_runs"]
SQL["query_log_stream_quarantine"] = SQL["query_log_quarantine"]
