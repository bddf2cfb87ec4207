"""The same results in DuckDB SQL, straight from the given tables."""

from __future__ import annotations

from checks.queries import AS_OF, RANGE

# The log of FIXTURES.md, its raw lines, and the lines that hold a record.
BASE = """
WITH log AS (
  SELECT e.event_id, e.ts,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS time,
         '/p/' || json_extract_string(e.props, '$.k') AS page,
         CASE WHEN e.event_id % 13 <> 0 THEN 'u' || CAST(e.user_id AS varchar) END AS openid,
         CAST(CASE e.event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                                WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS integer)
           AS event_type,
         r.r_name AS province,
         n.n_name AS city,
         CAST(CAST(json_extract_string(e.props, '$.k') AS integer) % 5 + 1 AS varchar) AS cid,
         json_extract_string(e.props, '$.k') AS pid,
         CAST(e.value AS decimal(18,2)) AS total_money
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
), whole AS (
  SELECT *,
         '{"time":"' || time || '","page":"' || page || '",'
         || CASE WHEN openid IS NULL THEN '' ELSE '"openid":"' || openid || '",' END
         || '"event_type":' || event_type || ',"province":"' || province || '","city":"' || city
         || '","cid":"' || cid || '","pid":"' || pid || '","total_money":' || total_money || '}'
           AS text
  FROM log
), lines AS (
  SELECT event_id,
         CAST(event_id % 3 AS integer) AS "partition",
         event_id // 3 AS "offset",
         CASE WHEN event_id % 101 = 0 THEN ''
              WHEN event_id % 97 = 0 THEN substr(text, 1, 12)
              ELSE text END AS value,
         CASE WHEN event_id % 101 = 0 THEN 'blank' WHEN event_id % 97 = 0 THEN 'corrupt' END AS kind
  FROM whole
), rec AS (
  SELECT *, CAST(CAST(time AS timestamp) AS date) AS dt,
         CASE cid WHEN '1' THEN 'books' WHEN '2' THEN 'clothing' WHEN '3' THEN 'furniture'
                  WHEN '4' THEN 'phones' ELSE 'unknown' END AS category
  FROM log WHERE event_id % 101 <> 0 AND event_id % 97 <> 0
)
"""

RECORD = (
    "time, page, openid, event_type, province, city, cid, pid, total_money, "
    "time AS event_time, dt"
)
AMOUNT = "CAST(sum(total_money) AS decimal(38,2)) AS total_money"
VIEWS = """
  SELECT category, pid, count(*) AS views FROM rec
  WHERE event_type = 1 AND cid IS NOT NULL AND openid IS NOT NULL GROUP BY category, pid
"""
TOTAL = f"SELECT {AMOUNT} FROM rec"
TODAY = f"{TOTAL} WHERE time >= '{AS_OF[:10]} 00:00:00' AND time <= '{AS_OF}'"
BY_DAY = f"SELECT dt, {AMOUNT} FROM rec GROUP BY dt"
BY_CATEGORY = f"SELECT category, {AMOUNT} FROM rec GROUP BY category"
BY_PROVINCE = f"SELECT province, {AMOUNT} FROM rec GROUP BY province"
KPIS = f"""
  SELECT 'total' AS kpi, 'all' AS key, total_money AS value FROM ({TOTAL})
  UNION ALL SELECT 'day', CAST(dt AS varchar), total_money FROM ({BY_DAY})
  UNION ALL SELECT 'category', category, total_money FROM ({BY_CATEGORY})
  UNION ALL SELECT 'province', province, total_money FROM ({BY_PROVINCE})
"""
OFFSETS = """
  SELECT 'access' AS topic, "partition", min("offset") AS from_offset,
         max("offset") + 1 AS until_offset
  FROM lines GROUP BY "partition"
"""

RAW_PV = """
        SELECT count(*) AS pv_raw, count(*) FILTER (kind IS NULL) AS parsed,
               count(*) FILTER (kind IS NOT NULL) AS malformed,
               (SELECT count(openid) FROM rec) AS pv,
               (SELECT count(DISTINCT openid) FROM rec) AS uv
        FROM lines"""

AREAS = """
        SELECT openid, province, city, count(*) AS views FROM rec
        WHERE openid IS NOT NULL GROUP BY openid, province, city"""

_BODIES = {
    "raw_pv": RAW_PV,
    "visits": """
        SELECT true AS ok, openid, province, city, count(*) AS views
        FROM rec GROUP BY openid, province, city
        UNION ALL SELECT false, NULL, NULL, NULL, count(*) FROM lines
        WHERE kind IS NOT NULL HAVING count(*) > 0""",
    "visits_traffic": RAW_PV,
    "visits_areas": AREAS,
    "pv_uv": """
        SELECT count(*) AS pv, count(DISTINCT openid) AS uv FROM rec WHERE openid IS NOT NULL""",
    "traffic_report": f"""
        SELECT '{AS_OF}' AS report_time, count(*) AS pv, count(DISTINCT openid) AS uv
        FROM rec WHERE openid IS NOT NULL""",
    "malformed_lines": """
        SELECT kind, count(*) AS lines FROM lines WHERE kind IS NOT NULL GROUP BY kind""",
    "records": f"SELECT {RECORD} FROM rec",
    "identified_json": f"SELECT {RECORD} FROM rec WHERE openid IS NOT NULL",
    "area_distribution": AREAS,
    "area_by_place": """
        SELECT province, city, count(*) AS views FROM rec
        WHERE openid IS NOT NULL GROUP BY province, city""",
    "visitor_provinces": """
        SELECT DISTINCT openid, province FROM rec WHERE openid IS NOT NULL""",
    "first_visitor_provinces": """
        SELECT DISTINCT openid, province FROM rec WHERE openid IS NOT NULL
        ORDER BY openid, province LIMIT 10""",
    "sql_report_provinces": """
        SELECT DISTINCT openid, province FROM rec WHERE openid IS NOT NULL""",
    "line_report_traffic": RAW_PV,
    "line_report_shared_traffic": RAW_PV,
    "line_report_shared_areas": AREAS,
    "line_report_malformed": """
        SELECT kind, count(*) AS lines FROM lines WHERE kind IS NOT NULL GROUP BY kind""",
    "labelled_records": "SELECT cid, category, pid, total_money FROM rec",
    "category_product_views": VIEWS,
    "top_products": f"""
        SELECT category, pid, views, "rank" FROM (
          SELECT *, row_number() OVER (PARTITION BY category ORDER BY views DESC, pid) AS "rank"
          FROM ({VIEWS})) WHERE "rank" <= 2""",
    "top_products_many": f"""
        SELECT category, pid, views, "rank" FROM (
          SELECT *, row_number() OVER (PARTITION BY category ORDER BY views DESC, pid) AS "rank"
          FROM ({VIEWS})) WHERE "rank" <= 2000""",
    "total_sales": TOTAL,
    "sales_today": TODAY,
    "sales_by_day": BY_DAY,
    "sales_by_category": BY_CATEGORY,
    "sales_by_province": BY_PROVINCE,
    "sales_kpis": KPIS,
    "range_filter": f"""
        SELECT time, page, openid, total_money FROM rec
        WHERE time >= '{RANGE[0]}' AND time < '{RANGE[1]}'""",
    "kafka_values": 'SELECT "partition", "offset", value FROM lines',
    "offset_ranges": OFFSETS,
    "starting_offsets": f"""
        SELECT '{{"access":{{' || string_agg('"' || "partition" || '":' || until_offset, ','
                 ORDER BY "partition") || '}}}}' AS starting_offsets
        FROM ({OFFSETS})""",
    "dedup_replay": 'SELECT \'access\' AS topic, "partition", "offset", value FROM lines',
    "stream_drop_replayed": """
        SELECT 'access' AS topic, "partition", "offset", value FROM lines""",
    "recode_lines": """
        SELECT event_id,
               CASE cid WHEN '1' THEN '图书' WHEN '2' THEN '服装' WHEN '3' THEN '家具'
                        WHEN '4' THEN '手机' ELSE 'unknown' END || ' ' || city AS value
        FROM log""",
    "recode_lines_gbk": """
        SELECT event_id,
               CASE cid WHEN '1' THEN '图书' WHEN '2' THEN '服装' WHEN '3' THEN '家具'
                        WHEN '4' THEN '手机' ELSE 'unknown' END || ' ' || city AS value
        FROM log""",
    "stream_total_sales": TOTAL,
    "stream_sales_by_day": BY_DAY,
    "stream_sales_by_category": BY_CATEGORY,
    "stream_sales_by_province": BY_PROVINCE,
    "stream_sales_by_brand": f"""
        SELECT coalesce(p_brand, 'unknown') AS brand, {AMOUNT}
        FROM rec LEFT JOIN part ON CAST(p_partkey AS varchar) = cid GROUP BY 1""",
    "stream_kpis": KPIS,
    "stream_uv": """
        SELECT count(*) AS pv, count(DISTINCT openid) AS uv FROM rec WHERE openid IS NOT NULL""",
    "stream_uv_by_day": """
        SELECT dt, count(DISTINCT openid) AS uv FROM rec WHERE openid IS NOT NULL GROUP BY dt""",
    "stream_top_products": f"""
        SELECT category, pid, views, "rank" FROM (
          SELECT *, row_number() OVER (PARTITION BY category ORDER BY views DESC, pid) AS "rank"
          FROM ({VIEWS})) WHERE "rank" <= 2""",
    "stream_archive": f"SELECT {RECORD} FROM rec",
    "archive_sales_today": TODAY,
    "stream_tail": "SELECT value FROM lines WHERE value <> ''",
    "stream_tail_rotated": "SELECT value FROM lines WHERE value <> ''",
    "stream_tail_capped": """
        SELECT value FROM lines, range(2) WHERE value <> ''""",
    "stream_offset_ranges": OFFSETS,
    "stream_quarantine": """
        SELECT "partition", "offset", value, kind FROM lines WHERE kind IS NOT NULL""",
    "job_kpis": KPIS,
    "job_offsets": OFFSETS,
    "job_malformed": """
        SELECT "partition", "offset", value, kind FROM lines WHERE kind IS NOT NULL""",
    "job_archive": f"SELECT {RECORD} FROM rec",
    "job_planned_offsets": f"""
        SELECT topic, "partition", from_offset, until_offset, 3 AS batches, 0 AS gaps
        FROM ({OFFSETS}) UNION ALL SELECT 'access', 3, 0, 0, 3, 0""",
    "job_handed_over_kpis": KPIS,
    "job_handed_over_archive": f"SELECT {RECORD} FROM rec",
    "job_compacted_archive": f"SELECT {RECORD} FROM rec",
    "history_areas": AREAS,
    "history_pv_uv": """
        SELECT count(*) AS pv, count(DISTINCT openid) AS uv FROM rec WHERE openid IS NOT NULL""",
    "history_traffic_by_day": """
        SELECT CAST(dt AS VARCHAR) AS dt, count(openid) AS pv, count(DISTINCT openid) AS uv
        FROM rec GROUP BY dt""",
}

ORACLE_SQL = {name: BASE + body for name, body in _BODIES.items()}
