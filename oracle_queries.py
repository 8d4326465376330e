"""SQL of the reference's operators for DuckDB over the given tables.

Labels, bands and ranges are written out here, apart from the library's, so
that a wrong value there shows as a mismatch.
"""

from __future__ import annotations

_CTE = {
    "rides": """rides AS (SELECT l_orderkey*10 + l_linenumber AS order_id, CAST(l_linenumber AS INTEGER) AS product_id,
  CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS type,
  CAST(CASE WHEN l_partkey % 100 = 0 THEN 302 ELSE l_partkey % 9 END AS INTEGER) AS traffic_type,
  CAST(l_suppkey % 300 AS INTEGER) AS city_id, CAST(l_partkey % 50 AS INTEGER) AS district,
  CAST(l_partkey % 7 AS INTEGER) AS county, CAST(l_orderkey % 3 AS INTEGER) AS combo_type,
  CAST(l_orderkey % 5 AS INTEGER) AS passenger_count, CAST(l_suppkey % 4 AS INTEGER) AS driver_product_id,
  strftime(l_shipdate + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS arrive_time,
  CAST(l_orderkey % 60 AS VARCHAR) AS normal_time, 'trace-' || l_orderkey AS bubble_trace_id,
  CAST(l_suppkey % 2 AS INTEGER) AS product_1level, (l_partkey % 180) / 2.0 AS dest_lng, (l_partkey % 90) / 2.0 AS dest_lat,
  (l_suppkey % 180) / 4.0 AS starting_lng, (l_suppkey % 90) / 4.0 AS starting_lat,
  l_extendedprice / 500.0 AS pre_total_fee, CAST(floor(l_extendedprice) AS INTEGER) AS start_dest_distance,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS departure_time, l_shipdate AS departure_ts,
  CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
  CAST(day(l_shipdate) AS INTEGER) AS d FROM lineitem)""",
    "log": """log AS (SELECT CAST(user_id AS VARCHAR) AS uuid, CAST(user_id % 4 AS VARCHAR) AS partitionpath, event_id, ts,
  value AS fare, 'driver-' || CAST(event_id % 7 AS VARCHAR) AS driver, 'rider-' || CAST(user_id AS VARCHAR) AS rider,
  (event_id % 90) / 90.0 AS begin_lat, (event_id % 180) / 180.0 AS begin_lon,
  strftime(ts, '%Y%m%d') || '000000000' AS commit_time, event_type = 'error' AS is_delete FROM events)""",
    "latest": """latest AS (SELECT *, row_number() OVER (PARTITION BY partitionpath, uuid
  ORDER BY commit_time DESC, ts DESC, event_id DESC) AS rn FROM log)""",
    "snap": "snap AS (SELECT * FROM latest WHERE rn = 1 AND NOT is_delete)",
    "msgs": """msgs AS (SELECT strftime(ts, '%Y%m%d%H%M%S%g') || lpad(CAST(event_id % 1000000 AS VARCHAR), 6, '0') AS order_id,
  CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS order_time, value AS order_money,
  CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS order_status,
  event_id, ts, CAST(CASE event_id % 10 WHEN 0 THEN 607649792 + (event_id * 7919) % 524288
    WHEN 1 THEN 1038614528 + (event_id * 7919) % 393216 WHEN 2 THEN 1783627776 + (event_id * 7919) % 1048576
    WHEN 3 THEN 2035023872 + (event_id * 7919) % 131072 WHEN 4 THEN 2078801920 + (event_id * 7919) % 262144
    WHEN 5 THEN -1950089216 + (event_id * 7919) % 1310720 WHEN 6 THEN -1425539072 + (event_id * 7919) % 524288
    WHEN 7 THEN -1236271104 + (event_id * 7919) % 851968 WHEN 8 THEN -770113536 + (event_id * 7919) % 1507328
    ELSE -569376768 + (event_id * 7919) % 5242880 END AS BIGINT) AS ip_int,
  ((ip_int >> 24) & 255) || '.' || ((ip_int >> 16) & 255) || '.' || ((ip_int >> 8) & 255) || '.' || (ip_int & 255) AS ip,
  'order-topic' AS topic, CAST(event_id % 3 AS INTEGER) AS part, epoch_us(ts) // 1000 AS timestamp_ms FROM events)""",
    "stored": """stored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY partitionpath, order_id
  ORDER BY ts DESC, pre_total_fee DESC, start_dest_distance DESC, product_id DESC, type DESC, traffic_type DESC,
  departure_time DESC) AS r FROM (SELECT *, y || '-' || m || '-' || d AS partitionpath,
  CAST(epoch(departure_ts) AS BIGINT) AS ts FROM rides)) WHERE r = 1)""",
}

# Labels, bands and address ranges of the reports.
PRODUCT = "CASE product_id WHEN 1 THEN '滴滴专车' WHEN 2 THEN '滴滴企业专车' WHEN 3 THEN '滴滴快车' WHEN 4 THEN '滴滴企业快车' END"
REALTIME = "CASE type WHEN 0 THEN '实时' WHEN 1 THEN '预约' END"
TRAFFIC = """CASE r.traffic_type WHEN 0 THEN '普通散客' WHEN 1 THEN '企业时租' WHEN 2 THEN '企业接机套餐' WHEN 3 THEN '企业送机套餐'
  WHEN 4 THEN '拼车' WHEN 5 THEN '接机' WHEN 6 THEN '送机' WHEN 302 THEN '跨城拼车' ELSE '未知' END"""
WEEKDAY = """CASE dayofweek(departure_ts) WHEN 0 THEN '星期日' WHEN 1 THEN '星期一' WHEN 2 THEN '星期二' WHEN 3 THEN '星期三'
  WHEN 4 THEN '星期四' WHEN 5 THEN '星期五' WHEN 6 THEN '星期六' END"""
PRICE = {
    "0~15": "pre_total_fee BETWEEN 0 AND 15",
    "16~30": "pre_total_fee BETWEEN 16 AND 30",
    "31~50": "pre_total_fee BETWEEN 31 AND 50",
    "51~100": "pre_total_fee BETWEEN 51 AND 100",
    "100+": "pre_total_fee > 100",
}
PRICE_SQL = {
    "0_15": "pre_total_fee BETWEEN 0 AND 15",
    "16_30": "pre_total_fee BETWEEN 16 AND 30",
    "31_50": "pre_total_fee BETWEEN 31 AND 50",
    "51_100": "pre_total_fee BETWEEN 50 AND 100",
    "100_": "pre_total_fee > 100",
}
DISTANCE = {
    "0~10km": "start_dest_distance BETWEEN 0 AND 10000",
    "10~20km": "start_dest_distance BETWEEN 10001 AND 20000",
    "20~30": "start_dest_distance BETWEEN 20001 AND 30000",
    "30~50km": "start_dest_distance BETWEEN 30001 AND 50000",
    "50+km": "start_dest_distance > 50001",
}
RANGES = """(VALUES
  (607649792, 608174079, '36.56.0.0'), (1038614528, 1039007743, '61.232.0.0'), (1783627776, 1784676351, '106.80.0.0'),
  (2035023872, 2035154943, '121.76.0.0'), (2078801920, 2079064063, '123.232.0.0'),
  (-1950089216, -1948778497, '139.196.0.0'), (-1425539072, -1425014785, '171.8.0.0'),
  (-1236271104, -1235419137, '182.80.0.0'), (-770113536, -768606209, '210.25.0.0'),
  (-569376768, -564133889, '222.16.0.0')) g(lo, hi, lo_ip)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(_CTE[c] for c in ctes.split()) + "\n" + body


def _bands(bands: dict[str, str]) -> str:
    sums = (f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS \"{name}\"" for name, cond in bands.items())
    return "SELECT " + ", ".join(sums) + " FROM rides"


def _listed_bands(report: str, bands: dict[str, str]) -> list[str]:
    return [f"SELECT '{report}', '{name}', count(*) FILTER ({cond}) FROM stored" for name, cond in bands.items()]


def _latest(where: str) -> str:
    return (
        "(SELECT *, row_number() OVER (PARTITION BY partitionpath, uuid ORDER BY commit_time DESC, ts DESC, event_id DESC) AS r "
        f"FROM log WHERE {where})"
    )


_DATE = "y || '-' || m || '-' || d"
_RIDE_COLUMNS = """order_id, product_id, city_id, district, county, type, combo_type, traffic_type, passenger_count,
  driver_product_id, start_dest_distance, arrive_time, departure_time, pre_total_fee, normal_time, bubble_trace_id,
  product_1level, dest_lng, dest_lat, starting_lng, starting_lat"""
_MESSAGE_COLUMNS = "topic, part AS \"partition\", event_id AS \"offset\", timestamp_ms"
_TYPED_ORDERS = """SELECT order_id AS "orderId", user_id AS "userId", order_time AS "orderTime", ip, order_money AS "orderMoney",
  order_status AS "orderStatus", substring(order_id, 1, 17) AS ts, substring(order_time, 1, 10) AS partition_day
  FROM msgs WHERE event_id % 10 <> 0"""
_COUNT_BY_COMMIT = """SELECT commit_time, count(*) AS n FROM (SELECT DISTINCT commit_time, partitionpath, uuid FROM log)
  GROUP BY commit_time"""
_SNAP = "log latest snap"
_AFTER_OLDEST = """commit_time > (SELECT min(commit_time) FROM
  (SELECT DISTINCT commit_time FROM snap ORDER BY commit_time DESC LIMIT 50))"""


_ANY_RANGES = RANGES.replace(
    ") g(lo, hi, lo_ip)",
    """, (-2147483648, 2147483647, ''), (0, 2147483647, ''), (-2147483648, -1, ''), (607649793, 608174078, ''), (-1, 0, ''),
  (1038614528, 1038614528, ''), (-570000001, 1783700001, '')) g(lo, hi, lo_ip)""",
)


def _dotted(x: str) -> str:
    return f"(({x}::BIGINT >> 24) & 255) || '.' || (({x}::BIGINT >> 16) & 255) || '.' || (({x}::BIGINT >> 8) & 255) || '.' || ({x}::BIGINT & 255)"


def oracle_sql() -> dict[str, str]:
    reports = [
        f"SELECT 'product' AS report, {PRODUCT} AS label, count(*) AS total FROM stored GROUP BY product_id",
        f"SELECT 'type', {REALTIME}, count(*) FROM stored GROUP BY type",
        f"SELECT 'traffic', {TRAFFIC}, count(*) FROM stored r GROUP BY r.traffic_type",
        "SELECT 'traffic_raw', CAST(traffic_type AS VARCHAR), count(*) FROM stored GROUP BY traffic_type",
        f"SELECT 'weekday', {WEEKDAY}, count(*) FROM stored GROUP BY dayofweek(departure_ts)",
        *_listed_bands("price", PRICE),
        *_listed_bands("price_sql", PRICE_SQL),
        *_listed_bands("distance", DISTANCE),
    ]
    return {
        "ride_by_product": _with("rides", f"SELECT {PRODUCT} AS order_type, count(*) AS total FROM rides GROUP BY product_id"),
        "ride_by_type": _with("rides", f"SELECT {REALTIME} AS order_realtime, count(*) AS total FROM rides GROUP BY type"),
        "ride_by_traffic": _with(
            "rides", f"SELECT {TRAFFIC} AS traffic_type, count(*) AS total FROM rides r GROUP BY r.traffic_type"
        ),
        "ride_by_traffic_raw": _with("rides", "SELECT traffic_type, count(*) AS total FROM rides GROUP BY traffic_type"),
        "ride_price_bands": _with("rides", _bands(PRICE)),
        "ride_price_bands_sql": _with("rides", _bands(PRICE_SQL)),
        "ride_distance_bands": _with("rides", _bands(DISTANCE)),
        "ride_by_weekday": _with(
            "rides", f"SELECT {WEEKDAY} AS week, count(*) AS total FROM rides GROUP BY dayofweek(departure_ts)"
        ),
        "ride_sample": _with(
            "rides",
            "SELECT order_id, product_id, type, pre_total_fee, traffic_type, start_dest_distance FROM rides ORDER BY ALL LIMIT 20",
        ),
        "ride_etl": _with(
            "rides",
            f"SELECT order_id, departure_time, {_DATE} AS partitionpath, CAST(epoch(departure_ts) AS BIGINT) AS ts FROM rides",
        ),
        "scan_delimited": _with("rides", f"SELECT {_RIDE_COLUMNS}, y AS year, m AS month, d AS day FROM rides"),
        "scan_delimited_inferred": _with(
            "rides",
            "SELECT order_id, CAST(traffic_type AS BIGINT) AS traffic_type, pre_total_fee, bubble_trace_id, departure_time FROM rides",
        ),
        "ride_store": _with(
            "rides stored",
            "SELECT partitionpath, count(*) AS n, CAST(sum(product_id) AS BIGINT) AS product_sum FROM stored GROUP BY partitionpath",
        ),
        "ride_reports_stored": _with("rides stored", "\nUNION ALL ".join(reports)),
        "scan_json_lines": _with("log", "SELECT uuid, partitionpath, driver, rider, fare, event_id FROM log"),
        "lake_insert": _with("log", _COUNT_BY_COMMIT),
        "lake_precombine": _with(
            "log",
            """SELECT commit_time, uuid, event_id FROM (SELECT *, row_number() OVER (PARTITION BY commit_time, partitionpath, uuid
              ORDER BY ts DESC, event_id DESC) AS r FROM log) WHERE r = 1""",
        ),
        "lake_snapshot": _with(_SNAP, "SELECT uuid, partitionpath, driver, rider, fare, commit_time FROM snap"),
        "lake_upsert": _with(_SNAP, "SELECT uuid, partitionpath, fare, event_id, commit_time FROM snap"),
        "lake_append_same_commit": _with(
            _SNAP, "SELECT kind, uuid, event_id, commit_time FROM snap, (VALUES ('cow'), ('mor')) k(kind)"
        ),
        "lake_partition_counts": _with(_SNAP, "SELECT partitionpath, count(*) AS n FROM snap GROUP BY partitionpath"),
        "lake_delete": _with(
            _SNAP,
            """SELECT (SELECT count(*) FROM snap) AS raw_count,
              (SELECT count(*) FROM snap) - (SELECT count(*) FROM (SELECT uuid FROM snap ORDER BY uuid LIMIT 2)) AS after_count""",
        ),
        "lake_delete_precombine": _with(
            "log",
            """SELECT uuid, event_id, commit_time FROM (SELECT *, row_number() OVER (PARTITION BY partitionpath, uuid
              ORDER BY ts DESC, commit_time DESC, event_id DESC) AS r FROM log
              WHERE CAST(uuid AS BIGINT) % 3 <> 0 OR commit_time > '20240112000000000')
              WHERE r = 1 AND NOT is_delete AND (CAST(uuid AS BIGINT) % 3 <> 1 OR ts > TIMESTAMP '2024-01-10 00:00:00')""",
        ),
        "lake_overwrite": _with(
            "log",
            """SELECT uuid, event_id, (SELECT max(commit_time) FROM log) AS commit_time FROM (SELECT *, row_number() OVER
              (PARTITION BY partitionpath, uuid ORDER BY ts DESC, event_id DESC) AS r FROM log) WHERE r = 1""",
        ),
        "lake_as_of": _with(
            "log",
            f"""SELECT uuid, partitionpath, fare, commit_time FROM {_latest("commit_time <= '20240115000000000'")}
              WHERE r = 1 AND NOT is_delete""",
        ),
        "lake_as_of_recent": _with(
            "log",
            f"""SELECT uuid, commit_time FROM {_latest("commit_time <= '20240115000000000'")}
              WHERE r = 1 AND NOT is_delete ORDER BY commit_time DESC, uuid LIMIT 5""",
        ),
        "lake_incremental": _with(
            "log",
            f"""SELECT commit_time, fare, begin_lon, begin_lat, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
              FROM {_latest("commit_time > '20240120000000000'")} WHERE r = 1 AND NOT is_delete AND fare > 20.0""",
        ),
        "lake_incremental_from_commits": _with(
            _SNAP,
            f"SELECT uuid, fare, commit_time FROM {_latest(_AFTER_OLDEST)} WHERE r = 1 AND NOT is_delete AND fare > 20.0",
        ),
        "lake_commits": _with(_SNAP, "SELECT DISTINCT commit_time FROM snap ORDER BY commit_time DESC LIMIT 50"),
        "trips_fare_range": _with(
            _SNAP,
            """SELECT driver, rider, fare, begin_lat, begin_lon, partitionpath, commit_time FROM snap
              WHERE fare >= 20 AND fare <= 50 ORDER BY fare DESC, commit_time DESC, uuid LIMIT 20""",
        ),
        "catalog_table": _with("rides", f"SELECT {_DATE} AS date_str, count(*) AS n FROM rides GROUP BY y, m, d"),
        "catalog_add_partitions": _with("rides", f"SELECT {_RIDE_COLUMNS}, {_DATE} AS date_str FROM rides"),
        "catalog_partitions": _with("rides", f"SELECT DISTINCT 'date_str=' || {_DATE} AS \"partition\" FROM rides"),
        "encode_messages": _with(
            "msgs",
            f"""SELECT order_id AS key, {_MESSAGE_COLUMNS}, order_id AS j_order_id, user_id AS j_user_id,
              order_time AS j_order_time, ip AS j_ip, order_money AS j_order_money, order_status AS j_order_status FROM msgs""",
        ),
        "stream_order_etl": _with(
            "msgs",
            f"""SELECT order_id, user_id, order_time, ip, {_MESSAGE_COLUMNS}, order_money,
              CAST(order_status AS VARCHAR) AS order_status, epoch_us(CAST(order_time AS TIMESTAMP)) // 1000 AS ts_ms,
              substring(order_time, 1, 10) AS day FROM msgs""",
        ),
        "stream_json_tolerant": _with("msgs", _TYPED_ORDERS),
        "stream_upsert_typed": _with("msgs", _TYPED_ORDERS),
        "stream_upsert_mor": _with(
            "msgs",
            """SELECT user_id, day, order_id, order_money FROM (SELECT *, substring(order_time, 1, 10) AS day, row_number() OVER
              (PARTITION BY substring(order_time, 1, 10), user_id ORDER BY ts DESC, event_id DESC) AS r FROM msgs) WHERE r = 1""",
        ),
        "stream_lake_read": _with("log", _COUNT_BY_COMMIT),
        "ride_labels_sql": _with(
            "rides",
            f"""SELECT 'product' AS report, {PRODUCT} AS label, count(*) AS total FROM rides GROUP BY product_id
              UNION ALL SELECT 'type', {REALTIME}, count(*) FROM rides GROUP BY type
              UNION ALL SELECT 'traffic', {TRAFFIC}, count(*) FROM rides r GROUP BY r.traffic_type
              UNION ALL SELECT 'weekday', {WEEKDAY}, count(*) FROM rides GROUP BY dayofweek(departure_ts)""",
        ),
        "scan_delimited_mixed": _with(
            "rides", "SELECT order_id, product_id, pre_total_fee, departure_time, y AS year, traffic_type FROM rides"
        ),
        "scan_rejected": _with(
            "rides",
            """SELECT CASE WHEN order_id % 17 > 2 THEN order_id END AS order_id, CASE WHEN order_id % 17 > 2 THEN product_id END AS product_id,
              CASE WHEN order_id % 17 > 2 THEN pre_total_fee END AS pre_total_fee,
              CASE WHEN order_id % 17 > 2 THEN departure_time END AS departure_time,
              CASE order_id % 17 WHEN 0 THEN order_id || chr(9) || product_id || chr(9) || fee
                WHEN 1 THEN order_id || chr(9) || product_id || chr(9) || fee || chr(9) || departure_time || chr(9) || 'more'
                WHEN 2 THEN order_id || chr(9) || 'many' || chr(9) || fee || chr(9) || departure_time END AS line
              FROM (SELECT *, CAST(pre_total_fee AS VARCHAR) AS fee FROM rides)""",
        ),
        "scan_json_drifting": _with(
            "log",
            """SELECT CASE WHEN broken IS NULL THEN event_id END AS event_id, CASE WHEN broken IS NULL THEN uuid END AS uuid,
              CASE WHEN broken IS NULL AND event_id % 3 <> 1 THEN fare END AS fare,
              CASE WHEN broken IS NULL AND event_id % 3 = 2 THEN event_id END AS tip,
              CASE WHEN broken IS NULL AND event_id % 3 = 2 THEN 'card' END AS paid,
              CASE WHEN broken IS NULL AND event_id % 3 = 1 THEN '"' || event_id || ' EUR"' END AS unfit_fare, broken
              FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN '{"event_id": ' || event_id END AS broken FROM log)""",
        ),
        "lake_bucketed_snapshot": _with(_SNAP, "SELECT uuid, partitionpath, fare, event_id, commit_time FROM snap"),
        "lake_count_footers": _with("rides stored", "SELECT count(*) AS n FROM stored"),
        "stream_lake_changes": _with("log", _COUNT_BY_COMMIT),
        "stream_log_orders": _with(
            "msgs",
            """SELECT order_id, user_id, order_time, ip, topic, part AS "partition", timestamp_ms,
              CAST(order_status AS VARCHAR) AS order_status, substring(order_time, 1, 10) AS day FROM msgs""",
        ),
        "stream_log_batches": """SELECT batch, least(total - batch * cap, cap) AS n FROM (SELECT count(*) AS total, count(*) // 3 + 1 AS cap FROM events),
          range(3) t(batch) WHERE batch * cap < total""",
        "stream_log_offsets": _with(
            "msgs",
            """SELECT topic, part AS "partition", count(*) AS n, 0 AS first_offset, count(*) - 1 AS last_offset, count(*) AS different
              FROM msgs GROUP BY topic, part""",
        ),
        "stream_log_latest": _with("msgs", "SELECT order_id, part AS \"partition\" FROM msgs WHERE event_id % 2 = 1"),
        "stream_log_loss": _with("msgs", "SELECT order_id, part AS \"partition\" FROM msgs WHERE event_id % 3 <> 1"),
        "sink_log": _with(
            "msgs",
            """SELECT order_id AS key, topic, part AS "partition", timestamp_ms, user_id,
              count(*) OVER (PARTITION BY part) AS next_offset FROM msgs""",
        ),
        "stream_progress": """SELECT name, count(*) AS input_rows, 1 AS started, 1 AS ended, 2 AS active, true AS one_ended
          FROM events, (VALUES ('first'), ('second')) t(name) GROUP BY name""",
        "ipv4_ranges_any_width": _with(
            "msgs",
            f"""SELECT {_dotted('g.lo')} AS range_start, {_dotted('g.hi')} AS range_end, count(*) AS total
              FROM msgs JOIN {_ANY_RANGES} ON ip_int BETWEEN g.lo AND g.hi GROUP BY g.lo, g.hi""",
        ),
        "ipv4_decode": _with("msgs", "SELECT event_id, ip FROM msgs"),
        "ipv4_range_tally": _with(
            "msgs", f"SELECT g.lo_ip AS range_start, count(*) AS total FROM msgs JOIN {RANGES} ON ip_int BETWEEN g.lo AND g.hi GROUP BY g.lo_ip"
        ),
    }
