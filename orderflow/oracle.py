"""The catalog's queries as SQL for an independent engine (DuckDB)."""

from __future__ import annotations

AMOUNT = "quantity * unit_price * (1 - discount_percent / 100.0::DOUBLE)"

LINES = f"""raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id, o_orderdate AS timestamp,
         o_custkey::VARCHAR AS customer_id, p_partkey::VARCHAR AS product_id,
         p_name AS product_name, p_type AS category, l_quantity::INTEGER AS quantity,
         l_extendedprice / l_quantity AS unit_price,
         l_discount * 100.0::DOUBLE AS discount_percent, n_name AS city,
         o_orderpriority AS payment_method,
         CASE l_returnflag WHEN 'N' THEN 'Completed' WHEN 'R' THEN 'Returned'
              WHEN 'A' THEN 'Cancelled' ELSE l_returnflag END AS order_status
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
), t AS (SELECT *, {AMOUNT} AS total_amount FROM raw)"""

_EVENT_RAW = """keyed AS (
  SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events
), raw AS (
  SELECT event_id::VARCHAR AS order_id, {time} AS timestamp,
         user_id::VARCHAR AS customer_id, k::VARCHAR AS product_id,
         'Product ' || k AS product_name, event_type AS category,
         (k % 5 + 1)::INTEGER AS quantity, value AS unit_price,
         (k % 50)::DOUBLE AS discount_percent, 'CITY_' || (user_id % 10) AS city,
         'PM_' || (k % 4) AS payment_method,
         CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'signup' THEN 'Returned'
              WHEN 'error' THEN 'Cancelled' ELSE event_type END AS order_status
  FROM keyed
)"""
EVENTS = (
    _EVENT_RAW.format(time="ts") + f", t AS (SELECT *, {AMOUNT} AS total_amount FROM raw)"
)
# Times as messages carry them.
SECONDS = (
    _EVENT_RAW.format(time="date_trunc('second', ts)::TIMESTAMP")
    + f", t AS (SELECT *, {AMOUNT} AS total_amount FROM raw)"
)

TOTAL = "count(*) AS total_orders"
COMPLETED = "count(*) FILTER (WHERE order_status = 'Completed') AS completed_orders"
RETURNED = "count(*) FILTER (WHERE order_status = 'Returned') AS returned_orders"
REVENUE = (
    "coalesce(round(sum(total_amount) FILTER (WHERE order_status = 'Completed'), 2), 0.0)"
    " AS completed_revenue"
)
KPIS = f"SELECT {TOTAL}, {COMPLETED}, {RETURNED}, {REVENUE} FROM t"
CATEGORY_REVENUE = "SELECT category, round(sum(total_amount), 2) AS revenue FROM t GROUP BY category"

FILTERED = """SELECT order_id, product_id, product_name, city, order_status FROM t
WHERE order_status = 'Returned' AND city = '{city}'
  AND (contains(lower(order_id), '7') OR contains(lower(product_name), '7'))"""

MINUTES = """SELECT date_trunc('minute', timestamp)::TIMESTAMP AS window_start,
  (date_trunc('minute', timestamp) + INTERVAL 1 MINUTE)::TIMESTAMP AS window_end,
  count(*) AS order_count FROM t WHERE timestamp IS NOT NULL GROUP BY ALL"""
TEN_MINUTES = """SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end,
  count(*) AS order_count
FROM (SELECT unnest([b, b - INTERVAL 5 MINUTE]) AS s
      FROM (SELECT make_timestamp((epoch_us(timestamp) // 300000000) * 300000000) AS b FROM t))
GROUP BY ALL"""
SLIDING = """SELECT s AS window_start, s + INTERVAL {width} MINUTE AS window_end, count(*) AS order_count
FROM (SELECT make_timestamp((epoch_us(timestamp) // ({slide} * 60000000) - n) * ({slide} * 60000000)) AS s, timestamp
      FROM t, (SELECT unnest(range({copies})) AS n))
WHERE timestamp < s + INTERVAL {width} MINUTE GROUP BY ALL"""
# Events that come in the last of five slices of time although they belong to the first two.
LATE = """SELECT * EXCLUDE (slice) FROM (
  SELECT *, (epoch_us(timestamp) - min(epoch_us(timestamp)) OVER ()) * 5
    // (max(epoch_us(timestamp)) OVER () - min(epoch_us(timestamp)) OVER () + 1) AS slice FROM t)
WHERE NOT (order_id::BIGINT % 50 = 0 AND slice <= 1)"""
LAST = """SELECT count(*) AS orders_in_last_minute FROM t
WHERE timestamp >= (SELECT max(timestamp) FROM t) - INTERVAL {span}"""

DISPLAY = """SELECT order_id, product_name AS product, category, total_amount AS amount,
  city, order_status AS status FROM t"""
FORMATTED = """SELECT order_id, product_name AS product, category,
  '₹' || format('{{:,.2f}}', total_amount) AS amount, city,
  CASE order_status WHEN 'Completed' THEN '✅ Completed' WHEN 'Returned' THEN '↩️ Returned'
       WHEN 'Cancelled' THEN '❌ Cancelled' ELSE order_status END AS status
FROM t {rest}"""
PROCESSED = """SELECT order_id, timestamp, customer_id, product_id, product_name, category,
  quantity, unit_price, discount_percent, city, payment_method, order_status, total_amount
FROM t {rest}"""

# Which messages the catalog spoils, by product id.
FAULTS = """SELECT CASE k % 10 WHEN 1 THEN 'bad_quantity' WHEN 2 THEN 'negative_unit_price'
  WHEN 3 THEN 'discount_out_of_range' WHEN 4 THEN 'bad_timestamp'
  WHEN 5 THEN 'missing_order_id' ELSE 'malformed_message' END AS reasons,
  count(*) AS order_count
FROM keyed WHERE k % 10 BETWEEN 1 AND 7 GROUP BY ALL"""
CSV_FAULTS = """SELECT CASE WHEN k % 10 = 3 THEN 'bad_quantity' ELSE 'corrupt_record' END AS reasons,
  count(*) AS order_count, count(*) AS with_text
FROM keyed WHERE k % 10 BETWEEN 1 AND 3 GROUP BY ALL"""
PUBLISHED_FIELDS = """SELECT order_id,
  CASE product_id::INTEGER % 10 WHEN 1 THEN NULL WHEN 2 THEN 'two' ELSE quantity::VARCHAR END AS quantity,
  CASE product_id::INTEGER % 10 WHEN 1 THEN NULL WHEN 2 THEN 'STRING' ELSE 'BIGINT' END AS quantity_type,
  CASE WHEN product_id::INTEGER % 10 <> 1 THEN unit_price END AS unit_price,
  CASE WHEN product_id::INTEGER % 10 <> 1 THEN city END AS city,
  CASE WHEN product_id::INTEGER % 10 IN (0, 2, 3, 4) THEN 'C' || product_id END AS coupon,
  CASE WHEN product_id::INTEGER % 10 IN (0, 2, 3, 4) THEN 'note ' || order_id END AS note
FROM t"""
# Line breaks, quotes and separators in a field.
BROKEN_NAME = (
    "CASE WHEN product_id::INTEGER % 3 = 1 "
    "THEN 'two' || chr(10) || 'lines, \"' || order_id || '\"' || chr(10) END"
)
DOCUMENT_STATUS = """SELECT 'whole' AS document, 'LIVE' AS status,
  '🟢 LIVE • Kafka + Spark Streaming' AS status_badge,
  'LIVE • Streaming active (updated 30s ago)' AS status_message,
  NULL::VARCHAR AS error, count(*) > 0 AS has_data FROM t
UNION ALL
SELECT 'broken', 'ERROR', '🔴 ERROR', 'Error reading analytics output: not valid JSON',
  'Error reading analytics output: not valid JSON', false
UNION ALL
SELECT 'empty', 'WAITING', '⚪ WAITING', 'Waiting for streaming data...', NULL, false"""
SOUND = "WHERE product_id::INTEGER % 10 NOT BETWEEN 1 AND 7"


def _orders_per(column: str) -> str:
    return f"SELECT {column}, count(*) AS order_count FROM t GROUP BY {column}"


def _positions(metric: str, by: str, key: str) -> str:
    order = f"{by} DESC, {key} ASC"
    return f"SELECT *, row_number() OVER (ORDER BY {order})::INTEGER AS position FROM ({metric})"


def _snapshot() -> str:
    """All metrics in one long result."""

    def part(
        metric: str,
        rows: str,
        key: str = "NULL",
        start: str = "NULL",
        end: str = "NULL",
        count: str = "NULL",
        revenue: str = "NULL",
    ) -> str:
        return (
            f"SELECT '{metric}' AS metric, {key}::VARCHAR AS key, "
            f"{start}::TIMESTAMP AS window_start, {end}::TIMESTAMP AS window_end, "
            f"{count}::BIGINT AS order_count, {revenue}::DOUBLE AS revenue FROM ({rows})"
        )

    parts = [
        part("total_orders", KPIS, count="total_orders"),
        part("completed_orders", KPIS, count="completed_orders"),
        part("returned_orders", KPIS, count="returned_orders"),
        part("completed_revenue", KPIS, revenue="completed_revenue"),
        part("orders_in_last_minute", LAST.format(span="1 MINUTE"), count="orders_in_last_minute"),
        part("revenue_by_category", CATEGORY_REVENUE, key="category", revenue="revenue"),
        part("orders_by_city", _orders_per("city"), key="city", count="order_count"),
        part(
            "payment_method_distribution",
            _orders_per("payment_method"),
            key="payment_method",
            count="order_count",
        ),
        part(
            "order_status_distribution",
            _orders_per("order_status"),
            key="order_status",
            count="order_count",
        ),
        part(
            "windowed_orders", MINUTES, start="window_start", end="window_end", count="order_count"
        ),
    ]
    return " UNION ALL ".join(parts)


RATIOS = f"""SELECT total_orders, completed_orders, returned_orders,
  coalesce(round(100.0::DOUBLE * completed_orders / nullif(total_orders, 0), 1), 0.0)
    AS completed_percent,
  coalesce(round(100.0::DOUBLE * returned_orders / nullif(total_orders, 0), 1), 0.0)
    AS returned_percent
FROM ({KPIS})"""

FRESHNESS = """SELECT 'soon' AS looked_at, 'LIVE' AS status,
  '🟢 LIVE • Kafka + Spark Streaming' AS status_badge,
  'LIVE • Streaming active (updated 30s ago)' AS status_message,
  strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_updated,
  30.0::DOUBLE AS age_seconds, true AS is_live, true AS has_data FROM t
UNION ALL
SELECT 'late', 'PAUSED', '🟡 PAUSED • Stream Inactive',
  'PAUSED • Stream inactive (last active: ' || strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') || ')',
  strftime(max(timestamp), '%Y-%m-%d %H:%M:%S'), 7200.0::DOUBLE, false, true FROM t"""


def _over(source: str, query: str) -> str:
    return f"WITH {source} {query}"


def oracle_queries() -> dict[str, str]:
    """SQL by catalog name."""
    newest = "ORDER BY timestamp DESC, order_id DESC LIMIT 20"
    latest = f"FROM (SELECT * FROM t {newest}) AS t"
    lines = {
        "kpis": KPIS,
        "total_orders": f"SELECT {TOTAL} FROM t",
        "completed_orders": f"SELECT {COMPLETED} FROM t",
        "returned_orders": f"SELECT {RETURNED} FROM t",
        "completed_revenue": f"SELECT {REVENUE} FROM t",
        "revenue_by_category": CATEGORY_REVENUE,
        "orders_by_city": _orders_per("city"),
        "payment_method_distribution": _orders_per("payment_method"),
        "order_status_distribution": _orders_per("order_status"),
        "status_ratios": RATIOS,
        "ranked_categories": _positions(CATEGORY_REVENUE, "revenue", "category"),
        "ranked_cities": _positions(_orders_per("city"), "order_count", "city"),
        "total_amounts": (
            "SELECT order_id, product_id, quantity, unit_price, discount_percent, total_amount FROM t"
        ),
        "filter_transactions": FILTERED.format(city="NATION_3"),
        "city_facet": "SELECT DISTINCT city AS value FROM t",
        "status_facet": "SELECT DISTINCT order_status AS value FROM t",
        "display_transactions": DISPLAY,
        "line_metrics": _snapshot(),
    }
    events = {
        "event_kpis": KPIS,
        "event_revenue_by_category": CATEGORY_REVENUE,
        "event_orders_by_city": _orders_per("city"),
        "event_payment_methods": _orders_per("payment_method"),
        "event_statuses": _orders_per("order_status"),
        "event_filter": FILTERED.format(city="CITY_3"),
        "event_formats": FORMATTED.format(rest=""),
        "event_kpi_texts": (
            "SELECT format('{:,}', total_orders) AS total_orders, "
            "format('{:,}', completed_orders) AS completed_orders, "
            f"'₹' || format('{{:,.2f}}', completed_revenue) AS completed_revenue FROM ({KPIS})"
        ),
        "event_metrics": _snapshot(),
        "event_metric_windows": MINUTES,
        "event_metric_revenue": f"SELECT {REVENUE} FROM t",
        "recent_transactions": DISPLAY.replace("FROM t", latest),
        "windowed_orders": MINUTES,
        "sliding_windowed_orders": TEN_MINUTES,
        "day_by_minute_windows": SLIDING.format(width=1440, slide=1, copies=1440),
        "uneven_sliding_windows": SLIDING.format(width=90, slide=25, copies=4),
        "orders_in_last_minute": LAST.format(span="1 MINUTE"),
        "orders_in_last_hour": LAST.format(span="1 HOUR"),
        "parsed_messages": "SELECT k AS quantity, count(*) AS order_count FROM keyed GROUP BY k",
        "refused_by_reason": FAULTS,
        "valid_revenue_by_category": CATEGORY_REVENUE.replace("FROM t", f"FROM t {SOUND}"),
        "stored_snapshot": _snapshot(),
        "exported_windows": (
            "SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, "
            "strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, order_count "
            f"FROM ({MINUTES})"
        ),
        "freshness_status": FRESHNESS,
        "csv_refused_by_reason": CSV_FAULTS,
        "published_fields": PUBLISHED_FIELDS,
        "recent_json_lines": DISPLAY.replace("total_amount", "unit_price").replace("FROM t", latest),
        "document_round_trip": _snapshot(),
        "document_status": DOCUMENT_STATUS,
        "stream_kpis": KPIS,
        "stream_revenue_by_category": CATEGORY_REVENUE,
        "stream_orders_by_city": _orders_per("city"),
        "stream_payment_methods": _orders_per("payment_method"),
        "stream_statuses": _orders_per("order_status"),
        "stream_windowed_orders": MINUTES,
        "stream_sliding_windowed_orders": TEN_MINUTES,
        "stream_closed_windows": (
            f"SELECT * FROM ({MINUTES}) "
            "WHERE window_end <= (SELECT max(timestamp) FROM t) - INTERVAL 10 MINUTE"
        ),
        "stream_late_rows": MINUTES.replace("FROM t", f"FROM ({LATE})"),
        "stream_dedup": _orders_per("order_status"),
        "stream_quarantine": FAULTS,
        "replayed_batch": _snapshot(),
        "stored_recent": FORMATTED.format(rest="").replace("FROM t", latest),
        "stored_recent_500": FORMATTED.format(rest="").replace(
            "FROM t", latest.replace("LIMIT 20", "LIMIT 500")
        ),
    }
    seconds = {
        "message_round_trip": PROCESSED.format(rest=""),
        "event_times": "SELECT order_id, timestamp FROM t",
        "csv_round_trip": PROCESSED.format(rest=""),
        "ndjson_round_trip": PROCESSED.format(rest=""),
        "quoted_csv_round_trip": PROCESSED.format(rest="").replace(" product_name", f" {BROKEN_NAME} AS product_name"),
        "stream_snapshot": _snapshot(),
        "stream_history": PROCESSED.format(rest=SOUND),
        "archived_history": PROCESSED.format(rest=""),
    }
    return {
        **{name: _over(LINES, query) for name, query in lines.items()},
        **{name: _over(EVENTS, query) for name, query in events.items()},
        **{name: _over(SECONDS, query) for name, query in seconds.items()},
    }
