"""DuckDB SQL giving the same answers as ``plans.queries``, column names included."""

from __future__ import annotations

HOUR = 3_600_000_000
MINUTE = 60_000_000
SECOND = 1_000_000


def sliding(source: str, keys: str, size: int, slide: int) -> str:
    """Window counts the direct way: every row is copied to each window holding it."""
    group = f"{keys}, " if keys else ""
    return f"""
        SELECT {group}make_timestamp(pane + (i + 1) * {slide} - {size}) AS window_start,
               make_timestamp(pane + (i + 1) * {slide}) AS window_end, count(*) AS "count"
        FROM (SELECT *, (epoch_us(ts) // {slide}) * {slide} AS pane FROM {source}), range({size // slide}) w(i)
        GROUP BY ALL"""


def top3(counts: str, key: str) -> str:
    return f"""
        SELECT window_end, {key}, "count", rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, {key}) AS INTEGER) AS rank
            FROM ({counts})) WHERE rank <= 3"""


def report(top: str, key: str, label: str) -> str:
    return f"""
        SELECT window_end, '时间: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
               string_agg('No.' || rank || ':{label}' || {key} || ' 数量=' || "count" || chr(10), '' ORDER BY rank) AS report
        FROM ({top}) GROUP BY window_end"""


def text_time(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') || '.0'"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
HASH = (
    "list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
    "lambda a, b: (a * 34 + b) & 536870911)"
)
ITEMS = "(SELECT ts, user_id AS item_id FROM events)"
VISITS = f"""(SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
        date_trunc('second', ts) AS ts, CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
        CASE {K} % 10 WHEN 0 THEN '/static/' || {K} || '.css' WHEN 1 THEN '/favicon.ico'
             WHEN 2 THEN '/img/' || {K} || '.png' WHEN 3 THEN '/' ELSE '/' || event_type || '/' || {K} END AS url
    FROM events)"""
PAGES = f"(SELECT * FROM {VISITS} WHERE NOT regexp_matches(url, '[.](css|ico|png)$') AND url <> '/')"
MARKET = f"""(SELECT ts, ['google store', 'facebook', 'apple store', 'wechat', 'webo'][{K} % 5 + 1] AS channel,
        event_type AS behavior FROM events WHERE event_type <> 'error')"""
CLICKS = """(SELECT event_id, ts, user_id, event_type AS ad_id, row_number() OVER (
        PARTITION BY user_id, event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS rn FROM events)"""
GOOD_CLICKS = f"(SELECT ts, ad_id AS province FROM {CLICKS} WHERE rn <= 2)"
ORDERED = "(PARTITION BY user_id ORDER BY ts, event_id)"
DAILY = """(SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
        min(ts) FILTER (event_type = 'signup') AS create_ts, min(ts) FILTER (event_type = 'purchase') AS pay_ts
    FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY ALL)"""
# each create with the first pay after it
NEXT_PAY = """(SELECT c.user_id, c.event_id AS create_id, c.ts AS create_ts,
        min(p.ts) AS pay_ts, arg_min(p.event_id, p.ts) AS pay_id
    FROM events c LEFT JOIN events p ON p.user_id = c.user_id AND p.event_type = 'purchase'
        AND (p.ts, p.event_id) > (c.ts, c.event_id)
    WHERE c.event_type = 'signup' GROUP BY ALL)"""
PAIRS = """events p JOIN events r ON p.user_id = r.user_id AND p.event_type = 'purchase' AND r.event_type = 'click'
        AND r.ts BETWEEN p.ts - INTERVAL 30 MINUTE AND p.ts + INTERVAL 30 MINUTE"""
ROUTED = """(SELECT event_id, user_id, value, CASE WHEN value > 30 THEN 'high30' ELSE 'low30' END AS routes FROM events)"""
JUMPS = """SELECT user_id, event_id, last_value, value FROM (
        SELECT *, lag(value{default}) OVER {ordered} AS last_value FROM events)
    WHERE abs(value - last_value) > 10"""

ORACLE: dict[str, str] = {
    "hot_items": top3(sliding(ITEMS, "item_id", HOUR, 5 * MINUTE), "item_id"),
    "hot_items_report": report(top3(sliding(ITEMS, "item_id", HOUR, 5 * MINUTE), "item_id"), "item_id", " 商品Id="),
    "parse_log": f"SELECT ip, user_id, ts, method, url FROM {VISITS}",
    "hot_urls": top3(sliding(PAGES, "url", HOUR, 5 * MINUTE), "url"),
    "hot_urls_report": report(top3(sliding(PAGES, "url", HOUR, 5 * MINUTE), "url"), "url", " Url="),
    "page_urls": r"""
        SELECT page_id, url FROM (
            SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS url FROM pages)
        WHERE NOT regexp_matches(url, '[.](css|ico|png)$') AND url <> '/'""",
    "page_view": """
        SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, 'pv' AS kind, count(*) AS pv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "keyed_hour_count": """
        SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
               count(*) AS n FROM events GROUP BY ALL""",
    "unique_visitor": """
        SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "uv_bitmap": f"""
        SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT {HASH}) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "uv_running": f"""
        SELECT event_id, window_end, CAST(sum(is_new) OVER (PARTITION BY window_end ORDER BY ts, event_id) AS BIGINT) AS uv
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_end, h ORDER BY ts, event_id) = 1 AS INTEGER) AS is_new
              FROM (SELECT event_id, ts, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {HASH} AS h
                    FROM events WHERE event_type = 'view'))""",
    "channel_count": f"""
        SELECT channel, behavior, {text_time('window_start')} AS window_start, {text_time('window_end')} AS window_end, "count"
        FROM ({sliding(MARKET, 'channel, behavior', HOUR, 10 * SECOND)})""",
    "market_total": f"""
        SELECT {text_time('window_start')} AS window_start, {text_time('window_end')} AS window_end,
               'app marketing' AS channel, 'total' AS behavior, "count"
        FROM ({sliding(MARKET, '', HOUR, 10 * SECOND)})""",
    "ad_blacklist": f"SELECT event_id, ts, user_id, ad_id FROM {CLICKS} WHERE rn <= 2",
    "ad_warning": f"SELECT user_id, ad_id, 'click over 2 times today' AS msg FROM {CLICKS} WHERE rn = 3",
    "ad_warning_month": """
        SELECT event_id, ts, user_id, ad_id FROM (
            SELECT event_id, ts, user_id, event_type AS ad_id,
                   row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
        WHERE rn = 9""",
    "ad_by_geo": f"""
        SELECT {text_time('window_end')} AS window_end, province, "count"
        FROM ({sliding(GOOD_CLICKS, 'province', HOUR, 5 * SECOND)})""",
    "sensor_min_window": f"""
        SELECT user_id, make_timestamp(pane + (i + 1) * {5 * HOUR}) AS window_end, min(value) AS min_value
        FROM (SELECT *, ((epoch_us(ts) - {2 * HOUR}) // {5 * HOUR}) * {5 * HOUR} + {2 * HOUR} AS pane FROM events),
             range(3) w(i)
        GROUP BY ALL""",
    "running_reduce": f"""
        SELECT user_id, event_id,
               CAST(floor(epoch(first_value(ts) OVER {ORDERED})) AS BIGINT) + row_number() OVER {ORDERED} - 1 AS epoch,
               CASE WHEN row_number() OVER {ORDERED} = 1 THEN value ELSE value + 10 END AS result
        FROM events""",
    "running_sum": f"""
        SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER {ORDERED} AS DOUBLE) AS running FROM events""",
    "running_word_sum": """
        SELECT event_type AS word, event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events""",
    "avg_int_div": """
        SELECT user_id, CAST(sum(CAST(floor(epoch(ts)) AS BIGINT)) // count(*) AS DOUBLE) AS average
        FROM events GROUP BY user_id""",
    "temp_jump": JUMPS.format(default="", ordered=ORDERED),
    "temp_jump_zero": JUMPS.format(default=", 1, 0.0", ordered=ORDERED),
    "rising_run": f"""
        WITH marked AS (
            SELECT *, CASE WHEN value > lag(value) OVER {ORDERED} THEN 0 ELSE 1 END AS brk FROM events),
        runs AS (SELECT *, sum(brk) OVER {ORDERED} AS run FROM marked)
        SELECT user_id, min(ts) AS run_start, max(ts) AS run_end, arg_min(value, ts) AS first_value,
               arg_max(value, ts) AS last_value, count(*) AS readings, user_id || '温度连续上升告警!' AS msg
        FROM runs GROUP BY user_id, run HAVING count(*) >= 2 AND max(ts) - min(ts) >= INTERVAL 10 HOUR""",
    "login_fail_pair": f"""
        SELECT user_id, first_fail, ts AS last_fail, event_id FROM (
            SELECT *, lag(event_type) OVER {ORDERED} AS prev, lag(ts) OVER {ORDERED} AS first_fail FROM events)
        WHERE event_type = 'error' AND prev = 'error' AND ts < first_fail + INTERVAL 2 HOUR""",
    "login_fail_burst": """
        WITH RECURSIVE fails AS (
            SELECT * FROM (SELECT user_id, ts, event_id, event_type, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events) WHERE event_type = 'error'),
        ahead AS (
            SELECT f.user_id, f.run, f.ts, min(g.ts) AS following FROM fails f LEFT JOIN fails g
            ON g.user_id = f.user_id AND g.run = f.run AND g.ts > f.ts + INTERVAL 12 HOUR GROUP BY ALL),
        starts AS (
            SELECT user_id, run, min(ts) AS ts FROM fails GROUP BY ALL
            UNION
            SELECT a.user_id, a.run, a.following FROM starts s JOIN ahead a
            ON a.user_id = s.user_id AND a.run = s.run AND a.ts = s.ts WHERE a.following IS NOT NULL)
        SELECT s.user_id, s.ts AS first_fail, max(f.ts) AS last_fail, count(*) AS fails
        FROM starts s JOIN fails f ON f.user_id = s.user_id AND f.run = s.run
            AND f.ts BETWEEN s.ts AND s.ts + INTERVAL 12 HOUR
        GROUP BY s.user_id, s.ts HAVING count(*) >= 2""",
    "order_pay": f"""
        SELECT user_id, create_id, pay_id, 'order paid in time' AS msg FROM {NEXT_PAY}
        WHERE pay_ts < create_ts + INTERVAL 12 HOUR""",
    "order_timeout": f"""
        SELECT user_id, create_id, 'timeout' AS msg FROM {NEXT_PAY}
        WHERE pay_ts IS NULL OR pay_ts >= create_ts + INTERVAL 12 HOUR""",
    "three_step_sequence": """
        WITH c AS (SELECT v.user_id, v.event_id AS view_id, v.ts AS vts, min(k.ts) AS cts, arg_min(k.event_id, k.ts) AS cid
                   FROM events v LEFT JOIN events k ON k.user_id = v.user_id AND k.event_type = 'click' AND k.ts > v.ts
                   WHERE v.event_type = 'view' GROUP BY ALL),
        b AS (SELECT c.user_id, view_id, vts, cts, cid, min(p.ts) AS bts, arg_min(p.event_id, p.ts) AS bid
              FROM c LEFT JOIN events p ON p.user_id = c.user_id AND p.event_type = 'purchase' AND p.ts > c.cts
              GROUP BY ALL)
        SELECT user_id, view_id, CASE WHEN cts < vts + INTERVAL 36 HOUR THEN cid END AS click_id,
               CASE WHEN bts < vts + INTERVAL 36 HOUR THEN bid END AS buy_id,
               CASE WHEN bts < vts + INTERVAL 36 HOUR THEN 'match' ELSE 'timeout' END AS route
        FROM b""",
    "order_status": f"""
        SELECT *, CASE WHEN msg = 'paid ok' THEN 'main' ELSE 'side' END AS route FROM (
            SELECT *, CASE WHEN create_ts IS NULL OR pay_ts < create_ts THEN 'paid but not found create log'
                           WHEN pay_ts IS NULL THEN 'order timeout'
                           WHEN pay_ts < create_ts + INTERVAL 4 HOUR THEN 'paid ok' ELSE 'paid but timeout' END AS msg
            FROM {DAILY})""",
    "order_paid_warning": f"""
        SELECT *, CASE WHEN pay_ts <= create_ts + INTERVAL 4 HOUR THEN 'order paid ok' ELSE 'order timeout' END AS msg
        FROM {DAILY} WHERE create_ts IS NOT NULL AND (pay_ts IS NULL OR pay_ts >= create_ts)""",
    "signup_paths": """
        SELECT s.user_id, s.event_id AS signup, c.event_id AS click, p.event_id AS purchase
        FROM events s JOIN events c ON c.user_id = s.user_id AND (c.ts, c.event_id) > (s.ts, s.event_id)
        JOIN events p ON p.user_id = s.user_id AND (p.ts, p.event_id) > (c.ts, c.event_id)
        WHERE s.event_type = 'signup' AND c.event_type = 'click' AND p.event_type = 'purchase'
          AND p.ts < s.ts + INTERVAL 48 HOUR""",
    "pay_match": f"SELECT p.user_id, p.event_id AS pay_id, r.event_id AS receipt_id FROM {PAIRS}",
    "pay_unmatched": f"""
        SELECT 'unmatched pay' AS kind, user_id, event_id FROM events
        WHERE event_type = 'purchase' AND event_id NOT IN (SELECT p.event_id FROM {PAIRS})
        UNION ALL
        SELECT 'unmatched receipt', user_id, event_id FROM events
        WHERE event_type = 'click' AND event_id NOT IN (SELECT r.event_id FROM {PAIRS})""",
    "pay_match_ids": f"""
        SELECT 't' || p.user_id AS trx_id, p.event_id AS pay_id, r.event_id AS receipt_id
        FROM (SELECT * FROM events WHERE {K} % 5 <> 0) p JOIN (SELECT * FROM events WHERE {K} % 5 <> 0) r
        ON p.user_id = r.user_id AND r.ts BETWEEN p.ts - INTERVAL 6 HOUR AND p.ts + INTERVAL 6 HOUR
        WHERE p.event_type = 'purchase' AND r.event_type = 'click'""",
    "login_fail_times": f"""
        SELECT user_id, event_id AS first_id, last_id FROM (
            SELECT *, lead(event_type) OVER {ORDERED} AS second_type, lead(event_type, 2) OVER {ORDERED} AS last_type,
                   lead(event_id, 2) OVER {ORDERED} AS last_id, lead(ts, 2) OVER {ORDERED} AS last_ts FROM events)
        WHERE event_type = 'error' AND second_type = 'error' AND last_type = 'error' AND last_ts < ts + INTERVAL 7 DAY""",
    "split_streams": f"SELECT event_id, value, routes FROM {ROUTED}",
    "union_streams": f"""
        SELECT event_id, user_id, value FROM {ROUTED}
        UNION ALL SELECT event_id, user_id, value FROM {ROUTED} WHERE routes = 'high30'""",
    "comap_union": f"""
        SELECT user_id, CASE WHEN routes = 'high30' THEN value END AS value,
               CASE WHEN routes = 'high30' THEN 'warning' ELSE 'healthy' END AS state FROM {ROUTED}""",
    "freezing_alert": """
        SELECT event_id, user_id, value, CASE WHEN value < 32 THEN 'side' ELSE 'main' END AS route,
               CASE WHEN value < 32 THEN 'freezing alert for ' || user_id END AS alert FROM events""",
    "prefix_filter": """
        SELECT event_id, 's_' || user_id AS id FROM events WHERE starts_with(CAST(user_id AS VARCHAR), '1')""",
    "partition_map": "SELECT event_id, upper(event_type) AS label FROM events",
    "word_count": """
        SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "word_count_nonempty": """
        SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "parse_events": f"""
        SELECT user_id, event_id AS item_id, {K} AS category_id, event_type AS behavior,
               CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp" FROM events""",
    "parse_quarantine": """
        WITH p AS (
            SELECT 's_' || user_id AS id,
                   CASE WHEN event_type <> 'error' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS "timestamp",
                   CASE WHEN event_type <> 'signup' THEN CAST(event_id AS DOUBLE) END AS temperature, event_id
            FROM events)
        SELECT id, "timestamp", temperature,
               CASE WHEN "timestamp" IS NULL THEN id || ',n/a,' || event_id
                    WHEN temperature IS NULL THEN id || ',' || "timestamp" END AS raw,
               "timestamp" IS NOT NULL AND temperature IS NOT NULL AS ok
        FROM p""",
    "periodic_watermark": "SELECT max(ts) - INTERVAL 60 SECOND AS watermark FROM events",
    "punctuated_watermark": "SELECT max(ts) - INTERVAL 60 SECOND AS watermark FROM events WHERE user_id = 1",
    "scalar_functions": f"""
        SELECT event_id, {HASH} AS hash, {text_time('ts')} AS text_time,
               date_trunc('day', ts) + INTERVAL 1 DAY AS resets_at, abs(value - 100) AS distance,
               event_type IN ('click', 'view') AS is_visit, ends_with(event_type, 'up') AS ends_up
        FROM events""",
    "latest_per_key": "SELECT user_id, arg_max(value, ts) AS value FROM events GROUP BY user_id",
    "sensor_documents": """
        SELECT CAST(user_id AS VARCHAR) AS sensor_id, CAST(value AS VARCHAR) AS temperature,
               CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts FROM events""",
    "topic_records": """
        SELECT CAST(user_id AS VARCHAR) AS "key",
               'SensorReading(' || user_id || ',' || CAST(floor(epoch(ts)) AS BIGINT) || ',' || value || ')' AS "value"
        FROM events""",
    "text_records": """
        SELECT 'word count' AS label, '(' || event_type || ',' || count(*) || ')' AS "value" FROM events GROUP BY event_type""",
}

# streams read to their end
ORDER_KINDS = "'signup', 'purchase'"
ORACLE |= {
    "stream_page_view": f"SELECT window_end, pv FROM ({ORACLE['page_view']})",
    "stream_unique_visitor": ORACLE["unique_visitor"],
    "stream_uv_bitmap": ORACLE["uv_bitmap"],
    "stream_hot_items": ORACLE["hot_items"],
    "stream_temp_jump": ORACLE["temp_jump"],
    "stream_login_fail_pair": ORACLE["login_fail_pair"],
    "stream_ad_blacklist": f"""
        SELECT user_id, ad_id, ts, event_id, CASE WHEN rn <= 2 THEN 'main' ELSE 'warning' END AS route
        FROM {CLICKS} WHERE rn <= 3""",
    "stream_pay_match": ORACLE["pay_match"],
    "stream_pay_unmatched": ORACLE["pay_unmatched"],
    "stream_hot_urls": ORACLE["hot_urls"],
    "stream_order_warning": f"SELECT user_id, day, msg FROM ({ORACLE['order_paid_warning']})",
    "stream_ad_by_geo": f"""
        SELECT {text_time('window_end')} AS window_end, province, "count"
        FROM ({sliding(GOOD_CLICKS, 'province', HOUR, 5 * SECOND)})""",
    "stream_sensor_min": ORACLE["sensor_min_window"],
    "stream_channel_count": ORACLE["channel_count"],
    "stream_word_sum": ORACLE["running_word_sum"],
    "stream_value_sum": ORACLE["running_sum"],
    "stream_running_reduce": ORACLE["running_reduce"],
    "stream_uv_running": ORACLE["uv_running"],
    "stream_fail_times": """
        SELECT user_id, fail1, CASE WHEN second THEN e1 END AS fail2, CASE WHEN third THEN e2 END AS fail3, route FROM (
            SELECT *, CASE WHEN third THEN 'match' WHEN k1 <> 'error' AND near1 OR second AND k2 <> 'error' AND near2 THEN NULL
                           ELSE 'timeout' END AS route
            FROM (SELECT *, coalesce(k1 = 'error' AND near1, false) AS second,
                         coalesce(k1 = 'error' AND near1 AND k2 = 'error' AND near2, false) AS third
                  FROM (SELECT user_id, event_id AS fail1, event_type, lead(event_id) OVER w AS e1, lead(event_id, 2) OVER w AS e2,
                               lead(event_type) OVER w AS k1, lead(event_type, 2) OVER w AS k2,
                               lead(ts) OVER w - ts < INTERVAL 72 HOUR AS near1, lead(ts, 2) OVER w - ts < INTERVAL 72 HOUR AS near2
                        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
            WHERE event_type = 'error')
        WHERE route IS NOT NULL""",
    "stream_signup_path": """
        WITH n AS (
            SELECT user_id, event_id, ts, event_type,
                   first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER w AS c,
                   first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS p
            FROM events
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
        SELECT s.user_id, s.event_id AS signup, CASE WHEN c.ts - s.ts < INTERVAL 48 HOUR THEN c.event_id END AS click,
               CASE WHEN p.ts - s.ts < INTERVAL 48 HOUR THEN p.event_id END AS purchase,
               CASE WHEN p.ts - s.ts < INTERVAL 48 HOUR THEN 'match' ELSE 'timeout' END AS route
        FROM n s LEFT JOIN n c ON c.event_id = s.c LEFT JOIN events p ON p.event_id = c.p
        WHERE s.event_type = 'signup'""",
    "stream_latest_per_key": ORACLE["latest_per_key"],
    "stream_login_fail_burst": ORACLE["login_fail_burst"],
    "stream_order_sequence": f"""
        SELECT user_id, create_id, CASE WHEN pay_ts < create_ts + INTERVAL 12 HOUR THEN pay_id END AS pay_id,
               CASE WHEN pay_ts < create_ts + INTERVAL 12 HOUR THEN 'match' ELSE 'timeout' END AS route
        FROM {NEXT_PAY}""",
    "stream_order_status": f"""
        SELECT user_id, msg, CASE WHEN msg = 'paid ok' THEN 'main' ELSE 'side' END AS route FROM (
            SELECT *, CASE WHEN create_ts IS NULL OR pay_ts < create_ts THEN 'paid but not found create log'
                           WHEN pay_ts IS NULL THEN 'order timeout'
                           WHEN pay_ts < create_ts + INTERVAL 72 HOUR THEN 'paid ok' ELSE 'paid but timeout' END AS msg
            FROM (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS create_ts,
                         min(ts) FILTER (event_type = 'purchase') AS pay_ts
                  FROM events WHERE event_type IN ({ORDER_KINDS}) GROUP BY user_id))""",
}
