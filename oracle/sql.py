"""The same results in plain SQL over the input tables, for another engine."""

from __future__ import annotations

SIZES = {"10s": "10 seconds", "1d": "1 day"}
LIMITS = {"10s": 10_000, "1h": 3_600_000, "6h": 21_600_000}

EVENTS = """
ev AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events
)"""

PAGES = EVENTS + """,
page_log AS (
  SELECT event_id AS seq,
         CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         'v' || (k % 3) AS vc, 'ch' || (k % 4) AS ch, 'ar' || (user_id % 5) AS ar,
         CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'trade' WHEN 'signup' THEN 'login' ELSE 'error' END AS page_id,
         CASE WHEN event_type IN ('view', 'signup') THEN NULL
              WHEN event_type = 'click' AND k < 20 THEN 'login'
              WHEN event_type = 'purchase' THEN 'search' ELSE 'home' END AS last_page_id,
         p_name AS item,
         CAST(floor(value * 100) AS BIGINT) AS during_time,
         ms AS ts, make_timestamp(ms * 1000) AS t, CAST(make_timestamp(ms * 1000) AS DATE) AS d
  FROM ev LEFT JOIN part ON event_type = 'purchase' AND p_partkey = event_id % (SELECT max(p_partkey) + 1 FROM part)
)"""

UNIQUE = """,
uv AS (
  SELECT * FROM (
    SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY ts, seq) AS l
    FROM page_log WHERE last_page_id IS NULL)
  WHERE l IS NULL OR l <> d
)"""


def jumps(limit: int) -> str:
    return f""",
uj AS (
  SELECT * FROM (
    SELECT *, lead(ts) OVER o AS nts, lead(last_page_id IS NULL) OVER o AS nstart
    FROM page_log WINDOW o AS (PARTITION BY mid ORDER BY ts, seq))
  WHERE last_page_id IS NULL AND (nts IS NULL OR nts >= ts + {limit} OR nstart)
)"""


def window(size: str, time: str = "t") -> str:
    return f"time_bucket(INTERVAL '{size}', {time})"


def bounds(size: str, w: str = "w") -> str:
    return (
        f"strftime({w}, '%Y-%m-%d %H:%M:%S') AS stt, "
        f"strftime({w} + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime({w}, '%Y-%m-%d') AS cur_date"
    )


# --------------------------------------------------------------------------
# Raw log
# --------------------------------------------------------------------------
LOG = EVENTS + """,
torn AS (SELECT * FROM ev WHERE event_type = 'error' AND k >= 90),
raw AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, k, event_type, ms AS ts,
         CAST(make_timestamp(ms * 1000) AS DATE) AS d,
         CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         'v' || (k % 3) AS vc, 'ch' || (k % 4) AS ch, 'ar' || (user_id % 5) AS ar,
         CASE WHEN k < 50 THEN '1' ELSE '0' END AS was_new,
         event_type = 'signup' AND k < 30 AS is_start,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'trade' WHEN 'signup' THEN 'login' ELSE 'error' END AS page_id,
         CASE WHEN event_type IN ('view', 'signup') THEN NULL
              WHEN event_type = 'click' AND k < 20 THEN 'login'
              WHEN event_type = 'purchase' THEN 'search' ELSE 'home' END AS last_page_id,
         CAST(floor(value * 100) AS BIGINT) AS during_time
  FROM ev WHERE NOT (event_type = 'error' AND k >= 90)
),
marked AS (
  SELECT *, first_value(was_new) OVER o AS first_new, first_value(d) OVER o AS first_d
  FROM raw WINDOW o AS (PARTITION BY mid ORDER BY ts, seq)
),
log AS (
  SELECT *, CASE WHEN was_new = '1'
                  AND (CASE WHEN first_new = '1' THEN first_d ELSE first_d - 1 END) <> d
                 THEN '0' ELSE was_new END AS is_new
  FROM marked
),
shown AS (
  SELECT *, unnest(range(1, k % 4 + 1)) AS item FROM log WHERE event_type = 'view'
),
acted AS (
  SELECT *, unnest(range(1, k % 3 + 1)) AS action_id FROM log
  WHERE event_type IN ('click', 'purchase')
)"""

# --------------------------------------------------------------------------
# Database changes
# --------------------------------------------------------------------------
CLOCK = "'%Y-%m-%d %H:%M:%S'"

DIC = """
dic(code, name) AS (VALUES
  ('1001','unpaid'),('1002','paid'),('1003','cancelled'),('1004','finished'),
  ('1005','refunding'),('1006','refunded'),('1101','alipay'),('1102','wechat pay'),
  ('1103','union pay'),('1201','good'),('1202','fair'),('1203','poor'),('1204','automatic'),
  ('1301','quality'),('1302','description'),('1303','out of stock'),('1304','wrong size'),
  ('1305','wrong order'),('1306','not wanted'),('1307','other'),('1401','unused'),
  ('1402','using'),('1403','used'),('1501','refund only'),('1502','return and refund'),
  ('2401','search'),('2402','promotion'),('2403','recommendation'),('2404','activity'))"""

ORDERS = DIC + f""",
od AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d')) AS id, *,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS share,
         strftime(l_shipdate, {CLOCK}) AS shipped,
         strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
         CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS ship_ts
  FROM lineitem
),
act AS (
  SELECT id, CAST(l_suppkey % 7 AS VARCHAR) AS activity_id,
         CAST(l_partkey % 11 AS VARCHAR) AS activity_rule_id
  FROM od WHERE l_returnflag = 'R'
),
cou AS (
  SELECT id, CAST(l_partkey % 13 AS VARCHAR) AS coupon_id FROM od WHERE l_discount >= 0.08
),
oi AS (
  SELECT o_orderkey, o_custkey, 'insert' AS type, '1001' AS order_status,
         NULL AS operated, NULL AS old_status, o_orderdate AS tm
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'update',
         CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1005' ELSE '1002' END,
         o_orderdate + INTERVAL 10 MINUTE, '1001', o_orderdate + INTERVAL 10 MINUTE
  FROM orders
),
pay AS (
  SELECT *, o_orderdate + CAST(o_custkey % 30 AS INT) * INTERVAL 1 MINUTE AS called_at,
         '110' || (o_custkey % 4 + 1) AS pay_code
  FROM orders WHERE o_orderstatus = 'P'
),
wide AS (
  SELECT od.id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         order_status, CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
         CAST(o_custkey % 25 AS VARCHAR) AS province_id,
         activity_id, activity_rule_id, coupon_id,
         ship_day AS date_id, shipped AS create_time,
         strftime(operated, '%Y-%m-%d') AS operate_date_id,
         strftime(operated, {CLOCK}) AS operate_time,
         CAST(l_suppkey AS VARCHAR) AS source_id, '240' || (l_suppkey % 5 + 1) AS source_type,
         name AS source_type_name, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
         CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * price AS VARCHAR)
           AS split_original_amount,
         CASE WHEN l_returnflag = 'R' THEN CAST(price * share AS VARCHAR) END
           AS split_activity_amount,
         CASE WHEN l_discount >= 0.08 THEN CAST(price * share AS VARCHAR) END
           AS split_coupon_amount,
         CAST(price * (CAST(1 AS DECIMAL(4,2)) - share) AS VARCHAR) AS split_total_amount,
         type, old_status, ship_ts AS od_ts,
         CAST(CAST(epoch(tm) AS BIGINT) AS VARCHAR) AS oi_ts
  FROM od JOIN oi ON l_orderkey = o_orderkey
       JOIN dic ON code = '240' || (l_suppkey % 5 + 1)
       LEFT JOIN act ON act.id = od.id
       LEFT JOIN cou ON cou.id = od.id
),
placed AS (SELECT *, source_type AS source_type_code FROM wide WHERE type = 'insert'),
paid AS (
  SELECT w.*, pay_code, dic.name AS pay_name, strftime(called_at, {CLOCK}) AS callback_time,
         CAST(epoch(called_at) AS BIGINT) AS pay_s, called_at
  FROM placed w JOIN pay ON order_id = CAST(o_orderkey AS VARCHAR) JOIN dic ON code = pay_code
)"""

DETAIL_AMOUNTS = "sku_num, split_original_amount, split_activity_amount, split_coupon_amount"
DETAIL_KEYS = (
    "order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id"
)

EVENT_CHANGES = DIC + "," + EVENTS + f""",
cart AS (
  SELECT event_id, user_id, k, event_id % 3 = 0 AS fresh, k % 9 + 1 AS put, k % 7 AS now,
         k % 5 AS old, CAST(floor(epoch(ts)) AS BIGINT) AS s
  FROM ev WHERE event_type = 'purchase'
),
cart_add AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(k AS VARCHAR) AS sku_id, CAST(k AS VARCHAR) AS source_id,
         code AS source_type_code, name AS source_type_name,
         CAST(CASE WHEN fresh THEN put ELSE now - old END AS VARCHAR) AS sku_num,
         CAST(s AS VARCHAR) AS ts, s, make_timestamp(s * 1000000) AS t, event_id
  FROM cart JOIN dic ON code = '240' || (k % 5 + 1)
  WHERE fresh OR now > old
)"""

EVENT_COLUMNS = f"""CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(k AS VARCHAR) AS sku_id, strftime(ts, '%Y-%m-%d') AS date_id,
  strftime(ts, {CLOCK}) AS create_time, CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts"""

COUPON = """CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 10 AS VARCHAR) AS coupon_id,
  CAST(o_custkey AS VARCHAR) AS user_id"""
ORDER_TS = "CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS ts"

DIMENSIONS = """
upserts AS (
  SELECT 'dim_region' AS sink_table, CAST(r_regionkey AS VARCHAR) AS pk, 1::BIGINT AS version,
         unnest([{'name': 'r_regionkey', 'value': CAST(r_regionkey AS VARCHAR)},
                 {'name': 'r_name', 'value': r_name}]) AS cell FROM region
  UNION ALL
  SELECT 'dim_nation', CAST(n_nationkey AS VARCHAR), v,
         unnest([{'name': 'n_nationkey', 'value': CAST(n_nationkey AS VARCHAR)},
                 {'name': 'n_name', 'value': n_name}])
  FROM nation, (VALUES (1::BIGINT), (3::BIGINT)) versions(v) WHERE v = 1 OR n_regionkey = 2
  UNION ALL
  SELECT 'dim_sku', CAST(p_partkey AS VARCHAR), v,
         unnest([{'name': 'p_partkey', 'value': CAST(p_partkey AS VARCHAR)},
                 {'name': 'p_name', 'value': p_name},
                 {'name': 'p_brand', 'value': p_brand || CASE WHEN v = 2 THEN ' II' ELSE '' END}])
  FROM part, (VALUES (1::BIGINT), (2::BIGINT)) versions(v) WHERE v = 1 OR p_size > 25
)"""

WORD = r"[\p{L}\p{M}\p{N}]+"
CJK = r"぀-ヿ㐀-䶿一-鿿가-힯\x{20000}-\x{3FFFF}"


def words(table: str) -> str:
    return f"""
WITH runs AS (
  SELECT unnest(regexp_extract_all(
    regexp_replace(lower(text), '([{CJK}]+)', ' \\1 ', 'g'), '{WORD}')) AS r FROM {table}
),
words AS (
  SELECT unnest(CASE WHEN NOT regexp_matches(r, '^[{CJK}]') OR length(r) < 2 THEN [r]
                     ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END)
         AS keyword
  FROM runs
)
SELECT keyword, count(*) AS keyword_count FROM words GROUP BY keyword"""


def oracle_sql() -> dict[str, str]:
    flat = "seq, mid, uid, vc, ch, ar, is_new, page_id, last_page_id"
    sql = {
        "log_errors": f"WITH {LOG} SELECT seq, mid, is_new, "
        "CASE WHEN NOT is_start THEN page_id END AS page_id, CAST(k AS BIGINT) AS error_code, ts "
        "FROM log WHERE event_type = 'error' OR (is_start AND k < 10)",
        "log_starts": f"WITH {LOG} SELECT seq, mid, is_new, CAST(k AS BIGINT) AS loading_time, ts "
        "FROM log WHERE is_start",
        "log_displays": f"WITH {LOG} SELECT seq, mid, is_new, page_id, item, ts FROM shown",
        "log_actions": f"WITH {LOG} SELECT seq, mid, is_new, page_id, action_id FROM acted",
        "log_pages": f"WITH {LOG} SELECT {flat}, during_time, ts FROM log WHERE NOT is_start",
        "log_dirty": f"WITH {LOG} SELECT event_id AS seq, "
        """substr('{"common":{"mid":"' || user_id || '","uid', 1, 20) AS value FROM torn""",
        "log_routed_topics": f"""WITH {LOG}, routed AS (
  SELECT 'dwd_traffic_error_log' AS topic, seq FROM log
   WHERE event_type = 'error' OR (is_start AND k < 10)
  UNION ALL SELECT 'dwd_traffic_start_log', seq FROM log WHERE is_start
  UNION ALL SELECT 'dwd_traffic_display_log', seq FROM shown
  UNION ALL SELECT 'dwd_traffic_action_log', seq FROM acted
  UNION ALL SELECT 'dwd_traffic_page_log', seq FROM log WHERE NOT is_start)
SELECT topic, seq, count(*) AS n FROM routed GROUP BY topic, seq""",
        "log_routed_messages": f"""WITH {LOG}, texts AS (
  SELECT *, '"common":{{"mid":"' || mid || '"' || coalesce(',"uid":"' || uid || '"', '') || ',"vc":"' || vc
      || '","ch":"' || ch || '","ar":"' || ar || '","is_new":"' || is_new || '"}}' AS common,
    CASE WHEN NOT is_start THEN ',"page":{{"page_id":"' || page_id || '"'
      || coalesce(',"last_page_id":"' || last_page_id || '"', '') || ',"during_time":' || during_time || '}}' ELSE '' END AS page,
    CASE WHEN is_start THEN ',"start":{{"entry":"icon","loading_time":' || k || '}}' ELSE '' END AS start,
    CASE WHEN event_type = 'view' AND k % 4 > 0 THEN ',"displays":[' || array_to_string(list_transform(
      range(1, k % 4 + 1), lambda i: '{{"item":' || i || ',"type":"promotion"}}'), ',') || ']' ELSE '' END AS displays,
    CASE WHEN event_type IN ('click', 'purchase') AND k % 3 > 0 THEN ',"actions":[' || array_to_string(list_transform(
      range(1, k % 3 + 1), lambda i: '{{"action_id":' || i || ',"type":"promotion"}}'), ',') || ']' ELSE '' END AS actions,
    ',"ts":' || ts || '}}' AS stamp
  FROM log)
SELECT 'dwd_traffic_error_log' AS topic, seq,
  '{{' || common || page || start || displays || actions || ',"err":{{"error_code":' || k || '}}' || stamp AS value
FROM texts WHERE event_type = 'error' OR (is_start AND k < 10)
UNION ALL SELECT 'dwd_traffic_start_log', seq, '{{' || common || page || start || displays || actions || stamp
FROM texts WHERE is_start
UNION ALL SELECT 'dwd_traffic_display_log', seq, '{{"display":{{"item":' || unnest(range(1, k % 4 + 1))
  || ',"type":"promotion"}},' || common || page || stamp FROM texts WHERE NOT is_start AND event_type = 'view'
UNION ALL SELECT 'dwd_traffic_action_log', seq, '{{"action":{{"action_id":' || unnest(range(1, k % 3 + 1))
  || ',"type":"promotion"}},' || common || page || '}}' FROM texts
  WHERE NOT is_start AND event_type IN ('click', 'purchase')
UNION ALL SELECT 'dwd_traffic_page_log', seq, '{{' || common || page || stamp FROM texts WHERE NOT is_start""",
        "visitor_flag_repair": f"""WITH {PAGES}, marked AS (
  SELECT *, first_value(is_new) OVER o AS first_new, first_value(d) OVER o AS first_d
  FROM page_log WINDOW o AS (PARTITION BY mid ORDER BY ts, seq))
SELECT seq, mid, CASE WHEN is_new = '1'
   AND (CASE WHEN first_new = '1' THEN first_d ELSE first_d - 1 END) <> d
  THEN '0' ELSE is_new END AS is_new FROM marked""",
        "unique_visitor_detail": f"WITH {PAGES} {UNIQUE} SELECT {flat}, during_time, ts FROM uv",
        **{
            f"user_jump_detail_{n}": f"WITH {PAGES} {jumps(ms)} SELECT {flat}, ts FROM uj"
            for n, ms in LIMITS.items()
        },
        "cart_add_detail": f"WITH {EVENT_CHANGES} SELECT id, user_id, sku_id, source_id, "
        "source_type_code, source_type_name, sku_num, ts FROM cart_add",
        "cart_add_messages": f"""WITH {EVENT_CHANGES} SELECT '{{"id":"' || id || '","user_id":"' || user_id
  || '","sku_id":"' || sku_id || '","source_id":"' || source_id || '","source_type_code":"' || source_type_code
  || '","source_type_name":"' || source_type_name || '","sku_num":"' || sku_num || '","ts":"' || ts || '"}}' AS value
FROM cart_add""",
        "event_time_texts": """
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, strftime(ts, '%Y%m%d') AS partition,
  strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS day_before,
  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days,
  epoch_ms(date_trunc('day', ts)) AS day_ms, epoch_ms(date_trunc('second', ts)) AS second_ms
FROM events""",
        "order_wide_detail": f"WITH {ORDERS} SELECT * FROM wide",
        "order_wide_upserted": f"WITH {ORDERS} SELECT * EXCLUDE (old_status) FROM wide "
        "QUALIFY row_number() OVER (PARTITION BY id ORDER BY CAST(oi_ts AS BIGINT) DESC) = 1",
        "order_placed_detail": f"WITH {ORDERS} SELECT id, {DETAIL_KEYS}, date_id, create_time, "
        f"source_id, source_type_code, source_type_name, {DETAIL_AMOUNTS}, split_total_amount, "
        "od_ts AS ts FROM placed",
        "order_cancel_detail": f"WITH {ORDERS} SELECT id, {DETAIL_KEYS}, "
        "operate_date_id AS date_id, operate_time AS cancel_time, source_id, "
        f"source_type AS source_type_code, source_type_name, {DETAIL_AMOUNTS}, "
        "split_total_amount, oi_ts AS ts FROM wide WHERE type = 'update' "
        "AND old_status IS NOT NULL AND order_status = '1003'",
        "payment_detail": f"WITH {ORDERS} SELECT id AS order_detail_id, {DETAIL_KEYS}, "
        "pay_code AS payment_type_code, pay_name AS payment_type_name, callback_time, source_id, "
        f"source_type_code, source_type_name, {DETAIL_AMOUNTS}, "
        "split_total_amount AS split_payment_amount, CAST(pay_s AS VARCHAR) AS ts FROM paid",
        **{
            f"payment_order_within_{n}s": f"""WITH {ORDERS}
SELECT CAST(pay.o_orderkey AS VARCHAR) AS order_id, strftime(called_at, {CLOCK}) AS callback_time,
       order_status
FROM pay JOIN oi ON pay.o_orderkey = oi.o_orderkey AND oi.type = 'update'
WHERE abs(epoch(called_at) - epoch(tm)) <= {n}"""
            for n in (905, 5)
        },
        "order_refund_detail": f"""WITH {ORDERS}
SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
       ship_day AS date_id, shipped AS create_time, t.code AS refund_type_code,
       t.name AS refund_type_name, r.code AS refund_reason_type_code,
       r.name AS refund_reason_type_name, 'line ' || l_linenumber AS refund_reason_txt,
       CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num,
       CAST(price AS VARCHAR) AS refund_amount, ship_ts AS ts
FROM od JOIN oi ON l_orderkey = o_orderkey AND type = 'update' AND order_status = '1005'
JOIN dic t ON t.code = '150' || (l_linenumber % 3 + 1)
JOIN dic r ON r.code = '130' || (l_suppkey % 8 + 1)
WHERE l_returnflag = 'R'""",
        "refund_payment_detail": f"""WITH {ORDERS}
SELECT p.id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(p.l_orderkey AS VARCHAR) AS order_id,
       CAST(p.l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
       code AS payment_type_code, name AS payment_type_name, p.ship_day AS date_id,
       p.shipped AS callback_time, CAST(CAST(r.l_quantity AS INT) AS VARCHAR) AS refund_num,
       CAST(p.price AS VARCHAR) AS refund_amount, p.ship_ts AS ts
FROM od p JOIN oi ON p.l_orderkey = o_orderkey AND type = 'update'
JOIN od r ON p.l_orderkey = r.l_orderkey AND p.l_partkey = r.l_partkey AND r.l_returnflag = 'R'
JOIN dic ON code = '110' || (p.l_suppkey % 4 + 1)
WHERE p.l_returnflag = 'R' AND p.l_linestatus = 'F'""",
        "coupon_get_detail": f"""SELECT {COUPON},
  strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS date_id,
  strftime(o_orderdate - INTERVAL 1 DAY, {CLOCK}) AS get_time,
  CAST(CAST(epoch(o_orderdate) AS BIGINT) - 86400 AS VARCHAR) AS ts FROM orders""",
        "coupon_order_detail": f"""SELECT {COUPON}, CAST(o_orderkey AS VARCHAR) AS order_id,
  strftime(o_orderdate, '%Y-%m-%d') AS date_id, strftime(o_orderdate, {CLOCK}) AS order_time,
  {ORDER_TS} FROM orders WHERE o_orderstatus IN ('P', 'O')""",
        "coupon_pay_detail": f"""WITH p AS (
  SELECT *, o_orderdate + CAST(o_custkey % 30 AS INT) * INTERVAL 1 MINUTE AS tm FROM orders
  WHERE o_orderstatus = 'P')
SELECT {COUPON}, CAST(o_orderkey AS VARCHAR) AS order_id, strftime(tm, '%Y-%m-%d') AS date_id,
  strftime(tm, {CLOCK}) AS payment_time, {ORDER_TS} FROM p""",
        "favor_add_detail": f"WITH {EVENTS} SELECT {EVENT_COLUMNS} FROM ev "
        "WHERE event_type = 'click'",
        "comment_detail": f"WITH {EVENT_CHANGES} SELECT {EVENT_COLUMNS}, "
        "CAST(event_id AS VARCHAR) AS order_id, code AS appraise_code, name AS appraise_name "
        "FROM ev JOIN dic ON code = '120' || (k % 5 + 1) WHERE event_type = 'error'",
        "user_register_detail": f"WITH {EVENTS}, r AS (SELECT {EVENT_COLUMNS} FROM ev "
        "WHERE event_type = 'signup') SELECT user_id, date_id, create_time, ts FROM r",
        "keyword_counts_documents": words("documents"),
        "keyword_counts_conversations": words("conversations"),
        "latest_event_by_user": f"""SELECT user_id, event_type, event_id,
  strftime(ts, '%Y-%m-%d') AS day, strftime(ts, {CLOCK}) AS last_visit,
  CAST(floor(value * 100) AS BIGINT) AS cost FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
        "aggregate_key_merge": f"""WITH e AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS day, CAST(floor(value * 100) AS BIGINT) AS c FROM events)
SELECT user_id, day, event_type, arg_max(strftime(ts, {CLOCK}), event_id) AS last_visit,
  CAST(sum(c) AS BIGINT) AS cost, max(c) AS max_dwell, min(c) AS min_dwell
FROM e GROUP BY user_id, day, event_type""",
        "login_days": f"""WITH {PAGES}, l AS (
  SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY ts, seq) AS last FROM page_log
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login'))
SELECT uid, ts, CAST(CASE WHEN date_diff('day', last, d) >= 8 THEN 1 ELSE 0 END AS INT) AS back
FROM l WHERE last IS NULL OR last <> d""",
        "dimension_cells": f"WITH {DIMENSIONS} SELECT sink_table, pk, version, cell.name AS name, "
        "cell.value AS value FROM upserts",
        "dimension_sku": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
  p_brand || CASE WHEN p_size > 25 THEN ' II' ELSE '' END AS p_brand FROM part""",
        "dimension_sizes": """SELECT 'dim_region' AS sink_table, count(*) AS n,
  count(*) * 2 AS cells FROM region
UNION ALL SELECT 'dim_nation', count(*), count(*) * 2 FROM nation
UNION ALL SELECT 'dim_sku', count(*), count(*) * 3 FROM part""",
    }
    for n, size in SIZES.items():
        sql |= _windows(n, size)
    sql["payment_upserted"] = f"""SELECT * FROM ({sql["payment_detail"]})
QUALIFY row_number() OVER (PARTITION BY order_detail_id ORDER BY CAST(ts AS BIGINT) DESC) = 1"""
    sql |= {f"{n}_from_messages": sql[f"{n}_detail"] for n in ("cart_add", "coupon_order")}
    streamed = {f"stream_{name}": sql[name] for name in STREAMED}
    tables = f"""WITH {DIMENSIONS}
SELECT sink_table, pk, cell.name AS name, cell.value AS value FROM upserts
QUALIFY rank() OVER (PARTITION BY sink_table, pk ORDER BY version DESC) = 1"""
    return sql | streamed | {
        "stream_payer_window_changes": sql["payer_window_1d"],
        "stream_dimension_tables": tables,
    }


# Results that the streaming operators give as well.
STREAMED = [
    "log_routed_topics", "unique_visitor_detail", "keyword_window_1d", "page_window_1d",
    "login_window_1d", "register_window_1d", "cart_window_1d", "dimension_sku",
    "user_jump_detail_10s", "traffic_window_1d", "cart_add_detail", "comment_detail",
    "coupon_get_detail", "coupon_order_detail", "coupon_pay_detail", "favor_add_detail",
    "user_register_detail", "order_wide_upserted", "payment_detail", "payer_window_1d",
    "order_refund_detail", "refund_payment_detail", "log_routed_messages", "log_dirty",
    "order_placed_detail", "order_cancel_detail", "payment_upserted", "payment_order_within_905s",
    "aggregate_key_merge",
]


def _windows(n: str, size: str) -> dict[str, str]:
    w, b = window(size), bounds(size)

    def total(name: str, expr: str) -> str:
        return f"CAST(sum({expr}) AS BIGINT) AS {name}"

    return {
        f"keyword_window_{n}": f"""WITH {PAGES}, words AS (
  SELECT {window(size, "date_trunc('second', t)")} AS w,
         unnest(regexp_extract_all(lower(item), '{WORD}')) AS keyword
  FROM page_log WHERE item IS NOT NULL AND last_page_id = 'search')
SELECT {b}, 'SEARCH' AS source, keyword, count(*) AS keyword_count
FROM words GROUP BY w, keyword""",
        f"traffic_window_{n}": f"""WITH {PAGES} {UNIQUE} {jumps(10_000)}, m AS (
  SELECT t, vc, ch, ar, is_new, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv,
         1 AS pv, coalesce(during_time, 0) AS dur, 0 AS uj FROM page_log
  UNION ALL SELECT t, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uv
  UNION ALL SELECT t + INTERVAL 10 SECOND, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM uj),
g AS (SELECT {w} AS w, * FROM m)
SELECT {b}, vc, ch, ar, is_new, {total('uv_ct', 'uv')}, {total('sv_ct', 'sv')},
  {total('pv_ct', 'pv')}, {total('dur_sum', 'dur')}, {total('uj_ct', 'uj')}
FROM g GROUP BY w, vc, ch, ar, is_new""",
        f"page_window_{n}": f"""WITH {PAGES}, f AS (
  SELECT *, lag(d) OVER (PARTITION BY mid, page_id ORDER BY ts, seq) AS l FROM page_log
  WHERE page_id IN ('home', 'good_detail')),
g AS (SELECT {w} AS w, page_id FROM f WHERE l IS NULL OR l <> d)
SELECT {b}, {total('home_uv_ct', "CAST(page_id = 'home' AS INT)")},
  {total('good_detail_uv_ct', "CAST(page_id = 'good_detail' AS INT)")} FROM g GROUP BY w""",
        f"login_window_{n}": f"""WITH {PAGES}, f AS (
  SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY ts, seq) AS l FROM page_log
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')),
g AS (SELECT {w} AS w, CASE WHEN date_diff('day', l, d) >= 8 THEN 1 ELSE 0 END AS back
      FROM f WHERE l IS NULL OR l <> d)
SELECT {b}, {total('back_ct', 'back')}, count(*) AS uu_ct FROM g GROUP BY w""",
        f"register_window_{n}": f"""WITH {EVENTS}, g AS (
  SELECT {window(size, 'ts')} AS w FROM ev WHERE event_type = 'signup')
SELECT {b}, count(*) AS register_ct FROM g GROUP BY w""",
        f"cart_window_{n}": f"""WITH {EVENT_CHANGES}, f AS (
  SELECT *, CAST(t AS DATE) AS d,
         lag(CAST(t AS DATE)) OVER (PARTITION BY user_id ORDER BY s, event_id) AS l FROM cart_add),
g AS (SELECT {w} AS w FROM f WHERE l IS NULL OR l <> d)
SELECT {b}, count(*) AS cart_add_uu_ct FROM g GROUP BY w""",
        f"cart_window_every_add_{n}": f"""WITH {EVENT_CHANGES}, g AS (
  SELECT {w} AS w FROM cart_add)
SELECT {b}, count(*) AS cart_add_uu_ct FROM g GROUP BY w""",
        f"payer_window_{n}": f"""WITH {ORDERS}, f AS (
  SELECT called_at AS t, CAST(called_at AS DATE) AS d,
         lag(CAST(called_at AS DATE)) OVER (PARTITION BY user_id ORDER BY pay_s) AS l FROM paid),
g AS (SELECT {w} AS w, CASE WHEN l IS NULL OR l <> d THEN 1 ELSE 0 END AS u,
             CASE WHEN l IS NULL THEN 1 ELSE 0 END AS f FROM f)
SELECT {b}, {total('payment_suc_unique_user_count', 'u')},
  {total('payment_new_user_count', 'f')} FROM g GROUP BY w""",
    }
