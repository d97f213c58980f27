"""The SQL each sample query is compared with, written for DuckDB."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from tallyline.plans import sample_definitions as samples
from tallyline.plans.sample_queries import MID_SECOND, NOW_SECOND
from tallyline.sources.definitions import BOOTSTRAP
from tallyline.sources.feeds import REDELIVERY_OFFSET


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Iterable[str]) -> str:
    return f"CAST([{', '.join(_text(v) for v in values)}] AS VARCHAR[])"


def _definitions(rows: Iterable[Mapping]) -> str:
    values = ", ".join(
        f"({n}, {_text(r['refName'])}, {_list(r.get('eventTypeCodes') or ())}, {_list(r.get('dimensions') or ())},"
        f" {_text(r.get('sliceGranularity', 'DAY').strip().upper())}, {r.get('windowDays', 1)},"
        f" {_text(r.get('accScript', 'current + 1'))})"
        for n, r in enumerate(r for r in rows if r.get("status", "ONLINE") == "ONLINE")
    )
    return f"""defs AS (
  SELECT *, greatest(1, days * 86400 // step) AS slices FROM (
    SELECT *, CASE gran WHEN 'MINUTE' THEN 60 WHEN 'HOUR' THEN 3600 ELSE 86400 END AS step
    FROM (VALUES {values}) AS d(ord, ref, codes, dims, gran, days, script)))"""


_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"

EVENTS = f"""src AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS code, epoch_us(ts) // 1000 AS ms, event_id AS seq,
         CAST(user_id AS VARCHAR) AS user_id, value AS amount, {_K} AS k, event_type AS kind,
         CAST(NULL AS DOUBLE) AS own_current
  FROM events)"""

REDELIVERED = f"""src AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS code, epoch_us(ts) // 1000 + later * 3600000 AS ms,
         event_id + later * {REDELIVERY_OFFSET} AS seq, CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN later = 1 THEN value + 1 WHEN {_K} >= 20 THEN value END AS amount,
         {_K} AS k, event_type AS kind, CAST(NULL AS DOUBLE) AS own_current
  FROM events, (VALUES (0), (1)) AS t(later))"""

# What survives of the irregular messages, by k.
_REFUSED = "0, 1, 2, 3, 4, 5, 8, 11, 14, 18, 20"
MESSAGES = f"""src AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CASE WHEN {_K} <> 17 THEN event_type END AS code,
         CASE WHEN {_K} = 9 THEN 0 ELSE epoch_us(ts) // 1000 END AS ms, event_id AS seq,
         CASE WHEN {_K} <> 13 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN {_K} NOT IN (13, 15) THEN value END AS amount,
         CAST(NULL AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS kind,
         CASE WHEN {_K} = 16 THEN 5.0 END AS own_current
  FROM events WHERE {_K} NOT IN ({_REFUSED}))"""

ORDERS = """src AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE o_orderstatus WHEN 'F' THEN 'EVT_FILLED' WHEN 'O' THEN 'EVT_OPEN' WHEN 'P' THEN 'EVT_PENDING' END AS code,
         epoch_us(o_orderdate) // 1000 AS ms, o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_totalprice AS amount, o_orderpriority AS priority, CAST(NULL AS DOUBLE) AS own_current
  FROM orders)"""

_EVENT_FIELDS = {
    "userId": "user_id",
    "merchantId": "user_id",
    "k": "CAST(k AS VARCHAR)",
    "kind": "kind",
    "coupon": "CASE WHEN k < 50 THEN CAST(k AS VARCHAR) END",
}
_ORDER_FIELDS = {"customerId": "customer_id", "priority": "priority"}

_SCRIPTS = {
    "current + 1": "coalesce(own_current, 0.0) + 1.0",
    "current + amount": "coalesce(own_current, 0.0) + amount",
    "amount + current": "coalesce(own_current, 0.0) + amount",
    "greatest(current, amount)": "greatest(0.0, amount)",
    "current * 0.5 + amount": "amount",
    "current + amount + 1": "coalesce(own_current, 0.0) + amount + 1",
    "current + missingVar": "NULL",
    "if(current > 100, amount, current + amount)": "amount",
    "if(current > 500, amount, current + amount)": "amount",
}


def _routed(source: str, rows: Iterable[Mapping], fields: Mapping[str, str] = _EVENT_FIELDS) -> str:
    value = " ".join(f"WHEN '{name}' THEN {sql}" for name, sql in fields.items())
    script = " ".join(f"WHEN {_text(text)} THEN {sql}" for text, sql in _SCRIPTS.items())
    return f"""{source}, {_definitions(rows)}, pairs AS (
  SELECT src.*, defs.*, list_transform(dims, lambda d: CASE d {value} END) AS vals,
         CAST(CASE script {script} END AS DOUBLE) AS inc, ((ms // 1000) // step) * step AS slice_ts
  FROM src JOIN defs ON trim(code) <> '' AND (len(codes) = 0 OR list_contains(codes, code))),
routed AS (
  SELECT *, CASE len(dims) WHEN 1 THEN vals[1] WHEN 0 THEN ''
            ELSE array_to_string(list_transform(range(1, len(dims) + 1), lambda i: dims[i] || '#' || vals[i]), ';')
            END AS dim
  FROM pairs WHERE len(list_filter(vals, lambda v: v IS NULL)) = 0)"""


_FIRST = """firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ref, dim, order_id ORDER BY seq, ord) AS rn
    FROM routed WHERE inc IS NOT NULL) WHERE rn = 1)"""
_KEY = "'ind:' || ref || ':' || dim || ':' || gran || ':' || slice_ts"
_UPDATES = f"""SELECT ref AS ref_name, dim AS dimension_key, gran AS granularity, slice_ts, inc AS increment, order_id,
       {_KEY} AS slice_key, step * slices + step AS ttl_seconds FROM firsts"""
_TOTALS = """totals AS (
  SELECT ref, dim, gran, any_value(step) AS step, any_value(slices) AS slices, slice_ts,
         sum(inc) AS value, count(*) AS n
  FROM firsts GROUP BY ref, dim, gran, slice_ts)"""


def _named(*names: str) -> list[Mapping]:
    return [r for r in samples.EVENTS if r["refName"] in names]


def _updates(source: str, rows: Iterable[Mapping], fields: Mapping[str, str] = _EVENT_FIELDS) -> str:
    return f"WITH {_routed(source, rows, fields)}, {_FIRST} {_UPDATES}"


def _routes(rows: Iterable[Mapping], columns: str, source: str = EVENTS) -> str:
    return f"WITH {_routed(source, rows)} SELECT {columns} FROM routed"


_ROUTE = "ref AS ref_name, order_id"
_ROUTE_KEY = "ref AS ref_name, order_id, dim AS dimension_key"
_PAYMENTS = EVENTS.replace(
    "event_type AS code", "CASE event_type WHEN 'purchase' THEN 'EVT_PAY_RESULT' ELSE event_type END AS code"
)
_BLANKED = EVENTS.replace(
    "event_type AS code", f"CASE WHEN {_K} < 10 THEN ' ' WHEN {_K} >= 20 THEN event_type END AS code"
)
_MOVED = EVENTS.replace("epoch_us(ts) // 1000 AS ms", f"epoch_us(ts) // 1000 - {MID_SECOND * 1000} AS ms")

_REASONS = f"""SELECT fail_reason, count(*) AS messages FROM (
  SELECT CASE WHEN k IN (0, 1) THEN '空消息'
              WHEN k IN (3, 5) THEN '缺少 orderId'
              WHEN k IN (2, 14, 18) THEN '反序列化失败: not an order object'
              WHEN k = 4 THEN '反序列化失败: unknown property'
              WHEN k = 11 THEN '反序列化失败: orderId is not a scalar'
              WHEN k IN (8, 20) THEN '反序列化失败: eventEpochMs is not a number' END AS fail_reason
  FROM (SELECT {_K} AS k FROM events)) WHERE fail_reason IS NOT NULL GROUP BY fail_reason"""


def _running(source: str, rows: Iterable[Mapping], value: str) -> str:
    window = "(PARTITION BY ref, dim, slice_ts ORDER BY seq ROWS UNBOUNDED PRECEDING)"
    return f"""WITH {_routed(source, rows)}, {_FIRST}
SELECT {_KEY} AS slice_key, order_id, round({value.format(window=window)} + 1e-7, 4) AS running_value FROM firsts"""


_DECAYED = "list_reduce(list(inc) OVER {window}, lambda a, b: a * 0.5 + b)"
_RESTARTED = (
    "list_reduce(list(inc) OVER {window}, lambda a, b: CASE WHEN a > CASE ref WHEN 'restarts' THEN 100 ELSE 500 END"
    " THEN b ELSE a + b END)"
)


def _order_by_order(source: str, rows: Iterable[Mapping]) -> str:
    """Deliveries of each indicator one after another: what the slices hold, and which orders counted."""
    return f"""WITH RECURSIVE {_routed(source, rows)},
line AS (SELECT *, row_number() OVER (PARTITION BY ref, dim ORDER BY seq, ord) AS nth FROM routed),
fold AS (
  SELECT ref, dim, CAST(0 AS BIGINT) AS nth, CAST(MAP {{}} AS MAP(BIGINT, DOUBLE)) AS slices, CAST([] AS VARCHAR[]) AS counted,
         CAST(NULL AS BIGINT) AS slice_ts, CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS DOUBLE) AS value
  FROM (SELECT DISTINCT ref, dim FROM routed)
  UNION ALL
  SELECT ref, dim, nth, CASE WHEN value IS NULL THEN slices ELSE map_concat(slices, MAP([slot], [value])) END,
         CASE WHEN value IS NULL THEN counted ELSE list_append(counted, oid) END, slot, oid, value
  FROM (
    SELECT f.ref, f.dim, l.nth, f.slices, f.counted, l.slice_ts AS slot, l.order_id AS oid,
           CASE WHEN list_contains(f.counted, l.order_id) THEN NULL
                WHEN f.ref = 'first_two' THEN CASE WHEN coalesce(f.slices[l.slice_ts], 0) < 2 THEN coalesce(f.slices[l.slice_ts], 0) + 1 END
                WHEN coalesce(f.slices[l.slice_ts], 0) + l.amount <= 100 THEN coalesce(f.slices[l.slice_ts], 0) + l.amount END AS value
    FROM fold f JOIN line l ON l.ref = f.ref AND l.dim = f.dim AND l.nth = f.nth + 1))
SELECT 'ind:' || ref || ':' || dim || ':DAY:' || slice_ts AS slice_key, order_id, round(value + 1e-7, 4) AS running_value
FROM fold WHERE value IS NOT NULL"""


_MANY_FOLDS = f"""WITH RECURSIVE {EVENTS},
line AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY seq) AS nth
         FROM (SELECT seq, amount, CAST(k AS DOUBLE) AS k, (ms // 1000) // 86400 AS day FROM src WHERE code = 'error')),
fold AS (
  SELECT n, day, CAST(0 AS BIGINT) AS nth, CAST(0 AS DOUBLE) AS value
  FROM range({len(samples.MANY_FOLDS)}) AS t(n), (SELECT DISTINCT day FROM line)
  UNION ALL
  SELECT n, f.day, l.nth, CASE WHEN n < 150 THEN f.value * ((n % 9 + 1) / 10.0) + CASE n % 2 WHEN 0 THEN amount ELSE k END
         WHEN f.value > n THEN CASE n % 2 WHEN 0 THEN amount ELSE k END ELSE f.value + 1 END
  FROM fold f JOIN line l ON l.day = f.day AND l.nth = f.nth + 1)
SELECT 'fold_' || n AS ref_name, round(sum(value), 3) AS total, count(*) AS slices
FROM (SELECT n, day, arg_max(value, nth) AS value FROM fold GROUP BY n, day) GROUP BY n"""

_STREAM_RUNNING = [*samples.EXTREMES, *_named("buy_amount_7d")]

_TYPED_REJECTS = """
SELECT 'large_buys' AS ref_name, user_id AS dimension_key, order_id,
       'if(kind = ''purchase'' and amount / (k - 1) > 1, current + amount, null)' AS acc_script,
       'script returned no number' AS reason
FROM src WHERE NOT coalesce(kind = 'purchase' AND k <> 1 AND amount / nullif(k - 1, 0) > 1, false)
UNION ALL
SELECT 'not_a_number', user_id, order_id, 'kind = ''purchase''', 'does not return a number' FROM src
UNION ALL
SELECT 'not_an_expression', user_id, order_id, 'current +', 'does not compile: PARSE_SYNTAX_ERROR' FROM src
UNION ALL
SELECT 'fails', user_id, order_id, 'current + missingVar', 'script returned no number' FROM src WHERE code = 'click'"""

_JOB = _named("buy_amount_1d", "act_cnt_1d", "fails")
_JOB_OUTPUTS = f"""WITH {_routed(MESSAGES, _JOB)}, {_FIRST},
reasons AS ({_REASONS}),
failed AS (SELECT ref, count(*) AS n FROM routed WHERE inc IS NULL GROUP BY ref)
SELECT 'updates' AS output, ref AS kind, {_KEY} AS about, count(*) AS number FROM firsts GROUP BY ALL
UNION ALL SELECT 'letters', 'letter', fail_reason, messages FROM reasons
UNION ALL SELECT 'rejects', ref, 'script returned no number', n FROM failed
UNION ALL SELECT 'counters', 'counter', reason, number FROM (
  SELECT 'messages' AS reason, count(*) AS number FROM events
  UNION ALL SELECT 'routed', count(*) FROM routed
  UNION ALL SELECT 'script returned no number', sum(n) FROM failed
  UNION ALL SELECT CASE WHEN starts_with(fail_reason, '反序列化失败') THEN '反序列化失败' ELSE fail_reason END, sum(messages)
    FROM reasons GROUP BY 1)"""


def _live() -> str:
    """Thirds of the messages under three definition lists; an order counts once under each name."""
    lists = (samples.LIVE[:1], samples.LIVE[:2], samples.LIVE[1:])
    parts = []
    for n, rows in enumerate(lists):
        third = MESSAGES.replace("FROM events WHERE", f"FROM events WHERE event_id % 3 = {n} AND")
        parts.append(f"SELECT * FROM (WITH {_routed(third, rows)}, {_FIRST} {_UPDATES})")
    return " UNION ALL ".join(parts)


SQL: dict[str, str] = {
    "slice_updates_events": _updates(EVENTS, samples.EVENTS),
    "slice_updates_orders": _updates(ORDERS, samples.ORDERS, _ORDER_FIELDS),
    "slice_updates_messages": _updates(MESSAGES, samples.EVENTS),
    "bootstrap_indicators": _updates(_PAYMENTS, BOOTSTRAP),
    "negative_epoch_slices": f"""WITH {_routed(_MOVED, _named("act_cnt_1d", "buy_amount_7d"))}, {_FIRST}
SELECT ref AS ref_name, dim AS dimension_key, order_id, slice_ts, {_KEY} AS slice_key FROM firsts""",
    "route_by_event_type": _routes(_named("act_cnt_1d", "buy_amount_1d", "buy_amount_7d", "error_cnt_1d"), _ROUTE),
    "route_missing_dimension": _routes(_named("coupon_cnt_1d", "by_country"), _ROUTE_KEY),
    "route_wildcard_event": _routes(_named("all_cnt_2d", "act_cnt_1d"), _ROUTE, _BLANKED),
    "route_fanout_counts": _routes(
        samples.EVENTS, "order_id, count(*) AS matches, min(ord) AS first_def, max(ord) AS last_def"
    )
    + " GROUP BY order_id",
    "dimension_key_single": _routes(_named("act_cnt_1d"), _ROUTE_KEY),
    "dimension_key_multi": _routes(_named("view_amount_by_k"), _ROUTE_KEY),
    "dimension_key_global": _routes(_named("all_cnt_2d"), _ROUTE_KEY),
    "dimension_key_legacy": f"""WITH {EVENTS}
SELECT 'view_amount_by_k' AS ref_name, order_id, 'userId#' || user_id || ';k#' || k || ';' AS legacy_key
FROM src WHERE code = 'view'
UNION ALL
SELECT 'coupon_cnt_1d', order_id, 'coupon#' || CASE WHEN k < 50 THEN CAST(k AS VARCHAR) ELSE 'null' END || ';' FROM src""",
    "dedupe_first_success": _updates(REDELIVERED, _named("act_cnt_1d", "buy_amount_1d", "buy_amount_7d")),
    "dedupe_same_ref_name": _updates(REDELIVERED, samples.SAME_NAME),
    "counted_deliveries": f"""WITH {_routed(REDELIVERED, _named("buy_amount_1d", "act_cnt_1d"))}, {_FIRST}
SELECT r.ref AS ref_name, r.dim AS dimension_key, r.order_id, r.seq AS arrival_seq, f.seq IS NOT NULL AS counted
FROM routed r LEFT JOIN firsts f ON f.ref = r.ref AND f.dim = r.dim AND f.order_id = r.order_id AND f.seq = r.seq""",
    "slice_totals": f"""WITH {_routed(EVENTS, samples.EVENTS)}, {_FIRST}, {_TOTALS}
SELECT ref AS ref_name, dim AS dimension_key, gran AS granularity, slice_ts, round(value, 4) AS value, n AS orders
FROM totals""",
    "window_value_at_now": f"""WITH {_routed(EVENTS, samples.EVENTS)}, {_FIRST}, {_TOTALS},
bounds AS (SELECT *, ({NOW_SECOND} // step) * step AS upto FROM totals)
SELECT ref AS ref_name, dim AS dimension_key, round(coalesce(sum(value)
         FILTER (WHERE slice_ts BETWEEN upto - (slices - 1) * step AND upto), 0.0), 4) AS window_value
FROM bounds GROUP BY ref, dim""",
    "window_value_every_slice": f"""WITH {_routed(EVENTS, samples.EVENTS)}, {_FIRST}, {_TOTALS}
SELECT a.ref AS ref_name, a.dim AS dimension_key, a.gran AS granularity, a.slice_ts,
       round(sum(b.value), 4) AS window_value
FROM totals a JOIN totals b ON a.ref = b.ref AND a.dim = b.dim
  AND b.slice_ts BETWEEN a.slice_ts - (a.slices - 1) * a.step AND a.slice_ts
GROUP BY a.ref, a.dim, a.gran, a.slice_ts""",
    "window_shared_name_now": f"""WITH {_routed(REDELIVERED, samples.SAME_NAME)}, {_FIRST}, {_TOTALS},
bounds AS (SELECT *, ({NOW_SECOND} // step) * step AS upto FROM totals)
SELECT ref AS ref_name, dim AS dimension_key, round(coalesce(sum(value)
         FILTER (WHERE slice_ts BETWEEN upto - (slices - 1) * step AND upto), 0.0), 4) AS window_value
FROM bounds GROUP BY ref, dim""",
    "window_shared_name_every_slice": f"""WITH {_routed(REDELIVERED, samples.SAME_NAME)}, {_FIRST}, {_TOTALS}
SELECT a.ref AS ref_name, a.dim AS dimension_key, a.gran AS granularity, a.slice_ts,
       round(sum(b.value), 4) AS window_value
FROM totals a JOIN totals b ON a.ref = b.ref AND a.dim = b.dim AND a.gran = b.gran
  AND b.slice_ts BETWEEN a.slice_ts - (a.slices - 1) * a.step AND a.slice_ts
GROUP BY a.ref, a.dim, a.gran, a.slice_ts""",
    "many_scripts_updates": f"""WITH {EVENTS}
SELECT 'scaled_' || n AS ref_name, round(sum(CASE WHEN n % 2 = 1 THEN amount * n WHEN k > n % 100 THEN amount ELSE 0.5 END), 4) AS total,
       count(*) AS orders
FROM src, range(1, {len(samples.MANY_SCRIPTS) + 1}) AS t(n) WHERE code = 'purchase' AND amount IS NOT NULL GROUP BY n""",
    "slice_retention": f"""WITH {_routed(EVENTS, samples.EVENTS)}, {_FIRST}
SELECT {_KEY} AS slice_key, order_id, step * slices + step AS ttl_seconds
FROM firsts WHERE slice_ts + step * slices + step > {NOW_SECOND}""",
    "granularity_steps": """WITH rows AS (
  SELECT c_custkey, c_nationkey - 3 AS days,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MINUTE' WHEN 'HOUSEHOLD' THEN 'MINUTE' WHEN 'BUILDING' THEN 'HOUR'
              ELSE 'DAY' END AS name FROM customer),
stepped AS (SELECT *, CASE name WHEN 'MINUTE' THEN 60 WHEN 'HOUR' THEN 3600 ELSE 86400 END AS step FROM rows)
SELECT c_custkey, step, name, name AS name_of_step,
       CASE days * 60 WHEN 60 THEN 'MINUTE' WHEN 3600 THEN 'HOUR' ELSE 'DAY' END AS name_of_other,
       greatest(1, greatest(1, days) * 86400 // step) AS window_slices FROM stepped""",
    "definitions_normalised": """
SELECT 'cust_' || c_custkey AS ref_name, c_mktsegment AS codes, 'a,b' AS dims, 3600 AS slice_seconds,
       greatest(1, c_nationkey) * 24 AS window_slices, 'HOUR' AS slice_granularity, 'current + amount' AS acc_script
FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), '', '', 86400, 1, 'DAY', 'current + 1' FROM customer
UNION ALL SELECT 'null', '', 'a', 60, 2880, 'MINUTE', 'null' FROM customer""",
    "parse_valid_orders": f"""WITH {MESSAGES}
SELECT src.order_id, code AS event_type_code, ms AS event_epoch_ms, src.user_id,
       amount, CASE WHEN {_K} = 13 THEN NULL ELSE {_K} = 15 END AS amount_is_text
FROM src JOIN events ON seq = event_id""",
    "coerced_epoch_ms": f"WITH {MESSAGES} SELECT seq AS arrival_seq, ms AS event_epoch_ms FROM src",
    "dead_letter_reasons": _REASONS,
    "script_rejects": f"WITH {EVENTS} {_TYPED_REJECTS}",
    "typed_script_inputs": f"""WITH {EVENTS}
SELECT 'large_buys' AS ref_name, user_id AS dimension_key, order_id, amount AS increment
FROM src WHERE kind = 'purchase' AND k <> 1 AND amount / nullif(k - 1, 0) > 1""",
    "script_field_overrides_current": f"""WITH {_routed(MESSAGES, _named("buy_amount_1d", "act_cnt_1d"))}, {_FIRST}
SELECT ref AS ref_name, order_id, inc AS increment FROM firsts""",
    "slice_update_kafka_records": f"""WITH {_routed(EVENTS, samples.EVENTS)}, {_FIRST}
SELECT ref || '|' || dim AS key,
       '{{"refName":"' || ref || '","dimensionKey":"' || dim || '","granularity":"' || gran || '","sliceTs":' || slice_ts
       || ',"increment":' || inc || ',"orderId":"' || order_id || '","sliceKey":"' || {_KEY}
       || '","ttlSeconds":' || (step * slices + step) || '}}' AS value
FROM firsts""",
    "running_slice_value": _running(
        REDELIVERED, _named("act_cnt_1d", "buy_amount_7d", "all_cnt_2d"), "sum(inc) OVER {window}"
    ),
    "running_slice_fold": _running(EVENTS, samples.EXTREMES, "max(inc) OVER {window}"),
    "running_slice_decay": _running(EVENTS, samples.DECAY, _DECAYED),
    "running_slice_general": _running(REDELIVERED, samples.GENERAL, _RESTARTED),
    "running_slice_capped": _order_by_order(REDELIVERED, samples.CAPPED),
    "many_scripts_fold": _MANY_FOLDS,
    "stream_slice_updates": _updates(EVENTS, samples.EVENTS),
    "stream_running_value": _running(
        EVENTS,
        _STREAM_RUNNING,
        "CASE WHEN ref LIKE 'largest%' THEN max(inc) OVER {window} ELSE sum(inc) OVER {window} END",
    ),
    "stream_running_decay": _running(EVENTS, samples.DECAY, _DECAYED),
    "stream_running_general": f"""SELECT * FROM ({_running(REDELIVERED, samples.GENERAL, _RESTARTED)})
UNION ALL SELECT * FROM ({_order_by_order(REDELIVERED, samples.CAPPED)})""",
    "stream_dead_letters": _REASONS,
    "stream_job_outputs": _JOB_OUTPUTS,
    "stream_definitions_live": _live(),
    "stream_slice_totals": f"""WITH {_routed(REDELIVERED, samples.EVENTS)}, {_FIRST}, {_TOTALS}
SELECT ref AS ref_name, dim AS dimension_key, gran AS granularity, slice_ts, round(value, 4) AS value, n AS orders
FROM totals""",
    "stream_restart_shared_name": _updates(MESSAGES, samples.SAME_NAME),
    "stream_dedupe_restart": _updates(MESSAGES, _named("act_cnt_1d", "buy_amount_1d", "all_cnt_2d")),
}
