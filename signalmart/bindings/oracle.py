"""DuckDB twins of the registered queries, written against the driver's views.

`VIEWS` mirrors the fixture views of `model.py`; each query adds its own SELECT. Expected reject
reasons come from the fault label of a record, not from a second validator.
"""

from __future__ import annotations

import re

from signalmart import catalog


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _uuid(text: str) -> str:
    h = f"md5({text})"
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in parts)


def _msisdn(number: str) -> str:
    return f"'27' || lpad(CAST({number} AS VARCHAR), 9, '0')"


def _key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


_TOPIC_CASE = "CASE kind " + " ".join(
    f"WHEN '{kind}' THEN '{topic}'" for topic, kind in catalog.TOPICS.items()
) + " END"

VIEWS = {
    "clock": "SELECT max(ts) AS as_of FROM events",
    "subs": f"""
        SELECT c_custkey + CASE WHEN c_custkey % 10 = 0 THEN 1000000000 ELSE 0 END AS subscriber_key,
               c_custkey + CASE WHEN c_custkey % 10 = 0 THEN 1000000000 ELSE 0 END AS subscriber_id,
               {_msisdn("c_custkey")} AS msisdn,
               {_list(catalog.PLANS)}[c_custkey % 3 + 1] AS plan,
               {_list(catalog.PROVINCES)}[c_nationkey % 9 + 1] AS province,
               TIMESTAMP '2024-01-01' + to_minutes(c_custkey % 40000) AS created_at,
               c_acctbal >= 0 AS is_active
        FROM customer""",
    "towers": f"""
        SELECT s_suppkey AS tower_key, s_name AS tower_id,
               'Tower ' || CAST(s_suppkey AS VARCHAR) AS tower_name,
               {_list(catalog.PROVINCES)}[s_nationkey % 9 + 1] AS province
        FROM supplier""",
    "bundles": """
        SELECT p_partkey AS bundle_key, 'B' || CAST(p_partkey AS VARCHAR) AS bundle_code,
               p_name AS bundle_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM part""",
    "ev": f"""
        SELECT event_id AS n, user_id, ts, CAST(value AS DECIMAL(10,2)) AS money,
               CAST(floor(value * 40) AS BIGINT) AS ticks,
               CASE event_type WHEN 'purchase' THEN 'airtime_purchase'
                    WHEN 'signup' THEN 'bundle_purchase' WHEN 'click' THEN 'voice_call'
                    WHEN 'view' THEN 'data_usage' WHEN 'error'
                    THEN CASE WHEN event_id % 2 = 0 THEN 'sms' ELSE 'tower_status' END END AS kind,
               {_uuid("CAST(event_id AS VARCHAR)")} AS uid,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS wire,
               {_list(catalog.PAYMENT_METHODS)}[event_id % 4 + 1] AS method,
               {_list(catalog.TECHNOLOGIES)}[event_id % 3 + 1] AS tech,
               {_msisdn("event_id % 1000000")} AS receiver,
               'Supplier#' || lpad(CAST(event_id % 10 AS VARCHAR), 9, '0') AS tower_id,
               event_id % 200 AS bundle_key, event_id % 101 AS sig
        FROM events""",
    "evt": f"SELECT *, {_TOPIC_CASE} AS topic FROM ev",
    "recharges": f"""
        SELECT uid AS event_id, subscriber_key, ts AS event_timestamp, money AS amount,
               method AS payment_method, {_key("ts")} AS date_key
        FROM ev JOIN subs ON subscriber_id = user_id WHERE kind = 'airtime_purchase'""",
    "sales": f"""
        SELECT uid AS event_id, subscriber_key, bundle_key, ts AS event_timestamp, price,
               {_key("ts")} AS date_key
        FROM ev JOIN subs ON subscriber_id = user_id JOIN bundles USING (bundle_key)
        WHERE kind = 'bundle_purchase'""",
    "calls": f"""
        SELECT uid AS event_id, subscriber_key AS caller_key, tower_key, ts AS event_timestamp,
               receiver AS receiver_msisdn, CAST(ticks AS BIGINT) AS duration_seconds,
               n % 33 = 0 AS dropped, {_key("ts")} AS date_key
        FROM ev JOIN subs ON subscriber_id = user_id JOIN towers USING (tower_id)
        WHERE kind = 'voice_call'""",
    "texts": f"""
        SELECT uid AS event_id, subscriber_key AS sender_key, ts AS event_timestamp,
               receiver AS receiver_msisdn, CAST(n % 320 + 1 AS BIGINT) AS length,
               {_key("ts")} AS date_key
        FROM ev JOIN subs ON subscriber_id = user_id WHERE kind = 'sms'""",
    "usage": f"""
        SELECT uid AS event_id, subscriber_key, tower_key, ts AS event_timestamp,
               CAST(money AS DECIMAL(12,2)) AS mb_used,
               CAST(n % 7200 + 10 AS BIGINT) AS session_seconds, tech AS technology,
               {_key("ts")} AS date_key
        FROM ev JOIN subs ON subscriber_id = user_id JOIN towers USING (tower_id)
        WHERE kind = 'data_usage'""",
    "state": """
        SELECT tower_id, tech AS technology, CAST(sig AS BIGINT) AS signal_strength,
               CAST(n % 5000 AS BIGINT) AS connected_devices,
               CASE WHEN sig < 45 THEN 'DOWN' WHEN sig < 60 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status,
               ts AS updated_at
        FROM ev WHERE kind = 'tower_status'
        QUALIFY row_number() OVER (PARTITION BY tower_id ORDER BY ts DESC, n % 3, n) = 1""",
    "dead": f"""
        SELECT uid AS event_id, topic AS source_topic,
               CASE WHEN kind = 'airtime_purchase' THEN 'PAYMENT_DECLINED'
                    ELSE 'RULE_VIOLATION:length_positive' END AS rejection_reason,
               ts AS rejected_at, {_key("ts")} AS date_key, n, user_id, money, method, wire
        FROM evt WHERE (kind = 'airtime_purchase' AND n % 25 = 7) OR (kind = 'sms' AND n % 8 = 0)""",
    "agg_revenue": """
        SELECT date_trunc('minute', event_timestamp) AS minute, province, revenue_type,
               sum(amount) AS total_amount, count(*) AS txn_count
        FROM (SELECT subscriber_key, event_timestamp, amount, 'AIRTIME' AS revenue_type FROM recharges
              UNION ALL
              SELECT subscriber_key, event_timestamp, price, 'BUNDLE' FROM sales)
        JOIN subs USING (subscriber_key) GROUP BY ALL""",
    "agg_calls": """
        SELECT date_trunc('minute', event_timestamp) AS minute, tower_key, count(*) AS call_count,
               count(*) FILTER (WHERE dropped) AS dropped_count, sum(duration_seconds) AS total_duration
        FROM calls GROUP BY ALL""",
    "agg_data": """
        SELECT date_trunc('minute', event_timestamp) AS minute, tower_key, technology,
               sum(mb_used) AS total_mb, count(*) AS session_count
        FROM usage GROUP BY ALL""",
    "agg_dlq": """
        SELECT date_trunc('minute', rejected_at) AS minute, source_topic, rejection_reason,
               count(*) AS record_count
        FROM dead GROUP BY ALL""",
    "lines": f"""
        SELECT {_uuid("'L-' || l_orderkey || '-' || l_linenumber")} AS event_id,
               l_shipdate + to_minutes((l_orderkey * 7 + l_linenumber) % 1440) AS event_timestamp,
               o_custkey AS subscriber_id, 'B' || CAST(l_partkey AS VARCHAR) AS bundle_code,
               l_partkey, CAST(floor(l_extendedprice / 1000) AS DECIMAL(10,2)) AS price, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "first_lines": """
        SELECT * FROM lines QUALIFY row_number() OVER (
            PARTITION BY event_id ORDER BY event_timestamp, bundle_code, price, l_suppkey) = 1""",
    "line_sales": f"""
        SELECT event_id, subscriber_key, bundle_key, event_timestamp, f.price,
               {_key("event_timestamp")} AS date_key
        FROM first_lines f JOIN subs USING (subscriber_id) JOIN bundles USING (bundle_code)""",
    # The raw stream: whole documents, then the label's damage.
    "late": "SELECT strftime(as_of + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS late FROM clock",
    "body": """
        SELECT e.*, n % 50 AS fault, b.price,
          CASE kind
          WHEN 'airtime_purchase' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"subscriber_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE CAST(user_id AS VARCHAR) END END || ',"amount":'
            || CASE n % 50 WHEN 4 THEN '-50.00' WHEN 8 THEN '5000.00' ELSE CAST(money AS VARCHAR) END
            || ',"payment_method":"' || CASE n % 50 WHEN 6 THEN 'Cash' ELSE method END || '"'
          WHEN 'bundle_purchase' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"subscriber_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE CASE n % 50 WHEN 8 THEN 'true' ELSE CAST(user_id AS VARCHAR) END END END
            || ',"bundle_code":"'
            || CASE n % 50 WHEN 6 THEN 'NO-BUNDLE' ELSE bundle_code END || '","price":'
            || CAST(CASE n % 50 WHEN 4 THEN b.price + 1 ELSE b.price END AS VARCHAR)
          WHEN 'voice_call' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"caller_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE CAST(user_id AS VARCHAR) END END || ',"receiver_msisdn":"'
            || CASE n % 50 WHEN 8 THEN '0821234567' ELSE receiver END || '","duration_seconds":'
            || CASE n % 50 WHEN 4 THEN '-5' WHEN 18 THEN '21601' ELSE CAST(ticks AS VARCHAR) END || ',"tower_id":"'
            || CASE n % 50 WHEN 6 THEN 'NO-TOWER' ELSE tower_id END || '","dropped":'
            || CASE WHEN n % 33 = 0 THEN 'true' ELSE 'false' END
          WHEN 'sms' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"sender_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE CAST(user_id AS VARCHAR) END END || ',"receiver_msisdn":"'
            || CASE n % 50 WHEN 8 THEN '0821234567' ELSE receiver END || '","length":'
            || CASE n % 50 WHEN 4 THEN '0' WHEN 6 THEN '5000' ELSE CAST(n % 320 + 1 AS VARCHAR) END
          WHEN 'data_usage' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"subscriber_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE CAST(user_id AS VARCHAR) END END || ',"mb_used":'
            || CASE n % 50 WHEN 4 THEN '0' WHEN 18 THEN '10240.5' ELSE CAST(money AS VARCHAR) END || ',"session_seconds":'
            || CASE n % 50 WHEN 8 THEN '0' WHEN 19 THEN '3000000000' ELSE CAST(n % 7200 + 10 AS VARCHAR) END || ',"tower_id":"'
            || tower_id || '","technology":"' || CASE n % 50 WHEN 6 THEN '9G' ELSE tech END || '"'
          WHEN 'tower_status' THEN CASE n % 50 WHEN 17 THEN '' ELSE ',"tower_id":' || CASE n % 50 WHEN 16 THEN 'null' ELSE '"' || tower_id || '"' END END || ',"technology":"' || tech
            || '","signal_strength":' || CASE n % 50 WHEN 4 THEN '250' ELSE CAST(sig AS VARCHAR) END
            || ',"connected_devices":' || CASE n % 50 WHEN 8 THEN '-1' WHEN 19 THEN '5000000000' ELSE CAST(n % 5000 AS VARCHAR) END
            || ',"status":"' || CASE WHEN n % 50 = 6 THEN 'ON_FIRE' WHEN sig < 45 THEN 'DOWN'
                 WHEN sig < 60 THEN 'DEGRADED' ELSE 'HEALTHY' END || '"'
          END AS payload
        FROM evt e LEFT JOIN bundles b USING (bundle_key)""",
    "sent": f"""
        SELECT topic, kind, CAST(n % 3 AS INTEGER) AS part, n AS off, fault, user_id AS subject,
               uid, ts, money, ticks, n, price, sig,
               CASE fault WHEN 10 THEN '[1,2]' ELSE
                 '{{' || CASE fault WHEN 14 THEN '' WHEN 11 THEN '"event_id":"not-a-uuid",'
                    ELSE '"event_id":"' || uid || '",' END
                 || '"event_type":"' || kind || '","timestamp":'
                 || CASE fault WHEN 13 THEN '5' WHEN 5 THEN '"' || late || '"' ELSE '"' || wire || '"' END
                 || CASE fault WHEN 1 THEN '' WHEN 12 THEN '' WHEN 2 THEN ',"schema_version":"one"'
                    ELSE ',"schema_version":1' END
                 || payload || CASE fault WHEN 3 THEN ',"discount":10' WHEN 12 THEN ',"discount":10'
                    WHEN 15 THEN ',"zeta":1,"alpha":null' ELSE '' END
                 || CASE fault WHEN 0 THEN '' WHEN 9 THEN '}} x' ELSE '}}' END
               END AS raw
        FROM body, late
        UNION ALL
        SELECT 'subscriber-created', 'subscriber_created', CAST(subscriber_id % 3 AS INTEGER),
               subscriber_id, 100 + subscriber_id % 20, subscriber_id, {_uuid("'S' || subscriber_id")}, created_at,
               1, 1, subscriber_id, 1, 0,
               '{{"event_id":"' || {_uuid("'S' || subscriber_id")}
               || '","event_type":"subscriber_created","timestamp":"'
               || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') || '","schema_version":1,"subscriber_id":'
               || subscriber_id || ',"msisdn":"' || CASE WHEN subscriber_id % 20 IN (1, 4) THEN '0821234567' ELSE msisdn END
               || '","plan":"' || CASE WHEN subscriber_id % 20 IN (2, 4) THEN 'Free' ELSE plan END
               || '","province":"' || CASE WHEN subscriber_id % 20 IN (3, 4) THEN 'Atlantis' ELSE province END || '"}}'
        FROM subs""",
    "raws": """
        SELECT * FROM sent
        UNION ALL SELECT * REPLACE (off + 1000000000000 AS off) FROM sent WHERE fault = 7""",
    # What the label says must happen to a record; natural faults are values at or below zero.
    "labelled": """
        SELECT *, CASE fault
          WHEN 0 THEN 'PARSE_ERROR' WHEN 9 THEN 'PARSE_ERROR'
          WHEN 1 THEN 'SCHEMA_VIOLATION:missing:schema_version'
          WHEN 2 THEN 'SCHEMA_VIOLATION:type:schema_version'
          WHEN 3 THEN 'SCHEMA_VIOLATION:unexpected:discount'
          WHEN 10 THEN 'SCHEMA_VIOLATION:not_an_object'
          WHEN 11 THEN 'SCHEMA_VIOLATION:format:event_id'
          WHEN 12 THEN 'SCHEMA_VIOLATION:missing:schema_version,unexpected:discount'
          WHEN 13 THEN 'SCHEMA_VIOLATION:type:timestamp'
          WHEN 14 THEN 'SCHEMA_VIOLATION:missing:event_id'
          WHEN 15 THEN 'SCHEMA_VIOLATION:unexpected:zeta,unexpected:alpha'
          WHEN 16 THEN 'SCHEMA_VIOLATION:type:' || CASE kind WHEN 'voice_call' THEN 'caller_id' WHEN 'sms' THEN 'sender_id'
            WHEN 'tower_status' THEN 'tower_id' ELSE 'subscriber_id' END
          WHEN 17 THEN 'SCHEMA_VIOLATION:missing:' || CASE kind WHEN 'voice_call' THEN 'caller_id'
            WHEN 'sms' THEN 'sender_id' WHEN 'tower_status' THEN 'tower_id' ELSE 'subscriber_id' END
          WHEN 8 THEN CASE kind WHEN 'bundle_purchase' THEN 'SCHEMA_VIOLATION:type:subscriber_id' END
          END AS structural,
          list_filter([
            CASE WHEN fault = 5 THEN 'timestamp_not_in_future' END,
            CASE WHEN kind = 'airtime_purchase' AND (fault = 4 OR (money <= 0 AND fault <> 8)) THEN 'amount_positive' END,
            CASE WHEN kind = 'airtime_purchase' AND fault = 8 THEN 'amount_within_limit' END,
            CASE WHEN kind = 'airtime_purchase' AND fault = 6 THEN 'payment_method_known' END,
            CASE WHEN kind = 'bundle_purchase' AND fault = 6 THEN 'bundle_exists' END,
            CASE WHEN kind = 'bundle_purchase' AND fault IN (4, 6) THEN 'price_matches_catalog' END,
            CASE WHEN kind = 'subscriber_created' AND fault IN (101, 104) THEN 'msisdn_format' END,
            CASE WHEN kind = 'subscriber_created' AND fault IN (102, 104) THEN 'plan_known' END,
            CASE WHEN kind = 'subscriber_created' AND fault IN (103, 104) THEN 'province_known' END,
            CASE WHEN kind = 'voice_call' AND (fault = 4 OR (fault <> 18 AND ticks < 0)) THEN 'duration_not_negative' END,
            CASE WHEN kind = 'voice_call' AND (fault = 18 OR (fault <> 4 AND ticks > 21600)) THEN 'duration_within_limit' END,
            CASE WHEN kind = 'sms' AND fault = 4 THEN 'length_positive' END,
            CASE WHEN kind = 'sms' AND fault = 6 THEN 'length_within_limit' END,
            CASE WHEN kind = 'data_usage' AND (fault = 4 OR (fault <> 18 AND money <= 0)) THEN 'volume_positive' END,
            CASE WHEN kind = 'data_usage' AND fault = 18 THEN 'volume_within_limit' END,
            CASE WHEN kind = 'data_usage' AND fault = 8 THEN 'session_positive' END,
            CASE WHEN kind = 'tower_status' AND fault = 4 THEN 'signal_in_range' END,
            CASE WHEN kind = 'tower_status' AND fault = 8 THEN 'devices_not_negative' END,
            CASE WHEN kind = 'voice_call' AND fault = 6 THEN 'tower_exists' END,
            CASE WHEN kind = 'data_usage' AND fault = 6 THEN 'technology_known' END,
            CASE WHEN kind = 'tower_status' AND fault = 6 THEN 'status_known' END,
            CASE WHEN kind IN ('voice_call', 'sms') AND fault = 8 THEN 'receiver_msisdn_format' END
          ], lambda x: x IS NOT NULL) AS broken
        FROM raws""",
    "verdict": """
        SELECT *, coalesce(split_part(structural, ',', 1), 'RULE_VIOLATION:' || broken[1]) AS reason
        FROM labelled""",
    "ok_events": """
        SELECT * FROM verdict WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY topic, uid ORDER BY part, off) = 1""",
    "rejects": """
        SELECT topic, part, off, raw, reason, topic || '|' || reason || '|' || raw AS name
        FROM verdict WHERE reason IS NOT NULL""",
    "hashed": f"""
        SELECT *, sha1(from_hex('{catalog.DLQ_NAMESPACE.replace("-", "")}') || encode(name)) AS h
        FROM rejects""",
    "dlq": """
        SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
               || substr('89ab', (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1)
               || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS dlq_id
        FROM hashed""",
    "samples": """
        SELECT event_type AS topic, CAST(event_id % 3 AS INTEGER) AS part, ts,
               event_id - event_id % 40 AS head, event_id - event_id % 40 - event_id % 7 AS done
        FROM events""",
    "lagged": """
        SELECT date_trunc('minute', ts) AS minute, head - done AS lag
        FROM samples QUALIFY row_number() OVER (
            PARTITION BY topic, part, date_trunc('minute', ts) ORDER BY ts DESC, head DESC, done DESC) = 1""",
    "lag_series": "SELECT minute, CAST(sum(lag) AS BIGINT) AS lag FROM lagged GROUP BY minute",
    "steps": """
        SELECT topic, part, date_trunc('minute', ts) AS minute, greatest(head - p_head, 0) AS gained,
               epoch_us(ts) - epoch_us(p_ts) AS us
        FROM (SELECT *, lag(head) OVER w AS p_head, lag(ts) OVER w AS p_ts FROM samples
              WINDOW w AS (PARTITION BY topic, part ORDER BY ts, head))
        WHERE p_ts IS NOT NULL""",
    "rates": """
        SELECT topic, minute, CAST(sum(gained) AS BIGINT) AS messages, sum(rate) AS rate
        FROM (SELECT topic, part, minute, sum(gained) AS gained,
                     CASE WHEN sum(us) > 0 THEN CAST(sum(gained) AS DOUBLE) * 1e6 / sum(us) ELSE 0 END AS rate
              FROM steps GROUP BY ALL) GROUP BY ALL""",
    "rate_series": "SELECT minute, sum(messages) AS messages FROM rates GROUP BY minute",
}

VIEWS["dense_series"] = """
    SELECT minute, coalesce(messages, 0) AS messages FROM (
        SELECT unnest(generate_series((SELECT min(minute) FROM rate_series),
            (SELECT date_trunc('minute', as_of) FROM clock), INTERVAL 1 MINUTE)) AS minute)
    LEFT JOIN rate_series USING (minute)"""


def _time(pattern: str) -> str:
    return f"strftime(ts, '{pattern}')"


_NO_TIME = "NULL::TIMESTAMP"
# What is written, and the instant that it names: s, m, h, d and w are the time cut to second, minute and so on.
_FORMS = (
    (_time("%Y-%m-%dT%H:%M:%S.%fZ"), "ts"), (_time("%Y%m%dT%H%M%SZ"), "s"), (_time("%Y%m%dT%H%M%S,%f"), "ts"),
    (_time("%Y-%m-%dT%H"), "h"), (_time("%Y-%m-%dT%H:%M"), "m"), (_time("%Y-%m-%dt%H:%M:%S"), "s"),
    (_time("%Y-%m-%d_%H:%M:%S+00"), "s"), (_time("%Y%m%d %H%M"), "m"), (_time("%Y-%m-%d"), "d"), (_time("%Y%m%d"), "d"),
    (_time("%G-W%V-%uT%H:%M:%SZ"), "s"), (_time("%GW%V%uT%H%M%S"), "s"), (_time("%G-W%V"), "w"), (_time("%GW%V"), "w"),
    (_time("%Y-%m-%dT%H:%M:%S+05:30"), "s - INTERVAL 330 MINUTE"), (_time("%Y-%m-%dT%H:%M:%S-0330"), "s + INTERVAL 210 MINUTE"),
    (_time("%Y-%m-%dT%H:%M:%S+05:30:15"), "s - INTERVAL 19815 SECOND"),
    (_time("%Y-%m-%dT%H:%M:%S-23:59:59.5"), "s + INTERVAL 86399500 MILLISECOND"),
    (_time("%Y-%m-%dT%H:%M:%S +02:00"), "s - INTERVAL 2 HOUR"),
    *((text, _NO_TIME) for text in (
        _time("%Y-%m-%dT"), _time("%Y-%m-%dT%H:%M:%S+24:00"), _time("%Y-%m-%dT%H:60"), _time("%Y-%m-%dT24:00"),
        _time("%Y-%m"), _time("%G-W54-1"), _time("%G-W%V-8"), _time("%Y-%m-%dT%H:%M:%Sz"),
        _time("%Y-%m-%dT%H:%M:%SZ "), _time("%Y-%m-32"), "''",
    )),
)

_TILE = "(SELECT as_of - INTERVAL 24 HOUR FROM clock)"
_RANGE = "(SELECT as_of - INTERVAL 30 DAY FROM clock) AND (SELECT as_of FROM clock)"


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _series(table: str, sums: dict[str, str], by: str | None = None, where: str = "true") -> str:
    metric = f"{by} AS metric," if by else ""
    return f"""SELECT minute AS time, {metric} {", ".join(f"{e} AS {a}" for a, e in sums.items())}
        FROM {table} WHERE {where} AND minute BETWEEN {_RANGE} GROUP BY ALL"""


def _check(table: str, alias: str, name: str, column: str, evaluated: str, bad: str) -> str:
    """One report row; `alias` is the view, `table` the reported name."""
    return f"""SELECT '{table}' AS table_name, '{name}' AS expectation, '{column}' AS column_name,
        {_n(evaluated)} AS evaluated, {_n(f"coalesce({bad}, 0)")} AS unexpected FROM {alias}"""


def _value(table: str, alias: str, name: str, column: str, bad: str) -> str:
    evaluated = "count(*)" if name == "not_null" else f"count({column})"
    return _check(table, alias, name, column, evaluated, f"count(*) FILTER (WHERE {bad})")


def _unique(table: str, alias: str, column: str, expr: str | None = None) -> str:
    source = f"(SELECT {expr or column} AS k, count(*) AS n FROM {alias} GROUP BY 1)"
    return _check(table, source, "unique", column, "coalesce(sum(n), 0)", "sum(n) FILTER (WHERE n > 1)")


def _refs(table: str, alias: str, column: str, dim: str, key: str) -> str:
    bad = f"count(*) FILTER (WHERE {column} NOT IN (SELECT {key} FROM {dim}))"
    return _check(table, alias, "references", column, f"count({column})", bad)


def _report(parts: list[str]) -> str:
    return "SELECT *, unexpected = 0 AS success FROM (" + " UNION ALL ".join(parts) + ")"


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_MSISDN_RE = "'^27[0-9]{9}$'"
_UUID_RE = "'^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$'"


def _fact_suite(table: str, alias: str, subject: str) -> list[str]:
    ceiling = "(SELECT as_of + INTERVAL 1 MINUTE FROM clock)"
    return [
        _value(table, alias, "not_null", "event_id", "event_id IS NULL"),
        _unique(table, alias, "event_id"),
        _value(table, alias, "not_null", subject, f"{subject} IS NULL"),
        _refs(table, alias, subject, "subs", "subscriber_key"),
        _value(table, alias, "max_at_most", "event_timestamp", f"event_timestamp > {ceiling}"),
    ]


_QUALITY = _report(
    [
        _value("dim_subscriber", "subs", "not_null", "subscriber_id", "subscriber_id IS NULL"),
        _unique("dim_subscriber", "subs", "subscriber_id"),
        _unique("dim_subscriber", "subs", "msisdn"),
        _value("dim_subscriber", "subs", "matches", "msisdn", f"NOT regexp_matches(msisdn, {_MSISDN_RE})"),
        _value("dim_subscriber", "subs", "in_set", "plan", f"plan NOT IN {_in(catalog.PLANS)}"),
        _value("dim_subscriber", "subs", "in_set", "province", f"province NOT IN {_in(catalog.PROVINCES)}"),
        *_fact_suite("fact_recharges", "recharges", "subscriber_key"),
        _value("fact_recharges", "recharges", "between", "amount", "amount <= 0 OR amount > 1000"),
        *_fact_suite("fact_bundle_sales", "sales", "subscriber_key"),
        _refs("fact_bundle_sales", "sales", "bundle_key", "bundles", "bundle_key"),
        _value("fact_bundle_sales", "sales", "between", "price", "price <= 0"),
        *_fact_suite("fact_calls", "calls", "caller_key"),
        _refs("fact_calls", "calls", "tower_key", "towers", "tower_key"),
        _value("fact_calls", "calls", "between", "duration_seconds",
               "duration_seconds < 0 OR duration_seconds > 21600"),
        *_fact_suite("fact_data_usage", "usage", "subscriber_key"),
        _refs("fact_data_usage", "usage", "tower_key", "towers", "tower_key"),
        _value("fact_data_usage", "usage", "between", "mb_used", "mb_used <= 0 OR mb_used > 10240"),
        _value("fact_data_usage", "usage", "in_set", "technology",
               f"technology NOT IN {_in(catalog.TECHNOLOGIES)}"),
        *_fact_suite("fact_sms", "texts", "sender_key"),
        _value("fact_sms", "texts", "between", "length", "length < 1 OR length > 1600"),
        _value("tower_status_current", "state", "between", "signal_strength",
               "signal_strength < 0 OR signal_strength > 100"),
        _value("tower_status_current", "state", "in_set", "status",
               f"status NOT IN {_in(catalog.TOWER_STATUSES)}"),
    ]
)


def _contract(kind: str, columns: str, domain: list[tuple[str, str, str]]) -> list[str]:
    """Rows of one batch contract; `domain` holds (expectation, column, bad condition)."""
    view = f"(SELECT *, user_id AS subscriber_id, user_id AS caller_id, user_id AS sender_id," \
           f" receiver AS receiver_msisdn, ticks AS duration_seconds, n % 320 + 1 AS length," \
           f" money AS amount, money AS mb_used, method AS payment_method, sig AS signal_strength," \
           f" n % 7200 + 10 AS session_seconds, tech AS technology, n % 5000 AS connected_devices," \
           f" uid AS event_id, kind AS event_type, wire AS timestamp, 1 AS schema_version," \
           f" 'B' || bundle_key AS bundle_code, true AS dropped, 'UP' AS status" \
           f" FROM evt LEFT JOIN bundles USING (bundle_key) WHERE kind = '{kind}')"
    skew = "(SELECT as_of + INTERVAL 30 SECOND FROM clock)"
    names = ["event_id", "event_type", "timestamp", "schema_version", *columns.split()]
    rows = [_value(kind, view, "not_null", c, f"{c} IS NULL") for c in names]
    rows += [
        _value(kind, view, "matches", "event_id", f"NOT regexp_matches(event_id, {_UUID_RE})"),
        _value(kind, view, "in_set", "event_type", f"event_type <> '{kind}'"),
        _value(kind, view, "timestamp_valid", "timestamp", f"ts > {skew}"),
        _value(kind, view, "at_least", "schema_version", "schema_version < 1"),
    ]
    return rows + [_value(kind, view, name, column, bad) for name, column, bad in domain]


def _registration_contract() -> list[str]:
    kind = "subscriber_created"
    view = f"(SELECT uid AS event_id, kind AS event_type, ts, subscriber_id, msisdn, plan, province," \
           f" 1 AS schema_version, ts AS timestamp FROM sent JOIN subs ON subscriber_id = subject" \
           f" WHERE kind = '{kind}' AND fault NOT IN (101, 102, 103, 104))"
    names = "event_id event_type timestamp schema_version subscriber_id msisdn plan province".split()
    skew = "(SELECT as_of + INTERVAL 30 SECOND FROM clock)"
    checks = [
        ("matches", "event_id", f"NOT regexp_matches(event_id, {_UUID_RE})"),
        ("in_set", "event_type", f"event_type <> '{kind}'"),
        ("timestamp_valid", "timestamp", f"ts > {skew}"),
        ("at_least", "schema_version", "schema_version < 1"),
        ("at_least", "subscriber_id", "subscriber_id < 1"),
        ("matches", "msisdn", f"NOT regexp_matches(msisdn, {_MSISDN_RE})"),
        ("in_set", "plan", f"plan NOT IN {_in(catalog.PLANS)}"),
        ("in_set", "province", f"province NOT IN {_in(catalog.PROVINCES)}"),
    ]
    rows = [_value(kind, view, "not_null", c, f"{c} IS NULL") for c in names]
    return rows + [_value(kind, view, name, column, bad) for name, column, bad in checks]


_DEAD_CONTRACT = [
    *[
        _value("dlq_record", "(SELECT *, topic AS source_topic, reason AS rejection_reason, raw AS original_payload FROM dlq)",
               "not_null", column, "false")
        for column in ("event_id", "event_type", "timestamp", "schema_version", "source_topic", "rejection_reason",
                       "original_payload")
    ],
    *[
        _check("dlq_record", "dlq", name, column, "count(*)", "0")
        for name, column in (("matches", "event_id"), ("in_set", "event_type"), ("timestamp_valid", "timestamp"),
                             ("at_least", "schema_version"))
    ],
]

_OK_NUMBER = ("matches", "receiver_msisdn", f"NOT regexp_matches(receiver_msisdn, {_MSISDN_RE})")
_OK_TOWER = ("references", "tower_id", "tower_id NOT IN (SELECT tower_id FROM towers)")
_CONTRACTS = _report(
    _registration_contract()
    + _contract("airtime_purchase", "subscriber_id amount payment_method", [
        ("at_least", "subscriber_id", "subscriber_id < 1"),
        ("between", "amount", "amount <= 0 OR amount > 1000"),
        ("in_set", "payment_method", f"payment_method NOT IN {_in(catalog.PAYMENT_METHODS)}"),
    ])
    + _contract("bundle_purchase", "subscriber_id bundle_code price", [
        ("at_least", "subscriber_id", "subscriber_id < 1"),
        ("references", "bundle_code", "bundle_code NOT IN (SELECT bundle_code FROM bundles)"),
        ("between", "price", "price <= 0"),
    ])
    + _contract("voice_call", "caller_id receiver_msisdn duration_seconds tower_id dropped", [
        ("at_least", "caller_id", "caller_id < 1"),
        _OK_NUMBER,
        ("between", "duration_seconds", "duration_seconds < 0 OR duration_seconds > 21600"),
        _OK_TOWER,
    ])
    + _contract("sms", "sender_id receiver_msisdn length", [
        ("at_least", "sender_id", "sender_id < 1"),
        _OK_NUMBER,
        ("between", "length", "length < 1 OR length > 1600"),
    ])
    + _contract("data_usage", "subscriber_id mb_used session_seconds tower_id technology", [
        ("at_least", "subscriber_id", "subscriber_id < 1"),
        ("between", "mb_used", "mb_used <= 0 OR mb_used > 10240"),
        ("between", "session_seconds", "session_seconds <= 0"),
        _OK_TOWER,
        ("in_set", "technology", f"technology NOT IN {_in(catalog.TECHNOLOGIES)}"),
    ])
    + _contract(
        "tower_status", "tower_id technology signal_strength connected_devices status", [
        _OK_TOWER,
        ("in_set", "technology", f"technology NOT IN {_in(catalog.TECHNOLOGIES)}"),
        ("between", "signal_strength", "signal_strength < 0 OR signal_strength > 100"),
        ("at_least", "connected_devices", "connected_devices < 0"),
        ("in_set", "status", "false"),
    ])
    + _DEAD_CONTRACT
)

_REQUIRED = {
    "fact_recharges": ("recharges", "event_id subscriber_key event_timestamp amount payment_method"),
    "fact_bundle_sales": ("sales", "event_id subscriber_key bundle_key event_timestamp price"),
    "fact_calls": ("calls", "event_id caller_key tower_key event_timestamp receiver_msisdn"
                   " duration_seconds dropped"),
    "fact_sms": ("texts", "event_id sender_key event_timestamp receiver_msisdn length"),
    "fact_data_usage": ("usage", "event_id subscriber_key tower_key event_timestamp mb_used"
                        " session_seconds technology"),
    "dim_subscriber": ("subs", "subscriber_key subscriber_id msisdn plan province created_at is_active"),
    "dlq_records": ("dead_table", "event_id source_topic rejection_reason original_payload rejected_at"),
    "tower_status_current": ("state", "tower_id technology signal_strength connected_devices status"
                             " updated_at"),
}
VIEWS["dead_table"] = "SELECT *, 'x' AS original_payload FROM dead"

_CONSTRAINTS = _report(
    [
        _value(table, alias, "not_null", column, f"{column} IS NULL")
        for table, (alias, columns) in _REQUIRED.items()
        for column in columns.split()
    ]
    + [
        _unique("dim_tower", "towers", "tower_id"),
        _unique("dim_bundle", "bundles", "bundle_code"),
        _unique("dim_date", "days", "full_date"),
        _unique("dlq_records", "dead", "event_id"),
    ]
    + [
        _refs(f"fact_{name}", alias, "date_key", "days", "date_key")
        for name, alias in (
            ("recharges", "recharges"), ("bundle_sales", "sales"), ("calls", "calls"),
            ("sms", "texts"), ("data_usage", "usage"),
        )
    ]
    + [
        _unique("agg_revenue_minute", "agg_revenue", "primary_key", "minute || '|' || province || '|' || revenue_type"),
        _unique("agg_calls_minute", "agg_calls", "primary_key", "minute || '|' || tower_key"),
        _unique("agg_data_minute", "agg_data", "primary_key", "minute || '|' || tower_key || '|' || technology"),
        _unique("agg_dlq_minute", "agg_dlq", "primary_key",
                "minute || '|' || source_topic || '|' || rejection_reason"),
    ]
)

VIEWS["days"] = f"""
    SELECT {_key("d")} AS date_key, d AS full_date,
           CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(month(d) AS INTEGER) AS month,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
           isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(
        (SELECT date_trunc('day', min(o_orderdate)) FROM orders)::TIMESTAMP,
        (SELECT date_trunc('day', max(ts)) FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS d)"""

_TOWER_ROWS = ", ".join(
    f"('tower', CAST({i} AS BIGINT), '{t[0]}', '{t[1]}', '{','.join(t[3])}')"
    for i, t in enumerate(catalog.TOWERS, 1)
)
_BUNDLE_ROWS = ", ".join(
    f"('bundle', CAST({i} AS BIGINT), '{b[0]}', '{b[1]}', '{b[2]}:{b[3]}')"
    for i, b in enumerate(catalog.BUNDLES, 1)
)

# Registrations from orders in three batches: the first claim of a number wins, and every batch rejects the
# first event of an id that lost its number.
VIEWS["orders_in"] = """
    SELECT o_custkey AS subscriber_id, '27' || lpad(CAST(o_custkey // 2 AS VARCHAR), 9, '0') AS msisdn,
           o_orderpriority AS plan, o_orderstatus AS province, o_orderdate AS created_at, o_orderkey AS off,
           floor(o_orderkey * 3::DOUBLE / (SELECT max(o_orderkey) + 1 FROM orders)) AS batch
    FROM orders WHERE o_custkey NOT IN (SELECT subscriber_id FROM subs WHERE NOT is_active)"""
VIEWS["claims"] = """
    SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY off) = 1
              AND msisdn NOT IN (SELECT msisdn FROM subs WHERE NOT is_active) AS wins
    FROM orders_in"""

# Stored table, its view, time and measure.
_GROWN = (
    ("fact_recharges", "recharges", "event_timestamp", "amount"),
    ("fact_bundle_sales", "sales", "event_timestamp", "price"),
    ("fact_calls", "calls", "event_timestamp", "duration_seconds"),
    ("fact_sms", "texts", "event_timestamp", "length"),
    ("fact_data_usage", "usage", "event_timestamp", "mb_used"),
    ("dlq_records", "dead", "rejected_at", "0"),
)

_STRUCT_TAG = "replace(structural, 'SCHEMA_VIOLATION:', '')"

SELECTS = {
    "decode_raw": 'SELECT topic, part AS "partition", off AS "offset", md5(raw) AS raw_md5 FROM raws',
    "topic_event_type": 'SELECT topic, off AS "offset", kind AS event_type FROM raws',
    "seed_dims": f"""
        SELECT dimension, key, code, name, detail, coalesce(n_bound, 0) AS n_bound
        FROM (VALUES {_TOWER_ROWS}, {_BUNDLE_ROWS}) v(dimension, key, code, name, detail)
        LEFT JOIN (SELECT 'tower' AS dimension, s_suppkey % 18 + 1 AS key, count(*) AS n_bound
                   FROM supplier GROUP BY ALL
                   UNION ALL SELECT 'bundle', p_partkey % 8 + 1, count(*) FROM part GROUP BY ALL)
        USING (dimension, key)""",
    "dim_date": "SELECT * FROM days",
    "lake_replay": """SELECT kind AS event_type, strftime(ts, '%Y-%m-%d') AS date, uid AS event_id
        FROM ok_events WHERE ts >= (SELECT date_trunc('day', as_of) - INTERVAL 30 DAY FROM clock)""",
    "lake_rows": """SELECT uid AS event_id, kind AS event_type,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, CAST(1 AS BIGINT) AS schema_version,
            subject AS subscriber_id, CAST(money AS DOUBLE) AS amount,
            ['Voucher', 'Card', 'EFT', 'USSD'][n % 4 + 1] AS payment_method,
            strftime(ts, '%Y-%m-%d') AS date
        FROM ok_events WHERE kind = 'airtime_purchase'""",
    "fact_insert_if_absent": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, event_id, {ts} AS event_timestamp, date_key, {_d(m)} AS measure FROM {alias}"
        for table, alias, ts, m in _GROWN),
    "compaction": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, date_key, count(*) AS n_rows, count(DISTINCT event_id) AS n_ids,
            round({_d(f"sum({_d(m)})")}, 2) AS measure FROM {alias} GROUP BY date_key"""
        for table, alias, ts, m in _GROWN),
    "dim_subscriber_upsert": """
        SELECT subscriber_id, msisdn, plan, province, created_at, 'stored' AS outcome FROM subs WHERE NOT is_active
        UNION ALL SELECT subscriber_id, msisdn, plan, province, created_at, 'inserted' FROM claims WHERE wins
        UNION ALL SELECT subscriber_id, msisdn, plan, province, created_at, 'REFERENTIAL:msisdn_duplicate' FROM (
            SELECT * FROM claims WHERE subscriber_id NOT IN (SELECT subscriber_id FROM claims WHERE wins)
            QUALIFY row_number() OVER (PARTITION BY subscriber_id, batch ORDER BY off) = 1)""",
    "tower_status_current": "SELECT * FROM state",
    "dlq_to_json": """SELECT 'failed-transactions' AS topic, part AS "partition", off AS "offset",
            CAST(json_object('event_id', dlq_id, 'event_type', 'dlq_record',
                'timestamp', left(strftime(as_of, '%Y-%m-%dT%H:%M:%S.%f'), 23) || '+00:00',
                'schema_version', 1, 'source_topic', topic, 'rejection_reason', reason,
                'original_payload', raw) AS VARCHAR) AS value
        FROM dlq, clock""",
    "dlq_records": f"""SELECT DISTINCT dlq_id AS event_id, topic AS source_topic,
            reason AS rejection_reason, raw AS original_payload, {_key("as_of")} AS date_key
        FROM dlq, clock""",
    "rollup_refresh": " UNION ALL ".join(
        f"""SELECT '{name}' AS rollup, minute, {_key("minute")} AS date_key, {key} AS key,
            {" || ' ' || ".join(f"format('{{:,.2f}}', {_d(c)})" for c in sums)} AS sums FROM {alias}"""
        for name, alias, key, sums in (
            ("agg_revenue_minute", "agg_revenue", "province || '|' || revenue_type", ("total_amount", "txn_count")),
            ("agg_calls_minute", "agg_calls", "tower_key::VARCHAR",
             ("call_count", "dropped_count", "total_duration")),
            ("agg_data_minute", "agg_data", "tower_key || '|' || technology", ("total_mb", "session_count")),
            ("agg_dlq_minute", "agg_dlq", "source_topic || '|' || rejection_reason", ("record_count",)),
        )),
    "rollup_dlq_minute": f"SELECT *, {_key('minute')} AS date_key FROM agg_dlq",
    "affected_minutes": """SELECT date_trunc('minute', min(ts)) AS lo, date_trunc('minute', max(ts)) AS hi,
            date_trunc('minute', max(ts)) + INTERVAL 1 MINUTE AS hi_next FROM ok_events""",
    "parse_verdict": """SELECT topic, off AS "offset", coalesce(structural <> 'PARSE_ERROR', true) AS parsed
        FROM labelled""",
    "schema_verdict": f"""SELECT topic, off AS "offset",
            CASE WHEN structural = 'PARSE_ERROR' THEN 'unparsed'
                 ELSE coalesce({_STRUCT_TAG}, '') END AS violations
        FROM labelled""",
    "rule_verdict": """SELECT topic, off AS "offset", array_to_string(broken, ',') AS violations
        FROM labelled WHERE structural IS NULL""",
    "validate_events": """SELECT topic, off AS "offset", coalesce(reason, 'ACCEPTED') AS reason FROM verdict""",
    "typed_events": """SELECT topic, off AS "offset", uid AS event_id, kind AS event_type,
            ts AS event_timestamp,
            CASE WHEN kind IN ('tower_status', 'subscriber_created') THEN -1 ELSE subject END AS subject_id,
            CAST(CASE kind WHEN 'airtime_purchase' THEN money WHEN 'data_usage' THEN money
                 WHEN 'bundle_purchase' THEN price WHEN 'voice_call' THEN ticks
                 WHEN 'sms' THEN n % 320 + 1 WHEN 'tower_status' THEN sig ELSE 0 END AS DOUBLE) AS measure,
            CAST(CASE WHEN kind = 'data_usage' THEN CASE fault WHEN 19 THEN 3000000000 ELSE n % 7200 + 10 END
                 WHEN kind = 'tower_status' THEN CASE fault WHEN 19 THEN 5000000000 ELSE n % 5000 END
                 ELSE 0 END AS BIGINT) AS detail
        FROM verdict WHERE reason IS NULL""",
    # From the labels: dead letters are faults and unknown subjects, a repeated event is neither.
    "batch_counts": """SELECT event_type, accepted, count(*) AS n_records FROM (
            SELECT kind AS event_type, kind IN ('tower_status', 'subscriber_created')
                OR subject IN (SELECT subscriber_id FROM subs) AS accepted FROM ok_events
            UNION ALL SELECT kind, false FROM verdict WHERE reason IS NOT NULL) GROUP BY ALL""",
    "contract_check": _CONTRACTS,
    "dedupe_first": f"""SELECT event_id, event_timestamp, bundle_code, {_d("price")} AS price, l_suppkey
        FROM first_lines""",
    "dlq_uuid5": 'SELECT topic, off AS "offset", dlq_id FROM dlq',
    "dlq_envelope": """SELECT dlq_id AS event_id, 'dlq_record' AS event_type,
            left(strftime(as_of, '%Y-%m-%dT%H:%M:%S.%f'), 23) || '+00:00' AS timestamp,
            CAST(1 AS BIGINT) AS schema_version, topic AS source_topic, reason AS rejection_reason,
            raw AS original_payload, part AS "partition", off AS "offset"
        FROM dlq, clock""",
    "dlq_intake": """SELECT 'failed-transactions' AS topic, off AS "offset", dlq_id AS event_id, false AS skipped FROM dlq
        UNION ALL SELECT topic, off, NULL, true FROM raws""",
    # An event lacks what only a dead letter has, unless something before it in the contract is wrong.
    "dlq_skipped": """SELECT topic, part AS "partition", off AS "offset", raw, CASE
            WHEN structural = 'PARSE_ERROR' THEN 'PARSE_ERROR'
            WHEN fault IN (1, 2, 10, 12, 13, 14) THEN replace(split_part(structural, ',', 1), 'SCHEMA_VIOLATION:', '')
            ELSE 'missing:source_topic' END AS cause
        FROM labelled""",
    "referential_rejects": """SELECT topic, part AS "partition", off AS "offset", raw,
            'REFERENTIAL:subscriber_unknown' AS reason
        FROM ok_events WHERE kind NOT IN ('tower_status', 'subscriber_created')
          AND subject NOT IN (SELECT subscriber_id FROM subs)""",
    "failed_payment_payloads": """SELECT event_id AS dlq_id, rejected_at, event_id, user_id AS subscriber_id,
            CAST(money AS DOUBLE) AS amount, method AS payment_method
        FROM dead WHERE rejection_reason = 'PAYMENT_DECLINED'""",
    "dlq_reasons": "SELECT DISTINCT reason AS rejection_reason FROM rejects",
    "fact_recharges": f"SELECT * REPLACE ({_d('amount')} AS amount) FROM recharges",
    "fact_bundle_sales": f"SELECT * REPLACE ({_d('price')} AS price) FROM line_sales",
    "fact_calls": "SELECT * FROM calls",
    "fact_sms": "SELECT * FROM texts",
    "fact_data_usage": f"SELECT * REPLACE ({_d('mb_used')} AS mb_used) FROM usage",
    "known_subscribers": """SELECT subscriber_id, event_id, bundle_code FROM lines
        WHERE subscriber_id IN (SELECT subscriber_id FROM subs)""",
    "rollup_revenue_minute": f"""
        SELECT date_trunc('minute', event_timestamp) AS minute, province, revenue_type,
               {_d("sum(amount)")} AS total_amount, count(*) AS txn_count,
               {_key("date_trunc('minute', event_timestamp)")} AS date_key
        FROM (SELECT subscriber_key, event_timestamp, amount, 'AIRTIME' AS revenue_type FROM recharges
              UNION ALL
              SELECT subscriber_key, event_timestamp, price, 'BUNDLE' FROM line_sales)
        JOIN subs USING (subscriber_key) GROUP BY ALL""",
    "rollup_calls_minute": f"""SELECT * REPLACE ({_n("total_duration")} AS total_duration),
            {_key("minute")} AS date_key FROM agg_calls""",
    "rollup_data_minute": f"""SELECT * REPLACE ({_d("total_mb")} AS total_mb),
            {_key("minute")} AS date_key FROM agg_data""",
    "quality_report": _QUALITY,
    "audit_orphan_keys": f"""SELECT {_n("count(*)")} AS orphans
        FROM calls f LEFT JOIN (SELECT subscriber_key FROM subs WHERE is_active) s
             ON s.subscriber_key = f.caller_key
        LEFT JOIN towers t ON t.tower_key = f.tower_key
        WHERE s.subscriber_key IS NULL OR t.tower_key IS NULL""",
    "audit_duplicates": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) - count(DISTINCT event_id) AS duplicates FROM {alias}"
        for name, alias in (
            ("fact_recharges", "recharges"), ("fact_bundle_sales", "lines"), ("fact_calls", "calls"),
            ("fact_sms", "texts"), ("fact_data_usage", "usage"),
        )
    ),
    "audit_fact_total": f"""SELECT {_n(
        "(SELECT count(*) FROM recharges) + (SELECT count(*) FROM sales) + (SELECT count(*) FROM calls)"
        " + (SELECT count(*) FROM texts) + (SELECT count(*) FROM usage)")} AS total_rows""",
    "audit_constraints": _CONSTRAINTS,
    "source_offsets": """SELECT 'events' AS query, topic, part AS "partition", date_trunc('millisecond', ts) AS sampled_at,
            head AS latest_offset, done AS committed_offset FROM samples""",
    "metric_lag": """SELECT 'events' AS query, minute, lag FROM lag_series""",
    "metric_rate": "SELECT topic, minute, messages, round(rate, 6) AS rate_per_second FROM rates",
    "alert_lag": """SELECT w.minute, low AS lowest_lag,
            low > 4 AND coalesce(p.lag > 4 AND p.minute > w.minute - INTERVAL 10 MINUTE, false) AS firing
        FROM (SELECT minute, min(lag) OVER (ORDER BY minute RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING
              AND CURRENT ROW) AS low FROM lag_series) w
        ASOF LEFT JOIN lag_series p ON w.minute - INTERVAL 5 MINUTE >= p.minute""",
    "alert_stalled": f"""SELECT w.minute, {_n("high")} AS highest_messages,
            high = 0 AND w.minute - INTERVAL 5 MINUTE >= (SELECT min(minute) FROM rate_series) AS firing
        FROM (SELECT minute, max(messages) OVER (ORDER BY minute RANGE BETWEEN INTERVAL 9 MINUTE PRECEDING
              AND CURRENT ROW) AS high FROM dense_series) w""",
    "timestamp_forms": f"""
        SELECT n AS "offset", CAST(form AS INTEGER) AS form, CASE form
            {" ".join(f"WHEN {i} THEN {text}" for i, (text, _) in enumerate(_FORMS))} END AS text,
          CASE form {" ".join(f"WHEN {i} THEN {instant}" for i, (_, instant) in enumerate(_FORMS))} END AS instant
        FROM (SELECT event_id AS n, ts, event_id % {len(_FORMS)} AS form,
                date_trunc('second', ts) AS s, date_trunc('minute', ts) AS m, date_trunc('hour', ts) AS h,
                date_trunc('day', ts) AS d, date_trunc('week', ts) AS w FROM events)""",
    # KPIs
    "kpi_active_subscribers": "SELECT count(*) AS subscribers FROM subs WHERE is_active",
    "kpi_revenue_last_hour": f"""SELECT {_d("coalesce(sum(total_amount), 0)")} AS revenue
        FROM agg_revenue WHERE minute > {_TILE}""",
    "kpi_calls_last_hour": f"""SELECT {_n("coalesce(sum(call_count), 0)")} AS calls
        FROM agg_calls WHERE minute > {_TILE}""",
    "kpi_rejected_last_hour": f"""SELECT {_n("coalesce(sum(record_count), 0)")} AS rejected
        FROM agg_dlq WHERE minute > {_TILE}""",
    "kpi_revenue_per_minute": _series("agg_revenue", {"value": _d("sum(total_amount)")}, "revenue_type"),
    "kpi_calls_per_minute": _series(
        "agg_calls", {"calls": _n("sum(call_count)"), "dropped": _n("sum(dropped_count)")}),
    "kpi_new_subscribers": f"""SELECT date_trunc('minute', created_at) AS time, count(*) AS subscribers
        FROM subs WHERE created_at BETWEEN {_RANGE} GROUP BY ALL""",
    "kpi_data_per_minute": _series("agg_data", {"mb": _d("sum(total_mb)")}),
    "kpi_tower_status": """SELECT tower_name AS tower, technology AS tech, signal_strength AS signal,
            connected_devices AS devices, status, updated_at AS updated
        FROM state JOIN towers USING (tower_id)""",
    "kpi_tower_load": f"""SELECT minute AS time, tower_name AS metric, {_n("sum(session_count)")} AS value
        FROM agg_data JOIN towers USING (tower_key) WHERE minute BETWEEN {_RANGE} GROUP BY ALL""",
    "kpi_dropped_calls": _series("agg_calls", {"dropped": _n("sum(dropped_count)")}),
    "kpi_traffic_by_technology": _series("agg_data", {"value": _d("sum(total_mb)")}, "technology"),
    "kpi_airtime_revenue": _series(
        "agg_revenue", {"airtime": _d("sum(total_amount)")}, where="revenue_type = 'AIRTIME'"),
    "kpi_bundle_revenue": _series(
        "agg_revenue", {"bundles": _d("sum(total_amount)")}, where="revenue_type = 'BUNDLE'"),
    "kpi_top_bundles": f"""SELECT bundle_name AS bundle, count(*) AS sales
        FROM sales JOIN bundles USING (bundle_key) WHERE event_timestamp > {_TILE}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""",
    "kpi_revenue_by_province": f"""SELECT province, {_d("sum(total_amount)")} AS revenue
        FROM agg_revenue WHERE minute > {_TILE} GROUP BY 1""",
    "kpi_avg_recharge": f"""SELECT round(coalesce({_d("sum(amount)")} / count(*), 0), 3) AS avg_amount
        FROM recharges WHERE event_timestamp > {_TILE}""",
    "kpi_recharges_by_method": f"""SELECT payment_method, count(*) AS recharges
        FROM recharges WHERE event_timestamp > {_TILE} GROUP BY 1""",
    "kpi_failed_payments": f"""SELECT count(*) AS failed FROM dead
        WHERE rejection_reason = 'PAYMENT_DECLINED' AND rejected_at > {_TILE}""",
    "kpi_subs_by_province": "SELECT province, count(*) AS subscribers FROM subs GROUP BY 1",
    "kpi_subs_by_plan": "SELECT plan, count(*) AS subscribers FROM subs GROUP BY 1",
    "kpi_arpu": f"""SELECT round({_d(f"(SELECT coalesce(sum(total_amount), 0) FROM agg_revenue WHERE minute > {_TILE})")}
        / greatest((SELECT count(DISTINCT subscriber_key) FROM subs), 1), 3) AS arpu""",
    "kpi_top_data_users": f"""SELECT msisdn, province, {_d("round(sum(mb_used), 1)")} AS mb_used
        FROM usage JOIN subs USING (subscriber_key) WHERE event_timestamp > {_TILE}
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""",
    "kpi_rejections_by_reason": _series("agg_dlq", {"value": _n("sum(record_count)")}, "rejection_reason"),
    "kpi_latest_dlq": """SELECT rejected_at AS rejected, source_topic AS topic, rejection_reason AS reason,
            left(CASE WHEN rejection_reason = 'PAYMENT_DECLINED' THEN '{"event_id":"' || event_id
                 || '","event_type":"airtime_purchase","timestamp":"' || wire
                 || '","schema_version":1,"subscriber_id":' || user_id || ',"amount":'
                 ELSE '{"offset":' || n || '}' END, 120) AS payload
        FROM dead ORDER BY rejected_at DESC, event_id LIMIT 25""",
    "kpi_tps": f"""SELECT date_trunc('minute', event_timestamp) AS time, count(*) / 60.0::DOUBLE AS tps
        FROM (SELECT event_timestamp FROM recharges UNION ALL SELECT event_timestamp FROM sales
              UNION ALL SELECT event_timestamp FROM calls UNION ALL SELECT event_timestamp FROM texts
              UNION ALL SELECT event_timestamp FROM usage)
        WHERE event_timestamp BETWEEN {_RANGE} GROUP BY ALL""",
}


def _needs(sql: str, found: dict[str, None]) -> None:
    """Collect the views a statement mentions, dependencies first."""
    for word in dict.fromkeys(re.findall(r"\w+", sql)):
        if word in VIEWS and word not in found:
            _needs(VIEWS[word].replace(word, ""), found)
            found[word] = None


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, select in SELECTS.items():
        found: dict[str, None] = {}
        _needs(select, found)
        views = ", ".join(f"{view} AS ({VIEWS[view]})" for view in found)
        out[name] = f"WITH {views} {select}" if views else select
    return out
