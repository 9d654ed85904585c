"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The derived tables are written once as CTE fragments and composed per query.
DuckDB spells ``last_value(x IGNORE NULLS)`` inside the parentheses and
structs as ``{'v': x}``; epoch millis are ``epoch_us(ts) // 1000`` because
DuckDB's ``epoch_ms`` rounds while the reference cuts.
"""

from __future__ import annotations

W_DEV = "(PARTITION BY device_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

CALLS = """
calls_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
calls_c AS (
  SELECT *, CASE
    WHEN event_type = 'signup' AND k % 4 = 0 THEN 'alias'
    WHEN event_type = 'signup' THEN 'identify'
    WHEN event_type = 'view' AND k % 2 = 0 THEN 'page'
    WHEN event_type = 'view' THEN 'screen'
    WHEN event_type = 'click' AND k % 4 = 0 THEN 'group'
    WHEN event_type = 'click' AND k % 4 = 1 THEN 'setAdvertisingId'
    WHEN event_type = 'click' THEN 'track'
    WHEN event_type = 'purchase' THEN 'track'
    WHEN event_type = 'error' AND k % 10 = 0 THEN 'reset'
    WHEN event_type = 'error' AND k % 10 = 1 THEN 'clearAdvertisingId'
    WHEN event_type = 'error' AND k % 10 = 2 THEN 'flush'
    WHEN event_type = 'error' AND k % 10 = 3 THEN 'initialize'
    ELSE 'track' END AS call
  FROM calls_k
),
calls AS (
  SELECT
    'wk-' || CAST(user_id % 4 AS VARCHAR) AS write_key,
    user_id AS device_id,
    event_id AS seq,
    ts,
    call,
    CASE WHEN call IN ('page', 'screen') THEN 'p-' || CAST(k AS VARCHAR) WHEN call = 'track' THEN event_type END AS name,
    CASE WHEN call = 'alias' THEN 'u-' || CAST(event_id AS VARCHAR)
         WHEN call = 'identify' THEN 'u-' || CAST(event_id % 1000 AS VARCHAR) END AS user_id,
    CASE WHEN call = 'group' THEN CASE WHEN k % 8 = 0 THEN '' ELSE 'g-' || CAST(k AS VARCHAR) END END AS group_id,
    CASE WHEN call = 'setAdvertisingId' THEN
      CASE WHEN k % 12 = 1 THEN NULL WHEN k % 12 = 5 THEN '  '
           ELSE 'ad-' || CAST(k AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) END END AS advertising_id,
    CAST(NULL AS VARCHAR) AS previous_id,
    CASE WHEN call = 'identify' THEN '{"k":' || CAST(k AS VARCHAR) || '}'
         WHEN call IN ('track', 'page', 'screen') THEN
           CASE WHEN k = 13 THEN '{bad' ELSE
             '{"flag":true,"k":' || CAST(k AS VARCHAR) || ',"meta":{"s":"x"},"none":null,"tags":["a",'
             || CAST(k AS VARCHAR) || '],"value":' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '}' END
    END AS payload_json,
    CASE WHEN event_type = 'purchase' AND k % 5 = 0 THEN strftime(ts, '%Y-%m-%dT00:00:00Z') END AS "timestamp"
  FROM calls_c
)"""

IDENTITY = f"""
idn1 AS (
  SELECT *,
    CAST(sum(CASE WHEN call = 'reset' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS epoch,
    CAST(sum(CASE WHEN call = 'flush' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS flush_epoch,
    last_value(CASE WHEN call = 'reset' THEN {{'v': NULL::VARCHAR}} WHEN call = 'identify' THEN {{'v': user_id}} END IGNORE NULLS) OVER w AS u_s,
    last_value(CASE WHEN call = 'reset' THEN {{'v': NULL::VARCHAR}} WHEN call = 'group' THEN {{'v': group_id}} END IGNORE NULLS) OVER w AS g_s,
    last_value(CASE WHEN call = 'reset' THEN false WHEN call = 'initialize' THEN true END IGNORE NULLS) OVER w AS m_s
  FROM calls
  WINDOW w AS {W_DEV}
),
idn2 AS (
  SELECT *,
    coalesce(m_s, true) AS initialized,
    u_s.v AS user_state,
    g_s.v AS group_state
  FROM idn1
),
idn3 AS (
  SELECT *,
    CASE WHEN initialized THEN
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)), 1, 8) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)), 9, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)), 13, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)), 17, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)), 21, 12)
    ELSE 'unknown' END AS anonymous_id
  FROM idn2
),
ident AS (
  SELECT *,
    a_s.v AS advertising_id_state,
    coalesce(a_s.c, 'unknown') AS consent_state
  FROM (
    SELECT *,
      last_value(CASE
        WHEN call = 'reset' THEN {{'v': NULL::VARCHAR, 'c': 'unknown'}}
        WHEN initialized AND call = 'setAdvertisingId' AND (advertising_id IS NULL OR trim(advertising_id, ' ' || chr(9)) <> '')
          THEN {{'v': advertising_id, 'c': CASE WHEN advertising_id IS NULL THEN 'withdrawn' ELSE 'granted' END}}
        WHEN initialized AND call = 'clearAdvertisingId' THEN {{'v': NULL::VARCHAR, 'c': 'withdrawn'}}
      END IGNORE NULLS) OVER w AS a_s
    FROM idn3
    WINDOW w AS {W_DEV}
  )
)"""

EVENTS = """
ev AS (
  SELECT *,
    CAST(epoch_us(ts) // 1000 AS VARCHAR) || '-' || upper(
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 1, 8) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 9, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 13, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 17, 4) || '-' ||
      substr(md5(CAST(device_id AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 21, 12)) AS message_id,
    call AS type,
    CASE WHEN call = 'track' THEN name END AS event,
    coalesce(CASE WHEN call IN ('identify', 'alias') THEN user_id END, user_state) AS ev_user_id,
    coalesce("timestamp", strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS event_time
  FROM ident
  WHERE call IN ('track', 'identify', 'group', 'screen', 'page', 'alias')
)"""


def with_(*fragments: str) -> str:
    return "WITH " + ",".join(fragments)


BASE = with_(CALLS, IDENTITY, EVENTS)

ORACLE: dict[str, str] = {
    "call_log": with_(CALLS) + """
SELECT write_key, device_id, seq, epoch_us(ts) AS ts_us, call, name, user_id, group_id, advertising_id,
       previous_id, payload_json, "timestamp" FROM calls""",
    "call_kinds": with_(CALLS) + """
SELECT call, count(*) AS n, call IN ('track', 'identify', 'group', 'screen', 'page', 'alias') AS emits_event
FROM calls GROUP BY call""",
    "enriched_events": BASE + """
SELECT message_id, device_id, seq, write_key, type, event, ev_user_id AS user_id, anonymous_id,
       group_state AS group_id, event_time FROM ev""",
    "identity_asof": BASE + """
SELECT device_id, seq, call, epoch, user_state AS user_id, group_state AS group_id FROM ident""",
    "identity_resumed": BASE + """
SELECT device_id, seq, epoch, user_state AS user_id, group_state AS group_id, anonymous_id,
  advertising_id_state AS advertising_id, consent_state, initialized FROM ident""",
    "stream_identity": BASE + """
SELECT device_id, seq, epoch, user_state AS user_id, group_state AS group_id, anonymous_id,
  advertising_id_state AS advertising_id, consent_state, initialized, false AS late FROM ident WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "anonymous_id": BASE + """
SELECT device_id, seq, epoch, initialized, anonymous_id FROM ident""",
    "adid_asof": BASE + """
SELECT device_id, seq, call, advertising_id_state AS advertising_id, consent_state FROM ident""",
}

ATTEMPTS = """
att0 AS (
  SELECT o_custkey % 15 AS device_id, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey % 15 ORDER BY o_orderdate, o_orderkey) - 1 AS n
  FROM orders
),
att1 AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(n * 6 AS BIGINT)) AS attempt_ts FROM att0
),
att2 AS (
  SELECT *, attempt_ts + INTERVAL 3 SECOND AS retry_at, (n // 20) % 3 AS form FROM att1
),
attempts AS (
  SELECT
    'wk-' || CAST(device_id % 4 AS VARCHAR) AS write_key,
    device_id, n AS seq, attempt_ts, o_orderkey AS batch_id, 1 + o_orderkey % 100 AS batch_size,
    CAST([200, 200, 503, 503, 503, 503, 200, 429, 429, 408, 200, 413, 400, 200, 302, NULL, 200, 500, 500, 404][n % 20 + 1] AS INTEGER) AS status,
    CASE WHEN n % 20 = 7 THEN '5' WHEN n % 20 = 8 THEN 'bad'
         WHEN n % 20 = 9 THEN CASE
           WHEN form = 0 THEN strftime(retry_at, '%a, %d %b %Y %H:%M:%S') || ' GMT'
           WHEN form = 1 THEN strftime(retry_at, '%A, %d-%b-%y %H:%M:%S') || ' GMT'
           ELSE strftime(retry_at, '%a %b %-d %H:%M:%S %Y') END
         WHEN n % 20 = 17 THEN ' 2 ' END AS retry_after
  FROM att2
)"""

MODEL_CASE_SQL = "coalesce(" + """CASE model_code
           WHEN 'iPhone14,7' THEN 'iPhone 13 mini' WHEN 'iPhone14,8' THEN 'iPhone 13'
           WHEN 'iPhone14,2' THEN 'iPhone 13 Pro' WHEN 'iPhone14,3' THEN 'iPhone 13 Pro Max'
           WHEN 'iPhone15,4' THEN 'iPhone 14' WHEN 'iPhone15,5' THEN 'iPhone 14 Plus'
           WHEN 'iPhone15,2' THEN 'iPhone 14 Pro' WHEN 'iPhone15,3' THEN 'iPhone 14 Pro Max'
           WHEN 'iPhone16,1' THEN 'iPhone 15 Pro' WHEN 'iPhone16,2' THEN 'iPhone 15 Pro Max'
           WHEN 'iPhone16,3' THEN 'iPhone 15' WHEN 'iPhone16,4' THEN 'iPhone 15 Plus'
           WHEN 'iPhone17,1' THEN 'iPhone 16 Pro' WHEN 'iPhone17,2' THEN 'iPhone 16 Pro Max'
           WHEN 'iPhone17,3' THEN 'iPhone 16' WHEN 'iPhone17,4' THEN 'iPhone 16 Plus'
           WHEN 'iPhone17,5' THEN 'iPhone 16e' WHEN 'iPhone18,1' THEN 'iPhone 17 Pro'
           WHEN 'iPhone18,2' THEN 'iPhone 17 Pro Max' WHEN 'iPhone18,3' THEN 'iPhone 17'
           WHEN 'iPhone18,4' THEN 'iPhone Air'
           WHEN 'iPad13,18' THEN 'iPad (10th generation)' WHEN 'iPad13,19' THEN 'iPad (10th generation)'
           WHEN 'iPad14,3' THEN 'iPad Pro 11-inch (4th generation)' WHEN 'iPad14,4' THEN 'iPad Pro 11-inch (4th generation)'
           WHEN 'iPad14,5' THEN 'iPad Pro 12.9-inch (6th generation)' WHEN 'iPad14,6' THEN 'iPad Pro 12.9-inch (6th generation)'
           WHEN 'x86_64' THEN 'Simulator' WHEN 'arm64' THEN 'Simulator' END""" + ", model_code)"

SNAP = f"""
snap0 AS (
  SELECT c_custkey AS device_id,
    ['iPhone16,2', 'iPhone17,1', 'iPad14,3', 'x86_64', 'iPhone99,9', 'arm64'][c_custkey % 6 + 1] AS model_code,
    CASE WHEN c_custkey % 17 = 5 THEN NULL
         ELSE ['phone', 'pad', 'tv', 'carPlay', 'mac', 'unspecified'][c_nationkey % 6 + 1] END AS idiom,
    c_custkey % 7 = 0 AS on_mac,
    c_name AS device_name,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Shop ' || CAST(c_custkey % 10 AS VARCHAR) END AS display_name,
    CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'shop' END AS bundle_name,
    CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE '2.' || CAST(c_custkey % 5 AS VARCHAR) || '.0' END AS app_version,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(100 + c_custkey % 50 AS VARCHAR) END AS app_build,
    CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'com.example.shop' END AS bundle_id,
    CASE WHEN c_custkey % 13 = 4 THEN 'visionOS' WHEN c_nationkey % 6 = 1 THEN 'iPadOS' WHEN c_nationkey % 6 = 2 THEN 'tvOS' ELSE 'iOS' END AS system_name,
    '17.' || CAST(c_custkey % 6 AS VARCHAR) AS system_version,
    '14.' || CAST(c_custkey % 6 AS VARCHAR) || '.' || CAST(c_custkey % 3 AS VARCHAR) AS mac_version,
    CASE WHEN c_nationkey % 6 = 4 AND c_custkey % 4 = 0 THEN NULL ELSE 393.0 END AS points_width,
    CASE WHEN c_nationkey % 6 = 4 AND c_custkey % 4 = 0 THEN NULL ELSE 852.0 END AS points_height,
    CAST(1 + c_custkey % 3 AS DOUBLE) AS scale,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS wifi,
    ['en_US', 'de_DE', 'fr_FR', 'ja_JP'][c_nationkey % 4 + 1] AS locale,
    ['America/New_York', 'Europe/Berlin', 'Europe/Paris', 'Asia/Tokyo'][c_nationkey % 4 + 1] AS timezone
  FROM customer
),
snap_all AS (
  SELECT device_id, model_code, idiom, on_mac,
    coalesce(display_name, bundle_name, 'Unknown') AS app_name,
    coalesce(app_version, 'unknown') AS app_version,
    coalesce(app_build, 'unknown') AS app_build,
    coalesce(bundle_id, 'unknown') AS app_namespace,
    'Apple' AS device_manufacturer,
    CASE WHEN idiom IS NULL THEN 'unknown' WHEN idiom = 'mac' THEN model_code
         ELSE {MODEL_CASE_SQL} END AS device_model,
    CASE WHEN idiom IS NULL THEN 'unknown' ELSE device_name END AS device_name,
    CASE WHEN idiom IN ('phone', 'pad') THEN 'ios' WHEN idiom = 'tv' THEN 'tv' WHEN idiom = 'carPlay' THEN 'car'
         WHEN idiom = 'mac' THEN 'macos' WHEN idiom IS NOT NULL AND on_mac THEN 'macos' ELSE 'unknown' END AS device_type,
    'eventloom-spark' AS library_name, '1.0.0' AS library_version,
    CASE WHEN idiom IS NULL THEN 'unknown' WHEN idiom = 'mac' THEN 'macOS' WHEN on_mac THEN 'macOS'
         ELSE system_name END AS os_name,
    CASE WHEN idiom IS NULL THEN 'unknown' WHEN idiom = 'mac' THEN mac_version ELSE system_version END AS os_version,
    CASE WHEN idiom IS NULL THEN 1.0 WHEN idiom = 'mac' AND points_width IS NULL THEN 2.0 ELSE scale END AS screen_density,
    CASE WHEN idiom IS NULL THEN 0 WHEN idiom = 'mac' AND points_width IS NULL THEN 1920
         ELSE CAST(trunc(points_width * scale) AS BIGINT) END AS screen_width,
    CASE WHEN idiom IS NULL THEN 0 WHEN idiom = 'mac' AND points_width IS NULL THEN 1080
         ELSE CAST(trunc(points_height * scale) AS BIGINT) END AS screen_height,
    wifi AS network_wifi, locale, timezone
  FROM snap0
),
snap AS (SELECT * FROM snap_all WHERE device_id % 11 <> 3)"""

BASE_ALL = with_(CALLS, IDENTITY, EVENTS, ATTEMPTS, SNAP)


def _env_sql(kind: str) -> str:
    safe = "(CASE WHEN json_valid(payload_json) THEN payload_json END)"
    keys = f"json_keys({safe})"
    valid = f"coalesce(json_type({safe}) = 'OBJECT', false)"
    return BASE + f"""
SELECT message_id, type, event, ev_user_id AS user_id,
  CASE
    WHEN type = 'track' THEN CASE WHEN {valid} THEN array_to_string(list_sort({keys}), ',') END
    WHEN type IN ('screen', 'page') THEN array_to_string(list_sort(list_distinct(list_concat(
         CASE WHEN {valid} THEN {keys} ELSE []::VARCHAR[] END, ['name']))), ',')
    WHEN type = 'group' THEN CASE WHEN length(group_id) > 0 THEN 'groupId' END
    WHEN type = 'alias' THEN CASE WHEN previous_id IS NOT NULL THEN 'previousId' END
  END AS prop_keys,
  CASE WHEN type IN ('identify', 'group') AND {valid} THEN array_to_string(list_sort({keys}), ',') END AS trait_keys,
  CASE WHEN type IN ('screen', 'page') THEN name END AS name_prop,
  CASE WHEN type = 'group' AND length(group_id) > 0 THEN group_id END AS group_prop,
  CASE WHEN type = 'alias' THEN previous_id END AS previous_prop,
  payload_json IS NULL OR {valid} AS props_ok
FROM ev WHERE type = '{kind}'"""


for _k in ("track", "identify", "group", "screen", "page", "alias"):
    ORACLE[f"env_{_k}"] = _env_sql(_k)

ORACLE.update({
    "identity_fill": BASE + """
SELECT message_id, ev_user_id AS user_id, anonymous_id, group_state AS group_id,
       type IN ('identify', 'alias') AS user_from_event FROM ev""",
    "identity_snapshot": BASE + """
SELECT write_key, device_id, seq AS last_seq, epoch, anonymous_id, user_state AS user_id,
       group_state AS group_id, advertising_id_state AS advertising_id, initialized, consent_state, flush_epoch
FROM ident QUALIFY row_number() OVER (PARTITION BY write_key, device_id ORDER BY seq DESC) = 1""",
    "alias_edges": BASE + """
SELECT anonymous_id, ev_user_id AS user_id, min(seq) AS first_seq, min(epoch_us(ts)) AS first_ts_us, count(*) AS n
FROM ev WHERE type = 'alias' GROUP BY anonymous_id, ev_user_id""",
    "consent_audit": BASE + """
SELECT consent_state, count(*) AS n_events, count(advertising_id_state) AS n_with_adid FROM ev GROUP BY consent_state""",
    "disabled_drop": with_(CALLS, ATTEMPTS) + """,
merged AS (
  SELECT device_id, ts AS t, 1 AS src, seq, call FROM calls
  UNION ALL
  SELECT device_id, attempt_ts AS t, 0 AS src, NULL AS seq, NULL AS call FROM attempts WHERE status IN (401, 403, 404)
),
flagged AS (
  SELECT *, last_value(CASE WHEN src = 0 THEN 1 WHEN call = 'reset' THEN 0 END IGNORE NULLS)
    OVER (PARTITION BY device_id ORDER BY t, src, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS off
  FROM merged
)
SELECT device_id, seq, call FROM flagged WHERE src = 1 AND coalesce(off, 0) = 0""",
    "context_attach": BASE_ALL + """
SELECT e.message_id, e.device_id, s.app_name, s.app_version, s.app_build, s.app_namespace, s.device_manufacturer,
  s.device_model, s.device_name, s.device_type,
  CASE WHEN s.device_id IS NOT NULL THEN e.advertising_id_state END AS device_advertising_id,
  s.library_name, s.library_version, s.os_name, s.os_version, s.screen_density, s.screen_width, s.screen_height,
  s.network_wifi, s.locale, s.timezone
FROM ev e LEFT JOIN snap s ON e.device_id = s.device_id""",
    "device_model": with_(SNAP) + f"""
SELECT device_id, model_code, {MODEL_CASE_SQL} AS model FROM snap0""",
    "device_type": with_(SNAP) + "\nSELECT device_id, idiom, on_mac, device_type FROM snap_all",
    "app_context": with_(SNAP) + "\nSELECT device_id, app_name, app_version, app_build, app_namespace FROM snap_all",
    "os_context": with_(SNAP) + "\nSELECT device_id, os_name, os_version FROM snap_all",
    "screen_context": with_(SNAP) + "\nSELECT device_id, screen_width, screen_height, screen_density FROM snap_all",
    "message_id": BASE + "\nSELECT device_id, seq, message_id FROM ev",
    "event_time": with_(CALLS) + """
SELECT device_id, seq, coalesce("timestamp", strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS event_time,
       "timestamp" IS NOT NULL AS given
FROM calls WHERE call IN ('track', 'identify', 'group', 'screen', 'page', 'alias')""",
    "masked_events": BASE + """
SELECT message_id,
  CASE WHEN length(write_key) > 4 THEN '***' || right(write_key, 4) ELSE '***' END AS masked_write_key,
  coalesce(substring(advertising_id_state, 1, 8) || '***', 'undefined') AS redacted_adid
FROM ev""",
})


def tag_sql(x: str) -> str:
    """Value kind of a JSON value, same rule as the Spark side."""
    return f"""(CASE json_type({x})
      WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'bool'
      WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'BIGINT' THEN 'int'
      WHEN 'UBIGINT' THEN CASE WHEN TRY_CAST({x} AS BIGINT) IS NOT NULL THEN 'int' ELSE 'double' END
      WHEN 'DOUBLE' THEN CASE WHEN CAST({x} AS DOUBLE) = floor(CAST({x} AS DOUBLE))
                              AND abs(CAST({x} AS DOUBLE)) < 9.2e18 THEN 'int' ELSE 'double' END
      WHEN 'HUGEINT' THEN 'double' END)"""


def _int_sql(x: str) -> str:
    return f"(CASE WHEN {tag_sql(x)} = 'int' THEN CASE WHEN json_type({x}) = 'DOUBLE' THEN CAST(CAST({x} AS DOUBLE) AS BIGINT) ELSE CAST({x} AS BIGINT) END END)"


def _dbl_sql(x: str) -> str:
    return f"(CASE WHEN {tag_sql(x)} IN ('int', 'double') THEN CAST({x} AS DOUBLE) END)"


SAFE_P = "(CASE WHEN json_valid(payload_json) THEN payload_json END)"

PAYLOADS = f"""
pv AS (
  SELECT device_id, seq, call, name, payload_json,
         CASE WHEN json_type({SAFE_P}) = 'OBJECT' THEN {SAFE_P} END AS p
  FROM calls WHERE payload_json IS NOT NULL
),
kv AS (SELECT device_id, seq, call, p, unnest(json_keys(p)) AS key FROM pv WHERE p IS NOT NULL),
vals AS (SELECT device_id, seq, call, key, json_extract(p, '$."' || key || '"') AS v FROM kv)"""

RECEIVED = """
recv AS (
  SELECT write_key, device_id, seq, event_time,
    CASE seq % 17
      WHEN 0 THEN regexp_replace(message_id, '-([0-9A-F]{12})$', '\\1')
      WHEN 1 THEN 'x' || message_id
      WHEN 2 THEN '+' || message_id
      WHEN 3 THEN ' ' || message_id
      WHEN 4 THEN substring(message_id, 1, length(message_id) - 1)
      WHEN 5 THEN lower(message_id)
      ELSE message_id END AS mid
  FROM ev
),
recv2 AS (
  SELECT *,
    CASE WHEN regexp_full_match(split_part(mid, '-', 1), '[+-]?[0-9]{1,19}') THEN TRY_CAST(split_part(mid, '-', 1) AS BIGINT) END AS id_ms
  FROM recv
),
recv3 AS (
  SELECT *,
    coalesce(regexp_full_match(mid, '[+]?[0-9]+-[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}')
             AND id_ms IS NOT NULL, false) AS valid
  FROM recv2
)"""

_x = "json_extract(p, '{path}')"
ORACLE.update({
    "settings_check": """
WITH st AS (
  SELECT CASE WHEN c_custkey % 17 = 16 THEN '' ELSE 'wk-' || CAST(c_custkey AS VARCHAR) END AS write_key,
    CASE c_custkey % 6 WHEN 0 THEN 'https://in.example.com/' WHEN 1 THEN '  https://in.example.com  '
      WHEN 2 THEN 'https://in.example.com/collect' WHEN 3 THEN 'in.example.com'
      WHEN 4 THEN 'https://in.example.com//' ELSE chr(10) || 'https://in.example.com' || chr(10) END AS ingestion_host,
    (c_custkey % 3) * 5 AS flush_interval_seconds, (c_custkey % 5) * 500 AS max_queue_events
  FROM customer
),
sc AS (SELECT *, regexp_replace(trim(ingestion_host, ' ' || chr(9) || chr(10) || chr(13)), '/$', '') AS host_clean FROM st),
sd AS (
  SELECT *, CASE WHEN NOT regexp_matches(host_clean, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'invalid host'
                 WHEN length(write_key) = 0 THEN 'empty write key'
                 WHEN ends_with(host_clean, '/') THEN 'host ends with slash' END AS reason
  FROM sc
)
SELECT write_key, host_clean, CAST(greatest(1, flush_interval_seconds) AS BIGINT) AS flush_interval_seconds,
       CAST(greatest(1, max_queue_events) AS BIGINT) AS max_queue_events, reason IS NULL AS valid, reason FROM sd""",
    "props_convert": with_(CALLS, PAYLOADS) + """
SELECT call, name, count(*) AS n, count(p) AS n_ok, count(*) - count(p) AS n_bad FROM pv GROUP BY call, name""",
    "props_profile": with_(CALLS, PAYLOADS) + f"""
SELECT call, key, {tag_sql('v')} AS tag, count(*) AS n FROM vals GROUP BY ALL""",
    "props_columns": with_(CALLS, PAYLOADS) + f"""
SELECT device_id, seq,
  {_int_sql(_x.format(path='$.k'))} AS k_int,
  {_dbl_sql(_x.format(path='$.value'))} AS value_double,
  {_int_sql(_x.format(path='$.value'))} AS value_int,
  CASE WHEN {tag_sql(_x.format(path='$.flag'))} = 'bool' THEN CAST({_x.format(path='$.flag')} AS BOOLEAN) END AS flag_bool,
  CASE WHEN {tag_sql(_x.format(path='$.flag'))} = 'string' THEN p ->> '$.flag' END AS flag_str,
  CASE WHEN {tag_sql(_x.format(path='$.meta.s'))} = 'string' THEN p ->> '$.meta.s' END AS meta_s,
  CASE WHEN {tag_sql(_x.format(path='$.tags'))} = 'array' THEN CAST(json_array_length({_x.format(path='$.tags')}) AS BIGINT) END AS tags_n,
  coalesce({tag_sql(_x.format(path='$.none'))} = 'null', false) AS none_is_null
FROM pv""",
    "props_explode": with_(CALLS, PAYLOADS) + f""",
arr AS (
  SELECT device_id, seq, key, v, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i
  FROM vals WHERE json_type(v) = 'ARRAY' AND json_array_length(v) > 0
),
elems AS (
  SELECT device_id, seq, key, NULL::BIGINT AS pos, v FROM vals
  WHERE json_type(v) <> 'ARRAY' OR json_array_length(v) = 0
  UNION ALL
  SELECT device_id, seq, key, i AS pos, json_extract(v, '$[' || CAST(i AS VARCHAR) || ']') AS v FROM arr
)
SELECT device_id, seq, key, pos, {tag_sql('v')} AS tag,
  CASE WHEN {tag_sql('v')} = 'string' THEN v ->> '$' END AS str_val,
  {_dbl_sql('v')} AS num_val,
  CASE WHEN {tag_sql('v')} = 'bool' THEN CAST(v AS BOOLEAN) END AS bool_val
FROM elems""",
    "message_id_valid": BASE + "," + RECEIVED + """
SELECT write_key, count(*) FILTER (WHERE valid) AS n_valid, count(*) FILTER (WHERE NOT valid) AS n_invalid
FROM recv3 GROUP BY write_key""",
    "message_id_gap": BASE + "," + RECEIVED + """,
gaps AS (SELECT *, id_ms - epoch_ms(try_strptime(event_time, '%Y-%m-%dT%H:%M:%SZ')) AS gap FROM recv3)
SELECT device_id, count(*) AS n, count(*) FILTER (WHERE id_ms IS NULL) AS n_unparsable,
       max(gap) AS max_gap_ms, min(gap) AS min_gap_ms
FROM gaps GROUP BY device_id""",
    "retry_after_ms": with_(ATTEMPTS) + """,
ra AS (
  SELECT device_id, seq, attempt_ts, retry_after,
    trim(retry_after, ' ' || chr(9)) AS tr,
    regexp_replace(regexp_replace(regexp_replace(retry_after, '^[A-Za-z]+,? +', ''), ' {2,}', ' ', 'g'), ' (GMT|UTC)$', '') AS hd
  FROM attempts
),
rb AS (
  SELECT *, CASE WHEN regexp_full_match(tr, '[+-]?[0-9]{1,15}') THEN CAST(tr AS BIGINT) END AS secs,
    try_strptime(hd, ['%d %b %Y %H:%M:%S', '%d-%b-%y %H:%M:%S', '%b %d %H:%M:%S %Y']) AS d0
  FROM ra
),
rc AS (SELECT *, CASE WHEN year(d0) > year(attempt_ts) + 50 THEN d0 - INTERVAL 100 YEAR ELSE d0 END AS d FROM rb)
SELECT device_id, seq, CAST(CASE WHEN secs IS NOT NULL THEN greatest(0, secs * 1000)
  WHEN d IS NOT NULL THEN greatest(0, epoch_ms(d) - epoch_ms(attempt_ts)) END AS BIGINT) AS retry_after_ms
FROM rc""",
    "event_json": BASE_ALL + """
SELECT e.message_id, e.type AS j_type, e.event AS j_event, e.ev_user_id AS j_user_id, e.anonymous_id AS j_anonymous_id,
  e.group_state AS j_group_id, e.event_time AS j_timestamp, e.write_key AS j_write_key, s.device_model AS j_model,
  CASE WHEN s.device_id IS NOT NULL THEN e.advertising_id_state END AS j_adid,
  CASE WHEN e.type IN ('screen', 'page') THEN e.name END AS j_props_name,
  e.event IS NOT NULL AS has_event_key, false AS has_sent_at_key
FROM ev e LEFT JOIN snap s ON e.device_id = s.device_id""",
    "event_json_parsed": BASE + """
SELECT message_id, seq % 5 <> 0 AS parsed, CASE WHEN seq % 5 <> 0 THEN type END AS p_type,
  CASE WHEN seq % 5 <> 0 THEN event END AS p_event, CASE WHEN seq % 5 <> 0 THEN ev_user_id END AS p_user_id,
  CASE WHEN seq % 5 <> 0 THEN anonymous_id END AS p_anonymous_id, CASE WHEN seq % 5 <> 0 THEN group_state END AS p_group_id,
  CASE WHEN seq % 5 <> 0 THEN event_time END AS p_timestamp, CASE WHEN seq % 5 <> 0 THEN write_key END AS p_write_key
FROM ev""",
    "event_json_roundtrip": BASE + "\nSELECT message_id, true AS roundtrip_ok FROM ev",
})

W_UNB = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

BATCHES = """
bat0 AS (SELECT *, epoch_us(ts) // 604800000000 * 604800 AS flush_start_s FROM ev),
bat AS (
  SELECT *, (rn - 1) // 100 AS batch_no, (rn - 1) % 100 AS batch_pos,
         write_key || ':' || CAST(flush_start_s AS VARCHAR) || ':' || CAST((rn - 1) // 100 AS VARCHAR) AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY write_key, flush_start_s ORDER BY seq) AS rn FROM bat0)
)"""

RETRY_AFTER = """
ra AS (
  SELECT device_id, seq, attempt_ts, retry_after,
    trim(retry_after, ' ' || chr(9)) AS tr,
    regexp_replace(regexp_replace(regexp_replace(retry_after, '^[A-Za-z]+,? +', ''), ' {2,}', ' ', 'g'), ' (GMT|UTC)$', '') AS hd
  FROM attempts
),
rb AS (
  SELECT *, CASE WHEN regexp_full_match(tr, '[+-]?[0-9]{1,15}') THEN CAST(tr AS BIGINT) END AS secs,
    try_strptime(hd, ['%d %b %Y %H:%M:%S', '%d-%b-%y %H:%M:%S', '%b %d %H:%M:%S %Y']) AS d0
  FROM ra
),
rc AS (SELECT *, CASE WHEN year(d0) > year(attempt_ts) + 50 THEN d0 - INTERVAL 100 YEAR ELSE d0 END AS d FROM rb),
rtim AS (
  SELECT device_id, seq, CAST(CASE WHEN secs IS NOT NULL THEN greatest(0, secs * 1000)
    WHEN d IS NOT NULL THEN greatest(0, epoch_ms(d) - epoch_ms(attempt_ts)) END AS BIGINT) AS retry_after_ms
  FROM rc
)"""

ORACLE["retry_after_ms"] = with_(ATTEMPTS, RETRY_AFTER) + "\nSELECT device_id, seq, retry_after_ms FROM rtim"

BREAKER = f"""
dl0 AS (
  SELECT *,
    CASE WHEN status IS NULL THEN 'failure' WHEN status BETWEEN 200 AND 299 THEN 'success'
         WHEN status BETWEEN 500 AND 599 OR status IN (408, 429) THEN 'failure'
         WHEN status IN (401, 403, 404) THEN 'fatal' ELSE 'nonretry' END AS outcome,
    CAST(greatest(1, 100 >> CAST(least(coalesce(sum(CASE WHEN status = 413 THEN 1 ELSE 0 END) OVER
      (PARTITION BY device_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 30) AS INTEGER)) AS BIGINT) AS size_in_force
  FROM attempts
),
dl1 AS (
  SELECT *, CASE WHEN status IS NULL THEN 'requeue' WHEN status BETWEEN 200 AND 299 THEN 'delivered'
    WHEN status BETWEEN 500 AND 599 OR status IN (408, 429) THEN 'requeue'
    WHEN status = 413 AND size_in_force > 1 THEN 'halve_requeue' WHEN status = 413 THEN 'drop'
    WHEN status IN (401, 403, 404) THEN 'disable' ELSE 'drop' END AS action,
    sum(CASE WHEN outcome IN ('success', 'nonretry') THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY seq {W_UNB}) AS brk
  FROM dl0
),
dl2 AS (
  SELECT *, CAST(sum(CASE WHEN outcome = 'failure' THEN 1 ELSE 0 END) OVER (PARTITION BY device_id, brk ORDER BY seq {W_UNB}) AS BIGINT) AS streak
  FROM dl1
),
dl3 AS (
  SELECT *, coalesce(last_value(CASE WHEN outcome = 'success' THEN 0 WHEN outcome = 'failure' AND streak >= 3 THEN 1 END IGNORE NULLS)
    OVER (PARTITION BY device_id ORDER BY seq {W_UNB}), 0) = 1 AS is_open
  FROM dl2
),
dl4 AS (SELECT *, outcome = 'failure' AND is_open AS trip FROM dl3),
dl5 AS (
  SELECT *, CAST(sum(CASE WHEN trip THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY seq {W_UNB}) AS BIGINT) AS trip_no
  FROM dl4
),
brk AS (
  SELECT *,
    CASE WHEN trip THEN least(120000, CAST(10000 AS BIGINT) << CAST(least(trip_no - 1, 30) AS INTEGER)) END AS cooldown_ms,
    CASE WHEN trip THEN 'open' WHEN is_open THEN 'half_open' ELSE 'closed' END AS breaker_state
  FROM dl5
)"""

SETTINGS_CHECKED = ORACLE["settings_check"].replace("WITH st AS", "st AS").split("\nSELECT write_key, host_clean")[0]
SETTINGS_CHECKED += """,
settings_ok AS (
  SELECT write_key, host_clean, CAST(greatest(1, flush_interval_seconds) AS BIGINT) AS flush_interval_seconds,
         CAST(greatest(1, max_queue_events) AS BIGINT) AS max_queue_events, reason IS NULL AS settings_valid FROM sd
)"""

# The queue, one row after the other.
QUEUE = """
cfg AS (
  SELECT write_key, max(max_queue_events) // 50 AS cap, max(flush_interval_seconds) AS days FROM settings_ok GROUP BY write_key
),
qm0 AS (
  SELECT write_key, device_id, seq, ts AS t, 1 AS src, call, CAST(NULL AS INTEGER) AS status, 0 AS size, CAST(NULL AS VARCHAR) AS action FROM calls
  WHERE call IN ('track', 'identify', 'group', 'screen', 'page', 'alias', 'flush', 'reset')
  UNION ALL
  SELECT write_key, device_id, seq, attempt_ts, 0, NULL, status, batch_size, action FROM dl1
),
qm1 AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY t, src, seq) AS rn,
    coalesce(last_value(CASE WHEN action = 'disable' THEN 1 WHEN call = 'reset' THEN 0 END IGNORE NULLS) OVER
      (PARTITION BY device_id ORDER BY t, src, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS off
  FROM qm0
),
qm AS MATERIALIZED (
  SELECT qm1.*, greatest(1, coalesce(cfg.cap, 40)) AS cap, 86400 * coalesce(cfg.days, 10) AS every_s,
    CASE WHEN call IN ('reset', 'flush') THEN call WHEN src = 1 THEN CASE WHEN off = 1 THEN 'ignored' ELSE 'event' END
         WHEN action = 'disable' THEN 'fatal' WHEN action = 'delivered' THEN 'delivered' WHEN action = 'drop' THEN 'dropped' ELSE 'retry' END AS kind
  FROM qm1 LEFT JOIN cfg ON qm1.write_key = cfg.write_key
),
qs AS (
  SELECT DISTINCT device_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS len, CAST(0 AS BIGINT) AS pushed FROM qm
  UNION ALL
  SELECT m.device_id, m.rn,
    CAST(CASE WHEN m.kind = 'event' THEN CASE WHEN q.len >= m.cap THEN m.cap ELSE q.len + 1 END
         WHEN m.kind IN ('reset', 'fatal') THEN 0
         WHEN m.kind IN ('delivered', 'dropped') THEN q.len - least(q.len, m.size) ELSE q.len END AS BIGINT),
    CAST(q.pushed + CASE WHEN m.kind = 'event' THEN 1 ELSE 0 END AS BIGINT)
  FROM qs q JOIN qm m ON m.device_id = q.device_id AND m.rn = q.rn + 1
),
ql AS MATERIALIZED (
  SELECT m.*, q.len AS queue_length, q.pushed, q.pushed - q.len AS gone FROM qm m JOIN qs q ON m.device_id = q.device_id AND m.rn = q.rn
),
ends AS (
  SELECT e.device_id, e.seq, min(l.rn) AS end_rn FROM ql e LEFT JOIN ql l ON l.device_id = e.device_id AND l.gone >= e.pushed
  WHERE e.kind = 'event' GROUP BY e.device_id, e.seq
),
fates AS (
  SELECT v.write_key, v.device_id, v.seq, v.message_id,
    CASE WHEN l.rn IS NULL THEN 'pending' WHEN l.kind = 'event' THEN 'overflow' ELSE l.kind END AS fate,
    CASE WHEN l.src = 0 THEN l.seq END AS attempt_seq
  FROM ends e JOIN ev v ON v.device_id = e.device_id AND v.seq = e.seq LEFT JOIN ql l ON l.device_id = e.device_id AND l.rn = e.end_rn
),
pending AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY seq) AS queue_pos FROM fates WHERE fate = 'pending')"""

# Who waits with whom: a group is left when it is full, at a tick, or at a row that ends it.
GROUPS = """
wr AS MATERIALIZED (
  SELECT *, epoch_us(t) // 1000000 // every_s * every_s AS tick, row_number() OVER (PARTITION BY device_id ORDER BY rn) AS k
  FROM qm WHERE kind IN ('event', 'flush', 'reset', 'fatal')
),
ws AS (
  SELECT DISTINCT device_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS grp, CAST(0 AS BIGINT) AS waiting, CAST(-1 AS BIGINT) AS tick FROM wr
  UNION ALL
  SELECT r.device_id, r.k,
    CAST(CASE WHEN r.kind <> 'event' OR (w.waiting BETWEEN 1 AND 19 AND w.tick = r.tick) THEN w.grp ELSE w.grp + 1 END AS BIGINT),
    CAST(CASE WHEN r.kind <> 'event' THEN 0 WHEN w.waiting BETWEEN 1 AND 19 AND w.tick = r.tick THEN w.waiting + 1 ELSE 1 END AS BIGINT),
    CAST(r.tick AS BIGINT)
  FROM ws w JOIN wr r ON r.device_id = w.device_id AND r.k = w.k + 1
),
wg AS (
  SELECT r.*, w.grp, w.waiting, min(r.seq) OVER (PARTITION BY r.device_id, w.grp) AS first_seq
  FROM wr r JOIN ws w ON r.device_id = w.device_id AND r.k = w.k WHERE r.kind = 'event'
)"""

QUEUED = "WITH RECURSIVE " + ",".join((CALLS, IDENTITY, EVENTS, ATTEMPTS, BREAKER, SETTINGS_CHECKED, QUEUE))

ORACLE.update({
    "keep_newest": BASE + "\nSELECT device_id, seq FROM ev QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY seq DESC) <= 25",
    "keep_first": BASE + "\nSELECT device_id, seq FROM ev QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY seq) <= 25",
    "drain_front": BASE + "\nSELECT device_id, seq FROM ev QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY seq) <= 10",
    "drop_front": BASE + "\nSELECT device_id, seq FROM ev QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY seq) > 10",
    "prebind_replay": with_(CALLS) + """,
fi AS (SELECT device_id, min(seq) AS first_init FROM calls WHERE call = 'initialize' GROUP BY device_id),
pb AS (
  SELECT c.device_id, c.seq, c.call FROM calls c JOIN fi ON c.device_id = fi.device_id WHERE c.seq < fi.first_init
  QUALIFY row_number() OVER (PARTITION BY c.device_id ORDER BY c.seq DESC) <= 20
)
SELECT device_id, seq, call, row_number() OVER (PARTITION BY device_id ORDER BY seq) AS replay_pos FROM pb""",
    "batch_assign": BASE + "," + BATCHES + """
SELECT message_id, write_key, device_id, seq, flush_start_s, batch_no, batch_pos, batch_id FROM bat""",
    "requeue_merge": BASE + "," + BATCHES + """,
rq AS (
  SELECT device_id, seq, batch_no % 3 <> 0 AS is_new,
         row_number() OVER (PARTITION BY device_id ORDER BY batch_no % 3 <> 0, seq) AS queue_pos
  FROM bat
)
SELECT device_id, seq, is_new, queue_pos FROM rq WHERE queue_pos <= 40""",
    "flush_windows": BASE + """
SELECT device_id, epoch_us(ts) // 10000000 * 10 AS window_start_s, count(*) AS n, CAST(ceil(count(*) / 100) AS BIGINT) AS n_batches
FROM ev GROUP BY device_id, epoch_us(ts) // 10000000 * 10""",
    "count_windows": QUEUED + "," + GROUPS + """,
sizes AS (SELECT device_id, grp, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS size, max(k) AS k, max(tick) AS tick FROM wg GROUP BY device_id, grp)
SELECT s.device_id, s.first_seq, s.last_seq, s.size,
  CASE WHEN s.size = 20 THEN 'threshold' WHEN n.tick = s.tick AND n.kind <> 'event' THEN n.kind ELSE 'timer' END AS ended_by
FROM sizes s LEFT JOIN wr n ON n.device_id = s.device_id AND n.k = s.k + 1""",
    "queue_depth": QUEUED + "\nSELECT device_id, src, seq, kind, queue_length, gone FROM ql",
    "event_fates": QUEUED + "\nSELECT device_id, seq, message_id, fate, attempt_seq FROM fates",
    "sent_at": BASE + "," + BATCHES + """
SELECT batch_id, count(*) AS n_events, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS sent_at FROM bat GROUP BY batch_id""",
    "batch_bodies": BASE + "," + BATCHES + """
SELECT batch_id, count(*) AS n_events, count(*) AS body_n, string_agg(message_id, ',' ORDER BY batch_pos) AS ids,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS body_sent_at
FROM bat GROUP BY batch_id""",
    "delivery_actions": with_(ATTEMPTS, BREAKER) + """
SELECT device_id, action, count(*) AS n, CAST(sum(batch_size) AS BIGINT) AS events FROM brk GROUP BY device_id, action""",
    "retry_delay": with_(ATTEMPTS, RETRY_AFTER, BREAKER) + """
SELECT b.device_id, b.seq, b.status, CAST(CASE
    WHEN b.status IS NULL THEN coalesce(b.cooldown_ms, 0)
    WHEN b.status BETWEEN 500 AND 599 OR b.status = 408 THEN greatest(100, coalesce(r.retry_after_ms, coalesce(b.cooldown_ms, 0)))
    WHEN b.status = 429 THEN greatest(1000, coalesce(r.retry_after_ms, 0), coalesce(b.cooldown_ms, 0))
    WHEN b.status = 413 AND b.size_in_force > 1 THEN 0 END AS BIGINT) AS retry_delay_ms
FROM brk b JOIN rtim r ON b.device_id = r.device_id AND b.seq = r.seq""",
    "fatal_clients": with_(ATTEMPTS) + """
SELECT write_key, device_id, min(seq) AS first_fatal_seq, arg_min(status, seq) AS first_fatal_status,
       arg_min(epoch_us(attempt_ts), seq) AS first_fatal_ts_us, count(*) AS n_fatal
FROM attempts WHERE status IN (401, 403, 404) GROUP BY write_key, device_id""",
    "batch_size_asof": with_(ATTEMPTS, BREAKER) + "\nSELECT device_id, seq, status, size_in_force, action FROM brk",
    "breaker_trips": with_(ATTEMPTS, BREAKER) + """
SELECT device_id, seq, status, outcome, CAST(CASE WHEN is_open THEN 0 ELSE streak END AS BIGINT) AS streak, trip, trip_no,
  CAST(cooldown_ms - floor(cooldown_ms * 0.2) AS BIGINT) AS cooldown_min_ms,
  CAST(cooldown_ms + floor(cooldown_ms * 0.2) AS BIGINT) AS cooldown_max_ms, breaker_state
FROM brk""",
    "undelivered": QUEUED + """
SELECT device_id, seq, message_id, queue_pos FROM pending""",
    "pipeline_status": QUEUED + """,
wk AS (SELECT DISTINCT write_key FROM calls),
q AS (SELECT write_key, count(*) AS queue_length FROM pending GROUP BY write_key),
snapx AS (
  SELECT write_key, device_id, user_state FROM ident
  QUALIFY row_number() OVER (PARTITION BY write_key, device_id ORDER BY seq DESC) = 1
),
ids AS (SELECT write_key, count(*) AS n_devices, count(user_state) AS n_identified FROM snapx GROUP BY write_key),
ls AS (SELECT write_key, device_id, arg_max(breaker_state, seq) AS state FROM brk GROUP BY write_key, device_id),
bo AS (SELECT write_key, count(*) FILTER (WHERE state = 'open') AS n_open_breakers FROM ls GROUP BY write_key)
SELECT wk.write_key, CASE WHEN length(wk.write_key) > 4 THEN '***' || right(wk.write_key, 4) ELSE '***' END AS masked_key,
  coalesce(q.queue_length, 0) AS queue_length, coalesce(ids.n_devices, 0) AS n_devices,
  coalesce(ids.n_identified, 0) AS n_identified, coalesce(bo.n_open_breakers, 0) AS n_open_breakers,
  s.host_clean, s.flush_interval_seconds, s.max_queue_events, s.settings_valid
FROM wk LEFT JOIN q ON wk.write_key = q.write_key LEFT JOIN ids ON wk.write_key = ids.write_key
LEFT JOIN bo ON wk.write_key = bo.write_key LEFT JOIN settings_ok s ON wk.write_key = s.write_key""",
})

JOURNEYS = """
links AS (
  SELECT anonymous_id AS l_anon, arg_min(ev_user_id, seq) AS l_user, min(seq) AS l_seq
  FROM ev WHERE type = 'alias' AND anonymous_id <> 'unknown' GROUP BY anonymous_id
),
jn AS (
  SELECT e.*, coalesce(l.l_user, e.ev_user_id, e.anonymous_id) AS person_id,
    CASE WHEN l.l_seq IS NULL THEN 'none' WHEN e.seq < l.l_seq THEN 'pre' ELSE 'post' END AS phase
  FROM ev e LEFT JOIN links l ON e.anonymous_id = l.l_anon
)"""

COPIES = """
stamped AS (SELECT *, max(ts) OVER (PARTITION BY batch_id) AS sent_ts FROM bat),
copies AS (
  SELECT message_id, device_id, seq, sent_ts, 1 AS copy FROM stamped
  UNION ALL
  SELECT message_id, device_id, seq, sent_ts + INTERVAL 30 SECOND, 2 FROM stamped WHERE batch_no % 3 = 0
)"""

ORACLE.update({
    "dedup_messages": BASE + "," + BATCHES + "," + COPIES + """
SELECT message_id, arg_min(device_id, sent_ts) AS device_id, arg_min(seq, sent_ts) AS seq,
       min(epoch_us(sent_ts)) AS first_sent_us, count(*) AS n_copies
FROM copies GROUP BY message_id""",
    "dedup_across_runs": BASE + "," + BATCHES + "," + COPIES + """,
runs AS (SELECT *, sent_ts < TIMESTAMP '2024-01-15 00:00:00' AND copy = 1 AS begun FROM copies)
SELECT message_id, arg_min(device_id, sent_ts) AS device_id, arg_min(seq, sent_ts) AS seq,
       min(epoch_us(sent_ts)) AS first_sent_us, count(*) AS n_copies
FROM runs WHERE NOT begun AND message_id NOT IN (SELECT message_id FROM runs WHERE begun) GROUP BY message_id""",
    "journeys": BASE + "," + JOURNEYS + "\nSELECT message_id, person_id, phase FROM jn",
    "funnel": BASE + "," + JOURNEYS + """,
per AS (
  SELECT person_id, min(seq) AS first_seq,
    min(CASE WHEN ev_user_id IS NOT NULL THEN ts END) AS identified_seq,
    min(CASE WHEN type = 'track' AND event = 'purchase' THEN ts END) AS converted_seq
  FROM jn GROUP BY person_id
)
SELECT count(*) AS n_people, count(identified_seq) AS n_identified, count(converted_seq) AS n_converted,
       count(*) FILTER (WHERE converted_seq > identified_seq) AS n_converted_after_identify
FROM per""",
})


SNAPV = """
snapv AS (
  SELECT device_id, TIMESTAMP '2023-12-31 00:00:00' AS snapshot_ts, app_version, app_build, device_model FROM snap
  UNION ALL
  SELECT device_id, TIMESTAMP '2024-01-15 00:00:00', '3.0.0', '300', device_model FROM snap WHERE device_id % 4 = 1
)"""

ORACLE["context_asof"] = BASE_ALL + "," + SNAPV + """
SELECT e.message_id, e.device_id, s.app_version, s.app_build, s.device_model,
       CASE WHEN s.device_id IS NOT NULL THEN e.advertising_id_state END AS device_advertising_id
FROM ev e ASOF LEFT JOIN snapv s ON e.device_id = s.device_id AND e.ts >= s.snapshot_ts"""

ORACLE["stream_context"] = BASE_ALL + "," + SNAPV + """
SELECT e.message_id, e.device_id, s.app_version, s.app_build, s.device_model,
       CASE WHEN s.device_id IS NOT NULL THEN e.advertising_id_state END AS device_advertising_id
FROM ev e LEFT JOIN snapv s ON e.device_id = s.device_id AND s.snapshot_ts <= e.ts AND s.snapshot_ts > e.ts - INTERVAL 20 DAY
QUALIFY row_number() OVER (PARTITION BY e.message_id ORDER BY s.snapshot_ts DESC NULLS LAST) = 1"""


KEPT = """
merged_k AS (
  SELECT device_id, ts AS t, 1 AS src, seq, call FROM calls
  UNION ALL
  SELECT device_id, attempt_ts AS t, 0 AS src, NULL AS seq, NULL AS call FROM attempts WHERE status IN (401, 403, 404)
),
flagged_k AS (
  SELECT *, last_value(CASE WHEN src = 0 THEN 1 WHEN call = 'reset' THEN 0 END IGNORE NULLS)
    OVER (PARTITION BY device_id ORDER BY t, src, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS off
  FROM merged_k
),
kept AS (
  SELECT c.* FROM calls c JOIN flagged_k f ON c.device_id = f.device_id AND c.seq = f.seq
  WHERE f.src = 1 AND coalesce(f.off, 0) = 0
)"""

ORACLE["active_events"] = with_(CALLS, ATTEMPTS, KEPT, IDENTITY.replace("  FROM calls\n  WINDOW w", "  FROM kept\n  WINDOW w"), EVENTS) + """
SELECT message_id, device_id, seq, type, ev_user_id AS user_id, anonymous_id, group_state AS group_id,
       advertising_id_state AS advertising_id FROM ev"""


ORACLE["stream_bodies"] = with_(CALLS, ATTEMPTS, KEPT, IDENTITY.replace("  FROM calls\n  WINDOW w", "  FROM kept\n  WINDOW w"), EVENTS) + """
SELECT message_id, type, ev_user_id AS user_id, anonymous_id, group_state AS group_id FROM ev"""


ORACLE["device_batches"] = QUEUED + "," + GROUPS + """
SELECT v.message_id, g.device_id, g.seq, g.tick AS flush_start_s, g.first_seq AS batch_first_seq, g.waiting - 1 AS batch_pos
FROM wg g JOIN ev v ON v.device_id = g.device_id AND v.seq = g.seq"""


ORACLE["device_status"] = QUEUED + """,
lastrow AS (
  SELECT write_key, device_id, initialized, anonymous_id, user_state AS user_id, group_state AS group_id FROM ident
  QUALIFY row_number() OVER (PARTITION BY write_key, device_id ORDER BY seq DESC) = 1
),
lastc AS (
  SELECT r.*, x.last_reset_ts FROM lastrow r JOIN (
    SELECT write_key, device_id, max(CASE WHEN call = 'reset' THEN ts END) AS last_reset_ts FROM ident GROUP BY write_key, device_id
  ) x ON r.write_key = x.write_key AND r.device_id = x.device_id
),
fat AS (SELECT device_id, max(attempt_ts) AS last_fatal_ts FROM attempts WHERE status IN (401, 403, 404) GROUP BY device_id),
que AS (SELECT device_id, count(*) AS queue_length FROM pending GROUP BY device_id),
cir AS (SELECT device_id, arg_max(breaker_state, seq) AS circuit_state FROM brk GROUP BY device_id)
SELECT l.write_key, CASE WHEN length(l.write_key) > 4 THEN '***' || right(l.write_key, 4) ELSE '***' END AS masked_key,
  l.device_id,
  CASE WHEN f.last_fatal_ts IS NOT NULL AND (l.last_reset_ts IS NULL OR f.last_fatal_ts > l.last_reset_ts) THEN 'disabled'
       WHEN l.initialized THEN 'ready' ELSE 'idle' END AS lifecycle,
  coalesce(q.queue_length, 0) AS queue_length, coalesce(c.circuit_state, 'closed') AS circuit_state,
  l.anonymous_id, l.user_id, l.group_id, s.flush_interval_seconds, s.max_queue_events
FROM lastc l LEFT JOIN fat f ON l.device_id = f.device_id LEFT JOIN que q ON l.device_id = q.device_id
LEFT JOIN cir c ON l.device_id = c.device_id LEFT JOIN settings_ok s ON l.write_key = s.write_key"""

ORACLE["size_batches"] = BASE + """,
sz AS (
  SELECT device_id, seq, ts, strlen(concat_ws('|', message_id, type, anonymous_id, ev_user_id,
    repeat('x', CASE WHEN seq % 50 = 7 THEN 900 ELSE seq % 90 END))) AS bytes FROM ev
),
pos0 AS (
  SELECT *, epoch_us(ts) // 604800000000 AS wk, row_number() OVER (PARTITION BY device_id, epoch_us(ts) // 604800000000 ORDER BY seq) - 1 AS rn
  FROM sz WHERE 12 + bytes <= 1000
),
pos AS (SELECT *, rn // 100 AS batch_no, rn % 100 AS batch_pos FROM pos0),
piece AS (
  SELECT device_id, wk, batch_no, s, 11 + sum(bytes) + count(*) AS body
  FROM pos, (VALUES (100), (50), (25), (12), (6), (3), (1)) c(s) GROUP BY device_id, wk, batch_no, s, batch_pos // s
),
fit AS (SELECT device_id, wk, batch_no, s FROM piece GROUP BY device_id, wk, batch_no, s HAVING max(body) <= 1000),
chosen AS (SELECT device_id, wk, batch_no, max(s) AS batch_size FROM fit GROUP BY device_id, wk, batch_no)
SELECT device_id, seq, bytes, batch_no, batch_size, batch_pos // batch_size AS piece FROM pos JOIN chosen USING (device_id, wk, batch_no)
UNION ALL SELECT device_id, seq, bytes, NULL, NULL, NULL FROM sz WHERE 12 + bytes > 1000"""


PEOPLE = """
pl AS (
  SELECT DISTINCT '1:' || anonymous_id AS a, '0:' || ev_user_id AS b FROM ev
  WHERE type IN ('alias', 'identify') AND anonymous_id <> 'unknown' AND ev_user_id <> ''
),
pe AS MATERIALIZED (SELECT a, b FROM pl UNION SELECT b, a FROM pl),
reach AS (
  SELECT a AS node, a AS root FROM pe
  UNION
  SELECT pe.b, r.root FROM reach r JOIN pe ON pe.a = r.node WHERE r.root < pe.b
),
graph AS (
  SELECT CASE WHEN node LIKE '0:%' THEN 'user' ELSE 'anonymous' END AS kind, substr(node, 3) AS id, substr(min(root), 3) AS person_id
  FROM reach GROUP BY node
)"""
LINKED = "WITH RECURSIVE " + ",".join((CALLS, IDENTITY, EVENTS, PEOPLE))

ORACLE.update({
    "person_graph": LINKED + "\nSELECT kind, id, person_id FROM graph",
    "people": LINKED + """,
owner AS (
  SELECT e.device_id, coalesce(a.person_id, u.person_id) AS person_id FROM ev e
  LEFT JOIN graph a ON a.kind = 'anonymous' AND a.id = e.anonymous_id LEFT JOIN graph u ON u.kind = 'user' AND u.id = e.ev_user_id
)
SELECT g.person_id, count(*) AS n_ids,
  (SELECT count(DISTINCT device_id) FROM owner o WHERE o.person_id = g.person_id) AS n_devices,
  (SELECT count(*) FROM owner o WHERE o.person_id = g.person_id) AS n_events
FROM graph g GROUP BY g.person_id""",
    "journeys_asof": BASE + """,
link AS (
  SELECT anonymous_id AS anon, seq AS since, ev_user_id AS linked, lead(seq) OVER w AS until, row_number() OVER w AS no
  FROM ev WHERE type = 'alias' AND anonymous_id <> 'unknown' WINDOW w AS (PARTITION BY anonymous_id ORDER BY seq)
)
SELECT e.message_id, coalesce(l.linked, e.ev_user_id, e.anonymous_id) AS person_id, coalesce(l.no, 0) AS link_no
FROM ev e LEFT JOIN link l ON l.anon = e.anonymous_id AND e.seq >= l.since AND (l.until IS NULL OR e.seq < l.until)""",
})
