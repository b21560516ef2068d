"""The SQL each query must agree with."""

from __future__ import annotations

from checks.standins import SQL_CLASS, SQL_MEASUREMENTS, SQL_RAW
from gaugeworks.operators.bank import bank_frames
from gaugeworks.operators.marts import GRAIN_INTERVAL, GRAIN_WORD, mart_name

ORACLE: dict[str, str] = {}

PER_BATCH = "SELECT event_id // 1000 AS batch, count(*) AS readings, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1"
ORACLE["scan_documents"] = PER_BATCH
ORACLE["unloaded_files"] = "SELECT DISTINCT event_id // 1000 AS batch FROM events WHERE (event_id // 1000) % 2 <> 0"
# Each landing wrote its own document per batch.
for _name in ("raw_load", "stream_ingest", "raw_load_after_stream"):
    ORACLE[_name] = PER_BATCH

ORACLE["flatten_two_level"] = " UNION ALL ".join(
    f"SELECT CAST(user_id AS VARCHAR) AS station_id, event_id, {i} AS seq, {r} AS reading FROM events"
    for i, r in enumerate(("value", "value", "value * 2"))
)
ORACLE["flatten_deep_path"] = (
    "SELECT c_custkey AS station_id, c_name AS name FROM customer UNION ALL SELECT -c_custkey, '' FROM customer"
)
ORACLE["flatten_root_array"] = "SELECT s_suppkey AS id, s_acctbal AS bal FROM supplier"
ORACLE["doc_level_field"] = "SELECT event_id, event_type FROM events, range(3)"
ORACLE["json_path_cast"] = (
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS missing FROM events"
)
ORACLE["decimal_cast"] = "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10, 2)) AS price FROM orders"
ORACLE["array_index"] = (
    "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[2] AS DOUBLE) AS second, "
    "CAST(embedding[100001] AS DOUBLE) AS beyond FROM embeddings"
)
ORACLE["distinct_nested"] = (
    "SELECT DISTINCT json_extract_string(props, '$.k') AS k, replace(props, ' ', '') AS whole FROM events"
)

ORACLE["distinct_nested_numbers"] = """SELECT DISTINCT '{"a":"1.0","b":[' || CAST(l_orderkey % 50 AS VARCHAR) || ',1.5]}' AS part
    FROM lineitem"""
ORACLE["quarantine_malformed"] = """SELECT event_id, value FROM (
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END AS value FROM events)
    WHERE value IS NOT NULL AND NOT json_valid(value)"""

ORACLE["project_rename"] = "SELECT event_type AS kind, ts AS measure_at, event_id AS id FROM events"
ORACLE["star_exclude"] = "SELECT * EXCLUDE (props) FROM events"
for _name, _rule in {
    "negative_to_null": "CASE WHEN air_temperature < 0 THEN NULL ELSE air_temperature END",
    "na_tag_to_null": "CASE WHEN visibility = '-99' THEN NULL ELSE visibility END",
    "classify_station": SQL_CLASS.format(id="station_id"),
}.items():
    ORACLE[_name] = f"WITH {SQL_RAW} SELECT event_id, {_rule} AS cleaned FROM raw"
for _name, _rule in {
    "empty_to_null": "CASE WHEN event_type = 'view' THEN NULL ELSE event_type END",
    "empty_to_null_date": "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) END",
    "quote_trim": "concat(event_type, '\"', event_type)",
    "parse_timestamp": "date_trunc('second', ts)",
}.items():
    ORACLE[_name] = f"SELECT event_id, {_rule} AS cleaned FROM events"
ORACLE["coalesce_priority"] = (
    f"WITH {SQL_RAW} SELECT event_id, CASE WHEN air_temperature >= 0 THEN air_temperature "
    "WHEN wind_direction_gust >= 0 THEN wind_direction_gust ELSE 0 END AS chosen FROM raw"
)
ORACLE["dedup_measurements"] = f"WITH {SQL_MEASUREMENTS} SELECT * FROM measurements"
ORACLE["distinct_geo"] = "SELECT DISTINCT lang, source FROM documents"
ORACLE["distinct_measurements"] = f"WITH {SQL_RAW} SELECT DISTINCT * EXCLUDE (event_id) FROM raw"

TWO = """SELECT coalesce(l.k, r.c_custkey) AS station_id, coalesce(l.s_name, r.c_name) AS name,
    coalesce(r.c_acctbal, l.s_acctbal) AS balance, r.c_nationkey AS nation_id
    FROM (SELECT s_suppkey - 50 AS k, * FROM supplier) l FULL OUTER JOIN customer r ON l.k = r.c_custkey"""
ORACLE["full_outer_two"] = TWO
ORACLE["full_outer_three"] = f"""SELECT coalesce(l.station_id, r.k) AS station_id, coalesce(l.name, r.n_name) AS name,
    l.balance, l.nation_id, r.n_regionkey AS region_id
    FROM ({TWO}) l FULL OUTER JOIN (SELECT n_nationkey - 60 AS k, * FROM nation) r ON l.station_id = r.k"""
ORACLE["full_outer_heavy_key"] = """SELECT coalesce(l.k, c_custkey) AS station_id, o_orderkey, c_name
    FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey * 2 END AS k, o_orderkey FROM orders) l
    FULL OUTER JOIN customer ON l.k = c_custkey"""
for _name, _status in {"existing_stations": "O", "revoked_stations": "F"}.items():
    ORACLE[_name] = f"""SELECT coalesce(c_custkey, o_custkey) AS station_id, c_name AS station_name, o_orderkey,
        o_orderstatus AS station_status FROM customer FULL OUTER JOIN orders ON c_custkey = o_custkey
        WHERE o_orderstatus = '{_status}'"""
ORACLE["left_join_enrich"] = """SELECT user_id, event_type, coalesce(s_name, 'none') AS rain_name,
    coalesce(c_acctbal, s_acctbal) AS balance FROM (SELECT DISTINCT user_id, event_type FROM events)
    LEFT JOIN supplier ON user_id = s_suppkey LEFT JOIN customer ON user_id = c_custkey"""
for _name, _key in {"not_in_new_keys": "s_suppkey", "not_in_with_null": "nullif(s_suppkey, 3)"}.items():
    ORACLE[_name] = f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT {_key} FROM supplier)"


def frame_sql(func: str, column: str, key: str, ts: str, interval: str) -> str:
    over = f"OVER (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN CURRENT ROW AND INTERVAL '{interval}' FOLLOWING)"
    return f"CAST(round(CAST({func}({column}) {over} AS DECIMAL(18, 6)), 2) AS DOUBLE)"


for _grain, _interval in GRAIN_INTERVAL.items():
    for _func in ("avg", "sum", "max"):
        _result = frame_sql(_func, "value", "user_id", "ts", _interval)
        ORACLE[f"window_{_func}_{_grain}"] = f"SELECT event_id, user_id, ts, value, {_result} AS result FROM events"
ORACLE["window_mode"] = """WITH e AS (SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
    counted AS (SELECT a.event_id, b.k, count(*) AS n FROM e a JOIN e b
        ON b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR GROUP BY 1, 2),
    best AS (SELECT event_id, k AS result FROM counted
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY n DESC, k) = 1)
    SELECT e.*, result FROM e JOIN best USING (event_id)"""


def _bank(grains) -> str:
    frames = bank_frames(grains=grains)
    columns = ", ".join(f"{frame_sql(f.func, f.column, 'station_id', 'measure_at', f.interval)} AS {f.name}" for f in frames)
    return f"{SQL_MEASUREMENTS}, bank AS (SELECT *, {columns} FROM measurements)"


IDENTITY = "station_id, station_name, station_type, measure_at"
ORACLE["window_bank"] = f"WITH {_bank(tuple(GRAIN_WORD))} SELECT * FROM bank"
for _grain, _word in GRAIN_WORD.items():
    _names = [f.name for f in bank_frames(grains=(_grain,))]
    _renamed = ", ".join(f"{n} AS {mart_name(n, _grain)}" for n in _names)
    _boundary = f"measure_at = date_trunc('{_grain}', measure_at)"
    ORACLE[f"grain_filter_{_grain}"] = (
        f"WITH {SQL_MEASUREMENTS} SELECT station_id, measure_at, air_temperature FROM measurements WHERE {_boundary}"
    )
    ORACLE[f"mart_{_word}"] = f"WITH {_bank((_grain,))} SELECT {IDENTITY}, {_renamed} FROM bank WHERE {_boundary}"
    if _grain == "hour":
        ORACLE["suffix_select"] = f"WITH {_bank((_grain,))} SELECT {IDENTITY}, {', '.join(_names)} FROM bank"
    if _grain == "day":
        ORACLE["suffix_rename"] = f"WITH {_bank((_grain,))} SELECT {IDENTITY}, {_renamed} FROM bank"

EVENTS = "SELECT event_id, ts, user_id, event_type, value FROM events"
LOADED = "ts <= TIMESTAMP '2024-01-20 12:00:00'"
ORACLE["global_max"] = "SELECT max(ts) AS mark FROM events"
for _name, _target, _floor in (
    ("hwm_strict", LOADED, "NULL"),
    ("hwm_strict_empty", "event_type = 'none such'", "NULL"),
    ("hwm_floor", LOADED, "TIMESTAMP '2024-01-01'"),
    ("hwm_floor_empty", "event_type = 'none such'", "TIMESTAMP '2024-01-10'"),
):
    ORACLE[_name] = f"{EVENTS} WHERE ts > (SELECT coalesce(max(ts), {_floor}) FROM events WHERE {_target})"
for _name in ("incremental_append", "incremental_append_floor"):
    ORACLE[_name] = f"""{EVENTS} WHERE ({LOADED} AND event_type <> 'error')
        OR ts > (SELECT max(ts) FROM events WHERE {LOADED} AND event_type <> 'error')"""
ORACLE["incremental_append_all"] = f"{EVENTS} UNION ALL {EVENTS}"
ORACLE["full_refresh"] = EVENTS
ORACLE["materialize_table"] = EVENTS
ORACLE["append_without_marker"] = EVENTS
ORACLE["delete_insert"] = """WITH pending AS (SELECT o_custkey AS key, max(o_totalprice) AS balance FROM orders GROUP BY 1)
    SELECT c_custkey AS key, c_acctbal AS balance FROM customer WHERE c_custkey NOT IN (SELECT key FROM pending)
    UNION ALL SELECT * FROM pending"""
