"""DuckDB SQL of the registered queries, for the side-by-side correctness check.

Each statement runs on the driver tables (``events``, ``nation``, ``region`` ...)
registered as views and returns the same columns as the Spark query, with the
same presentation: instants as Manila wall clock (``TIMESTAMP``, the zone has
no daylight saving, so +8 h), means as ``round(x + 1e-9, 6)``.
"""
from __future__ import annotations

# Manila wall clock of UTC microseconds: +8 hours.
LOCAL = 28_800_000_000

CAMS = """
cams AS (
  SELECT 'CAM-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS camera_id,
         n_name AS location_name, r_name AS road_name, r_name AS city,
         CAST(14.4 AS DOUBLE) + n_nationkey * CAST(0.01 AS DOUBLE) AS latitude,
         CAST(121.0 AS DOUBLE) + n_nationkey * CAST(0.005 AS DOUBLE) AS longitude,
         CAST(CASE WHEN n_nationkey % 3 = 2 THEN 40 ELSE 60 END AS INTEGER) AS speed_limit_kph,
         CASE n_nationkey % 3 WHEN 0 THEN 'SPEED' WHEN 1 THEN 'INTERSECTION'
              ELSE 'NO_PARKING' END AS camera_type
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

READINGS = """
readings AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'CAM-' || lpad(CAST(user_id % 27 AS VARCHAR), 2, '0') AS camera_id,
         'P ' || CAST(user_id AS VARCHAR) AS plate_number,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE upper(event_type) END AS vehicle_type,
         CAST(14.4 AS DOUBLE) + (user_id % 27) * CAST(0.01 AS DOUBLE) AS latitude,
         CAST(121.0 AS DOUBLE) + (user_id % 27) * CAST(0.005 AS DOUBLE) AS longitude,
         CASE WHEN user_id % 27 % 3 = 2 THEN value / 20 ELSE value END AS speed_kph,
         CASE WHEN user_id % 27 % 3 = 1 THEN
           CASE event_type WHEN 'error' THEN 'RED' WHEN 'view' THEN 'YELLOW' ELSE 'GREEN' END
         END AS traffic_light_state,
         CASE WHEN user_id % 27 % 3 = 1 THEN
           CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0
         END AS stop_line_crossed,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 360 AS us
  FROM events
)"""

ENRICHED = """
enriched AS (
  SELECT r.*, c.location_name, c.road_name, c.camera_type, c.speed_limit_kph
  FROM readings r JOIN cams c USING (camera_id)
  WHERE speed_kph >= 0 AND NOT isnan(speed_kph)
)"""

BASE = "WITH " + ",".join([CAMS, READINGS, ENRICHED])


def ts(expr: str) -> str:
    """Manila wall clock of a UTC microsecond expression."""
    return f"make_timestamp({expr} + {LOCAL})"


def mean(expr: str) -> str:
    return f"round({expr} + 1e-9, 6)"


def vid(vtype: str, micros: str) -> str:
    return (f"substr(sha256(concat_ws('|', '{vtype}', plate_number, camera_id, "
            f"CAST({ts(micros)} AS VARCHAR))), 1, 32)")


FIRST_TYPE = ("min(CASE WHEN vehicle_type IS NOT NULL THEN {'t': us, 'v': vehicle_type} END).v")

READING_COLS = """event_id, camera_id, plate_number, vehicle_type, latitude, longitude, speed_kph,
  traffic_light_state, stop_line_crossed"""

SPEED_WINDOWS = """
sw AS (
  SELECT e.*, (us - us % 20000000) - k * 20000000 AS ws
  FROM enriched e CROSS JOIN range(3) t(k) WHERE camera_type = 'SPEED'
),
swagg AS (
  SELECT ws, plate_number, camera_id, location_name, road_name, speed_limit_kph,
         avg(speed_kph) AS avg_speed, max(speed_kph) AS max_speed, count(*) AS readings,
         min(us) AS first_us, max(us) AS last_us, """ + FIRST_TYPE + """ AS vehicle_type,
         avg(latitude) AS latitude, avg(longitude) AS longitude
  FROM sw GROUP BY ws, plate_number, camera_id, location_name, road_name, speed_limit_kph
)"""

SPEEDING = f"""
speeding AS (
  SELECT {vid('SPEEDING', 'first_us')} AS violation_id, 'SPEEDING' AS violation_type,
         plate_number, vehicle_type, camera_id, location_name, road_name,
         latitude, longitude,
         {ts('first_us')} AS violation_time, CAST({ts('first_us')} AS DATE) AS violation_date,
         {ts('ws')} AS window_start, {ts('ws + 60000000')} AS window_end,
         avg_speed AS recorded_speed_kph, speed_limit_kph,
         CAST(readings AS INTEGER) AS reading_count,
         CAST(NULL AS VARCHAR) AS evidence,
         'PENDING_REVIEW' AS ticket_status, {ts('ws + 90000000')} AS detected_at
  FROM swagg WHERE avg_speed > speed_limit_kph + 0.0 AND readings >= 2
)"""

RED_LIGHT = f"""
red_light AS (
  SELECT {vid('BEATING_RED_LIGHT', 'us')} AS violation_id, 'BEATING_RED_LIGHT' AS violation_type,
         plate_number, vehicle_type, camera_id, location_name, road_name,
         latitude, longitude,
         {ts('us')} AS violation_time, CAST({ts('us')} AS DATE) AS violation_date,
         {ts('us')} AS window_start, {ts('us')} AS window_end,
         speed_kph AS recorded_speed_kph, speed_limit_kph,
         CAST(1 AS INTEGER) AS reading_count,
         'Crossed the stop line on RED at '
           || CAST(round(CAST(speed_kph AS DECIMAL(18, 2)), 1) AS VARCHAR) || ' kph' AS evidence,
         'PENDING_REVIEW' AS ticket_status, {ts('us + 30000000')} AS detected_at
  FROM enriched
  WHERE camera_type = 'INTERSECTION' AND traffic_light_state = 'RED' AND stop_line_crossed
    AND speed_kph >= 5.0
)"""

SESSIONS = """
st AS (SELECT * FROM enriched WHERE camera_type = 'NO_PARKING' AND speed_kph <= 3.0),
st_mark AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY plate_number, camera_id ORDER BY us)
                      <= 120000000 THEN 0 ELSE 1 END AS brk
  FROM st
),
st_sid AS (
  SELECT *, sum(brk) OVER (PARTITION BY plate_number, camera_id ORDER BY us, brk DESC
                           ROWS UNBOUNDED PRECEDING) AS sid
  FROM st_mark
),
sessions AS (
  SELECT plate_number, camera_id, location_name, road_name, speed_limit_kph,
         """ + FIRST_TYPE + """ AS vehicle_type,
         avg(speed_kph) AS avg_speed, max(speed_kph) AS max_speed_kph, count(*) AS readings,
         min(us) AS first_us, max(us) AS last_us,
         avg(latitude) AS latitude, avg(longitude) AS longitude,
         max(us) // 1000000 - min(us) // 1000000 AS stationary_seconds
  FROM st_sid GROUP BY plate_number, camera_id, location_name, road_name, speed_limit_kph, sid
)"""

PARKING = f"""
parking AS (
  SELECT {vid('ILLEGAL_PARKING', 'first_us')} AS violation_id, 'ILLEGAL_PARKING' AS violation_type,
         plate_number, vehicle_type, camera_id, location_name, road_name,
         latitude, longitude,
         {ts('first_us')} AS violation_time, CAST({ts('first_us')} AS DATE) AS violation_date,
         {ts('first_us')} AS window_start, {ts('last_us')} AS window_end,
         avg_speed AS recorded_speed_kph, speed_limit_kph,
         CAST(readings AS INTEGER) AS reading_count,
         'Stationary for ' || CAST(stationary_seconds AS VARCHAR) || ' s in a no-parking zone ('
           || CAST(readings AS VARCHAR) || ' readings); grace period 180 s' AS evidence,
         'PENDING_REVIEW' AS ticket_status, {ts('last_us + 30000000')} AS detected_at
  FROM sessions WHERE stationary_seconds >= 180
)"""

# All detections, then the keyed upsert (last write wins, see UPSERT_ORDER).
VIOLATIONS = """
all_violations AS (
  SELECT * FROM speeding UNION ALL SELECT * FROM red_light UNION ALL SELECT * FROM parking
),
violations AS (
  SELECT * FROM all_violations
  QUALIFY row_number() OVER (PARTITION BY violation_id
    ORDER BY window_end DESC, recorded_speed_kph DESC, detected_at DESC, window_start DESC,
             reading_count DESC, evidence DESC NULLS LAST) = 1
)"""

DETECTIONS = ",".join([SPEED_WINDOWS, SPEEDING, RED_LIGHT, SESSIONS, PARKING, VIOLATIONS])

VIOLATION_COLS = f"""violation_id, violation_type, plate_number, vehicle_type, camera_id,
  location_name, road_name, {mean('latitude')} AS latitude, {mean('longitude')} AS longitude,
  violation_time, violation_date, window_start, window_end,
  {mean('recorded_speed_kph')} AS recorded_speed_kph, speed_limit_kph, reading_count,
  ticket_status, detected_at"""


def with_detections(select: str) -> str:
    return BASE + "," + DETECTIONS + "\n" + select


SQL: dict[str, str] = {}

SQL["enriched_telemetry"] = BASE + f"""
SELECT {READING_COLS}, {ts('us')} AS event_time,
       location_name, road_name, camera_type, speed_limit_kph
FROM enriched"""

SQL["valid_telemetry"] = BASE + f"""
SELECT {READING_COLS}, {ts('us')} AS event_time
FROM readings
WHERE camera_id IS NOT NULL AND plate_number IS NOT NULL AND us IS NOT NULL
  AND speed_kph >= 0 AND NOT isnan(speed_kph)"""

SQL["detect_speeding"] = with_detections(
    f"SELECT {VIOLATION_COLS} FROM speeding")

SQL["detect_red_light"] = with_detections(
    f"SELECT {VIOLATION_COLS}, evidence FROM red_light")

SQL["detect_illegal_parking"] = with_detections(
    f"SELECT {VIOLATION_COLS}, evidence FROM parking")

SQL["stationary_sessions"] = with_detections(f"""
SELECT plate_number, camera_id, location_name, road_name, speed_limit_kph, vehicle_type,
       {mean('avg_speed')} AS avg_speed_kph, max_speed_kph, readings,
       {ts('first_us')} AS first_seen, {ts('last_us')} AS last_seen,
       {mean('latitude')} AS latitude, {mean('longitude')} AS longitude, stationary_seconds
FROM sessions""")

STATS = f"""
cw AS (
  SELECT e.*, (us - us % 30000000) - k * 30000000 AS ws
  FROM enriched e CROSS JOIN range(2) t(k)
),
stats AS (
  SELECT camera_id, CAST({ts('ws')} AS DATE) AS stat_date,
         {ts('ws')} AS window_start, {ts('ws + 60000000')} AS window_end,
         avg(speed_kph) AS avg_speed_kph, max(speed_kph) AS max_speed_kph,
         CAST(count(*) AS INTEGER) AS reading_count,
         CAST(count(DISTINCT plate_number) AS INTEGER) AS vehicle_count,
         avg(CASE WHEN speed_kph > speed_limit_kph THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
           AS pct_over_limit,
         speed_limit_kph
  FROM cw GROUP BY camera_id, ws, speed_limit_kph
)"""

STATS_COLS = f"""camera_id, stat_date, window_start, window_end,
       {mean('avg_speed_kph')} AS avg_speed_kph, max_speed_kph, reading_count, vehicle_count,
       {mean('pct_over_limit')} AS pct_over_limit, speed_limit_kph"""

SQL["camera_speed_stats"] = BASE + "," + STATS + f"""
SELECT {STATS_COLS} FROM stats"""

SQL["violations_upserted"] = with_detections(
    f"SELECT {VIOLATION_COLS} FROM violations")

# The approximate count is checked against the exact one inside the Spark query.
SQL["camera_speed_stats_approx"] = BASE + "," + STATS + f"""
SELECT {STATS_COLS.replace('vehicle_count', 'TRUE AS vehicle_count_close')} FROM stats"""

SQL["violation_evidence"] = with_detections("""
SELECT violation_id, violation_type, window_start, reading_count AS said_readings,
       CASE WHEN violation_type = 'SPEEDING' THEN speed_limit_kph END AS said_limit, TRUE AS sentence_right
FROM all_violations""")

# The stream's messages carry milliseconds.
_MILLIS = READINGS.replace("// 360 AS us", "// 360 - (1704067200000000 + (epoch_us(ts) - 1704067200000000) // 360) % 1000 AS us")
_STREAM_BASE = "WITH " + ",".join([CAMS, _MILLIS, ENRICHED])

SQL["store_compacted"] = SQL["violations_upserted"]

SQL["stream_violations"] = _STREAM_BASE + "," + DETECTIONS + f"""
SELECT {VIOLATION_COLS} FROM violations"""

SQL["stream_stats"] = _STREAM_BASE + "," + STATS + f"""
SELECT {STATS_COLS.replace('reading_count, vehicle_count', 'reading_count')} FROM stats"""

# --- lookups and reports -------------------------------------------------------------
# Parameters shared with trafficwatch.catalog.
DAY = "DATE '2024-01-01'"
NOW = "TIMESTAMP '2024-01-01 10:02:00'"        # Manila wall clock
PREV_POLL = "TIMESTAMP '2024-01-01 09:57:00'"
PLATE_INPUT = "  p   12 "
CAMERA_INPUT = "cam-03"
TYPE_INPUT = "speeding "


def iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') || '+08:00'"


def api(src: str) -> str:
    """API records (evidence left out, see catalog) of a violations relation."""
    return f"""SELECT violation_id AS id, {iso('violation_time')} AS time,
       violation_type AS type, plate_number AS plate, vehicle_type AS vehicle,
       camera_id AS camera, location_name AS location,
       {mean('recorded_speed_kph')} AS speed, speed_limit_kph AS "limit",
       ticket_status AS status, {iso('detected_at')} AS detected
FROM {src}"""


DAY_RECORDS = f"""
recs AS (
  SELECT * FROM violations
  WHERE violation_date = {DAY}
    AND violation_type IN ('BEATING_RED_LIGHT', 'SPEEDING', 'ILLEGAL_PARKING')
)"""


def with_day(select: str) -> str:
    return BASE + "," + DETECTIONS + "," + DAY_RECORDS + "\n" + select


STORED_ORDER = "ORDER BY violation_time DESC, violation_id ASC"

SQL["violations_by_plate"] = with_detections(f"""
SELECT {VIOLATION_COLS} FROM violations
WHERE plate_number = trim(regexp_replace(upper('{PLATE_INPUT}'), '\\s+', ' ', 'g'))
{STORED_ORDER} LIMIT 100""")

# The same rows, from the store.
SQL["store_by_plate"] = SQL["violations_by_plate"]

SQL["violations_by_camera"] = with_detections(f"""
SELECT {VIOLATION_COLS} FROM violations
WHERE camera_id = upper(trim('{CAMERA_INPUT}')) AND violation_date = {DAY}
{STORED_ORDER} LIMIT 50""")

SQL["violations_by_type"] = with_detections(f"""
SELECT {VIOLATION_COLS} FROM violations
WHERE violation_type = upper(trim('{TYPE_INPUT}')) AND violation_date = {DAY}
{STORED_ORDER} LIMIT 50""")

SQL["stats_by_camera"] = BASE + "," + STATS + f"""
SELECT {STATS_COLS} FROM stats
WHERE camera_id = upper(trim('{CAMERA_INPUT}')) AND stat_date = {DAY}
ORDER BY window_start DESC LIMIT 50"""

SQL["violations_of_day"] = with_day(
    api("recs") + " ORDER BY time DESC NULLS LAST, id ASC LIMIT 300")


def _as_of(moment: str) -> str:
    return f"""(SELECT * FROM all_violations WHERE detected_at <= {moment}
  QUALIFY row_number() OVER (PARTITION BY violation_id
    ORDER BY window_end DESC, recorded_speed_kph DESC, detected_at DESC, window_start DESC,
             reading_count DESC, evidence DESC NULLS LAST) = 1)"""


SQL["new_violations"] = BASE + "," + DETECTIONS + f""",
seen AS (
  SELECT violation_id FROM {_as_of(PREV_POLL)} s
  WHERE violation_date = {DAY}
    AND violation_type IN ('BEATING_RED_LIGHT', 'SPEEDING', 'ILLEGAL_PARKING')
),
fetched AS (
  SELECT * FROM {_as_of(NOW)} f
  WHERE violation_date = {DAY}
    AND violation_type IN ('BEATING_RED_LIGHT', 'SPEEDING', 'ILLEGAL_PARKING')
    AND violation_time >= {NOW} - INTERVAL 30 MINUTE
),
fresh AS (SELECT * FROM fetched WHERE violation_id NOT IN (SELECT violation_id FROM seen))
""" + api("fresh")

SQL["snapshot_cycle"] = SQL["new_violations"].split("fresh AS (")[0] + f"""
held AS (
  SELECT s.*, FALSE AS is_news FROM {_as_of(PREV_POLL)} s
  WHERE violation_date = {DAY} AND violation_id NOT IN (SELECT violation_id FROM fetched)
  UNION ALL
  SELECT f.*, violation_id NOT IN (SELECT violation_id FROM seen) AS is_news FROM fetched f
)
""" + api("held").replace("AS detected", "AS detected, is_news")

#: The polls of each client: moment, whether the whole day is read.
POLLS = {
    "early": (("2023-12-31 23:59:00", True), ("2024-01-01 08:30:00", True), ("2024-01-01 08:33:00", False),
              ("2024-01-01 09:50:00", True)),
    "late": (("2024-01-01 09:00:00", True), ("2024-01-01 09:04:00", False), ("2024-01-01 09:04:30", False),
             ("2024-01-01 09:06:00", True)),
}


def _durable_poll() -> str:
    """Every poll's fetch; news are ids no earlier fetch of the client and day had, but
    not at a client's first poll; held is each id's newest copy of the last day."""
    fetches, news, held = [], [], []
    for client, polls in POLLS.items():
        last_day = polls[-1][0][:10]
        for n, (at, full) in enumerate(polls):
            name, moment = f"{client}_{n}", f"TIMESTAMP '{at}'"
            recent = "" if full else f" AND violation_time >= {moment} - INTERVAL 30 MINUTE"
            fetches.append(f"""{name} AS (SELECT * FROM {_as_of(moment)} p
  WHERE violation_date = DATE '{at[:10]}'
    AND violation_type IN ('BEATING_RED_LIGHT', 'SPEEDING', 'ILLEGAL_PARKING'){recent})""")
            earlier = [f"SELECT violation_id FROM {client}_{k}" for k in range(n) if polls[k][0][:10] == at[:10]]
            unseen = f" WHERE violation_id NOT IN ({' UNION ALL '.join(earlier)})" if earlier else ""
            if n:
                news.append(f"SELECT *, '{client}' AS client, {n} AS poll, {str(full).upper()} AS is_full, 'news' AS part "
                            f"FROM {name}{unseen}")
        copies = " UNION ALL ".join(f"SELECT *, {n} AS n FROM {client}_{n}" for n, (at, _) in enumerate(polls)
                                    if at[:10] == last_day)
        held.append(f"SELECT * EXCLUDE (n), '{client}' AS client, {len(polls) - 1} AS poll, CAST(NULL AS BOOLEAN) AS is_full, "
                    f"'held' AS part FROM ({copies}) QUALIFY row_number() OVER (PARTITION BY violation_id ORDER BY n DESC) = 1")
    rows = "\nUNION ALL\n".join(news + held)
    return (BASE + "," + DETECTIONS + ",\n" + ",\n".join(fetches) + f",\nanswers AS ({rows})\n"
            + api("answers").replace("AS detected", "AS detected, client, poll, is_full, part"))


SQL["durable_poll"] = _durable_poll()

SQL["day_stats"] = with_day(f""",
per_cam AS (
  SELECT camera_id, count(*) AS n,
         count(*) FILTER (WHERE detected_at >= {NOW} - INTERVAL 5 MINUTE) AS recent,
         sum(recorded_speed_kph) AS s, count(recorded_speed_kph) AS c,
         arg_max(location_name, {{'t': violation_time, 'i': violation_id}}) AS location_name
  FROM recs GROUP BY camera_id
)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total,
       round(coalesce(sum(recent), 0) / CAST(5 AS DOUBLE), 1) AS per_minute,
       coalesce(round(sum(s) / sum(c) + 1e-9, 2), CAST(0 AS DOUBLE)) AS avg_speed,
       arg_min(location_name, {{'m': -n, 'k': camera_id}}) AS busiest
FROM per_cam""")

SQL["counts_by_camera"] = with_day("SELECT camera_id, count(*) AS n FROM recs GROUP BY camera_id")
SQL["counts_by_type"] = with_day(
    "SELECT violation_type, count(*) AS n FROM recs GROUP BY violation_type")
SQL["counts_by_location"] = with_day(
    "SELECT location_name, count(*) AS n FROM recs GROUP BY location_name")
SQL["top_plate"] = with_day(
    "SELECT plate_number, count(*) AS n FROM recs GROUP BY plate_number "
    "ORDER BY n DESC, plate_number ASC LIMIT 1")

SQL["day_summary"] = with_day(f""",
per_plate AS (
  SELECT plate_number, count(*) AS n, min(violation_time) AS f, max(violation_time) AS l,
         sum(recorded_speed_kph) AS s, count(recorded_speed_kph) AS c
  FROM recs GROUP BY plate_number
)
SELECT '2024-01-01' AS date, {iso('min(f)')} AS first, {iso('max(l)')} AS last,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS total,
       coalesce(round(sum(s) / sum(c) + 1e-9, 2), CAST(0 AS DOUBLE)) AS avg_speed,
       arg_min(plate_number, {{'m': -n, 'k': plate_number}}) AS top_plate,
       max(n) AS top_plate_count
FROM per_plate""")

SQL["latest_detection_age"] = with_day(f"""
SELECT CASE WHEN max(detected_at) IS NOT NULL THEN
         greatest(CAST(0 AS DOUBLE),
                  (epoch_us({NOW}) - epoch_us(max(detected_at))) / CAST(1000000 AS DOUBLE))
       END AS age_seconds
FROM recs""")

_RATE = """CASE WHEN lag(poll) OVER w IS NULL OR poll <= lag(poll) OVER w THEN CAST(0 AS DOUBLE)
  ELSE greatest(CAST(0 AS DOUBLE),
       (total - lag(total) OVER w) / ((poll - lag(poll) OVER w) / CAST(1000000 AS DOUBLE))) END"""

OFFSETS = f"""
valid_msgs AS (SELECT * FROM readings WHERE speed_kph >= 0 AND NOT isnan(speed_kph)),
counts AS (SELECT us - us % 300000000 + 300000000 AS poll, count(*) AS n FROM valid_msgs GROUP BY poll),
totals AS (SELECT poll, CAST(sum(n) OVER (ORDER BY poll) AS BIGINT) AS total FROM counts),
rates AS (SELECT poll, total, {_RATE} AS events_per_sec FROM totals WINDOW w AS (ORDER BY poll))"""

SQL["offset_rate"] = BASE + "," + OFFSETS + f"""
SELECT {ts('poll')} AS poll_time, total, {mean('events_per_sec')} AS events_per_sec FROM rates"""

SQL["camera_listing"] = BASE + """
SELECT camera_id AS id, location_name AS location, road_name AS road, camera_type AS type,
       speed_limit_kph AS "limit", latitude AS lat, longitude AS lon
FROM cams"""

SQL["csv_registry"] = SQL["camera_listing"]

# --- ingestion -----------------------------------------------------------------------


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


VALID = "valid AS (SELECT * FROM readings WHERE speed_kph >= 0 AND NOT isnan(speed_kph))"

RAW_EXPORT = f"""
raw AS (
  SELECT CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN '' ELSE event_id END AS id,
         ' ' || camera_id || ' ' AS cam,
         '  ' || lower(plate_number) || chr(9) AS plate,
         coalesce(' ' || vehicle_type, '   ') AS kind,
         printf('%.4f', latitude) AS lat, printf('%.4f', longitude) AS lon,
         printf('%.4f', speed_kph) AS kph,
         coalesce(lower(traffic_light_state), '') AS light,
         CASE WHEN stop_line_crossed IS NULL THEN ''
              WHEN stop_line_crossed THEN ['TRUE', '1', 'Yes', 'y', 't'][CAST(event_id AS BIGINT) % 5 + 1]
              ELSE ['no', '0', 'false', 'N', 'f'][CAST(event_id AS BIGINT) % 5 + 1] END AS crossed,
         CASE CAST(event_id AS BIGINT) % 3
           WHEN 0 THEN strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
           WHEN 1 THEN strftime(make_timestamp(us + {LOCAL}), '%Y-%m-%dT%H:%M:%S.%f') || '+08:00'
           ELSE strftime(make_timestamp(us + {LOCAL}), '%Y-%m-%d %H:%M:%S.%f') END AS ts
  FROM readings
)"""

_FIELDS = ("id", "cam", "plate", "kind", "lat", "lon", "kph", "light", "crossed", "ts")

SQL["normalize_csv_rows"] = BASE + "," + RAW_EXPORT + f""",
norm AS (
  SELECT coalesce(nullif({strip('id')}, ''),
                  sha256(concat_ws(chr(1), {', '.join(f"coalesce({c}, '')" for c in _FIELDS)})))
           AS event_id,
         {strip('cam')} AS camera_id,
         upper({strip('plate')}) AS plate_number,
         nullif({strip('kind')}, '') AS vehicle_type,
         CAST({strip('lat')} AS DOUBLE) AS latitude,
         CAST({strip('lon')} AS DOUBLE) AS longitude,
         CAST({strip('kph')} AS DOUBLE) AS speed_kph,
         upper(nullif({strip('light')}, '')) AS traffic_light_state,
         CASE WHEN nullif({strip('crossed')}, '') IS NULL THEN NULL
              ELSE lower({strip('crossed')}) IN ('true', '1', 'yes', 'y', 't') END AS stop_line_crossed,
         CASE WHEN ts LIKE '%Z' OR ts LIKE '%+08:00' THEN epoch_us(CAST(ts AS TIMESTAMPTZ))
              ELSE epoch_us(CAST(ts AS TIMESTAMP)) - {LOCAL} END AS us
  FROM raw
)
SELECT {READING_COLS}, {ts('us')} AS event_time FROM norm"""

SQL["dedupe_events"] = BASE + "," + VALID + f""",
both_files AS (
  SELECT event_id, camera_id, plate_number, vehicle_type, latitude, longitude, speed_kph,
         traffic_light_state, stop_line_crossed, us,
         'part-' || CAST(CAST(event_id AS BIGINT) % 2 AS VARCHAR) AS _file,
         CAST(event_id AS BIGINT) AS _pos
  FROM valid
  UNION ALL
  SELECT event_id, camera_id, plate_number, 'DUPLICATE', latitude, longitude,
         speed_kph + CAST(1 AS DOUBLE), traffic_light_state, stop_line_crossed, us,
         'part-' || CAST((CAST(event_id AS BIGINT) + 1) % 2 AS VARCHAR), CAST(event_id AS BIGINT)
  FROM valid
)
SELECT {READING_COLS}, {ts('us')} AS event_time FROM both_files
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _file, _pos) = 1"""

SQL["csv_events"] = SQL["normalize_csv_rows"]

# The rows do not show how their file was written.
SQL["csv_quoted_breaks"] = SQL["csv_events"]

SQL["decode_json"] = BASE + "," + VALID + f"""
SELECT {READING_COLS}, {ts('us - us % 1000')} AS event_time FROM valid"""


def java_double(x: str) -> str:
    """JSON text of a non-negative DOUBLE as the JVM writes it: plain decimal in
    [1e-3, 1e7), otherwise d.dddE-n."""
    s = f"CAST({x} AS VARCHAR)"
    frac = f"substr({s}, 3)"
    digits = f"ltrim({frac}, '0')"
    exp_a = f"-(length({frac}) - length({digits}) + 1)"
    form_a = (f"substr({digits}, 1, 1) || '.' || CASE WHEN length({digits}) > 1 "
              f"THEN substr({digits}, 2) ELSE '0' END || 'E' || CAST({exp_a} AS VARCHAR)")
    mant = f"split_part({s}, 'e', 1)"
    form_b = (f"CASE WHEN {mant} LIKE '%.%' THEN {mant} ELSE {mant} || '.0' END || 'E' || "
              f"CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")
    return (f"CASE WHEN {x} IS NULL THEN 'null' WHEN {x} = 0 OR ({x} >= 0.001 AND {x} < 10000000) "
            f"THEN {s} WHEN {s} LIKE '0.%' THEN {form_a} ELSE {form_b} END")


def _json_text(col: str) -> str:
    return f"coalesce(to_json({col}), 'null')"


SQL["encode_messages"] = BASE + "," + VALID + f"""
SELECT plate_number AS key,
       '{{"event_id":' || {_json_text('event_id')}
       || ',"camera_id":' || {_json_text('camera_id')}
       || ',"plate_number":' || {_json_text('plate_number')}
       || ',"vehicle_type":' || {_json_text('vehicle_type')}
       || ',"latitude":' || {java_double('latitude')}
       || ',"longitude":' || {java_double('longitude')}
       || ',"speed_kph":' || {java_double('speed_kph')}
       || ',"traffic_light_state":' || {_json_text('traffic_light_state')}
       || ',"stop_line_crossed":' || {_json_text('stop_line_crossed')}
       || ',"event_time":"' || {iso(ts('us'))} || '"}}' AS value
FROM valid"""

# 2026-09-01 07:00:00 +08:00 in epoch microseconds.
REBASE_START_US = 1_788_217_200_000_000

SQL["rebase_time"] = BASE + "," + VALID + f"""
SELECT {READING_COLS}, {ts(f'us + ({REBASE_START_US} - min(us) OVER ())')} AS event_time
FROM valid"""

SQL["replay_passes"] = BASE + "," + VALID + f""",
bounds AS (SELECT min(us) AS lo, max(us) AS hi FROM valid)
SELECT {READING_COLS}, CAST(p.replay_pass AS INTEGER) AS replay_pass,
       {ts('us + p.replay_pass * (hi - lo + 10000000)')} AS event_time
FROM valid CROSS JOIN bounds CROSS JOIN range(2) p(replay_pass)"""

SQL["normalize_plate"] = BASE + """,
messy AS (
  SELECT event_id,
         ' ' || chr(9) || replace(lower(plate_number), ' ', '  ' || chr(9) || ' ') || '  '
           AS plate_raw
  FROM readings
)
SELECT event_id, plate_raw, trim(regexp_replace(upper(plate_raw), '\\s+', ' ', 'g')) AS plate
FROM messy"""

SQL["iso_times"] = with_detections(f"""
SELECT violation_id, {iso('violation_time')} AS violation_time_iso,
       {iso('detected_at')} AS detected_at_iso
FROM violations""")

# --- quality -------------------------------------------------------------------------

LABELLED = """
labelled AS (
  SELECT e.*,
         CASE WHEN camera_type = 'SPEED' AND speed_kph > speed_limit_kph THEN 'SPEEDING'
              WHEN camera_type = 'INTERSECTION' AND traffic_light_state = 'RED'
                   AND coalesce(stop_line_crossed, false) THEN 'RED_LIGHT'
              WHEN camera_type = 'NO_PARKING' AND speed_kph <= 3.0 THEN 'ILLEGAL_PARKING'
              ELSE 'NORMAL' END AS simulated_scenario
  FROM enriched e
)"""

SQL["registry_checks"] = BASE + """,
per_id AS (
  SELECT camera_id, count(*) AS n,
         count(*) FILTER (WHERE camera_type IS NULL
                          OR camera_type NOT IN ('SPEED', 'INTERSECTION', 'NO_PARKING')) AS bad_type,
         count(*) FILTER (WHERE latitude IS NULL OR latitude <= 14.3 OR latitude >= 14.8) AS bad_lat,
         count(*) FILTER (WHERE longitude IS NULL OR longitude <= 120.9 OR longitude >= 121.2)
           AS bad_lon
  FROM cams GROUP BY camera_id
),
rules AS (
  SELECT 'unique_camera_id' AS rule, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS failed
  FROM per_id
  UNION ALL SELECT 'known_camera_type', CAST(coalesce(sum(bad_type), 0) AS BIGINT) FROM per_id
  UNION ALL SELECT 'all_camera_types_present',
         CAST(3 - (SELECT count(DISTINCT camera_type) FROM cams
                   WHERE camera_type IN ('SPEED', 'INTERSECTION', 'NO_PARKING')) AS BIGINT)
  UNION ALL SELECT 'latitude_in_bounds', CAST(coalesce(sum(bad_lat), 0) AS BIGINT) FROM per_id
  UNION ALL SELECT 'longitude_in_bounds', CAST(coalesce(sum(bad_lon), 0) AS BIGINT) FROM per_id
)
SELECT rule, failed, failed = 0 AS passed FROM rules"""

SQL["planted_rule_checks"] = BASE + "," + LABELLED + """
SELECT event_id, plate_number, camera_id, simulated_scenario, speed_kph, traffic_light_state,
       stop_line_crossed
FROM labelled
WHERE (simulated_scenario = 'RED_LIGHT'
       AND NOT coalesce(traffic_light_state = 'RED' AND coalesce(stop_line_crossed, false)
                        AND speed_kph >= 5.0, false))
   OR (simulated_scenario = 'ILLEGAL_PARKING'
       AND NOT coalesce(camera_type = 'NO_PARKING' AND speed_kph <= 3.0, false))"""

SQL["scenario_counts"] = BASE + "," + LABELLED + """
SELECT simulated_scenario, count(DISTINCT {'p': plate_number, 'c': camera_id}) AS vehicles,
       count(*) AS events
FROM labelled GROUP BY simulated_scenario"""

SQL["detection_quality"] = BASE + "," + DETECTIONS + "," + LABELLED + f""",
planted AS (
  SELECT DISTINCT plate_number, camera_id,
         CASE simulated_scenario WHEN 'SPEEDING' THEN 'SPEEDING'
              WHEN 'RED_LIGHT' THEN 'BEATING_RED_LIGHT' ELSE 'ILLEGAL_PARKING' END AS violation_type,
         true AS _p
  FROM labelled WHERE simulated_scenario IN ('SPEEDING', 'RED_LIGHT', 'ILLEGAL_PARKING')
),
found AS (SELECT DISTINCT plate_number, camera_id, violation_type, true AS _f FROM violations),
joined AS (
  SELECT coalesce(p.violation_type, f.violation_type) AS violation_type,
         coalesce(p._p, false) AS pl, coalesce(f._f, false) AS fd
  FROM planted p FULL OUTER JOIN found f
    ON p.plate_number = f.plate_number AND p.camera_id = f.camera_id
   AND p.violation_type = f.violation_type
),
counts AS (
  SELECT violation_type, count(*) FILTER (WHERE pl AND fd) AS tp,
         count(*) FILTER (WHERE NOT pl AND fd) AS fp, count(*) FILTER (WHERE pl AND NOT fd) AS fn
  FROM joined GROUP BY violation_type
)
SELECT violation_type, tp, fp, fn,
       {mean('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END')} AS precision,
       {mean('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END')} AS recall
FROM counts"""

SQL["health_counters"] = with_day("," + OFFSETS + f""",
last_poll AS (SELECT * FROM rates ORDER BY poll DESC LIMIT 1)
SELECT 'topic_total' AS metric, {mean('CAST(total AS DOUBLE)')} AS value FROM last_poll
UNION ALL SELECT 'events_per_sec', {mean('events_per_sec')} FROM last_poll
UNION ALL SELECT 'latest_violation_age',
  {mean(f"CASE WHEN max(detected_at) IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), (epoch_us({NOW}) - epoch_us(max(detected_at))) / CAST(1000000 AS DOUBLE)) END")}
  FROM recs
UNION ALL SELECT 'violations_today', {mean(f"CAST(count(*) FILTER (WHERE violation_date = {DAY}) AS DOUBLE)")}
  FROM recs""")

SQL["speeding_windows"] = with_detections(f"""
SELECT {ts('ws')} AS window_start, {ts('ws + 60000000')} AS window_end,
       plate_number, camera_id, location_name, road_name, speed_limit_kph,
       {mean('avg_speed')} AS avg_speed_kph, max_speed AS max_speed_kph, readings,
       {ts('first_us')} AS first_seen, {ts('last_us')} AS last_seen,
       {mean('latitude')} AS latitude, {mean('longitude')} AS longitude, vehicle_type
FROM swagg""")

SQL["snapshot_news"] = SQL["new_violations"]

SQL["first_events"] = BASE + "," + VALID + f"""
SELECT {READING_COLS}, {ts('us')} AS event_time FROM valid
ORDER BY us, event_id LIMIT 1000"""
