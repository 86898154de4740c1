"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement is self-contained: the derived views are CTEs over the
driver's raw tables (``events``, ``nation``), written with the same integer
and double arithmetic as ``sources.fixtures``.  Sliding windows are the
shifted-bucket expansion of Spark's ``window(t, size, slide)``: an event at t
belongs to the windows starting at bucket(t) - k * slide, k < size / slide.
"""

from __future__ import annotations

from citystream.operators.advisories import ADVISORY_TYPE
from citystream.operators.incidents import AQI_MESSAGE, GRIDLOCK_MESSAGE

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"

VIEWS = {
    "meter_readings": """
  SELECT 'MTR_' || CAST(1000 + user_id AS VARCHAR) AS meter_id,
         'W' || CAST(user_id % 5 + 1 AS VARCHAR) AS ward_id,
         value AS kwh_reading,
         210e0 + CAST(event_id % 300 AS DOUBLE) / 1e1 AS voltage,
         85e-2 + CAST(event_id % 15 AS DOUBLE) / 1e2 AS power_factor,
         ts AS event_time, event_id
  FROM events""",
    "air_quality": """
  SELECT 'AQI_SENS_' || CAST(100 + user_id % 51 AS VARCHAR) AS sensor_id,
         'ZONE_' || CAST(CASE WHEN user_id % 10 < 9 THEN user_id % 10 + 1 ELSE 26 END
                         AS VARCHAR) AS zone,
         CASE WHEN event_id % 20 = 0 THEN NULL
              ELSE CAST(floor(value * 3e0) AS INTEGER) END AS aqi,
         ts AS event_time, event_id
  FROM events""",
    "bus_gps": """
  SELECT 'BUS_' || CAST(1000 + (user_id % 40) AS VARCHAR) AS bus_id,
         'ROUTE_' || CAST(CASE WHEN user_id % 5 < 4 THEN user_id % 5 + 1 ELSE 26 END * 101
                          AS VARCHAR) AS route_id,
         CASE WHEN event_id % 97 = 0 THEN 0e0
              ELSE 19e0 + CAST((event_id * 37) % 120 AS DOUBLE) / 1e4 END AS lat,
         CASE WHEN event_id % 89 = 0 THEN NULL
              ELSE 7287e-2 + CAST((event_id * 53) % 127 AS DOUBLE) / 1e4 END AS lon,
         ts AS event_time, event_id
  FROM events""",
    "traffic_signals": """
  SELECT 'J_' || CAST(user_id % 20 + 1 AS VARCHAR) AS junction_id,
         'ZONE_' || CAST(user_id % 10 + 1 AS VARCHAR) AS zone,
         value * 4e0 AS avg_wait_sec,
         ts AS event_time, event_id
  FROM events""",
    "zone_profile": """
  SELECT 'ZONE_' || CAST(n_nationkey + 1 AS VARCHAR) AS zone, n_name AS zone_name,
         100000 + n_nationkey * 17000 AS population,
         4 + (n_nationkey * 7) % 47 AS num_schools
  FROM nation""",
    "route_schedule": """
  SELECT 'ROUTE_' || CAST((n_nationkey + 1) * 101 AS VARCHAR) AS route_id,
         n_name AS route_name,
         'Terminal ' || CAST(n_regionkey AS VARCHAR) AS terminal,
         '18:' || CAST(10 + n_nationkey * 5 AS VARCHAR) || ':00' AS scheduled_arrival_time
  FROM nation""",
}


def with_views(body: str, *names: str, extra: str = "") -> str:
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _bucket(width: str, col: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width}', {col}, {EPOCH})"


def _rolling(size_min: int, slide_min: int) -> str:
    n = size_min // slide_min
    return f"""
rolling_src AS (
  SELECT zone, aqi,
         {_bucket(f'{slide_min} minutes')} - to_minutes(CAST(k * {slide_min} AS BIGINT)) AS ws
  FROM (SELECT *, unnest(range({n})) AS k FROM air_quality WHERE aqi IS NOT NULL)),
rolling AS (
  SELECT ws, ws + INTERVAL '{size_min} minutes' AS we, zone, avg(aqi) AS mean
  FROM rolling_src GROUP BY ws, zone)"""


def _advisory_select(threshold: float = 150.0) -> str:
    return f"""
SELECT CAST(r.ws AS VARCHAR) AS window_start, CAST(r.we AS VARCHAR) AS window_end,
       r.zone, z.zone_name, z.population, z.num_schools,
       round(r.mean, 2) AS rolling_avg_aqi, '{ADVISORY_TYPE}' AS advisory_type
FROM rolling r JOIN zone_profile z ON r.zone = z.zone
WHERE r.mean > {threshold}"""


_VALIDATED = """
validated AS (
  SELECT 'air_quality' AS original_topic, sensor_id AS entity_id, event_id,
         event_time,
         CASE WHEN aqi IS NULL THEN 'NULL_AQI_VALUE'
              WHEN NOT (CAST(aqi AS DOUBLE) BETWEEN 0 AND 500) THEN 'OUT_OF_RANGE_AQI'
         END AS error_reason
  FROM air_quality
  UNION ALL
  SELECT 'bus_gps', bus_id, event_id, event_time,
         CASE WHEN NOT (coalesce(lat, 0e0) BETWEEN 18.5 AND 19.5
                        AND coalesce(lon, 0e0) BETWEEN 72.5 AND 73.5)
              THEN 'IMPOSSIBLE_GPS_COORDINATES' END
  FROM bus_gps)"""


def _q_ward_energy() -> str:
    return with_views(f"""
SELECT CAST(ws AS VARCHAR) AS window_start,
       CAST(ws + INTERVAL '15 minutes' AS VARCHAR) AS window_end,
       ward_id, strftime(ws, '%Y-%m-%d') AS date,
       round(sum(kwh_reading), 6) AS total_kwh_consumed,
       round(avg(power_factor), 6) AS avg_power_factor,
       round(max(voltage), 6) AS peak_voltage
FROM (SELECT *, {_bucket('15 minutes')} AS ws FROM meter_readings)
GROUP BY ws, ward_id""", "meter_readings")


def _q_advisories(size: int, slide: int) -> str:
    return with_views(_advisory_select(), "air_quality", "zone_profile",
                      extra=_rolling(size, slide).strip())


def _q_aqi_emergency() -> str:
    return with_views(f"""
SELECT 'AQI_EMERGENCY' AS incident_type, 'CRITICAL' AS severity, sensor_id, zone, aqi,
       '{AQI_MESSAGE}' AS message, event_id, (epoch_us(event_time) // 1000) AS event_ms
FROM air_quality WHERE aqi IS NOT NULL AND aqi > 300""", "air_quality")


def _q_dead_letters() -> str:
    return with_views("""
SELECT original_topic, error_reason, entity_id,
       CASE WHEN original_topic = 'air_quality' THEN CAST(a.aqi AS VARCHAR) END AS aqi,
       CASE WHEN original_topic = 'air_quality' THEN 'aqi,sensor_id,zone'
            ELSE 'bus_id,lat,lon,route_id' END AS payload_fields,
       v.event_id, (epoch_us(v.event_time) // 1000) AS failed_at
FROM validated v JOIN air_quality a ON a.event_id = v.event_id
WHERE error_reason IS NOT NULL""", "air_quality", "bus_gps", extra=_VALIDATED.strip())


def _q_topic_dead_letters() -> str:
    return with_views("""
SELECT original_topic, error_reason,
       CASE WHEN original_topic = 'air_quality' AND error_reason <> 'UNPARSEABLE_JSON'
            THEN aqi END AS aqi,
       original_topic = 'air_quality' AND error_reason <> 'UNPARSEABLE_JSON' AS has_aqi,
       CASE WHEN error_reason = 'UNPARSEABLE_JSON' THEN v END AS raw,
       CASE WHEN error_reason <> 'UNPARSEABLE_JSON' THEN event_id END AS event_id
FROM judged WHERE error_reason IS NOT NULL""", "air_quality", "bus_gps", extra="""
texts AS (
  SELECT 'air_quality' AS original_topic, event_id, NULL AS lat, NULL AS lon,
         CASE WHEN event_id % 30 = 1 THEN 'x' ELSE CAST(aqi AS VARCHAR) END AS aqi,
         '{"sensor_id":"' || sensor_id || '","zone":"' || zone || '","aqi":'
         || CASE WHEN event_id % 30 = 1 THEN '"x"' WHEN aqi IS NULL THEN 'null'
                 ELSE '"' || CAST(aqi AS VARCHAR) || '"' END
         || ',"event_id":' || CAST(event_id AS VARCHAR) || '}' AS j
  FROM air_quality
  UNION ALL
  SELECT 'bus_gps', event_id, coalesce(lat, 0e0), coalesce(lon, 0e0), NULL,
         '{"bus_id":"' || bus_id || '","route_id":"' || route_id || '","lat":'
         || CAST(lat AS VARCHAR) || ',"lon":' || coalesce(CAST(lon AS VARCHAR), 'null')
         || ',"event_id":' || CAST(event_id AS VARCHAR) || '}'
  FROM bus_gps),
judged AS (
  SELECT *, CASE WHEN event_id % 50 = 7 THEN left(j, length(j) - 5)
                 WHEN event_id % 70 = 9 THEN '1' || CAST(event_id AS VARCHAR) ELSE j END AS v,
         CASE WHEN event_id % 50 = 7 OR event_id % 70 = 9 THEN 'UNPARSEABLE_JSON'
              WHEN original_topic = 'air_quality' AND aqi IS NULL THEN 'NULL_AQI_VALUE'
              WHEN original_topic = 'air_quality'
                   AND NOT coalesce(TRY_CAST(aqi AS DOUBLE) BETWEEN 0 AND 500, false)
                THEN 'OUT_OF_RANGE_AQI'
              WHEN original_topic = 'bus_gps' AND NOT (lat BETWEEN 18.5 AND 19.5
                                                       AND lon BETWEEN 72.5 AND 73.5)
                THEN 'IMPOSSIBLE_GPS_COORDINATES' END AS error_reason
  FROM texts)""".strip())


def _q_incident_messages() -> str:
    return f"""
SELECT sensor_id AS key, incident_type, severity, message, CAST(NULL AS VARCHAR) AS bus_1,
       CAST(aqi AS DOUBLE) AS measure, 4 AS n_fields, event_ms AS timestamp
FROM ({_q_aqi_emergency()})
UNION ALL
SELECT junction_id, incident_type, severity, message, NULL, round(wait_1, 6), 4, event_ms
FROM ({_q_gridlock()})
UNION ALL
SELECT route_id, incident_type, severity, NULL, bus_1, round(distance_meters, 6), 5, event_ms
FROM ({_q_bunching()})"""


def _q_valid_events() -> str:
    return with_views("""
SELECT original_topic, entity_id, event_id FROM validated WHERE error_reason IS NULL""",
                      "air_quality", "bus_gps", extra=_VALIDATED.strip())


def _q_error_counts() -> str:
    return with_views("""
SELECT coalesce(reason, 'TOTAL_SCANNED') AS error_reason, count(*) AS records
FROM (SELECT coalesce(error_reason, 'NONE') AS reason FROM validated)
GROUP BY ROLLUP (reason)""", "air_quality", "bus_gps", extra=_VALIDATED.strip())


def _q_route_enrichment() -> str:
    return with_views("""
SELECT g.bus_id, g.route_id, g.lat, g.lon, g.event_id,
       r.route_name, r.terminal, r.scheduled_arrival_time
FROM bus_gps g LEFT JOIN route_schedule r ON g.route_id = r.route_id""",
                      "bus_gps", "route_schedule")


def _advisories_cte() -> str:
    return (_rolling(10, 1).strip() + ",\nadvisories AS (" + _advisory_select() + ")")


def _q_advisory_summary() -> str:
    return with_views("""
SELECT zone, zone_name, count(rolling_avg_aqi) AS total_advisories,
       round(avg(rolling_avg_aqi), 2) AS mean_aqi, max(rolling_avg_aqi) AS max_aqi
FROM advisories WHERE zone IS NOT NULL AND zone_name IS NOT NULL
GROUP BY zone, zone_name ORDER BY zone, zone_name""",
                      "air_quality", "zone_profile", extra=_advisories_cte())


def _q_advisory_totals() -> str:
    return with_views("""
SELECT count(*) AS total_advisories, count(DISTINCT zone) AS unique_zones
FROM advisories""", "air_quality", "zone_profile", extra=_advisories_cte())


def _q_advisory_preview() -> str:
    return with_views("""
SELECT window_start, window_end, zone, zone_name, rolling_avg_aqi
FROM advisories ORDER BY window_start, zone LIMIT 5""",
                      "air_quality", "zone_profile", extra=_advisories_cte())


def _q_json_roundtrip() -> str:
    return with_views("""
SELECT ward_id AS key, meter_id, ward_id, kwh_reading, voltage, power_factor, event_id,
       (epoch_us(event_time) // 1000) AS event_ms
FROM meter_readings""", "meter_readings")


def _q_gridlock() -> str:
    return with_views(f"""
SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, 'HIGH' AS severity, junction_id, zone,
       w3 AS wait_1, w2 AS wait_2, w AS wait_3, '{GRIDLOCK_MESSAGE}' AS message,
       event_id, (epoch_us(event_time) // 1000) AS event_ms
FROM (
  SELECT *, r - coalesce(max(CASE WHEN NOT high THEN r END)
                           OVER (PARTITION BY junction_id ORDER BY r
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS pos,
         lag(w, 1) OVER (PARTITION BY junction_id ORDER BY r) AS w2,
         lag(w, 2) OVER (PARTITION BY junction_id ORDER BY r) AS w3
  FROM (SELECT *, coalesce(avg_wait_sec, 0e0) AS w,
               coalesce(avg_wait_sec, 0e0) > 180 AS high,
               row_number() OVER (PARTITION BY junction_id
                                  ORDER BY event_time, event_id) AS r
        FROM traffic_signals))
WHERE high AND pos % 3 = 0""", "traffic_signals")


def _q_bunching(silent: bool = False, forget_s: int | None = None) -> str:
    """``forget_s``: a bus not seen for longer is forgotten at the next tick of its
    route and begins another life when it comes back."""
    if forget_s is None:
        ends, gone = "", "false"
    else:
        ends = f"""
ends AS (
  SELECT a.route_id, a.n, z.n AS e FROM g a ASOF JOIN (
    SELECT route_id, t, min(n) AS n FROM g GROUP BY route_id, t) z
  ON a.route_id = z.route_id AND a.t + INTERVAL '{forget_s} seconds' < z.t),"""
        gone = f"t > lag(t) OVER w + INTERVAL '{forget_s} seconds'"
    body = """
SELECT 'BUS_BUNCHING' AS incident_type, 'MEDIUM' AS severity, f.route_id,
       CASE WHEN fa.fn < fb.fn THEN f.b1 ELSE f.b2 END AS bus_1,
       CASE WHEN fa.fn < fb.fn THEN f.b2 ELSE f.b1 END AS bus_2,
       round(p.d, 2) AS distance_meters,
       (epoch_us(ga.t) - epoch_us(gp.t)) // 1000000 AS duration_seconds,
       ga.e AS event_id, epoch_us(ga.t) // 1000 AS event_ms
FROM fold f
JOIN g ga ON ga.route_id = f.route_id AND ga.n = f.n
JOIN g gp ON gp.route_id = f.route_id AND gp.n = f.prev
JOIN near p ON p.route_id = f.route_id AND p.b1 = f.b1 AND p.b2 = f.b2
           AND p.s <= f.n AND f.n < p.f
JOIN first_seen fa ON fa.route_id = f.route_id AND fa.bus_id = f.b1 AND fa.life = p.l1
JOIN first_seen fb ON fb.route_id = f.route_id AND fb.bus_id = f.b2 AND fb.life = p.l2"""
    extra = """
valid AS (
  SELECT route_id, bus_id, lat, lon, event_time, event_id
  FROM bus_gps WHERE lat BETWEEN 18.5 AND 19.5 AND lon BETWEEN 72.5 AND 73.5),
silent AS (
  SELECT route_id, 'BUS_SILENT' AS bus_id, lat, lon, event_time, -event_id - 1 AS event_id
  FROM valid QUALIFY row_number() OVER (PARTITION BY route_id
                                        ORDER BY event_time, event_id) = 1),
g AS (
  SELECT route_id, bus_id, lat, lon, event_time AS t, event_id AS e,
         row_number() OVER (PARTITION BY route_id ORDER BY event_time, event_id) AS n
  FROM (""" + ("SELECT * FROM valid UNION ALL SELECT * FROM silent" if silent
               else "SELECT * FROM valid") + """)),
back AS (SELECT *, CASE WHEN """ + gone + """ THEN 1 ELSE 0 END AS back
         FROM g WINDOW w AS (PARTITION BY route_id, bus_id ORDER BY n)),
lives AS (SELECT *, sum(back) OVER (PARTITION BY route_id, bus_id ORDER BY n) AS life FROM back),
first_seen AS (SELECT route_id, bus_id, life, min(n) AS fn FROM lives
               GROUP BY route_id, bus_id, life),""" + ends + """
iv AS (
  SELECT l.*, least(coalesce(lead(l.n) OVER (PARTITION BY l.route_id, bus_id ORDER BY l.n),
                             9000000000000000000)""" + (", coalesce(ends.e, 9000000000000000000)"
                                                        if ends else "") + """) AS n2
  FROM lives l""" + (" LEFT JOIN ends ON ends.route_id = l.route_id AND ends.n = l.n"
                     if ends else "") + """),
p0 AS (
  SELECT a.route_id, a.bus_id AS b1, b.bus_id AS b2, a.life AS l1, b.life AS l2,
         greatest(a.n, b.n) AS s, least(a.n2, b.n2) AS f,
         pow(sin(radians(b.lat - a.lat) / 2), 2)
         + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2) AS x
  FROM iv a JOIN iv b ON a.route_id = b.route_id AND a.bus_id < b.bus_id
                     AND a.n < b.n2 AND b.n < a.n2),
near AS (
  SELECT route_id, b1, b2, l1, l2, s, f, d FROM (
    SELECT *, 6371000e0 * 2 * atan2(sqrt(x), sqrt(1 - x)) AS d FROM p0) WHERE d <= 200),
p2 AS (
  SELECT *, CASE WHEN lag(f) OVER (PARTITION BY route_id, b1, b2, l1, l2 ORDER BY s) = s
                 THEN 0 ELSE 1 END AS h FROM near),
p3 AS (SELECT *, sum(h) OVER (PARTITION BY route_id, b1, b2 ORDER BY s) AS k FROM p2),
isl AS (SELECT route_id, b1, b2, k, min(s) AS s, max(f) AS f FROM p3
        GROUP BY route_id, b1, b2, k),
tk AS (
  SELECT i.route_id, i.b1, i.b2, i.k, i.s AS st, g.n, g.t
  FROM isl i JOIN g ON g.route_id = i.route_id AND g.n >= i.s AND g.n < i.f),
nx AS (
  SELECT a.*, (SELECT min(z.n) FROM tk z
               WHERE z.route_id = a.route_id AND z.b1 = a.b1 AND z.b2 = a.b2 AND z.k = a.k
                 AND z.n > a.n AND z.t >= a.t + INTERVAL '300 seconds') AS nn
  FROM tk a),
fold AS (
  SELECT route_id, b1, b2, k, n AS prev, nn AS n FROM nx WHERE n = st AND nn IS NOT NULL
  UNION ALL
  SELECT x.route_id, x.b1, x.b2, x.k, x.n, x.nn
  FROM fold f JOIN nx x ON x.route_id = f.route_id AND x.b1 = f.b1 AND x.b2 = f.b2
                       AND x.k = f.k AND x.n = f.n
  WHERE x.nn IS NOT NULL)"""
    return "WITH RECURSIVE " + with_views(body, "bus_gps", extra=extra.strip())[5:]


def _q_incidents() -> str:
    return f"""
SELECT incident_type, severity, sensor_id AS entity_id, zone, event_ms AS timestamp, event_id
FROM ({_q_aqi_emergency()})
UNION ALL
SELECT incident_type, severity, junction_id, zone, event_ms, event_id
FROM ({_q_gridlock()})
UNION ALL
SELECT incident_type, severity, route_id, CAST(NULL AS VARCHAR), event_ms, event_id
FROM ({_q_bunching()})"""


def _q_stream_ward_energy() -> str:
    """Append mode emits a window once the watermark (max event time - 45 min)
    has passed its end; windows still open at the end of input stay out."""
    return f"""
SELECT * FROM ({_q_ward_energy()})
WHERE CAST(window_end AS TIMESTAMP)
      <= (SELECT max(ts) FROM events) - INTERVAL '45 minutes'"""


def _q_paced_stream() -> str:
    return with_views("SELECT junction_id, zone, avg_wait_sec, event_id, 1 AS fast_copies\n"
                      "FROM traffic_signals",
                      "traffic_signals")


def _q_paced_backlog() -> str:
    """Files are (day, event_id % 4) parts in that order, four a trigger."""
    return """
WITH parts AS (SELECT DISTINCT epoch_us(ts) // 86400000000 AS day, event_id % 4 AS bucket FROM events),
taken AS (SELECT (row_number() OVER (ORDER BY day, bucket) - 1) // 4 AS trigger FROM parts),
per AS (SELECT trigger, count(*) AS files FROM taken GROUP BY trigger)
SELECT trigger, files,
       CAST(coalesce(sum(files) OVER (ORDER BY trigger ROWS BETWEEN 1 FOLLOWING
                                      AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS outstanding
FROM per"""


def _q_stored_generations() -> str:
    return with_views("""
SELECT sensor_id, zone, CAST(aqi AS BIGINT) AS aqi, event_id,
       CASE WHEN event_id % 2 = 1 THEN CAST(epoch_us(event_time) // 1000 AS BIGINT) END AS event_ms
FROM air_quality""", "air_quality")


def _q_text_timestamps() -> str:
    return with_views("""
SELECT event_id, bus_id,
       CASE WHEN event_id % 6 = 0 THEN epoch_us(event_time) // 1000
            WHEN event_id % 6 IN (1, 2, 3) THEN epoch_us(date_trunc('second', event_time)) // 1000
       END AS event_ms FROM bus_gps""", "bus_gps")


def _q_dead_letters_now() -> str:
    return with_views("""
SELECT original_topic, error_reason, event_id, true AS stamped_now
FROM validated WHERE error_reason IS NOT NULL AND original_topic = 'air_quality'""",
                      "air_quality", "bus_gps", extra=_VALIDATED.strip())


def _q_stream_scan_totals() -> str:
    return with_views("""
SELECT (SELECT count(*) FROM validated WHERE original_topic = 'air_quality') AS scanned,
       (SELECT count(error_reason) FROM validated WHERE original_topic = 'air_quality') AS failed,
       (SELECT count(DISTINCT zone) FROM air_quality) AS zones""",
                      "air_quality", "bus_gps", extra=_VALIDATED.strip())


def _q_stream_rolling_aqi() -> str:
    """Windows whose end the watermark (newest reading less 5 minutes) has passed."""
    return with_views("""
SELECT CAST(ws AS VARCHAR) AS window_start, r.zone, round(avg(r.aqi), 6) AS rolling_avg_aqi,
       count(r.aqi) AS readings
FROM rolling_src r GROUP BY ws, r.zone
HAVING ws + INTERVAL '10 minutes' <= (SELECT max(event_time) FROM air_quality WHERE aqi IS NOT NULL)
                                     - INTERVAL '5 minutes'""",
                      "air_quality", extra=_rolling(10, 1).strip())


def _q_latest_positions() -> str:
    return with_views("""
SELECT route_id, bus_id, lat, lon, event_id, epoch_us(event_time) // 1000 AS event_ms
FROM bus_gps WHERE lat BETWEEN 18.5 AND 19.5 AND lon BETWEEN 72.5 AND 73.5
QUALIFY row_number() OVER (PARTITION BY route_id, bus_id
                           ORDER BY event_time DESC, event_id DESC) = 1""", "bus_gps")


def _q_open_enrichment() -> str:
    return with_views("""
SELECT g.event_id, g.route_id, r.route_name, r.terminal, r.scheduled_arrival_time,
       CASE WHEN r.route_id IS NULL THEN 5 ELSE 8 END AS n_fields, true AS lon_key_kept
FROM bus_gps g LEFT JOIN route_schedule r ON g.route_id = r.route_id""",
                      "bus_gps", "route_schedule")


def oracle_sql() -> dict[str, str]:
    return {
        "q_ward_energy": _q_ward_energy(),
        "q_aqi_advisories": _q_advisories(10, 2),
        "q_aqi_rolling_join": _q_advisories(10, 1),
        "q_aqi_emergency": _q_aqi_emergency(),
        "q_dead_letters": _q_dead_letters(),
        "q_topic_dead_letters": _q_topic_dead_letters(),
        "q_stream_topic_dead_letters": _q_topic_dead_letters(),
        "q_incident_messages": _q_incident_messages(),
        "q_stream_advisories_sql": _q_advisories(10, 2),
        "q_stream_ward_messages": _q_ward_energy(),
        "q_valid_events": _q_valid_events(),
        "q_error_counts": _q_error_counts(),
        "q_route_enrichment": _q_route_enrichment(),
        "q_advisory_summary": _q_advisory_summary(),
        "q_advisory_totals": _q_advisory_totals(),
        "q_advisory_preview": _q_advisory_preview(),
        "q_json_roundtrip": _q_json_roundtrip(),
        "q_gridlock": _q_gridlock(),
        "q_bunching": _q_bunching(),
        "q_bunching_distributed": _q_bunching(),
        "q_bunching_silent": _q_bunching(silent=True),
        "q_incidents": _q_incidents(),
        "q_aqi_rolling_sql": _q_advisories(10, 1),
        "q_aqi_advisories_join_first": _q_advisories(10, 2),
        "q_latest_positions": _q_latest_positions(),
        "q_open_enrichment": _q_open_enrichment(),
        "q_stream_ward_energy": _q_stream_ward_energy(),
        "q_stream_advisories": _q_advisories(10, 2),
        "q_stream_gridlock": _q_gridlock(),
        "q_stream_bunching": _q_bunching(),
        "q_stream_gridlock_ordered": _q_gridlock(),
        "q_stream_bunching_ordered": _q_bunching(),
        "q_stream_bunching_state": _q_bunching(forget_s=12 * 3600),
        "q_paced_stream": _q_paced_stream(),
        "q_text_timestamps": _q_text_timestamps(),
        "q_dead_letters_now": _q_dead_letters_now(),
        "q_stream_scan_totals": _q_stream_scan_totals(),
        "q_stream_rolling_aqi": _q_stream_rolling_aqi(),
        "q_paced_backlog": _q_paced_backlog(),
        "q_stored_generations": _q_stored_generations(),
        "q_stream_late_rows": "SELECT count(*) AS input_rows, true AS some_dropped FROM events",
        "q_stream_advisory_messages": "SELECT *, rolling_avg_aqi AS table_avg FROM ("
                                      + _q_advisories(10, 2) + ")",
        "q_stream_periodic_counts": _q_error_counts(),
        "q_stream_error_counts": _q_error_counts(),
    }
