"""The adapter and the shared views as DuckDB SQL, for checking results."""

from __future__ import annotations

FIELDS = (
    "event_id, icao24, callsign, origin_country, observed_at, position_source, lat, lon, "
    "baro_altitude_m, geo_altitude_m, velocity_ms, true_track_deg, vertical_rate_ms, "
    "on_ground, squawk, spi, category"
)

BASE = f"""
WITH ev AS (SELECT event_id AS n, user_id AS u, ts, value FROM events),
last_seen AS (SELECT max(ts) AS t FROM events),
tel AS (
  SELECT n, '00000000-0000-0000-0000-' || lpad(n::VARCHAR, 12, '0') AS event_id,
    printf('%06x', u) AS icao24,
    CASE WHEN u % 10 = 0 THEN NULL WHEN u % 10 = 1 THEN 'N1'
         ELSE (['BAW','DLH','AFR','UAL','KLM'])[(u % 5 + 1)::INT] || u::VARCHAR END AS callsign,
    'NATION_' || (u % 25)::VARCHAR AS origin_country,
    ts AS observed_at,
    (['ADSB','ASTERIX','MLAT','FLARM','UNKNOWN'])[(n % 5 + 1)::INT] AS position_source,
    50::DOUBLE + (u % 4) / 2::DOUBLE + (n % 3) / 10::DOUBLE AS lat,
    (u % 8 - 4) / 2::DOUBLE + (n % 3) / 10::DOUBLE AS lon,
    CASE WHEN n % 20 = 0 OR n % 17 = 0 THEN NULL ELSE (n % 12000)::DOUBLE END AS baro_altitude_m,
    CASE WHEN n % 20 = 0 OR n % 17 = 0 THEN NULL ELSE (n % 12000 + n % 7)::DOUBLE END AS geo_altitude_m,
    CASE WHEN n % 20 = 0 OR n % 13 = 0 THEN NULL ELSE value END AS velocity_ms,
    (n % 360)::DOUBLE AS true_track_deg,
    CASE WHEN n % 11 = 0 THEN NULL ELSE (n % 31 - 15) / 2::DOUBLE END AS vertical_rate_ms,
    n % 20 = 0 AS on_ground,
    CASE n % 50 WHEN 0 THEN '7700' WHEN 1 THEN '7600' WHEN 2 THEN '7500' WHEN 3 THEN NULL ELSE '1200' END AS squawk,
    n % 100 = 0 AS spi,
    CASE WHEN n % 4 = 0 THEN NULL ELSE (n % 21)::INT END AS category,
    CASE WHEN n % 10 = 3 THEN (n + 500) * 10 + 1 ELSE n * 10 END AS seq
  FROM ev),
feed AS (
  SELECT {FIELDS}, seq FROM tel
  UNION ALL SELECT {FIELDS}, (n + 100) * 10 + 2 FROM tel WHERE n % 20 = 7
  UNION ALL SELECT * REPLACE ('00000001' || substr(event_id, 9) AS event_id, velocity_ms + 1 AS velocity_ms)
    FROM (SELECT {FIELDS}, (n + 50) * 10 + 3 AS seq FROM tel WHERE n % 30 = 11)
  UNION ALL SELECT * REPLACE (observed_at - INTERVAL 1 HOUR AS observed_at)
    FROM (SELECT {FIELDS}, (n + 200) * 10 + 4 AS seq FROM tel WHERE n % 40 = 9)),
raw AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, seq) = 1),
state AS (SELECT icao24, callsign AS last_callsign, origin_country, observed_at, lat, lon, baro_altitude_m,
  velocity_ms, on_ground, squawk AS last_squawk, event_id AS last_event_id FROM latest)
"""

# The messages below are those of the contract, as in MESSAGES of operators/validate.py and in sources/payloads.py.
# Requests: one row per event with its fault number and its place in a body.
REQUESTS = """,
req AS (
  SELECT *, n // 10 AS block, n % 200 AS fault,
    CASE n // 10 % 3 WHEN 0 THEN 's' || n WHEN 1 THEN 'w' || (n // 10) ELSE 'a' || (n // 10) END AS request_id,
    CASE n // 10 % 3 WHEN 0 THEN 0 ELSE row_number() OVER (PARTITION BY n // 10 ORDER BY n) - 1 END AS index
  FROM tel
  UNION ALL
  SELECT *, n // 10, n % 200, 'x' || n, 0 FROM tel WHERE n % 100 = 62),
told AS (
  SELECT request_id, index, n,
    CASE WHEN fault = 1 THEN '' ELSE event_id END AS event_id,
    CASE fault WHEN 2 THEN '' WHEN 3 THEN 'ABC123' ELSE icao24 END AS icao24,
    CASE WHEN fault = 4 THEN '' ELSE origin_country END AS origin_country,
    CASE WHEN fault = 10 THEN 90.5 ELSE lat END AS lat,
    CASE WHEN fault = 11 THEN -180.5 ELSE lon END AS lon,
    CASE WHEN fault = 15 THEN 21 ELSE category END AS category,
    observed_at,
    CASE WHEN fault BETWEEN 1 AND 15 THEN 'v' || fault END AS rule,
    CASE fault
      WHEN 1 THEN 'event_id is required' WHEN 2 THEN 'icao24 is required'
      WHEN 3 THEN 'icao24 must be 6 lowercase hex chars: "ABC123"'
      WHEN 4 THEN 'origin_country is required' WHEN 5 THEN 'observed_at is required'
      WHEN 6 THEN 'position_source is required'
      WHEN 7 THEN 'position_source "GPS" is not one of ADSB, ASTERIX, MLAT, FLARM, UNKNOWN'
      WHEN 8 THEN 'observed_at is not valid RFC3339'
      WHEN 9 THEN 'observed_at is too far in the future (>24h)'
      WHEN 10 THEN 'lat out of range [-90, 90]: 90.500000'
      WHEN 11 THEN 'lon out of range [-180, 180]: -180.500000'
      WHEN 12 THEN 'velocity_ms must be >= 0: -1.500000'
      WHEN 13 THEN 'true_track_deg must be in [0, 360): 360.000000'
      WHEN 14 THEN 'squawk must be 4 octal digits (0-7): "1289"'
      WHEN 15 THEN 'category out of OpenSky range [0, 20]: 21' END AS error
  FROM req)
"""

REFUSED = """,
refused AS (
  SELECT 'x' || n AS request_id, CASE n % 100
    WHEN 60 THEN 'empty body' WHEN 63 THEN 'expected JSON object or array'
    WHEN 64 THEN 'invalid JSON array' WHEN 66 THEN 'invalid JSON in events array'
    ELSE 'invalid JSON object' END AS body_error
  FROM tel WHERE n % 100 IN (60, 63, 64, 65, 66, 67))
"""

# State vectors: what each event looks like after the snapshot mapping.
VECTORS = """,
vec AS (
  SELECT n, n // 10 AS snapshot_id, row_number() OVER (PARTITION BY n // 10 ORDER BY n) - 1 AS pos,
    icao24,
    CASE WHEN n % 100 = 53 THEN NULL ELSE callsign END AS callsign,
    CASE WHEN n % 100 IN (54, 55) THEN 'Unknown' ELSE origin_country END AS origin_country,
    1704067200 + n // 10 * 60 AS poll,
    CASE WHEN n % 100 = 56 THEN 1704067200 + n // 10 * 60 ELSE epoch(date_trunc('second', observed_at))::BIGINT END AS seconds,
    n % 100 = 57 AS cut, lat, lon, baro_altitude_m,
    CASE WHEN n % 100 = 57 THEN NULL ELSE geo_altitude_m END AS geo_altitude_m,
    CASE WHEN n % 100 = 57 THEN NULL ELSE velocity_ms END AS velocity_ms,
    CASE WHEN n % 100 = 57 THEN NULL ELSE true_track_deg END AS true_track_deg,
    CASE WHEN n % 100 = 57 THEN NULL ELSE vertical_rate_ms END AS vertical_rate_ms,
    on_ground AND n % 100 <> 57 AS on_ground,
    CASE WHEN n % 100 = 57 THEN NULL ELSE squawk END AS squawk,
    spi AND n % 100 <> 57 AS spi,
    CASE WHEN n % 100 = 57 THEN 'UNKNOWN' ELSE position_source END AS position_source,
    CASE WHEN n % 100 = 57 OR n % 2 = 0 THEN NULL ELSE category END AS category
  FROM tel),
snap AS (
  SELECT *, make_timestamp(seconds * 1000000) AS observed_at,
    sha256(icao24 || '|' || (seconds * 1000000) || '|' || poll || '|' || pos) AS h
  FROM vec WHERE n % 100 <> 50)
"""
SNAP_ID = "substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12)"

RFC3339 = "regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z'"


def token(ts: str, row_id: str) -> str:
    raw = f"{RFC3339.format(ts=ts)} || '|' || {row_id}"
    return f"rtrim(translate(to_base64(encode({raw})), '+/', '-_'), '=')"


PREFIX = "coalesce(substr(callsign, 1, 3), '')"
PHASE = (
    "CASE WHEN isnan(vertical_rate_ms) THEN NULL WHEN vertical_rate_ms > 2.5 THEN 'climbing' "
    "WHEN vertical_rate_ms < -2.5 THEN 'descending' WHEN vertical_rate_ms BETWEEN -2.5 AND 2.5 THEN 'cruising' END"
)
COUNTERS = (
    "count(*) FILTER (WHERE vertical_rate_ms > 2.5) AS climbing_count, "
    "count(*) FILTER (WHERE vertical_rate_ms < -2.5) AS descending_count, "
    "count(*) FILTER (WHERE vertical_rate_ms BETWEEN -2.5 AND 2.5) AS cruising_count, "
    "count(*) FILTER (WHERE on_ground) AS on_ground_count"
)
EMERGENCY = "count(*) FILTER (WHERE squawk IN ('7500','7600','7700')) AS emergency_squawks_count"
AVG_VELOCITY = "round(avg(velocity_ms) FILTER (WHERE NOT on_ground) + 1e-9, 6) AS avg_velocity_ms"
AVG_ALTITUDE = "round(avg(baro_altitude_m) FILTER (WHERE NOT on_ground) + 1e-9, 6) AS avg_baro_altitude_m"
SUM_VELOCITY = (
    "round(coalesce(sum(velocity_ms) FILTER (WHERE NOT on_ground), 0) + 1e-9, 6) AS sum_velocity_ms, "
    "count(velocity_ms) FILTER (WHERE NOT on_ground) AS count_velocity_obs"
)
SUM_ALTITUDE = (
    "round(coalesce(sum(baro_altitude_m) FILTER (WHERE NOT on_ground), 0) + 1e-9, 6) AS sum_baro_altitude_m, "
    "count(baro_altitude_m) FILTER (WHERE NOT on_ground) AS count_alt_obs"
)


def country_hour(source: str, grain: str = "hour", by: str = "origin_country") -> str:
    return (
        f"SELECT {by}, date_trunc('{grain}', observed_at)::TIMESTAMP AS {grain}, count(DISTINCT icao24) AS active_aircraft, "
        f"{AVG_VELOCITY}, {AVG_ALTITUDE}, {COUNTERS}, {EMERGENCY} FROM {source} GROUP BY 1, 2"
    )


def airline_hour(source: str) -> str:
    return (
        f"SELECT {PREFIX} AS callsign_prefix, date_trunc('hour', observed_at) AS hour, "
        "count(DISTINCT icao24) AS active_aircraft, count(DISTINCT coalesce(callsign, '')) AS distinct_callsigns, "
        f"{AVG_VELOCITY}, {COUNTERS} FROM {source} GROUP BY 1, 2"
    )


def grid(source: str, minutes: int = 5) -> str:
    return (
        f"SELECT time_bucket(INTERVAL {minutes} MINUTE, observed_at, TIMESTAMP '1970-01-01') AS bucket, "
        "floor(lat * 4)::SMALLINT AS lat_cell, floor(lon * 4)::SMALLINT AS lon_cell, icao24 "
        f"FROM {source} WHERE NOT on_ground"
    )


def grid_final(source: str, minutes: int = 5) -> str:
    return (
        "SELECT bucket, lat_cell, lon_cell, lat_cell / 4::DOUBLE AS lat, lon_cell / 4::DOUBLE AS lon, "
        f"count(DISTINCT icao24) AS aircraft_count FROM ({grid(source, minutes)}) GROUP BY ALL"
    )
