"""Record layouts and the values fixed by the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values of the contract -------------------------------------------
POSITION_SOURCES = ("ADSB", "ASTERIX", "MLAT", "FLARM", "UNKNOWN")
EMERGENCY_SQUAWKS = ("7500", "7600", "7700")
ICAO24_PATTERN = r"^[0-9a-f]{6}\z"
SQUAWK_PATTERN = r"^[0-7]{4}\z"
VERTICAL_RATE_LIMIT_MS = 2.5
CELLS_PER_DEGREE = 4
MAX_FUTURE_HOURS = 24
ACTIVE_MINUTES = 5
DEFAULT_PAGE = 100
MAX_PAGE = 1000
HOT_RAW_DAYS = 7
COLUMNAR_RAW_DAYS = 180
ROLLUP_DAYS = 90
GRID_DAYS = 30
REPLAY_HOURS = 48
MAX_BODY_BYTES = 10 * 1024 * 1024
TOO_LARGE = f"request body exceeds {MAX_BODY_BYTES} bytes"
WIRE_MAGIC = 0
WIRE_HEADER_BYTES = 5
# Position of each value inside a snapshot state vector (12 is unused).
SNAPSHOT_INDEX = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "lon": 5,
    "lat": 6,
    "baro_altitude_m": 7,
    "on_ground": 8,
    "velocity_ms": 9,
    "true_track_deg": 10,
    "vertical_rate_ms": 11,
    "geo_altitude_m": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
    "category": 17,
}
# -----------------------------------------------------------------------------

TELEMETRY = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("icao24", T.StringType(), False),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType(), False),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("position_source", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
        T.StructField("baro_altitude_m", T.DoubleType()),
        T.StructField("geo_altitude_m", T.DoubleType()),
        T.StructField("velocity_ms", T.DoubleType()),
        T.StructField("true_track_deg", T.DoubleType()),
        T.StructField("vertical_rate_ms", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType(), False),
        T.StructField("squawk", T.StringType()),
        T.StructField("spi", T.BooleanType(), False),
        T.StructField("category", T.IntegerType()),
    ]
)
TELEMETRY_COLUMNS = TELEMETRY.fieldNames()

# A pushed event before its checks: times are text, the category is not narrowed.
EVENT_REQUEST = T.StructType(
    [
        T.StructField(
            f.name,
            {"observed_at": T.StringType(), "category": T.LongType()}.get(f.name, f.dataType),
        )
        for f in TELEMETRY.fields
    ]
)

# Latest-state columns and the telemetry column each is taken from.
STATE_FROM = {
    "icao24": "icao24",
    "last_callsign": "callsign",
    "origin_country": "origin_country",
    "observed_at": "observed_at",
    "lat": "lat",
    "lon": "lon",
    "baro_altitude_m": "baro_altitude_m",
    "velocity_ms": "velocity_ms",
    "on_ground": "on_ground",
    "last_squawk": "squawk",
    "last_event_id": "event_id",
}

# Topic rows as the Kafka source delivers them.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
