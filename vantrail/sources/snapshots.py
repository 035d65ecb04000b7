"""Snapshots of many aircraft: an envelope time and positional state vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vantrail.functions import (
    country_or_unknown,
    flag_at,
    item,
    normalise_callsign,
    normalise_icao24,
    number_at,
    observed_or_poll_time,
    position_source_name,
    stable_event_id,
)
from vantrail.schema import SNAPSHOT_INDEX as AT

_ENVELOPE = "time bigint, states array<array<string>>"


def explode_snapshots(df: DataFrame, body: str = "body", *keep: str) -> DataFrame:
    """Telemetry of every state vector that has an id and a position.

    Vectors may be 17 or 18 long, or shorter; what is missing is null. The event
    id is made from the content and the place in the snapshot, so that a retried
    task gives the same ids.
    """
    rows = (
        df.select(*keep, F.from_json(body, _ENVELOPE).alias("_s"))
        .select(*keep, F.col("_s.time").alias("_poll"), F.posexplode("_s.states").alias("_pos", "_v"))
        .withColumn("_id", item(F.col("_v"), AT["icao24"]))
        .withColumn("_lat", number_at(F.col("_v"), AT["lat"]))
        .withColumn("_lon", number_at(F.col("_v"), AT["lon"]))
        .filter((F.col("_id") != "") & F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    )
    v = F.col("_v")
    icao24 = normalise_icao24(F.col("_id"))
    observed = observed_or_poll_time(item(v, AT["time_position"]), F.col("_poll"))
    return rows.select(
        *keep,
        stable_event_id(icao24, F.unix_micros(observed), F.col("_poll"), F.col("_pos")).alias("event_id"),
        icao24.alias("icao24"),
        normalise_callsign(item(v, AT["callsign"])).alias("callsign"),
        country_or_unknown(item(v, AT["origin_country"])).alias("origin_country"),
        observed.alias("observed_at"),
        position_source_name(item(v, AT["position_source"])).alias("position_source"),
        F.col("_lat").alias("lat"),
        F.col("_lon").alias("lon"),
        *[
            number_at(v, AT[name]).alias(name)
            for name in ("baro_altitude_m", "geo_altitude_m", "velocity_ms", "true_track_deg", "vertical_rate_ms")
        ],
        flag_at(v, AT["on_ground"]).alias("on_ground"),
        item(v, AT["squawk"]).alias("squawk"),
        flag_at(v, AT["spi"]).alias("spi"),
        number_at(v, AT["category"]).try_cast("int").alias("category"),
    )
