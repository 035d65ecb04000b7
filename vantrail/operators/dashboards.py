"""Live dashboard panels over the latest state or the raw observations."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from vantrail.functions import callsign_prefix, flag_text, is_emergency, minute_bucket, rounded_mean
from vantrail.operators.reads import active_since
from vantrail.schema import ACTIVE_MINUTES

# Choices of the ground filter and the pattern each stands for.
GROUND_CHOICES = {"All": ".*", "Airborne only": "false", "On ground only": "true"}


def matches(
    origin: str = ".*", airline: str = ".*", ground: str = ".*", callsign: str = "last_callsign"
) -> Column:
    """Unanchored patterns on country, callsign prefix and ground flag."""
    checks = F.lit(True)
    if origin != ".*":
        checks = checks & F.col("origin_country").rlike(origin)
    if airline != ".*":
        checks = checks & callsign_prefix(F.col(callsign)).rlike(airline)
    if ground != ".*":
        checks = checks & flag_text(F.col("on_ground")).rlike(ground)
    return checks


def filter_countries(state: DataFrame, as_of: datetime, minutes: int = 60) -> DataFrame:
    return state.filter(active_since(as_of, minutes)).select("origin_country").distinct().orderBy("origin_country")


def filter_airlines(state: DataFrame, as_of: datetime, minutes: int = 60) -> DataFrame:
    """Prefixes of the callsigns that have three characters or more when trimmed."""
    return (
        state.filter(active_since(as_of, minutes))
        .filter(F.length(F.trim("last_callsign")) >= 3)
        .select(F.substring("last_callsign", 1, 3).alias("prefix"))
        .distinct()
        .orderBy("prefix")
    )


def active_count(state, as_of, origin=".*", airline=".*", ground=".*", minutes: int = ACTIVE_MINUTES) -> DataFrame:
    rows = state.filter(active_since(as_of, minutes) & matches(origin, airline, ground))
    return rows.agg(F.count(F.lit(1)).alias("active"))


def airborne_count(state, as_of, origin=".*", airline=".*", minutes: int = ACTIVE_MINUTES) -> DataFrame:
    rows = state.filter(active_since(as_of, minutes) & matches(origin, airline))
    return rows.agg(F.count_if(~F.col("on_ground")).alias("airborne"))


def on_ground_count(state, as_of, origin=".*", airline=".*", minutes: int = ACTIVE_MINUTES) -> DataFrame:
    rows = state.filter(active_since(as_of, minutes) & matches(origin, airline))
    return rows.agg(F.count_if("on_ground").alias("on_ground"))


def avg_altitude(state, as_of, origin=".*", airline=".*", minutes: int = ACTIVE_MINUTES) -> DataFrame:
    rows = state.filter(active_since(as_of, minutes) & matches(origin, airline) & ~F.col("on_ground"))
    return rows.agg(rounded_mean(F.col("baro_altitude_m")).alias("avg_alt"))


def top_countries(
    state, as_of, airline=".*", ground=".*", n: int = 10, minutes: int = ACTIVE_MINUTES
) -> DataFrame:
    """Countries with the most aircraft; equal counts are ordered by name."""
    return (
        state.filter(active_since(as_of, minutes) & matches(".*", airline, ground))
        .groupBy("origin_country")
        .agg(F.count(F.lit(1)).alias("aircraft"))
        .orderBy(F.desc("aircraft"), F.asc("origin_country"))
        .limit(n)
    )


def aircraft_per_minute(raw, as_of, origin=".*", airline=".*", ground=".*", minutes: int = 60) -> DataFrame:
    return (
        raw.filter(active_since(as_of, minutes) & matches(origin, airline, ground, "callsign"))
        .groupBy(minute_bucket(F.col("observed_at")).alias("minute"))
        .agg(F.count_distinct("icao24").alias("aircraft"))
        .orderBy("minute")
    )


def emergencies(raw, as_of: datetime, origin=".*", airline=".*", n: int = 50, hours: int = 6) -> DataFrame:
    """Latest emergency squawks; equal times are ordered by event id."""
    since = F.col("observed_at") >= F.lit(as_of - timedelta(hours=hours))
    return (
        raw.filter(since & is_emergency(F.col("squawk")) & matches(origin, airline, callsign="callsign"))
        .orderBy(F.desc("observed_at"), F.desc("event_id"))
        .limit(n)
        .select("observed_at", "icao24", "callsign", "origin_country", "squawk", "lat", "lon", "baro_altitude_m")
    )
