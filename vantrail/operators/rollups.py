"""Mergeable rollups with exact distinct counts.

A state holds one row per (group, aircraft) instead of a set inside the group
row. Distinct counts stay exact, every step is a hash aggregate with a map-side
part, and no task ever holds a whole set, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vantrail.functions import (
    callsign_prefix,
    cell_origin,
    flight_phase,
    grid_cell,
    hour_bucket,
    is_emergency,
    time_bucket,
)
from vantrail.operators.dedupe import dedupe_first
from vantrail.schema import CELLS_PER_DEGREE

PHASES = {"climbing_count": "climbing", "descending_count": "descending", "cruising_count": "cruising"}
VELOCITY = ("sum_velocity_ms", "count_velocity_obs")
ALTITUDE = ("sum_baro_altitude_m", "count_alt_obs")

#: What a country state is made of, beside the time and the group.
COUNTRY_INPUT = ("on_ground", "velocity_ms", "baro_altitude_m", "vertical_rate_ms", "squawk")
COUNTRY_SUMS = (*VELOCITY, *ALTITUDE, *PHASES, "on_ground_count", "emergency_squawks_count")
AIRLINE_SUMS = (*VELOCITY, *PHASES, "on_ground_count")


def _metric(name: str) -> Column:
    airborne = ~F.col("on_ground")
    if name in PHASES:
        return F.count_if(flight_phase(F.col("vertical_rate_ms")) == PHASES[name])
    source = "velocity_ms" if name in VELOCITY else "baro_altitude_m"
    return {
        VELOCITY[0]: lambda: F.coalesce(F.sum(F.when(airborne, F.col(source))), F.lit(0.0)),
        VELOCITY[1]: lambda: F.count(F.when(airborne, F.col(source))),
        ALTITUDE[0]: lambda: F.coalesce(F.sum(F.when(airborne, F.col(source))), F.lit(0.0)),
        ALTITUDE[1]: lambda: F.count(F.when(airborne, F.col(source))),
        "on_ground_count": lambda: F.count_if("on_ground"),
        "emergency_squawks_count": lambda: F.count_if(is_emergency(F.col("squawk"))),
    }[name]()


def _input(df: DataFrame, columns: Sequence[str], dedupe: bool) -> DataFrame:
    """Narrow first, so that the dedupe shuffle carries only what is needed."""
    if not dedupe:
        return df.select(*columns)
    return dedupe_first(df.select("event_id", "seq", *columns)).drop("event_id", "seq")


def _state(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[_metric(name).alias(name) for name in sums])


def _mean(sum_name: str, count_name: str) -> Column:
    return F.try_divide(F.sum(sum_name), F.sum(count_name))


def country_hour_state(
    df: DataFrame, dedupe: bool = True, grain: str = "hour", by: str = "origin_country"
) -> DataFrame:
    """Partial state per (country, hour, aircraft).

    ``dedupe=False`` counts repeated deliveries in the sums and counters, as a
    store does that aggregates each inserted block; distinct counts are exact
    either way. ``grain`` and ``by`` give other buckets and groups.
    """
    columns = ["icao24", by, "observed_at", *COUNTRY_INPUT]
    rows = _input(df, columns, dedupe).withColumn(grain, F.date_trunc(grain, "observed_at"))
    return _state(rows, [by, grain, "icao24"], COUNTRY_SUMS)


def country_hour_final(state: DataFrame, grain: str = "hour", by: str = "origin_country") -> DataFrame:
    """Readable values of a country state, merged or not."""
    return state.groupBy(by, grain).agg(
        F.count_distinct("icao24").alias("active_aircraft"),
        _mean(*VELOCITY).alias("avg_velocity_ms"),
        _mean(*ALTITUDE).alias("avg_baro_altitude_m"),
        *[F.sum(c).alias(c) for c in (*PHASES, "on_ground_count", "emergency_squawks_count")],
    )


def airline_hour_state(df: DataFrame, dedupe: bool = True, grain: str = "hour") -> DataFrame:
    """Partial state per (callsign prefix, hour, aircraft, callsign); no callsign is ''."""
    columns = ["icao24", "callsign", "observed_at", "on_ground", "velocity_ms", "vertical_rate_ms"]
    rows = (
        _input(df, columns, dedupe)
        .withColumn("callsign_prefix", callsign_prefix(F.col("callsign")))
        .withColumn("callsign", F.coalesce("callsign", F.lit("")))
        .withColumn(grain, F.date_trunc(grain, "observed_at"))
    )
    return _state(rows, ["callsign_prefix", grain, "icao24", "callsign"], AIRLINE_SUMS)


def airline_hour_final(state: DataFrame, grain: str = "hour") -> DataFrame:
    """Readable values of an airline state, merged or not.

    Spark plans the two exact distinct counts by expanding the rows. These are
    state rows, already folded per aircraft and callsign, so that stays small;
    two separate passes would compute an unstored state twice.
    """
    return state.groupBy("callsign_prefix", grain).agg(
        F.count_distinct("icao24").alias("active_aircraft"),
        F.count_distinct("callsign").alias("distinct_callsigns"),
        _mean(*VELOCITY).alias("avg_velocity_ms"),
        *[F.sum(c).alias(c) for c in (*PHASES, "on_ground_count")],
    )


def grid_state(
    df: DataFrame, bucket_minutes: int = 5, cells_per_degree: int = CELLS_PER_DEGREE
) -> DataFrame:
    """Airborne aircraft per (bucket, cell): one row for each aircraft seen.

    A repeated delivery changes nothing here, so there is no dedupe step.
    """
    return (
        df.filter(~F.col("on_ground"))
        .select(
            time_bucket(F.col("observed_at"), bucket_minutes).alias("bucket"),
            grid_cell(F.col("lat"), cells_per_degree).alias("lat_cell"),
            grid_cell(F.col("lon"), cells_per_degree).alias("lon_cell"),
            "icao24",
        )
        .distinct()
    )


def grid_final(state: DataFrame, cells_per_degree: int = CELLS_PER_DEGREE) -> DataFrame:
    return (
        state.groupBy("bucket", "lat_cell", "lon_cell")
        .agg(F.count_distinct("icao24").alias("aircraft_count"))
        .withColumn("lat", cell_origin(F.col("lat_cell"), cells_per_degree))
        .withColumn("lon", cell_origin(F.col("lon_cell"), cells_per_degree))
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """Adds up partial states of separate inserts; order and grouping do not matter."""
    every = reduce(lambda a, b: a.unionByName(b), states)
    sums = [c for c in every.columns if c in {*COUNTRY_SUMS, *AIRLINE_SUMS}]
    keys = [c for c in every.columns if c not in sums]
    if not sums:
        return every.distinct()
    return every.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def leaderboard(final: DataFrame, n: int = 10) -> DataFrame:
    """Most active countries of the latest hours."""
    return (
        final.select("origin_country", "hour", "active_aircraft", "avg_velocity_ms")
        .orderBy(F.desc("hour"), F.desc("active_aircraft"), F.asc("origin_country"))
        .limit(n)
    )


def top_airlines(state: DataFrame, day, metric: str = "climbing", n: int = 10) -> DataFrame:
    """Airlines of one day by their share of climbing (or descending) observations."""
    counts = list(PHASES)
    phases = sum((F.col(c) for c in counts), F.lit(0))
    return (
        state.filter(F.col("callsign_prefix") != "")
        .filter((F.col("hour") >= F.lit(day)) & (F.col("hour") < F.lit(day) + F.expr("interval 1 day")))
        .groupBy("callsign_prefix")
        .agg(F.count_distinct("icao24").alias("active_aircraft"), *[F.sum(c).alias(c) for c in counts])
        .withColumn("share", F.try_divide(F.col(f"{metric}_count"), phases))
        .select("callsign_prefix", "active_aircraft", f"{metric}_count", "share")
        .orderBy(F.desc_nulls_last("share"), F.asc("callsign_prefix"))
        .limit(n)
    )


def density_in_box(
    state: DataFrame, south: float, west: float, north: float, east: float, since=None, until=None,
    cells_per_degree: int = CELLS_PER_DEGREE,
) -> DataFrame:
    """Grid cells whose origin lies in a box, for buckets in [since, until)."""
    lat, lon = F.col("lat_cell"), F.col("lon_cell")
    inside = (
        (lat >= F.lit(south) * cells_per_degree)
        & (lat < F.lit(north) * cells_per_degree)
        & (lon >= F.lit(west) * cells_per_degree)
        & (lon < F.lit(east) * cells_per_degree)
    )
    if since is not None:
        inside = inside & (F.col("bucket") >= F.lit(since))
    if until is not None:
        inside = inside & (F.col("bucket") < F.lit(until))
    return grid_final(state.filter(inside), cells_per_degree)


def week_over_week(final: DataFrame) -> DataFrame:
    """Each country hour next to the same hour one week before, or nulls where there was none."""
    now = final.select(
        "origin_country",
        "hour",
        F.col("active_aircraft").alias("aircraft"),
        F.col("avg_velocity_ms").alias("velocity"),
    )
    before = now.select(
        "origin_country",
        (F.col("hour") + F.expr("interval 7 days")).alias("hour"),
        F.col("aircraft").alias("aircraft_before"),
        F.col("velocity").alias("velocity_before"),
    )
    return (
        now.join(before, ["origin_country", "hour"], "left")
        .withColumn("aircraft_change", F.col("aircraft") - F.col("aircraft_before"))
        .withColumn("velocity_change", F.col("velocity") - F.col("velocity_before"))
    )


def distinct_bitmap_state(df: DataFrame, by: str = "origin_country", grain: str = "hour") -> DataFrame:
    """Exact distinct aircraft per group as bitmaps: a second form of the row state, for dense groups.

    The six hex digits of an aircraft are its number, so a group has at most 512 bitmaps of 32,768 aircraft, 4 KB each (2 MB in all,
    however often it is seen). The row state takes about 20 bytes an aircraft and group: a bitmap is smaller from some 200 aircraft of
    one range on. No state depends on the order of rows or batches.
    """
    number = F.conv("icao24", 16, 10).cast("bigint") + 1  # bitmap positions count from 1
    rows = df.select(by, F.date_trunc(grain, "observed_at").alias(grain), number.alias("number"))
    placed = rows.select(by, grain, F.call_function("bitmap_bucket_number", "number").alias("range"), F.call_function("bitmap_bit_position", "number").alias("place"))
    return placed.groupBy(by, grain, "range").agg(F.call_function("bitmap_construct_agg", "place").alias("aircraft"))


def merge_bitmaps(*states: DataFrame) -> DataFrame:
    """Bitmap states of separate inserts as one: the bits are or-ed."""
    every = reduce(lambda a, b: a.unionByName(b), states)
    keys = [c for c in every.columns if c != "aircraft"]
    return every.groupBy(*keys).agg(F.call_function("bitmap_or_agg", "aircraft").alias("aircraft"))


def distinct_bitmap_final(state: DataFrame, by: str = "origin_country", grain: str = "hour") -> DataFrame:
    """active_aircraft per group of a bitmap state, merged or not."""
    return merge_bitmaps(state).groupBy(by, grain).agg(F.sum(F.call_function("bitmap_count", "aircraft")).alias("active_aircraft"))
