"""Rollups and what is read from them."""

from __future__ import annotations

from datetime import timedelta
from functools import partial

from pyspark.sql import functions as F

from vantrail.operators import rollups as r
from vantrail.plans.catalog import add as add_query
from vantrail.plans.oracle import (
    AVG_VELOCITY,
    COUNTERS,
    EMERGENCY,
    PREFIX,
    SUM_ALTITUDE,
    SUM_VELOCITY,
    airline_hour,
    country_hour,
    grid,
    grid_final,
)

C = F.col
#: Sums and means of speeds and heights, whose last digit depends on the order of the rows.
add = partial(add_query, rounded=("avg_velocity_ms", "avg_baro_altitude_m", "sum_velocity_ms", "sum_baro_altitude_m", "share", "velocity_before", "velocity_change"))
HOUR = "date_trunc('hour', observed_at)"

for source, deduped in (("raw", True), ("feed", False)):
    tail = "" if deduped else "_all_deliveries"
    add(
        f"a1_country_hour_state{tail}",
        lambda c, d=deduped: r.country_hour_state(c.feed, d),
        f"SELECT origin_country, {HOUR} AS hour, icao24, {SUM_VELOCITY}, {SUM_ALTITUDE}, {COUNTERS}, {EMERGENCY} FROM {source} GROUP BY 1, 2, 3",
    )
    add(
        f"a2_country_hour_final{tail}",
        lambda c, d=deduped: r.country_hour_final(r.country_hour_state(c.feed, d)),
        country_hour(source),
    )
    add(
        f"a3_airline_hour_state{tail}",
        lambda c, d=deduped: r.airline_hour_state(c.feed, d),
        f"SELECT {PREFIX} AS callsign_prefix, {HOUR} AS hour, icao24, coalesce(callsign, '') AS callsign, {SUM_VELOCITY}, {COUNTERS} FROM {source} GROUP BY ALL",
    )
    add(
        f"a4_airline_hour_final{tail}",
        lambda c, d=deduped: r.airline_hour_final(r.airline_hour_state(c.feed, d)),
        airline_hour(source),
    )

add("a5_grid_state", lambda c: r.grid_state(c.feed), f"SELECT DISTINCT * FROM ({grid('feed')})")
add("a6_grid_final", lambda c: r.grid_final(r.grid_state(c.feed)), grid_final("feed"))
add("a6_grid_final_day", lambda c: r.grid_final(r.grid_state(c.feed, 1440)), grid_final("feed", 1440))


def in_parts(c, build):
    """The feed in three inserts, each with its own partial state."""
    return [build(c.feed.filter(C("seq") % 3 == k)) for k in range(3)]


add(
    "a7_merge_states",
    lambda c: r.country_hour_final(r.merge_states(*in_parts(c, lambda df: r.country_hour_state(df, dedupe=False)))),
    country_hour("feed"),
)
add("a7_merge_grid_states", lambda c: r.grid_final(r.merge_states(*in_parts(c, r.grid_state))), grid_final("feed"))
add(
    "a9_filtered_counts",
    lambda c: c.raw.groupBy("origin_country").agg(
        F.count_if(~C("on_ground")).alias("airborne"),
        F.count_if("on_ground").alias("grounded"),
        F.count_if(C("vertical_rate_ms") > 2.5).alias("climbing"),
    ),
    "SELECT origin_country, count(*) FILTER (WHERE NOT on_ground) AS airborne, count(*) FILTER (WHERE on_ground) AS grounded, "
    "count(*) FILTER (WHERE vertical_rate_ms > 2.5) AS climbing FROM raw GROUP BY 1",
)
add(
    "a10_exact_distinct",
    lambda c: c.feed.groupBy("origin_country").agg(F.count_distinct("icao24").alias("aircraft")),
    "SELECT origin_country, count(DISTINCT icao24) AS aircraft FROM feed GROUP BY 1",
)
add(
    "a11_country_day",
    lambda c: r.country_hour_final(r.country_hour_state(c.feed, grain="day"), grain="day"),
    country_hour("raw", "day"),
)
add(
    "a11_source_hour",
    lambda c: r.country_hour_final(r.country_hour_state(c.feed, by="position_source"), by="position_source"),
    country_hour("raw", by="position_source"),
)
add(
    "a12_leaderboard",
    lambda c: r.leaderboard(r.country_hour_final(r.country_hour_state(c.feed))),
    f"SELECT origin_country, {HOUR} AS hour, count(DISTINCT icao24) AS active_aircraft, {AVG_VELOCITY} FROM raw GROUP BY 1, 2 "
    "ORDER BY hour DESC, active_aircraft DESC, origin_country LIMIT 10",
)
for metric in ("climbing", "descending"):
    add(
        f"a13_top_airlines_{metric}",
        lambda c, m=metric: r.top_airlines(
            r.airline_hour_state(c.feed), c.as_of.replace(hour=0, minute=0, second=0, microsecond=0), m
        ),
        f"SELECT callsign_prefix, active_aircraft, {metric}_count, round({metric}_count / nullif(climbing_count + descending_count + cruising_count, 0) + 1e-9, 6) AS share FROM ("
        f"SELECT {PREFIX} AS callsign_prefix, count(DISTINCT icao24) AS active_aircraft, {COUNTERS} FROM raw "
        f"WHERE date_trunc('day', observed_at) = date_trunc('day', (SELECT t FROM last_seen)) AND {PREFIX} <> '' GROUP BY 1) "
        "ORDER BY share DESC NULLS LAST, callsign_prefix LIMIT 10",
    )
add(
    "a14_density_in_box",
    lambda c: r.density_in_box(
        r.grid_state(c.feed), 50.0, -1.0, 51.0, 1.0, c.as_of - timedelta(days=5), c.as_of + timedelta(days=1)
    ),
    f"SELECT * FROM ({grid_final('feed')}) WHERE lat >= 50 AND lat < 51 AND lon >= -1 AND lon < 1 "
    "AND bucket >= (SELECT t FROM last_seen) - INTERVAL 5 DAY",
)
WEEK = f"SELECT origin_country, {HOUR} AS hour, count(DISTINCT icao24) AS aircraft, avg(velocity_ms) FILTER (WHERE NOT on_ground) AS velocity FROM raw GROUP BY 1, 2"
add(
    "a15_week_over_week",
    lambda c: r.week_over_week(r.country_hour_final(r.country_hour_state(c.feed))).withColumn("velocity", F.round(C("velocity") + 1e-9, 6)),
    f"SELECT a.origin_country, a.hour, a.aircraft, round(a.velocity + 1e-9, 6) AS velocity, b.aircraft AS aircraft_before, "
    "round(b.velocity + 1e-9, 6) AS velocity_before, a.aircraft - b.aircraft AS aircraft_change, "
    f"round(a.velocity - b.velocity + 1e-9, 6) AS velocity_change FROM ({WEEK}) a LEFT JOIN ({WEEK}) b "
    "ON a.origin_country = b.origin_country AND a.hour = b.hour + INTERVAL 7 DAY",
)
