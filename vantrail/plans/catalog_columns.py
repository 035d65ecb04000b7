"""Scalar functions and filters over the whole feed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, functions as F

from vantrail import functions as fn
from vantrail.operators.dashboards import matches
from vantrail.operators.reads import Cursor, active_since, before_cursor
from vantrail.plans.catalog import add
from vantrail.plans.oracle import PHASE, PREFIX
from vantrail.schema import POSITION_SOURCES


def column(name: str, out: str, value: Callable[[], Column], sql: str) -> None:
    """A query that shows one expression for every arrival."""
    add(
        name,
        lambda c: c.feed.select("event_id", "seq", value().alias(out)),
        f"SELECT event_id, seq, {sql} AS {out} FROM feed",
    )


C = F.col


def time_texts() -> Column:
    """The observation time in forms that are and are not RFC 3339."""
    stamp, form = F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), C("seq") % 7
    return (
        F.when(form == 0, F.concat(stamp, F.lit("Z")))
        .when(form == 1, F.concat(stamp, F.lit("+02:00")))
        .when(form == 2, F.concat(stamp, F.lit("789-05:30")))
        .when(form == 3, F.substring(stamp, 1, 10))
        .when(form == 4, stamp)
        .when(form == 5, F.concat(stamp, F.lit("Z\n")))
        .otherwise(F.concat(F.substring(stamp, 1, 19), F.lit("Z")))
    )


def padded_callsigns() -> Column:
    padded = F.concat(F.lit("  "), C("callsign"), F.lit("\t "))
    return F.when(C("seq") % 3 == 0, padded).when(C("seq") % 3 == 1, "   ").otherwise(C("callsign"))


def lists_of_two_lengths() -> Column:
    lat, baro = C("lat").cast("string"), C("baro_altitude_m").cast("string")
    return F.when(C("seq") % 2 == 0, F.array(lat)).otherwise(F.array(lat, baro))


def source_codes() -> Column:
    code = C("seq") % 7
    return F.when(code == 6, None).when(code == 5, "x").otherwise(code.cast("string"))


def countries_with_gaps() -> Column:
    return F.when(C("seq") % 3 == 0, "").when(C("seq") % 3 == 1, None).otherwise(C("origin_country"))


def position_or_poll() -> Column:
    seconds = F.unix_seconds("observed_at")
    return fn.observed_or_poll_time(F.when(C("seq") % 3 > 0, seconds.cast("string")), seconds + 60)


column(
    "p2_parse_rfc3339",
    "parsed",
    lambda: fn.parse_rfc3339(time_texts()),
    "CASE seq % 7 WHEN 0 THEN observed_at WHEN 1 THEN observed_at - INTERVAL 2 HOUR "
    "WHEN 2 THEN observed_at + INTERVAL 330 MINUTE WHEN 6 THEN date_trunc('second', observed_at) END",
)
column(
    "p3_normalise_icao24",
    "icao24",
    lambda: fn.normalise_icao24(F.concat(F.lit(" \t"), F.upper("icao24"), F.lit(" "))),
    "icao24",
)
column(
    "p4_normalise_callsign",
    "callsign",
    lambda: fn.normalise_callsign(padded_callsigns()),
    "CASE WHEN seq % 3 = 1 THEN NULL ELSE callsign END",
)
column(
    "p5_country_or_unknown",
    "country",
    lambda: fn.country_or_unknown(countries_with_gaps()),
    "CASE WHEN seq % 3 = 2 THEN origin_country ELSE 'Unknown' END",
)
column(
    "p6_position_source_name",
    "source",
    lambda: fn.position_source_name(source_codes()),
    "CASE WHEN seq % 7 < 4 THEN (['" + "','".join(POSITION_SOURCES) + "'])[(seq % 7 + 1)::INT] ELSE 'UNKNOWN' END",
)
column(
    "p7_observed_or_poll_time",
    "at",
    position_or_poll,
    "date_trunc('second', observed_at) + CASE WHEN seq % 3 > 0 THEN INTERVAL 0 SECOND ELSE INTERVAL 60 SECOND END",
)
column(
    "p8_number_at",
    "altitude",
    lambda: fn.number_at(lists_of_two_lengths(), 1),
    "CASE WHEN seq % 2 = 0 THEN NULL ELSE baro_altitude_m END",
)
add(
    "p9_stable_event_id",
    lambda c: c.feed.select("seq", fn.stable_event_id(C("icao24"), F.unix_micros("observed_at"), C("seq")).alias("id")),
    "SELECT seq, substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS id "
    "FROM (SELECT seq, sha256(icao24 || '|' || epoch_us(observed_at) || '|' || seq) AS h FROM feed)",
)
column("p10_callsign_prefix", "prefix", lambda: fn.callsign_prefix(C("callsign")), PREFIX)
column("p11_hour_bucket", "hour", lambda: fn.hour_bucket(C("observed_at")), "date_trunc('hour', observed_at)")
column(
    "p12_five_minute_bucket",
    "bucket",
    lambda: fn.time_bucket(C("observed_at")),
    "time_bucket(INTERVAL 5 MINUTE, observed_at, TIMESTAMP '1970-01-01')",
)
add(
    "p13_grid_cell",
    lambda c: c.feed.select(
        "event_id", "seq", fn.grid_cell(C("lat")).alias("lat_cell"), fn.grid_cell(C("lon")).alias("lon_cell")
    ),
    "SELECT event_id, seq, floor(lat * 4)::SMALLINT AS lat_cell, floor(lon * 4)::SMALLINT AS lon_cell FROM feed",
)
column("p14_cell_origin", "west", lambda: fn.cell_origin(fn.grid_cell(C("lon"))), "floor(lon * 4) / 4")


def rates_with_nan() -> Column:
    return F.when(C("seq") % 9 == 0, F.lit(float("nan"))).otherwise(C("vertical_rate_ms"))


add(
    "p15_flight_phase",
    lambda c: c.feed.withColumn("vertical_rate_ms", rates_with_nan()).select(
        "event_id", "seq", fn.flight_phase(C("vertical_rate_ms")).alias("phase")
    ),
    f"SELECT event_id, seq, {PHASE} AS phase FROM (SELECT * REPLACE (CASE WHEN seq % 9 = 0 THEN 'nan'::DOUBLE "
    "ELSE vertical_rate_ms END AS vertical_rate_ms) FROM feed)",
)
column("p16_is_emergency", "emergency", lambda: fn.is_emergency(C("squawk")), "coalesce(squawk IN ('7500','7600','7700'), false)")
column("p17_minute_bucket", "minute", lambda: fn.minute_bucket(C("observed_at")), "date_trunc('minute', observed_at)")
column("p18_flag_text", "on_ground", lambda: fn.flag_text(C("on_ground")), "on_ground::VARCHAR")
add(
    "p19_rounded_mean",
    lambda c: c.feed.groupBy("icao24").agg(fn.rounded_mean(C("baro_altitude_m")).alias("mean_altitude")),
    "SELECT icao24, round(avg(baro_altitude_m)::DECIMAL(38,10), 0)::BIGINT AS mean_altitude FROM feed GROUP BY 1",
)
add(
    "p20_speed_units",
    lambda c: c.feed.select(
        "event_id",
        "seq",
        F.round(fn.to_kmh(C("velocity_ms")) + 1e-9, 4).alias("kmh"),
        F.round(fn.to_knots(C("velocity_ms")) + 1e-9, 4).alias("knots"),
    ),
    "SELECT event_id, seq, round(velocity_ms * 3.6::DOUBLE + 1e-9, 4) AS kmh, round(velocity_ms * 1.943844::DOUBLE + 1e-9, 4) AS knots FROM feed",
)

add(
    "f1_active_filter",
    lambda c: c.state.filter(active_since(c.as_of, 1440)).select("icao24", "observed_at"),
    "SELECT icao24, observed_at FROM state WHERE observed_at >= (SELECT t FROM last_seen) - INTERVAL 1440 MINUTE",
)
add(
    "f1_active_filter_5min",
    lambda c: c.state.filter(active_since(c.as_of)).select("icao24", "observed_at"),
    "SELECT icao24, observed_at FROM state WHERE observed_at >= (SELECT t FROM last_seen) - INTERVAL 5 MINUTE",
)
add(
    "f2_country_filter",
    lambda c: c.raw.filter(C("origin_country") == "NATION_7").select("event_id", "icao24"),
    "SELECT event_id, icao24 FROM raw WHERE origin_country = 'NATION_7'",
)
add(
    "f3_pattern_filter",
    lambda c: c.raw.filter(matches("NATION_1", "^(BAW|N1)", "false", "callsign")).select("event_id", "callsign"),
    f"SELECT event_id, callsign FROM raw WHERE regexp_matches(origin_country, 'NATION_1') "
    f"AND regexp_matches({PREFIX}, '^(BAW|N1)') AND regexp_matches(on_ground::VARCHAR, 'false')",
)
add(
    "f4_airborne_filter",
    lambda c: c.raw.filter(~C("on_ground")).select("event_id", "velocity_ms"),
    "SELECT event_id, velocity_ms FROM raw WHERE NOT on_ground",
)
add(
    "f5_keyset_filter",
    lambda c: c.raw.filter(
        before_cursor(
            Cursor((c.as_of - timedelta(days=9)).isoformat(), "00000000-0000-0000-0000-000000000500"), "observed_at", "event_id"
        )
    ).select("event_id", "observed_at"),
    "SELECT event_id, observed_at FROM raw WHERE (observed_at, event_id) < "
    "((SELECT t FROM last_seen) - INTERVAL 9 DAY, '00000000-0000-0000-0000-000000000500')",
)
