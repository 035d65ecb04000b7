"""Dashboard panels. The day-long window is used next to the five-minute one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vantrail.operators import dashboards as d
from vantrail.plans.catalog import add
from vantrail.plans.oracle import PREFIX

LAST_PREFIX = "coalesce(substr(last_callsign, 1, 3), '')"
ORIGIN, AIRLINE, GROUND = "NATION_[0-9]$", "^(BAW|DLH|UAL)", "false"


def seen(minutes: int) -> str:
    return f"observed_at >= (SELECT t FROM last_seen) - INTERVAL {minutes} MINUTE"


def like(origin: bool = True, airline: bool = True, ground: bool = False, prefix: str = LAST_PREFIX) -> str:
    checks = []
    if origin:
        checks.append(f"regexp_matches(origin_country, '{ORIGIN}')")
    if airline:
        checks.append(f"regexp_matches({prefix}, '{AIRLINE}')")
    if ground:
        checks.append(f"regexp_matches(on_ground::VARCHAR, '{GROUND}')")
    return " AND ".join(checks)


for minutes, tail in ((1440, "_day"), (60, "")):
    add(
        f"b1_filter_countries{tail}",
        lambda c, m=minutes: d.filter_countries(c.state, c.as_of, m),
        f"SELECT DISTINCT origin_country FROM state WHERE {seen(minutes)}",
    )
    add(
        f"b2_filter_airlines{tail}",
        lambda c, m=minutes: d.filter_airlines(c.state, c.as_of, m),
        "SELECT DISTINCT substr(last_callsign, 1, 3) AS prefix FROM state "
        f"WHERE length(trim(last_callsign)) >= 3 AND {seen(minutes)}",
    )
for minutes, tail in ((1440, "_day"), (5, "")):
    add(
        f"b3_active_count{tail}",
        lambda c, m=minutes: d.active_count(c.state, c.as_of, ORIGIN, AIRLINE, GROUND, m),
        f"SELECT count(*) AS active FROM state WHERE {seen(minutes)} AND {like(ground=True)}",
    )
    add(
        f"b4_airborne_count{tail}",
        lambda c, m=minutes: d.airborne_count(c.state, c.as_of, ORIGIN, AIRLINE, m),
        f"SELECT count(*) FILTER (WHERE NOT on_ground) AS airborne FROM state WHERE {seen(minutes)} AND {like()}",
    )
    add(
        f"b5_on_ground_count{tail}",
        lambda c, m=minutes: d.on_ground_count(c.state, c.as_of, ORIGIN, ".*", m),
        f"SELECT count(*) FILTER (WHERE on_ground) AS on_ground FROM state WHERE {seen(minutes)} AND {like(airline=False)}",
    )
    add(
        f"b6_avg_altitude{tail}",
        lambda c, m=minutes: d.avg_altitude(c.state, c.as_of, ORIGIN, ".*", m).withColumnRenamed("avg_alt", "altitude"),
        "SELECT round(avg(baro_altitude_m)::DECIMAL(38,10), 0)::BIGINT AS altitude FROM state "
        f"WHERE NOT on_ground AND {seen(minutes)} AND {like(airline=False)}",
    )
    add(
        f"b7_top_countries{tail}",
        lambda c, m=minutes: d.top_countries(c.state, c.as_of, ".*", GROUND, minutes=m),
        f"SELECT origin_country, count(*) AS aircraft FROM state WHERE {seen(minutes)} AND {like(False, False, True)} "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    )
for minutes, tail in ((1440, "_day"), (60, "")):
    add(
        f"b8_aircraft_per_minute{tail}",
        lambda c, m=minutes: d.aircraft_per_minute(c.raw, c.as_of, ORIGIN, ".*", ".*", m),
        "SELECT date_trunc('minute', observed_at) AS minute, count(DISTINCT icao24) AS aircraft FROM raw "
        f"WHERE {seen(minutes)} AND {like(airline=False)} GROUP BY 1",
    )
for hours, tail in ((72, "_days"), (6, "")):
    add(
        f"b9_emergencies{tail}",
        lambda c, h=hours: d.emergencies(c.raw, c.as_of, ORIGIN, ".*", hours=h),
        "SELECT observed_at, icao24, callsign, origin_country, squawk, lat, lon, baro_altitude_m FROM raw "
        f"WHERE squawk IN ('7500','7600','7700') AND {seen(hours * 60)} AND {like(airline=False)} "
        "ORDER BY observed_at DESC, event_id DESC LIMIT 50",
    )
add(
    "b10_ground_choices",
    lambda c: reduce(
        lambda a, b: a.unionByName(b),
        [
            d.active_count(c.state, c.as_of, ground=pattern, minutes=1440).select(F.lit(choice).alias("choice"), "active")
            for choice, pattern in d.GROUND_CHOICES.items()
        ],
    ),
    f"SELECT choice, count(*) FILTER (WHERE {seen(1440)} AND regexp_matches(on_ground::VARCHAR, pattern)) AS active "
    "FROM state, (VALUES ('All', '.*'), ('Airborne only', 'false'), ('On ground only', 'true')) v(choice, pattern) GROUP BY 1",
)
