"""Invariants between the stores, and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantrail.operators import invariants as i, reads, retention as keep, rollups as r
from vantrail.operators.dedupe import dedupe_first
from vantrail.operators.state import latest_state
from vantrail.plans.catalog import Case, add
from vantrail.plans.oracle import FIELDS, country_hour, grid

C = F.col

UNIQUE = "SELECT count(*) AS total, count(DISTINCT event_id) AS distinct_ids, count(*) = count(DISTINCT event_id) AS ok FROM {}"
add("i1_check_unique", lambda c: i.check_unique(c.raw), UNIQUE.format("raw"))
add("i1_check_unique_before_dedupe", lambda c: i.check_unique(c.feed), UNIQUE.format("feed"))
add(
    "i2_check_state_is_max",
    lambda c: i.check_state_is_max(c.raw, c.state),
    "SELECT icao24, max_raw, observed_at AS state_at, max_raw = observed_at AS ok FROM state "
    "JOIN (SELECT icao24, max(observed_at) AS max_raw FROM raw GROUP BY 1) USING (icao24)",
)
add(
    "i4_check_rollup_parity",
    lambda c: i.check_rollup_parity(c.raw, r.country_hour_final(r.country_hour_state(c.feed))),
    "SELECT origin_country, date_trunc('hour', observed_at) AS hour, count(DISTINCT icao24) AS raw_aircraft, "
    "count(DISTINCT icao24) AS rollup_aircraft, true AS ok FROM raw GROUP BY 1, 2",
)
add(
    "i4_final_count",
    lambda c: i.check_final_count(c.feed, dedupe_first(c.feed)),
    "SELECT count(DISTINCT event_id) AS ids, count(DISTINCT event_id) AS final_rows, count(DISTINCT event_id) AS final_ids, true AS ok FROM feed",
)
add(
    "i5_check_pages_cover_once",
    lambda c: i.check_pages_cover_once(reads.paginate(c.raw, 10), c.raw),
    "SELECT count(*) AS served, 0::BIGINT AS missed, 0::BIGINT AS repeated, 0::BIGINT AS unknown FROM raw",
)


def in_sink_order(c: Case):
    """The feed as a sink would hold it that wrote in order of event numbers."""
    number = F.substring("event_id", 25, 12).cast("bigint") * 4
    kind = F.when(C("seq") % 10 > 1, C("seq") % 10 - 1).otherwise(0)
    return c.feed.withColumn("position", number + kind)


add(
    "i6_check_key_order",
    lambda c: i.check_key_order(in_sink_order(c)),
    "SELECT * FROM (SELECT icao24, position, seq, max(seq) OVER (PARTITION BY icao24 ORDER BY position "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS after_seq FROM (SELECT icao24, seq, "
    "substr(event_id, 25)::BIGINT * 4 + CASE WHEN seq % 10 > 1 THEN seq % 10 - 1 ELSE 0 END AS position FROM feed)) WHERE seq < after_seq",
)
add(
    "i7_find_duplicates",
    lambda c: i.find_duplicates(c.feed),
    "SELECT event_id, count(*) AS copies FROM feed GROUP BY 1 HAVING count(*) > 1",
)

LAST = "(SELECT t FROM last_seen)"
add(
    "r1_retain_hot_raw",
    lambda c: keep.retain_hot_raw(c.feed, c.as_of),
    f"SELECT {FIELDS}, seq FROM feed WHERE observed_at >= {LAST} - INTERVAL 7 DAY",
)
add(
    "r2_retain_columnar_raw",
    lambda c: keep.retain_columnar_raw(c.feed, c.as_of, "10"),
    f"SELECT {FIELDS}, seq FROM feed WHERE date_trunc('second', observed_at) >= {LAST} - INTERVAL 10 DAY",
)
add(
    "r3_retain_rollup",
    lambda c: keep.retain_rollup(r.country_hour_final(r.country_hour_state(c.feed)), c.as_of, 9),
    f"SELECT * FROM ({country_hour('raw')}) WHERE hour >= {LAST} - INTERVAL 9 DAY",
    rounded=("avg_velocity_ms", "avg_baro_altitude_m"),
)
add(
    "r4_retain_grid",
    lambda c: keep.retain_grid(r.grid_state(c.feed), c.as_of, 5),
    f"SELECT DISTINCT * FROM ({grid('feed')}) WHERE bucket >= {LAST} - INTERVAL 5 DAY",
)
add(
    "r5_retain_forever",
    lambda c: keep.retain_forever(latest_state(c.feed), c.as_of),
    f"SELECT {FIELDS}, seq FROM latest",
)
