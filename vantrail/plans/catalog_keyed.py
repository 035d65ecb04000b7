"""Dedupe contracts, latest state and reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantrail.functions import cursor_token
from vantrail.operators import dedupe, reads, state
from vantrail.plans.catalog import Case, add
from vantrail.plans.oracle import FIELDS, token

SEEN = f"{FIELDS}, seq"
C = F.col

add("d1_dedupe_first", lambda c: dedupe.dedupe_first(c.feed), f"SELECT {SEEN} FROM raw")
add(
    "d2_dedupe_in_batch",
    lambda c: dedupe.dedupe_in_batch(c.feed.withColumn("flush", F.floor(C("seq") / 1000)), "flush"),
    f"SELECT {SEEN}, seq // 1000 AS flush FROM feed "
    "QUALIFY row_number() OVER (PARTITION BY seq // 1000, event_id ORDER BY seq) = 1",
)
add(
    "d3_collapse_versions",
    lambda c: dedupe.collapse_versions(c.feed),
    f"SELECT {SEEN} FROM feed QUALIFY row_number() OVER (PARTITION BY icao24, observed_at, event_id ORDER BY seq DESC) = 1",
)
add(
    "d4_read_time_distinct",
    lambda c: dedupe.read_time_distinct(
        dedupe.dedupe_in_batch(c.feed.withColumn("flush", F.floor(C("seq") / 1000)), "flush"), order="seq"
    ).drop("flush"),
    f"SELECT {SEEN} FROM raw",
)

add("u1_latest_state", lambda c: state.latest_state(c.feed), f"SELECT {SEEN} FROM latest")


def two_batches(c: Case):
    """The feed cut in the middle of its arrivals."""
    middle = c.feed.agg(F.max("seq")).first()[0] // 2
    return c.feed.filter(C("seq") < middle), c.feed.filter(C("seq") >= middle)


def merged(c: Case):
    early, late = two_batches(c)
    return state.merge_state(state.latest_state(early), late)


add("u2_merge_state", merged, f"SELECT {SEEN} FROM latest")

OUTCOMES = """
SELECT event_id, icao24, observed_at, seq,
  row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1 AS raw_inserted,
  coalesce(observed_at > max(observed_at) OVER (PARTITION BY icao24 ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS state_updated
FROM feed"""
add("u3_apply_outcomes", lambda c: state.apply_outcomes(c.feed), OUTCOMES)


def outcomes_on_tables(c: Case):
    early, late = two_batches(c)
    return state.apply_outcomes(late, dedupe.dedupe_first(early), state.latest_state(early), slice_width=5_000)


add(
    "u3_apply_outcomes_on_tables",
    outcomes_on_tables,
    f"SELECT * FROM ({OUTCOMES}) WHERE seq >= (SELECT max(seq) // 2 FROM feed)",
)
add(
    "u4_project_state",
    lambda c: state.project_state(state.latest_state(c.feed), F.lit(c.as_of)),
    "SELECT *, (SELECT t FROM last_seen) AS updated_at FROM state",
)

# Wanted: every customer number as an aircraft id; most have no state.
wanted = lambda c: c.spark.read.parquet(f"{c.sf_dir}/customer.parquet").select(
    F.lpad(F.lower(F.hex("c_custkey")), 6, "0").alias("icao24")
)
WANTED = "(SELECT printf('%06x', c_custkey) AS icao24 FROM customer)"
add("q1_lookup_state", lambda c: reads.lookup_state(c.state, wanted(c))[0], f"SELECT * FROM state WHERE icao24 IN {WANTED}")
add(
    "q1_lookup_not_found",
    lambda c: reads.lookup_state(c.state, wanted(c))[1],
    f"SELECT DISTINCT icao24 FROM {WANTED} WHERE icao24 NOT IN (SELECT icao24 FROM state)",
)


def paged_sql(source: str, where: str, row_id: str, size: int, page: int) -> str:
    """Page number ``page`` of a listing by row numbers, with its cursor."""
    first, last = page * size + 1, (page + 1) * size
    return (
        f"SELECT * EXCLUDE (rn, total), CASE WHEN rn = {last} AND total > {last} THEN {token('observed_at', row_id)} END AS next_cursor "
        f"FROM (SELECT *, row_number() OVER (ORDER BY observed_at DESC, {row_id} DESC) AS rn, count(*) OVER () AS total "
        f"FROM (SELECT * FROM {source} WHERE {where})) WHERE rn BETWEEN {first} AND {last}"
    )


def last_cursor(page):
    """The cursor a client would send next."""
    return page.filter(C("next_cursor").isNotNull()).first()["next_cursor"]


DAY = "observed_at >= (SELECT t FROM last_seen) - INTERVAL 1440 MINUTE"
add("q2_active_page", lambda c: reads.active_page(c.state, c.as_of, limit=5, minutes=1440), paged_sql("state", DAY, "icao24", 5, 0))
add(
    "q2_active_page_next",
    lambda c: reads.active_page(
        c.state, c.as_of, cursor=last_cursor(reads.active_page(c.state, c.as_of, limit=5, minutes=1440)), limit=5, minutes=1440
    ),
    paged_sql("state", DAY, "icao24", 5, 1),
)
WEEKS = "observed_at >= (SELECT t FROM last_seen) - INTERVAL 43200 MINUTE AND origin_country = 'NATION_3'"
add(
    "q2_active_page_country",
    lambda c: reads.active_page(c.state, c.as_of, "NATION_3", limit=3, minutes=43200),
    paged_sql("state", WEEKS, "icao24", 3, 0),
)
TRACK = f"(SELECT {SEEN} FROM raw)"
add("q3_track_page", lambda c: reads.track_page(c.raw, "000003", limit=10), paged_sql(TRACK, "icao24 = '000003'", "event_id", 10, 0))
add(
    "q3_track_page_next",
    lambda c: reads.track_page(c.raw, "000003", last_cursor(reads.track_page(c.raw, "000003", limit=10)), 10),
    paged_sql(TRACK, "icao24 = '000003'", "event_id", 10, 1),
)
add(
    "q4_tracks_top_n",
    lambda c: reads.tracks_top_n(c.raw, 20),
    f"SELECT {SEEN} FROM raw QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, event_id DESC) <= 20",
)
PAGES = (
    f"SELECT {SEEN}, rn AS rank, (rn - 1) // 10 AS page, CASE WHEN rn % 10 = 0 AND rn < total THEN {token('observed_at', 'event_id')} END AS next_cursor "
    "FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, event_id DESC) AS rn, "
    "count(*) OVER (PARTITION BY icao24) AS total FROM raw)"
)
add("q5_paginate", lambda c: reads.paginate(c.raw, 10), PAGES)
# Narrow slices, as for aircraft with very many rows.
add("q5_paginate_large_keys", lambda c: reads.paginate(c.raw, 10, slice_seconds=3600), PAGES)
add(
    "q4_tracks_top_n_large",
    lambda c: reads.tracks_top_n(c.raw, 1500),
    f"SELECT {SEEN} FROM raw QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, event_id DESC) <= 1500",
)
add(
    "q6_cursor_token",
    lambda c: c.raw.select("event_id", cursor_token(C("observed_at"), C("event_id")).alias("token")),
    f"SELECT event_id, {token('observed_at', 'event_id')} AS token FROM raw",
)
