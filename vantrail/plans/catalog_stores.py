"""Versioned tables: many batches, restarts and merges against one pass of SQL."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from vantrail.operators import pinned, rollups as r
from vantrail.plans.catalog import Case
from vantrail.plans.catalog_checks import LAST
from vantrail.plans.catalog_streams import SEEN, add, run, run_with_new_checkpoint
from vantrail.plans.oracle import airline_hour, country_hour, grid_final
from vantrail.plans.staging import ends, replay, stage, steps
from vantrail.session import shared_folder
from vantrail.sources import stores
from vantrail.sources.versions import Table
from vantrail.streaming import jobs, sinks, stateful

C = F.col
#: Few enough rows a bucket that the tables here split theirs several times.
SMALL_BUCKET = 40


def slices(c: Case, n: int, columns: Sequence[str] = ("*",)) -> list[DataFrame]:
    """The feed as ``n`` batches in arrival order, computed and written once; only ``columns``, with ``seq``."""
    cuts = steps(*ends(c.feed), n)
    staged = stage(c.feed.select(*columns), cuts)
    return [staged.read(since, until) for since, until in zip(cuts, [*cuts[1:], None], strict=True)]


def many_batches(c: Case) -> DataFrame:
    """Twenty batches into a leveled rollup, the last one twice, and a merge of what is left."""
    sink, root = None, shared_folder(c.spark, "tables")
    sink = sinks.leveled_rollup_sink(root, rollups=("country",))
    parts = slices(c, 20, ("seq", "icao24", "origin_country", "observed_at", *r.COUNTRY_INPUT))
    for k, batch in enumerate([*parts, parts[-1]]):
        sink(batch, min(k, 19))
    table = level_table(c, root, "country", r.country_hour_state(c.feed))
    stores.compact(table, fanout=2)
    return r.country_hour_final(table.read())


def level_table(c: Case, root: str, name: str, state: DataFrame) -> Table:
    return Table(c.spark, f"{root}/levels_{name}", state.schema, "bucket" if name == "grid" else "hour")


def leveled(name: str):
    def maker(root: str):
        return sinks.leveled_rollup_sink(root, rollups=(name,))

    return {"columnar": maker}


add("a8_leveled_rollup", many_batches, country_hour("feed"))
add(
    "t10_leveled_rollups",
    lambda c: r.country_hour_final(level_table(c, run(c, leveled("country")), "country", r.country_hour_state(c.feed)).read()),
    country_hour("feed"),
)
add(
    "t10_leveled_rollups_airline",
    lambda c: r.airline_hour_final(level_table(c, run(c, leveled("airline")), "airline", r.airline_hour_state(c.feed)).read()),
    airline_hour("feed"),
)
add(
    "t10_leveled_rollups_grid",
    lambda c: r.grid_final(level_table(c, run(c, leveled("grid")), "grid", r.grid_state(c.feed)).read()),
    grid_final("feed"),
)


def bucketed(root: str):
    return sinks.bucketed_state_sink(root, bucket_rows=SMALL_BUCKET)


def bucket_table(c: Case, root: str) -> Table:
    return Table(c.spark, f"{root}/buckets", c.feed.schema, "observed_at")


add("s8_bucketed_state", lambda c: bucket_table(c, run(c, {"operational": bucketed})).read(), f"SELECT {SEEN} FROM latest")
add(
    "s8_bucketed_state_new_checkpoint",
    lambda c: bucket_table(c, run_with_new_checkpoint(c, {"operational": bucketed})).read(),
    f"SELECT {SEEN} FROM latest",
)


def pages_of_a_moving_table(c: Case) -> DataFrame:
    """All pages of the state as the first page saw it, while two more batches are committed: between the first two pages, and before the rest."""
    root = shared_folder(c.spark, "tables")
    sink = bucketed(root)
    batches = slices(c, 3)
    sink(batches[0], 0)
    table, token, page_size = bucket_table(c, root), None, {"limit": 1000, "minutes": 60 * 24 * 400}
    pages = []
    for k, batch in enumerate(batches[1:]):
        if k == 0 or token is not None:
            page, token = pinned.active_page_at(table, c.as_of, token, **page_size)
            pages.append(page.withColumn("page", F.lit(k)))
        sink(batch, k + 1)
    if token is not None:
        rest = pinned.active_pages_at(table, c.as_of, token, **page_size)
        pages.append(rest.withColumn("page", C("page") + len(pages)))
    every = pages[0]
    for page in pages[1:]:
        every = every.unionByName(page)
    return every.select("icao24", "event_id", "observed_at", "seq", "page")


add(
    "q2_pinned_pages",
    pages_of_a_moving_table,
    "SELECT icao24, event_id, observed_at, seq, ((row_number() OVER (ORDER BY observed_at DESC, icao24 DESC) - 1) // 1000)::INT AS page FROM ("
    "SELECT * FROM feed WHERE seq < (SELECT min(seq) + (max(seq) - min(seq)) // 3 + 1 FROM feed) "
    "QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, seq) = 1)",
)


def day_table(c: Case, root: str) -> Table:
    return Table(c.spark, f"{root}/days", c.feed.schema, "observed_at")


def expired(days: int):
    def build(c: Case) -> DataFrame:
        table = day_table(c, run(c, {"columnar": sinks.day_sink}))
        stores.expire(table, c.as_of - timedelta(days=days))
        return table.read()

    return build


def expired_rollup(c: Case) -> DataFrame:
    table = level_table(c, run(c, leveled("country")), "country", r.country_hour_state(c.feed))
    stores.expire(table, c.as_of - timedelta(days=9))
    return r.country_hour_final(table.read())


def expired_grid(c: Case) -> DataFrame:
    table = level_table(c, run(c, leveled("grid")), "grid", r.grid_state(c.feed))
    stores.expire(table, c.as_of - timedelta(days=5))
    return r.grid_final(table.read())


add("r1_expired_days", expired(7), f"SELECT {SEEN} FROM feed WHERE observed_at >= {LAST} - INTERVAL 7 DAY")
add("r3_expired_rollup", expired_rollup, f"SELECT * FROM ({country_hour('feed')}) WHERE hour >= {LAST} - INTERVAL 9 DAY")
add("r4_expired_grid", expired_grid, f"SELECT * FROM ({grid_final('feed')}) WHERE bucket >= {LAST} - INTERVAL 5 DAY")


def keyed_state(c: Case) -> DataFrame:
    """The changes that keyed stream state gives out, with restarts, put into the bucketed state."""
    root, marks = shared_folder(c.spark, "tables"), shared_folder(c.spark, "marks")
    with jobs.rocksdb(c.spark):
        replay(c.spark, c.feed, lambda stream: [jobs.start(stateful.stream_latest_state(stream), "operational", bucketed(root), marks, drain=True)])
    return bucket_table(c, root).read()


add("t8_keyed_latest_state", keyed_state, f"SELECT {SEEN} FROM latest")


def exact_ids(c: Case) -> DataFrame:
    """Ids behind the exact dedupe: those of recent events by the state alone, older ones by the table."""
    root, marks = shared_folder(c.spark, "tables"), shared_folder(c.spark, "marks")
    arrivals = c.feed.withColumn("ingested_at", F.timestamp_millis(F.unix_millis(F.lit(c.as_of)) + C("seq")))
    with jobs.rocksdb(c.spark):
        replay(c.spark, arrivals, lambda stream: [jobs.start(stateful.exact_dedupe(stream), "operational", stateful.exact_dedupe_sink(root), marks, drain=True)])
    return c.spark.read.parquet(f"{root}/raw").select("event_id", "icao24")


add("t9_exact_dedupe", exact_ids, "SELECT DISTINCT event_id, icao24 FROM feed")


def collapsing_table(c: Case) -> Table:
    """Five batches of deliveries, the third one twice."""
    table = Table(c.spark, f"{shared_folder(c.spark, 'tables')}/columnar", c.feed.schema, "observed_at")
    parts = slices(c, 5)
    for k in (0, 1, 2, 2, 3, 4):
        stores.append_collapsing(table, parts[k], "columnar/direct", k)
    return table


def merged_rows(c: Case) -> DataFrame:
    table = collapsing_table(c)
    stores.collapse_all(table)
    return table.read()


COLLAPSED = f"SELECT {SEEN} FROM feed QUALIFY row_number() OVER (PARTITION BY icao24, observed_at, event_id ORDER BY seq DESC) = 1"
add("d3_stored_before_merge", lambda c: stores.read_collapsed(collapsing_table(c)), COLLAPSED)
add("d3_stored_after_merge", merged_rows, COLLAPSED)


def lake_table(c: Case) -> Table:
    table = Table(c.spark, f"{shared_folder(c.spark, 'tables')}/lake", c.feed.schema, "observed_at")
    for k, batch in enumerate(slices(c, 4)):
        stores.append_lake(table, batch, "lake/direct", k)
    return table


add("s10_lake_parts", lambda c: lake_table(c).read(), f"SELECT {SEEN} FROM feed")
add(
    "s11_lake_parts_pruned",
    lambda c: stores.read_lake_parts(lake_table(c), c.as_of - timedelta(days=7), None, ["NATION_3"]),
    f"SELECT {SEEN} FROM feed WHERE origin_country = 'NATION_3' AND observed_at >= {LAST} - INTERVAL 7 DAY",
)


def bitmaps(c: Case) -> DataFrame:
    return r.distinct_bitmap_final(r.merge_bitmaps(*[r.distinct_bitmap_state(batch) for batch in slices(c, 3)]))


add(
    "a10_distinct_bitmaps",
    bitmaps,
    "SELECT origin_country, date_trunc('hour', observed_at) AS hour, count(DISTINCT icao24) AS active_aircraft FROM feed GROUP BY 1, 2",
)
