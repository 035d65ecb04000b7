"""Versioned tables: levels of rollups, buckets of state, parts of days."""

from datetime import timedelta

import pytest
from conftest import OBSERVED, at
from pyspark.sql import functions as F

from vantrail.operators import rollups as r
from vantrail.operators.state import latest_state
from vantrail.sources import stores
from vantrail.sources.versions import Conflict, Part, Table


def sorted_rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture
def feed(observations):
    return observations(*[{"event_id": f"e{i}", "icao24": f"a{i * 7 % 23}", "observed_at": at("10:00:00") + timedelta(minutes=i * 11 % 300), "velocity_ms": float(i)} for i in range(120)])


def test_rollup_levels_bound_what_is_read(spark, feed, tmp_path):
    state = r.country_hour_state(feed, dedupe=False)
    table = Table(spark, f"{tmp_path}/rollup", state.schema, "hour")
    for k in range(20):
        stores.add_rollup(table, r.country_hour_state(feed.filter(F.col("seq") % 20 == k), dedupe=False), "main/run", k)
        per_level = [p.level for p in table.snapshot().parts]
        assert all(per_level.count(level) < stores.FANOUT for level in per_level)
        assert len(per_level) <= (stores.FANOUT - 1) * 3
    before = table.snapshot()
    stores.add_rollup(table, r.country_hour_state(feed.filter("seq % 20 = 19"), dedupe=False), "main/run", 19)
    assert table.snapshot() == before
    assert len(table.read().inputFiles()) == len(before.parts) == 2  # 20 = 16 + 4
    assert sorted_rows(r.country_hour_final(table.read())) == sorted_rows(r.country_hour_final(state))


def test_compaction_keeps_grid_states_distinct(spark, feed, tmp_path):
    state = r.grid_state(feed)
    table = Table(spark, f"{tmp_path}/grid", state.schema, "bucket")
    for k in range(5):
        stores.add_rollup(table, r.grid_state(feed.filter(F.col("seq") % 5 <= k)), "main/run", k)
    assert sorted_rows(table.read().distinct()) == sorted_rows(state)


def test_upsert_rewrites_only_touched_buckets(spark, feed, tmp_path):
    table = Table(spark, f"{tmp_path}/state", OBSERVED)
    stores.upsert_buckets(table, feed.filter("seq < 100"), "w", 0, bucket_rows=2)
    first = table.snapshot()
    assert len({(p.depth, p.bucket) for p in first.parts}) == len(first.parts) > 8
    assert sum(2.0**-p.depth for p in first.parts) == 1  # the buckets tile the hashes
    one = feed.filter("seq = 119")
    stores.upsert_buckets(table, one, "w", 1, bucket_rows=2)
    second = table.snapshot()
    files = lambda s: set(table.read(s).inputFiles())
    assert len(files(first) - files(second)) <= 1 and len(set(second.parts) - set(first.parts)) <= 4  # one bucket, which was split
    stores.upsert_buckets(table, feed.filter("seq >= 100"), "w", 2, bucket_rows=2)
    assert sorted_rows(table.read()) == sorted_rows(latest_state(feed))
    assert sorted_rows(table.read(first)) == sorted_rows(latest_state(feed.filter("seq < 100")))


def test_older_rows_and_ties_do_not_move_the_state(spark, observations, tmp_path):
    rows = observations({"event_id": "a", "observed_at": at("10:05:00")}, {"event_id": "b", "observed_at": at("10:05:00")}, {"event_id": "c", "observed_at": at("10:01:00")})
    table = Table(spark, f"{tmp_path}/state", OBSERVED)
    for k in range(3):
        stores.upsert_buckets(table, rows.filter(F.col("seq") == k), "w", k)
    assert [x["event_id"] for x in table.read().collect()] == ["a"]


def test_a_crash_before_the_commit_changes_nothing(spark, feed, tmp_path, monkeypatch):
    table = Table(spark, f"{tmp_path}/state", OBSERVED)
    stores.upsert_buckets(table, feed.filter("seq < 60"), "w", 0)
    held, now = sorted_rows(table.read()), table.snapshot()
    commit = Table.commit
    monkeypatch.setattr(Table, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        stores.upsert_buckets(table, feed.filter("seq >= 60"), "w", 1)
    monkeypatch.setattr(Table, "commit", commit)
    assert sorted_rows(table.read()) == held and table.snapshot() == now
    stores.upsert_buckets(table, feed.filter("seq >= 60"), "w", 1)
    assert sorted_rows(table.read()) == sorted_rows(latest_state(feed))


def test_a_version_cut_off_is_written_again_and_a_second_writer_is_refused(spark, feed, tmp_path):
    table = Table(spark, f"{tmp_path}/t", OBSERVED)
    (tmp_path / "t/versions/version=1/_temporary").mkdir(parents=True)
    base = table.snapshot()
    assert base.version == 0
    table.commit(base, add=table.write(feed), applied=("w", 0))
    assert table.read().count() == 120
    with pytest.raises(Conflict):
        table.commit(base, add=[Part("x")])


def test_empty_batches_and_tables(spark, feed, tmp_path):
    table = Table(spark, f"{tmp_path}/t", OBSERVED, "observed_at")
    none = feed.filter("false")
    stores.append_days(table, none, "w", 0)
    stores.upsert_buckets(table, none, "v", 0)
    stores.add_rollup(table, none, "u", 0)
    assert table.read().count() == 0 and dict(table.snapshot().applied) == {"w": 0, "v": 0, "u": 0}


def test_expire_drops_parts_and_rewrites_the_border(spark, observations, tmp_path):
    days = observations(*[{"event_id": f"e{i}", "observed_at": at("2025-01-01T09:00:00") + timedelta(hours=6 * i)} for i in range(16)])
    table = Table(spark, f"{tmp_path}/raw", OBSERVED, "observed_at")
    stores.append_days(table, days, "w", 0)
    before = table.snapshot()
    assert len(before.parts) == 5
    limit = at("2025-01-03T09:00:00")
    stores.expire(table, limit)
    after = table.snapshot()
    untouched = {p.name for p in before.parts if p.low >= limit.replace(tzinfo=None) and p.low.day > 3}
    assert untouched and untouched < {p.name for p in after.parts} and len(after.parts) == len(untouched) + 1
    assert sorted_rows(table.read()) == sorted_rows(days.filter(F.col("observed_at") >= F.lit(limit)))
    assert stores.expire(table, limit) == after
    assert table.read(before).count() == 16


def test_reads_between_times_open_only_their_parts(spark, observations, tmp_path):
    days = observations(*[{"event_id": f"e{i}", "observed_at": at("2025-01-01T09:00:00") + timedelta(hours=6 * i)} for i in range(16)])
    table = Table(spark, f"{tmp_path}/raw", OBSERVED, "observed_at")
    stores.append_days(table, days, "w", 0)
    found = table.between(at("2025-01-02T00:00:00"), at("2025-01-03T00:00:00"))
    assert found.count() == 4 and len(found.inputFiles()) == 1


def test_vacuum_keeps_pinned_versions(spark, feed, tmp_path):
    table = Table(spark, f"{tmp_path}/state", OBSERVED)
    for k in range(4):
        stores.upsert_buckets(table, feed.filter(F.col("seq") % 4 == k), "w", k)
    pinned = table.snapshot(3)
    table.vacuum(keep=2, hours=24)
    assert table.versions() == [1, 2, 3, 4]  # too young to go
    table.vacuum(keep=2, hours=-1)
    assert table.versions() == [3, 4]
    assert sorted_rows(table.read(pinned)) == sorted_rows(latest_state(feed.filter("seq % 4 < 3")))
    assert sorted_rows(table.read()) == sorted_rows(latest_state(feed))
    with pytest.raises(ValueError, match="does not exist"):
        table.snapshot(1)
    assert len(list((tmp_path / "state/data").iterdir())) == 2


def test_lake_parts_are_merged_and_pruned(spark, observations, tmp_path):
    countries = ["FR", "a/b=c d", "DE", "ÄÖ"]
    rows = observations(*[{"event_id": f"e{i}", "origin_country": countries[i % 4], "observed_at": at("2025-01-01T09:00:00") + timedelta(hours=i)} for i in range(96)])
    table = Table(spark, f"{tmp_path}/lake", OBSERVED, "observed_at")
    for k in range(6):
        stores.append_lake(table, rows.filter(F.col("seq") % 6 == k), "w", k, fanout=3)
    before = table.snapshot()
    stores.append_lake(table, rows.filter("seq % 6 = 5"), "w", 5, fanout=3)
    assert table.snapshot() == before
    assert sorted_rows(table.read()) == sorted_rows(rows)
    groups = [(p.tag, p.low.date()) for p in before.parts]
    assert all(groups.count(g) < 3 for g in groups), "no day and country is left in many small files"
    found = stores.read_lake_parts(table, at("2025-01-02T00:00:00"), at("2025-01-03T00:00:00"), ["a/b=c d"])
    want = rows.filter((F.col("origin_country") == "a/b=c d") & (F.to_date("observed_at") == F.lit("2025-01-02").cast("date")))
    assert sorted_rows(found) == sorted_rows(want) and found.count() == 6
    assert len(found.inputFiles()) * 20 <= len(table.read().inputFiles()) * 2  # a tenth of the files at most
    stores.compact_lake(table, fanout=2)
    assert len(table.snapshot().parts) == 20 and sorted_rows(table.read()) == sorted_rows(rows)  # five days, four countries


def test_columnar_rows_collapse_as_they_merge(spark, observations, tmp_path):
    rows = observations(*[{"event_id": f"e{i % 7}", "velocity_ms": float(i)} for i in range(28)])
    table = Table(spark, f"{tmp_path}/columnar", OBSERVED, "observed_at")
    for k in range(4):
        stores.append_collapsing(table, rows.filter(F.col("seq") % 4 == k), "w", k)
        assert sorted(r["seq"] for r in stores.read_collapsed(table).collect()) == sorted({i % 7: i for i in range(28) if i % 4 <= k}.values())
    assert table.read().count() == 7  # the fourth part filled the level


def test_bitmaps_count_each_aircraft_once(spark, observations):
    ids = ["000000", "000001", "007fff", "008000", "ffffff", "abcdef"]
    rows = observations(*[{"icao24": ids[i % 6], "origin_country": "GB" if i % 3 else "FR"} for i in range(40)])
    halves = [rows.filter(F.col("seq") % 2 == k) for k in (0, 1)]
    state = r.merge_bitmaps(*map(r.distinct_bitmap_state, halves), r.distinct_bitmap_state(halves[0]))
    got = {(x["origin_country"], x["active_aircraft"]) for x in r.distinct_bitmap_final(state).collect()}
    assert got == {("FR", 2), ("GB", 4)}
