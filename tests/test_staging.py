"""Arrivals are computed once, however many rounds or batches they are read in."""

from pyspark.sql import functions as F

from vantrail.operators.rollups import country_hour_final, country_hour_state
from vantrail.plans.catalog import Case
from vantrail.plans.catalog_stores import slices
from vantrail.plans.staging import replay, stage
from vantrail.sources import stores
from vantrail.sources.versions import Table
from vantrail.streaming import sinks

from conftest import OBSERVED, SF, at


def test_replay_computes_the_arrivals_once(spark, observations, tmp_path):
    rows = observations(*[{"event_id": f"e{i}", "observed_at": at("10:00:00")} for i in range(40)])
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    got = []

    def begin(stream):
        sink = lambda batch, k: got.append(sorted(r["seq"] for r in batch.collect()))
        return [stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/marks").trigger(availableNow=True).start()]

    replay(spark, rows.mapInPandas(counted, OBSERVED), begin, rounds=5)
    assert got == [list(range(k, k + 8)) for k in range(0, 40, 8)]
    assert seen.value <= 2 * 40  # the ends, and the one copy


def test_pieces_of_staged_arrivals(spark, observations):
    rows = observations(*[{"event_id": f"e{i}"} for i in range(10)])
    staged = stage(rows, [0, 4, 7, 50])
    numbers = lambda df: sorted(r["seq"] for r in df.collect())
    assert numbers(staged.read(4)) == [4, 5, 6, 7, 8, 9] and numbers(staged.read(4, 7)) == [4, 5, 6]
    assert numbers(staged.read(50)) == numbers(staged.read(until=0)) == []


def test_slices_are_read_from_what_was_written(spark):
    c = Case(spark, SF)
    parts = slices(c, 4)
    assert not any("events.parquet" in f for part in parts for f in part.inputFiles())
    assert sum(part.count() for part in parts) == c.feed.count()


def test_a_batch_that_is_written_once_is_not_kept(spark, observations, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(sinks, "append_columnar", lambda batch, *a: kept.append(batch.storageLevel.useMemory))
    monkeypatch.setattr(sinks, "add_rollup", lambda table, state, *a: kept.append(batch.storageLevel.useMemory))
    batch = observations({"event_id": "e"})
    sinks.columnar_sink(str(tmp_path), rollups=())(batch, 0)
    sinks.leveled_rollup_sink(str(tmp_path), rollups=("country",))(batch, 0)
    assert kept == [False, False]


def test_lake_rows_are_computed_as_often_as_they_are_placed(spark, observations, tmp_path):
    """Once for the borders and once for the files; the names of the groups come from the folders."""
    countries = ["FR", "a/b=c d", "ÄÖ"]
    rows = observations(*[{"event_id": f"e{i}", "origin_country": countries[i % 3]} for i in range(30)])
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    table = Table(spark, f"{tmp_path}/lake", OBSERVED, "observed_at")
    stores.append_lake(table, rows.mapInPandas(counted, OBSERVED), "w", 0)
    assert sorted(p.tag for p in table.snapshot().parts) == sorted(countries)
    assert stores.read_lake_parts(table, tags=["ÄÖ"]).filter(F.col("origin_country") == "ÄÖ").count() == 10
    assert seen.value <= 3 * 30  # borders may be sampled a second time where rows are uneven


def test_a_piece_lies_in_many_files(spark):
    """Arrivals in one task, in order, as a scan of a sorted table gives them: each piece is still read by several tasks."""
    staged = stage(spark.range(0, 500_000, 1, 1).withColumnRenamed("id", "seq"), [0, 250_000])
    assert all(len(piece.inputFiles()) >= 3 for piece in (staged.read(until=250_000), staged.read(250_000)))
    assert staged.read().agg(F.count_distinct("seq")).first()[0] == 500_000


def test_a_batch_of_files_is_read_again_not_kept(spark, observations, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(sinks, "append_raw", lambda batch, *a: kept.append(batch.storageLevel.useMemory))
    monkeypatch.setattr(sinks, "upsert_state", lambda batch, *a: kept.append(batch.storageLevel.useMemory))
    batch = observations({"event_id": "e"})
    sinks.operational_sink(str(tmp_path), keep=False)(batch, 0)
    sinks.operational_sink(str(tmp_path))(batch, 1)
    assert kept == [False, False, True, True]


def test_a_rollup_state_is_shuffled_by_its_keys_only(spark, observations, tmp_path, monkeypatch):
    """Neither a batch nor a merge of levels goes through a second shuffle before it is written."""
    state = country_hour_state(observations(*[{"event_id": f"e{i}"} for i in range(10)]), dedupe=False)
    hints, hint = [], type(state).hint
    monkeypatch.setattr(type(state), "hint", lambda df, name, *a: hints.append(name) or hint(df, name, *a))
    table = Table(spark, f"{tmp_path}/levels", state.schema, "hour")
    for k in range(4):
        stores.add_rollup(table, state, "w", k)
    assert [p.level for p in table.snapshot().parts] == [1] and hints == []
    assert country_hour_final(table.read()).count() == 1
