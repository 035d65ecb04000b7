"""Small buckets share folders, keys share calls, and pages share a job."""

from datetime import timedelta

import pandas as pd
from conftest import OBSERVED, at
from pyspark.sql import functions as F, types as T

from vantrail.operators import pinned, reads
from vantrail.operators.state import latest_state
from vantrail.sources import stores
from vantrail.sources.versions import Table
from vantrail.streaming.stateful import _Latest


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def fleet(spark, n):
    columns = {f.name: F.lit(None).cast(f.dataType) for f in OBSERVED.fields}
    columns |= {"event_id": F.concat(F.lit("e"), "id"), "icao24": F.lpad(F.hex(F.col("id") % 1200), 6, "0"), "seq": F.col("id")}
    columns |= {"observed_at": F.timestamp_seconds(F.lit(1_735_689_600) + F.col("id") * 7919 % 86_400)}
    return spark.range(n).select(*[columns[f.name].alias(f.name) for f in OBSERVED.fields])


def test_many_small_buckets_lie_in_few_folders(spark, tmp_path):
    feed, table = fleet(spark, 4800), Table(spark, f"{tmp_path}/state", OBSERVED, "observed_at")
    versions = []
    for k, batch in enumerate([feed.filter("seq < 2400"), feed.filter("seq = 2400"), feed.filter("seq between 2401 and 2700"), feed.filter("seq > 2700")]):
        versions.append(stores.upsert_buckets(table, batch, "w", k, bucket_rows=4))
        until = [2400, 2401, 2701, 4800][k]
        assert sum(2.0**-p.depth for p in versions[-1].parts) == 1
        assert rows_of(table.read()) == rows_of(latest_state(feed.filter(F.col("seq") < until)))
    first, second = versions[:2]
    assert len(first.parts) > 256 and len({p.name for p in first.parts if p.name}) <= 64
    assert len(set(second.parts) - set(first.parts)) <= 4  # one row rewrites one bucket
    for v in versions:  # no folder has more idle rows than live ones
        for name in {p.name for p in v.parts if p.name}:
            its = [p for p in v.parts if p.name == name]
            assert 2 * sum(p.rows for p in its) >= its[0].stored
    assert rows_of(table.read(first)) == rows_of(latest_state(feed.filter("seq < 2400")))


def test_all_further_pages_in_one_job_are_those_of_a_walk(spark, tmp_path):
    feed, as_of = fleet(spark, 1200), at("2025-01-02T00:00:00")
    table = Table(spark, f"{tmp_path}/state", OBSERVED, "observed_at")
    stores.upsert_buckets(table, feed, "w", 0)
    walked, token = [], None
    while token is not None or not walked:
        page, token = pinned.active_page_at(table, as_of, token, limit=250, minutes=1440)
        walked.append([r["icao24"] for r in page.collect()])
        if len(walked) == 1:
            begin = token
            stores.upsert_buckets(table, feed.withColumn("observed_at", F.col("observed_at") + timedelta(hours=1)), "w", 1)
    rest = pinned.active_pages_at(table, as_of, begin, limit=250, minutes=1440).orderBy(F.desc("observed_at"), F.desc("icao24")).collect()
    assert [[r["icao24"] for r in rest if r["page"] == k] for k in range(len(walked) - 1)] == walked[1:]
    assert reads.active_pages(feed.limit(0), as_of).count() == 0


def test_a_call_takes_all_keys_of_a_group():
    class Held(dict):
        getValue, updateValue = dict.get, dict.__setitem__

    processor = _Latest("k", T.StringType(), "at", "seq", ["k", "at", "seq"])
    processor.held = Held({("a",): (10, 0), ("b",): (5, 1)})
    frames = [pd.DataFrame({"k": ["a", "b", None], "at": [10, 6, 1], "seq": [2, 4, 5], "_group": 0}), pd.DataFrame({"k": ["b", "c", "b"], "at": [6, 1, 4], "seq": [3, 6, 7], "_group": 0})]
    [out] = processor.handleInputRows((0,), iter(frames), None)
    assert sorted(out["seq"]) == [3, 5, 6] and list(out.columns) == ["k", "at", "seq"]
    assert processor.held == {("a",): (10, 0), ("b",): (6, 3), ("c",): (1, 6), (None,): (1, 5)}
    assert list(processor.handleInputRows((0,), iter(frames), None)) == []
