import glob
from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F, types as T

from vantrail.operators import retention
from vantrail.sources import lake


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """One day and country holds half of all rows."""
    path = str(tmp_path_factory.mktemp("lake") / "t")
    n = F.col("id")
    rows = spark.range(4000).select(
        F.concat(F.lit("e"), n.cast("string")).alias("event_id"),
        F.when(n % 2 == 0, "GB").otherwise(F.concat(F.lit("C"), (n % 3).cast("string"))).alias("origin_country"),
        F.timestamp_seconds(F.lit(1735689600) + F.when(n % 2 == 0, n % 7919).otherwise(n * 60)).alias("observed_at"),
        (n * 1.5).alias("velocity_ms"),
    )
    lake.write_lake(rows, path, files=6)
    return path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruning_and_pushdown(spark, stored):
    day = at("2025-01-01T00:00:00")
    df = lake.read_lake(spark, stored, day, day + timedelta(hours=1), ["GB"]).select("event_id", "observed_at")
    plan = plan_of(df)
    assert "isnotnull(observed_day" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "origin_country" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(observed_at" in plan.split("PushedFilters:")[1]
    assert "velocity_ms" not in plan.split("ReadSchema:")[1]
    assert df.count() == spark.range(4000).filter((F.col("id") % 2 == 0) & (F.col("id") % 7919 < 3600)).count()


def test_large_day_is_spread_and_time_clustered(spark, stored):
    files = glob.glob(f"{stored}/observed_day=2025-01-01/origin_country=GB/*.parquet")
    assert len(files) >= 3
    spans = []
    for f in files:
        rows = [r[0] for r in spark.read.parquet(f).select("observed_at").collect()]
        assert rows == sorted(rows)
        spans.append((rows[0], rows[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_sql_is_always_capped(spark, stored):
    table = lake.read_lake(spark, stored)
    assert lake.lake_sql(spark, table, "SELECT 'limit' AS word, * FROM telemetry", 7).count() == 7
    assert lake.lake_sql(spark, table, "SELECT * FROM telemetry").count() == 4000


def test_evolve(spark):
    old = spark.createDataFrame([("a", 1)], "event_id string, n int")
    new = T.StructType().add("event_id", T.StringType()).add("n", T.LongType()).add("extra", T.DoubleType())
    assert lake.evolve_to(old, new).first().asDict() == {"event_id": "a", "n": 1, "extra": None}
    assert lake.evolve_to(old, new, {"extra": 2}).first()["extra"] == 2.0
    with pytest.raises(ValueError):
        lake.evolve_to(old, T.StructType().add("must", T.StringType(), False))


def test_retention_limits(observations):
    df = observations({"observed_at": at("2025-01-01T10:00:00")}, {"observed_at": at("2025-01-01T09:59:59.999999")})
    now = at("2025-01-08T10:00:00")
    assert [r["event_id"] for r in retention.retain_hot_raw(df, now).collect()] == ["e0"]
    for bad in ("", "7; drop", "-1", "1.5"):
        with pytest.raises(ValueError):
            retention.days_of(bad)
    assert retention.retain_forever(df, now).count() == 2
    seconds = observations({"observed_at": at("2025-01-01T10:00:00.5")})
    assert retention.retain_columnar_raw(seconds, at("2025-01-08T10:00:00.7"), 7).count() == 0
