"""The skew-proof forms equal brute force when one key has a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from vantrail.operators import ranking
from vantrail.operators.dedupe import dedupe_first


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", i, rng.randrange(200)) for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "key string, seq bigint, value int").repartition(6).cache()


@pytest.mark.parametrize("width", [1, 37, 1000, 10**6])
def test_running_max(skewed, width):
    rows, df = skewed
    best, want = {}, {}
    for key, seq, value in sorted(rows, key=lambda r: r[1]):
        want[seq] = best.get(key)
        best[key] = max(value, best.get(key, value))
    got = ranking.running_max_before(df, "key", "seq", "value", "top", width)
    assert {r["seq"]: r["top"] for r in got.collect()} == want


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_ranked(skewed, width):
    rows, df = skewed
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))
        want.update({r[1]: (i, len(mine)) for i, r in enumerate(mine, 1)})
    got = ranking.ranked(df, "key", [F.desc("value"), F.asc("seq")], F.floor(F.col("value") / width))
    assert {r["seq"]: (r["rank"], r["total"]) for r in got.collect()} == want


def test_large_key_is_spread(skewed, spark):
    """Range slices hold about the same number of rows, whatever the key."""
    _, df = skewed
    place = [F.col("key"), F.desc("value"), F.asc("seq")]
    sizes = df.repartitionByRange(6, *place).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 1000


def test_limit_before_the_shuffle(skewed):
    _, df = skewed
    plan = dedupe_first(df, "key")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(key") :]
    assert "WindowGroupLimit" in below and "Partial" in below
