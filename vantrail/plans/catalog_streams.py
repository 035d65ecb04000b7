"""Streaming jobs. Each replays the whole feed as several micro-batches with
restarts, and the result must equal the batch SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from vantrail.operators import rollups as r
from vantrail.operators.invariants import table_difference
from vantrail.plans.catalog import add as add_query, Case
from vantrail.plans.catalog_ingest import SIZE, damaged_topic
from vantrail.plans.oracle import FIELDS, airline_hour, country_hour, grid_final
from vantrail.plans.staging import ends, replay, replay_staged, stage, steps
from vantrail.schema import TELEMETRY_COLUMNS
from vantrail.session import shared_folder
from vantrail.sources import tables, topic, wire
from vantrail.sources.lake import read_lake
from vantrail.streaming import jobs, metrics, sinks

C = F.col
#: Sums and means of speeds and heights, whose last digit depends on the order of the rows.
add = partial(add_query, rounded=("avg_velocity_ms", "avg_baro_altitude_m", "sum_velocity_ms", "sum_baro_altitude_m", "share", "velocity_before", "velocity_change"))
SEEN = f"{FIELDS}, seq"


def run(c: Case, make: dict, arrivals: DataFrame | None = None) -> str:
    """Replay through sinks given as name -> maker(root), under new checkpoints; returns their root."""
    root = shared_folder(c.spark, "tables")
    replay(c.spark, c.feed if arrivals is None else arrivals, fresh_start(c, make, root))
    return root


def fresh_start(c: Case, make: dict, root: str):
    """Starts the sinks on a stream, under checkpoints of their own."""
    marks, built = shared_folder(c.spark, "marks"), {name: maker(root) for name, maker in make.items()}
    return lambda stream: jobs.start_fanout(stream, built, marks, drain=True)


def run_with_new_checkpoint(c: Case, make: dict) -> str:
    """All arrivals, then from the start again and from a later offset, each time under new checkpoints and with other batch borders."""
    root = shared_folder(c.spark, "tables")
    low, high = ends(c.feed)
    replays = [steps(low, high, 3), steps(low, high, 2), [max(low, high // 2)]]
    staged = stage(c.feed, [cut for cuts in replays for cut in cuts])
    for cuts in replays:
        replay_staged(staged, fresh_start(c, make, root), cuts)
    return root


def batches(c: Case, path: str, schema) -> DataFrame:
    return tables.read_batches(c.spark, path, schema).drop(*tables.BATCH_KEYS)


# Staged arrivals are files: the sinks read them again instead of keeping them.
OPERATIONAL = {"operational": partial(sinks.operational_sink, keep=False)}
COUNTRY = {"operational": partial(sinks.operational_sink, rollups=("country",), keep=False)}
COLUMNAR = {"columnar": partial(sinks.columnar_sink, keep=False)}
LAKE = {"lake": sinks.lake_sink}


def raw_table(c: Case) -> DataFrame:
    return batches(c, f"{run(c, {'operational': sinks.raw_sink})}/raw", c.feed.schema)


def state_table(c: Case) -> DataFrame:
    return tables.read_state(c.spark, f"{run(c, {'operational': sinks.state_sink})}/state", c.feed.schema)


def columnar_table(c: Case, root: str) -> DataFrame:
    schema = c.feed.withColumn("category", C("category").cast("tinyint")).schema
    return batches(c, f"{root}/columnar", schema)


def rollup(c: Case, root: str, name: str) -> DataFrame:
    return c.spark.read.parquet(f"{root}/rollup_{name}").drop(*tables.BATCH_KEYS)


add("s7_append_raw", raw_table, f"SELECT {SEEN} FROM raw")
add("s8_upsert_state", state_table, f"SELECT {SEEN} FROM latest")
add(
    "s9_append_columnar",
    lambda c: columnar_table(c, run(c, {"columnar": lambda root: sinks.columnar_sink(root, rollups=())})),
    f"SELECT * REPLACE (category::TINYINT AS category) FROM (SELECT {SEEN} FROM feed)",
)


add(
    "s7_append_raw_new_checkpoint",
    lambda c: batches(c, f"{run_with_new_checkpoint(c, {'operational': sinks.raw_sink})}/raw", c.feed.schema),
    f"SELECT {SEEN} FROM raw",
)
add(
    "s8_upsert_state_new_checkpoint",
    lambda c: tables.read_state(c.spark, f"{run_with_new_checkpoint(c, {'operational': sinks.state_sink})}/state", c.feed.schema),
    f"SELECT {SEEN} FROM latest",
)
add(
    "s9_append_columnar_new_checkpoint",
    lambda c: columnar_table(c, run_with_new_checkpoint(c, {"columnar": lambda root: sinks.columnar_sink(root, rollups=())})),
    f"SELECT * REPLACE (category::TINYINT AS category) FROM (SELECT {SEEN} FROM feed UNION ALL SELECT {SEEN} FROM feed "
    f"UNION ALL SELECT {SEEN} FROM feed WHERE seq >= (SELECT max(seq) // 2 FROM feed))",
)


def staged_topic(c: Case) -> DataFrame:
    """The telemetry as topic rows; arrival order is the offset."""
    return wire.encode_topic(c.telemetry.withColumn("sent_at", C("observed_at")), 7, "seq", "sent_at").select(
        "key",
        "value",
        F.lit("telemetry").alias("topic"),
        F.pmod(F.hash("key"), F.lit(3)).alias("partition"),
        C("seq").alias("offset"),
        C("sent_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def from_topic(c: Case) -> DataFrame:
    landing, root, marks = (shared_folder(c.spark, p) for p in ("topic", "tables", "marks"))
    staged_topic(c).write.parquet(landing)
    stream = topic.read_topic(c.spark, {}, "parquet", landing)
    good, _ = wire.split_decoded(wire.decode_topic(stream.withColumnRenamed("offset", "seq").select("seq", "value")))
    jobs.start(good, "columnar", sinks.columnar_sink(root, rollups=()), marks, drain=True).awaitTermination()
    return c.spark.read.parquet(f"{root}/columnar").select(*TELEMETRY_COLUMNS, "seq")


add("s5_read_topic", from_topic, f"SELECT * REPLACE (category::TINYINT AS category) FROM (SELECT {FIELDS}, seq FROM tel)")


def to_topic(c: Case) -> DataFrame:
    out, marks = shared_folder(c.spark, "topic"), shared_folder(c.spark, "marks")
    replay(
        c.spark,
        c.telemetry.drop("n"),
        lambda stream: [
            topic.write_topic(wire.encode_topic(stream, 7), {}, marks, "parquet", out).trigger(availableNow=True).start()
        ],
        rounds=2,
    )
    return wire.split_decoded(wire.decode_topic(c.spark.read.parquet(out).select("value")))[0]


add("s6_write_topic", to_topic, f"SELECT {FIELDS} FROM tel")


def fanout(c: Case) -> DataFrame:
    """Three consumers of one stream: rows in each table."""
    root = run(c, OPERATIONAL | COLUMNAR | LAKE)
    parts = {
        "raw": batches(c, f"{root}/raw", c.feed.schema),
        "state": tables.read_state(c.spark, f"{root}/state", c.feed.schema),
        "columnar": columnar_table(c, root),
    }
    rows = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"))
        rows = one if rows is None else rows.unionByName(one)
    lake = read_lake(c.spark, f"{root}/lake")
    return rows.unionByName(lake.agg(F.lit("lake").alias("table"), F.lit(None).cast("bigint").alias("rows"), F.count_distinct("event_id").alias("ids")))


add(
    "t1_start_fanout",
    fanout,
    "SELECT 'raw' AS \"table\", count(*) AS rows, count(DISTINCT event_id) AS ids FROM raw "
    "UNION ALL SELECT 'state', count(*), count(DISTINCT event_id) FROM latest "
    "UNION ALL SELECT 'columnar', count(*), count(DISTINCT event_id) FROM feed "
    "UNION ALL SELECT 'lake', NULL, count(DISTINCT event_id) FROM feed",
)


def paced(c: Case) -> DataFrame:
    """The columnar consumer with a limit on the files of a batch."""
    landing, root, marks = (shared_folder(c.spark, p) for p in ("landing", "tables", "marks"))
    c.feed.repartition(4).write.parquet(landing)
    stream = c.spark.readStream.schema(c.feed.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    jobs.start(stream, "columnar", sinks.columnar_sink(root, rollups=()), marks, drain=True).awaitTermination()
    rows = tables.read_batches(c.spark, f"{root}/columnar", c.feed.schema)
    return rows.agg(F.count_distinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("rows"))


add("t2_paced_batches", paced, "SELECT 4::BIGINT AS batches, count(*) AS rows FROM feed")


class Lost(Exception):
    """Stands for a driver lost between a write and its commit."""


def crashed_once(c: Case) -> DataFrame:
    """A consumer that dies after its second write and before the commit."""
    state = {"left": 1}

    def maker(root):
        real = sinks.operational_sink(root)

        def sink(batch, batch_id):
            real(batch, batch_id)
            if batch_id == 1 and state["left"]:
                state["left"] = 0
                raise Lost()

        return sink

    root, marks = shared_folder(c.spark, "tables"), shared_folder(c.spark, "marks")
    sink = maker(root)

    def begin(stream):
        query = jobs.start(stream, "operational", sink, marks, drain=True)
        try:
            query.awaitTermination()
        except Exception:  # the batch is not committed; the next start runs it again
            query = jobs.start(stream, "operational", sink, marks, drain=True)
        return [query]

    replay(c.spark, c.feed, begin)
    return batches(c, f"{root}/raw", c.feed.schema)


add("t3_commit_after_write", crashed_once, f"SELECT {SEEN} FROM raw")


def poisoned(c: Case) -> DataFrame:
    """A stream with values that cannot be read: good rows arrive, bad ones are counted."""
    landing, root, marks = (shared_folder(c.spark, p) for p in ("topic", "tables", "marks"))
    damaged_topic(c).withColumnRenamed("n", "seq").write.parquet(landing)
    stream = c.spark.readStream.schema("seq bigint, key binary, value binary").parquet(landing)
    jobs.start(wire.decode_topic(stream), "poison", sinks.outcome_sink(root), marks, drain=True).awaitTermination()
    rows = c.spark.read.parquet(f"{root}/outcomes")
    return rows.groupBy("error").agg(F.count(F.lit(1)).alias("messages"))


add(
    "t4_poison_skip",
    poisoned,
    "SELECT CASE WHEN n % 50 IN (0, 3) THEN 'message too short' WHEN n % 50 = 1 THEN 'unexpected magic byte' "
    "WHEN n % 50 IN (2, 4) THEN 'avro record cannot be decoded' END AS error, count(*) AS messages FROM tel GROUP BY 1",
)


def replayed_group(c: Case) -> DataFrame:
    """A second group reads everything again into the same raw table."""
    root = shared_folder(c.spark, "tables")
    low, high = ends(c.feed)
    first, second = steps(low, high, 3), steps(low, high, 2)
    staged = stage(c.feed, [*first, *second])
    replay_staged(staged, fresh_start(c, {"operational": sinks.raw_sink}, root), first)
    replay_staged(staged, fresh_start(c, {"again": lambda root: sinks.raw_sink(root, group="again")}, root), second)
    return batches(c, f"{root}/raw", c.feed.schema)


add("t6_replay_from_start", replayed_group, f"SELECT {SEEN} FROM raw")


def late_rows(c: Case) -> DataFrame:
    """Rows far behind the newest observation, reversed in arrival."""
    late = c.feed.withColumn("seq", F.when(C("seq") % 3 == 0, C("seq") + 10**15).otherwise(C("seq")))
    return rollup_final(c, run(c, COUNTRY, late))


def rollup_final(c: Case, root: str) -> DataFrame:
    return r.country_hour_final(rollup(c, root, "country"))


LATE_RAW = (
    f"(SELECT * FROM (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN seq + 1000000000000000 ELSE seq END AS seq) FROM feed) "
    "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1)"
)
add("t7_late_data", late_rows, country_hour(LATE_RAW))
add("t8_stream_latest_state", state_table, f"SELECT {SEEN} FROM latest")


def deduped_stream(c: Case) -> DataFrame:
    out, marks = shared_folder(c.spark, "deduped"), shared_folder(c.spark, "marks")
    arrivals = c.feed.select("event_id", "icao24", "seq", F.timestamp_millis(F.lit(1_704_067_200_000) + C("seq")).alias("ingested_at"))

    def begin(stream):
        writer = jobs.stream_dedupe(stream).select("event_id", "icao24").writeStream.format("parquet")
        return [writer.option("checkpointLocation", marks).option("path", out).trigger(availableNow=True).start()]

    replay(c.spark, arrivals, begin)
    return c.spark.read.parquet(out)


add("d5_stream_dedupe", deduped_stream, "SELECT DISTINCT event_id, icao24 FROM feed")
add("t9_stream_dedupe", lambda c: raw_table(c).select("event_id", "seq"), "SELECT event_id, seq FROM raw")
add(
    "a8_maintain_rollup",
    lambda c: rollup_final(c, run(c, COUNTRY)),
    country_hour("raw"),
)
add(
    "a8_maintain_rollup_new_checkpoint",
    lambda c: rollup_final(c, run_with_new_checkpoint(c, COUNTRY)),
    country_hour("raw"),
)
add("t10_stream_rollups", lambda c: rollup_final(c, run(c, COLUMNAR)), country_hour("feed"))
add(
    "t10_stream_rollups_airline",
    lambda c: r.airline_hour_final(rollup(c, run(c, {"columnar": lambda root: sinks.columnar_sink(root, rollups=("airline",), keep=False)}), "airline")),
    airline_hour("feed"),
)
add(
    "t10_stream_rollups_grid",
    lambda c: r.grid_final(rollup(c, run(c, {"columnar": lambda root: sinks.columnar_sink(root, rollups=("grid",), keep=False)}), "grid")),
    grid_final("feed"),
)


def replay_difference(c: Case) -> DataFrame:
    """Tables before and after the last batch is run a second time."""
    root = shared_folder(c.spark, "tables")
    sink = sinks.operational_sink(root)
    low, high = ends(c.feed)
    staged = stage(c.feed, [low, high // 2])
    early, late = staged.read(until=high // 2), staged.read(high // 2)
    sink(early, 0)
    sink(late, 1)
    kept = shared_folder(c.spark, "before")
    read = lambda: {
        "raw": batches(c, f"{root}/raw", c.feed.schema),
        "state": tables.read_state(c.spark, f"{root}/state", c.feed.schema),
    }
    for name, df in read().items():
        df.write.parquet(f"{kept}/{name}")
    sink(late, 1)
    result = None
    for name, after in read().items():
        before = c.spark.read.parquet(f"{kept}/{name}")
        one = table_difference(before, after).select(F.lit(name).alias("table"), "lost", "gained")
        result = one if result is None else result.unionByName(one)
    return result


add(
    "i3_check_replay_noop",
    replay_difference,
    "SELECT 'raw' AS \"table\", count(*) - count(*) AS lost, count(*) - count(*) AS gained FROM raw "
    "UNION ALL SELECT 'state', count(*) - count(*), count(*) - count(*) FROM latest",
)


def lag(c: Case) -> DataFrame:
    """A consumer reads what has landed of the topic by two thirds of its offsets; the rest waits, and one partition is not begun."""
    landing, root, marks = (shared_folder(c.spark, p) for p in ("topic", "tables", "marks"))
    rows = c.telemetry.select(F.lit("telemetry").alias("topic"), F.pmod("n", F.lit(4)).cast("int").alias("partition"), C("n").alias("offset"))
    landed = rows.filter((C("partition") < 3) & (C("offset") <= c.telemetry.agg(F.max("n")).first()[0] * 2 // 3))
    landed.write.parquet(landing)
    stream = c.spark.readStream.schema(landed.schema).parquet(landing)
    jobs.start(stream, "progress", sinks.progress_sink(root), marks, drain=True).awaitTermination()
    return metrics.partition_lag(rows, c.spark.read.parquet(f"{root}/progress").select("topic", "partition", "offset"))


add(
    "t11_partition_lag",
    lag,
    "SELECT 'telemetry' AS topic, (n % 4)::INT AS partition, max(n) AS latest, max(n) FILTER (WHERE n % 4 < 3 AND n <= edge) AS consumed, "
    "count(*) FILTER (WHERE n % 4 = 3 OR n > edge) AS lag FROM (SELECT n, (SELECT max(n) * 2 // 3 FROM tel) AS edge FROM tel) GROUP BY 1, 2",
)


def consumer_metrics(c: Case) -> DataFrame:
    rows = damaged_topic(c).withColumn("partition", (C("n") % 3).cast("int")).drop("n")
    return metrics.topic_metrics(rows)


add(
    "t11_consumer_metrics",
    consumer_metrics,
    "SELECT (n % 3)::INT AS partition, count(*) AS messages, sum(size)::BIGINT AS bytes, count(*) FILTER (WHERE n % 50 <= 4) AS decode_failures "
    "FROM (SELECT n, CASE n % 50 WHEN 0 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 0 WHEN 4 THEN full_size - 3 ELSE full_size END AS size "
    f"FROM (SELECT *, {SIZE} AS full_size FROM tel)) GROUP BY 1",
)
