"""Tables that a micro-batch writes. Writing a batch again changes nothing.

A batch is known by its consumer group, its run and its number, and has its own
folder, which is replaced as a whole. The run is the id that Spark keeps in the
checkpoint: batch numbers start again at 0 with a new checkpoint, and the
new run then neither overwrites nor hides what earlier runs wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from vantrail.operators.dedupe import dedupe_first
from vantrail.operators.state import latest_state, merge_state


def read_if_there(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or no rows when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def run_of(batch: DataFrame) -> str:
    """Id of the streaming query of this batch, the same for every start from one checkpoint; ``direct`` outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def place(path: str, group: str, run: str, batch_id: int) -> str:
    return f"{path}/group={group}/run={run}/batch_id={batch_id}"


BATCH_KEYS = ("group", "run", "batch_id")


def with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("group", T.StringType()).add("run", T.StringType()).add("batch_id", T.LongType())


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of a batch-written table, with their group, run and batch number."""
    return read_if_there(spark, path, with_batch(schema))


def append_raw(batch: DataFrame, path: str, batch_id: int, group: str = "main") -> DataFrame:
    """Insert the rows whose id is not in the table; returns what was inserted.

    Only the folder that is about to be replaced is left out of the comparison, so
    a replay from any offset under a new checkpoint inserts nothing twice. One
    group writes a table at a time: the comparison and the write are not one step.
    The batch has one row per id when it meets the table, and only the id column
    of the table is read.
    """
    spark, schema, run = batch.sparkSession, batch.schema, run_of(batch)
    own = (F.col("group") == group) & (F.col("run") == run) & (F.col("batch_id") == batch_id)
    stored = read_batches(spark, path, schema).filter(~own)
    fresh = dedupe_first(batch).join(stored.select("event_id"), "event_id", "left_anti")
    target = place(path, group, run, batch_id)
    fresh.select(*batch.columns).write.mode("overwrite").parquet(target)
    return spark.read.schema(schema).parquet(target)


COMMITS = StructType().add("group", T.StringType()).add("slot", T.IntegerType()).add("version", T.LongType())


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return read_if_there(spark, f"{path}/commits", COMMITS)


def upsert_state(batch: DataFrame, path: str, batch_id: int, group: str = "main") -> None:
    """Merge a batch into the latest-state table.

    Two slots take turns. The slot that was committed last is read and the other one replaced; a commit
    record of one row per slot, written after the data, says which is which. A failed
    or retried batch, or a new checkpoint, therefore starts from the state that
    was committed last, and the state never goes back.
    """
    spark = batch.sparkSession
    last = _commits(spark, path).filter(F.col("group") == group).orderBy(F.desc("version")).first()  # two rows a group
    held_slot, version = (last["slot"], last["version"]) if last else (1, 0)
    slots = f"{path}/slots/group={group}"
    held = read_if_there(spark, f"{slots}/slot={held_slot}", batch.schema) if last else spark.createDataFrame([], batch.schema)
    own = 1 - held_slot
    merge_state(held, batch).write.mode("overwrite").parquet(f"{slots}/slot={own}")
    record = spark.range(1).select(F.lit(version + 1).cast("long").alias("version"))
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/group={group}/slot={own}")


def read_state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Latest state over the groups, each from the slot that was committed last."""
    slots = StructType([*schema.fields]).add("group", T.StringType()).add("slot", T.IntegerType())
    newest = _commits(spark, path).groupBy("group").agg(F.max_by("slot", "version").alias("slot"))
    held = read_if_there(spark, f"{path}/slots", slots).join(newest, ["group", "slot"], "left_semi")
    return latest_state(held).drop("group", "slot")


def append_columnar(batch: DataFrame, path: str, batch_id: int, group: str = "main") -> None:
    """Append all rows of a batch, with the category narrowed to one byte."""
    narrow = batch.withColumn("category", F.col("category").try_cast("tinyint"))
    narrow.write.mode("overwrite").parquet(place(path, group, run_of(batch), batch_id))


def append_rollup(state: DataFrame, path: str, batch_id: int, run: str, group: str = "main") -> None:
    """Store the partial rollup state of one batch; readers merge the batches."""
    state.write.mode("overwrite").parquet(place(path, group, run, batch_id))
