"""What each consumer group does with a micro-batch.

Every sink is idempotent per (group, run, batch number), where the run is the id that
the checkpoint holds: the checkpoint advances only after the sink returns, a
batch that runs again replaces its own output, and a new checkpoint starts a new run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vantrail.operators.dedupe import dedupe_first
from vantrail.operators.rollups import airline_hour_state, country_hour_state, grid_state
from vantrail.sources.lake import write_lake
from vantrail.sources.stores import BUCKET_ROWS, add_rollup, append_days, upsert_buckets
from vantrail.sources.tables import append_columnar, append_raw, append_rollup, place, run_of, upsert_state
from vantrail.sources.versions import Table
from vantrail.streaming.metrics import partition_progress

BatchSink = Callable[[DataFrame, int], None]

ROLLUPS = {"country": country_hour_state, "airline": airline_hour_state, "grid": lambda df, dedupe: grid_state(df)}


def _held(sink: BatchSink) -> BatchSink:
    """Keep the batch while a sink writes it more than once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def raw_sink(root: str, group: str = "operational") -> BatchSink:
    """Only the raw insert by unseen id."""

    def run(batch: DataFrame, batch_id: int) -> None:
        append_raw(batch, f"{root}/raw", batch_id, group)

    return run


def state_sink(root: str, group: str = "operational") -> BatchSink:
    """Only the state upsert, on every arrival."""
    return lambda batch, batch_id: upsert_state(batch, f"{root}/state", batch_id, group)


def operational_sink(root: str, group: str = "operational", rollups: tuple[str, ...] = (), keep: bool = True) -> BatchSink:
    """Raw insert by unseen id, and the state upsert on every arrival.

    Rollups listed here are built from the rows really inserted, so replays do
    not inflate their sums. ``keep=False`` reads the batch from its source for each
    write, which for files costs less than keeping it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        inserted = append_raw(batch, f"{root}/raw", batch_id, group)
        upsert_state(batch, f"{root}/state", batch_id, group)
        for name in rollups:
            append_rollup(ROLLUPS[name](inserted, dedupe=False), f"{root}/rollup_{name}", batch_id, run_of(batch), group)

    return _held(run) if keep else run


def columnar_sink(root: str, group: str = "columnar", rollups: tuple[str, ...] = ("country", "airline", "grid"), keep: bool = True) -> BatchSink:
    """Append every delivery and add its partial rollup states, however late it is; ``keep`` as in ``operational_sink``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        append_columnar(batch, f"{root}/columnar", batch_id, group)
        for name in rollups:
            append_rollup(ROLLUPS[name](batch, dedupe=False), f"{root}/rollup_{name}", batch_id, run_of(batch), group)

    return _held(run) if rollups and keep else run  # written once, a batch need not be kept


def outcome_sink(root: str, group: str = "poison") -> BatchSink:
    """What became of each value of a decoded topic: ``seq`` and ``error``, which is null for good ones, so that bad ones are counted and passed over."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.select("seq", "error").write.mode("overwrite").parquet(place(f"{root}/outcomes", group, run_of(batch), batch_id))

    return run


def progress_sink(root: str, group: str = "progress") -> BatchSink:
    """How far a consumer has come in each partition, one row per batch and partition."""

    def run(batch: DataFrame, batch_id: int) -> None:
        partition_progress(batch).write.mode("overwrite").parquet(place(f"{root}/progress", group, run_of(batch), batch_id))

    return run


def lake_sink(root: str, group: str = "lake") -> BatchSink:
    """One row per id and flush, into the day and country layout."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_lake(dedupe_first(batch), place(f"{root}/lake", group, run_of(batch), batch_id), mode="overwrite")

    return run


def leveled_rollup_sink(root: str, group: str = "columnar", rollups: tuple[str, ...] = ("country", "airline", "grid")) -> BatchSink:
    """Partial rollup states in levels that are merged as they fill; every delivery counts."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for name in rollups:
            state = ROLLUPS[name](batch, dedupe=False)
            table = Table(batch.sparkSession, f"{root}/levels_{name}", state.schema, "bucket" if name == "grid" else "hour")
            add_rollup(table, state, f"{group}/{run_of(batch)}", batch_id)

    return _held(run) if len(rollups) > 1 else run


def bucketed_state_sink(root: str, group: str = "operational", bucket_rows: int = BUCKET_ROWS) -> BatchSink:
    """The state upsert on every arrival, which rewrites only the buckets that a batch touches."""

    def run(batch: DataFrame, batch_id: int) -> None:
        table = Table(batch.sparkSession, f"{root}/buckets", batch.schema, "observed_at")
        upsert_buckets(table, batch, f"{group}/{run_of(batch)}", batch_id, bucket_rows=bucket_rows)

    return run


def day_sink(root: str, group: str = "columnar") -> BatchSink:
    """Append every delivery, in parts of one day that ``expire`` can drop whole."""

    def run(batch: DataFrame, batch_id: int) -> None:
        append_days(Table(batch.sparkSession, f"{root}/days", batch.schema, "observed_at"), batch, f"{group}/{run_of(batch)}", batch_id)

    return run
