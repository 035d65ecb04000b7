"""Keyed state in the stream itself: the latest observation per aircraft, and exact dedupe beyond the replay horizon."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vantrail.operators.dedupe import dedupe_first
from vantrail.schema import MAX_FUTURE_HOURS, REPLAY_HOURS
from vantrail.sources.tables import append_raw, place, read_batches, run_of
from vantrail.streaming.jobs import stream_dedupe
from vantrail.streaming.sinks import BatchSink


#: Groups of keys that go to Python together. A group has its keys' state as a map, so more keys do not mean more calls.
GROUPS = 4096
_GROUP = "_group"


class _Latest(StatefulProcessor):
    """Holds (time, arrival) of the newest observation of each key of a group; gives out the rows of those for which a strictly newer one arrives."""

    def __init__(self, key: str, kind: T.DataType, ts: str, seq: str, columns: list[str]) -> None:
        self.key, self.kind, self.ts, self.seq, self.columns = key, kind, ts, seq, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("newest", T.StructType().add("key", self.kind), "at bigint, seq bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            both = frame if best is None else pd.concat([best, frame])
            best = both.sort_values([self.ts, self.seq], ascending=[False, True]).drop_duplicates(self.key)
        if best is None:
            return
        newer = []
        for k, at, seq in zip(best[self.key].tolist(), best[self.ts].tolist(), best[self.seq].tolist(), strict=True):
            held = self.held.getValue((k,))
            newer.append(held is None or at > held[0])
            if newer[-1]:
                self.held.updateValue((k,), (int(at), int(seq)))
        if any(newer):
            yield best.loc[newer, self.columns]

    def close(self) -> None:
        pass


def stream_latest_state(stream: DataFrame, key: str = "icao24", ts: str = "observed_at", seq: str = "seq") -> DataFrame:
    """The state as a stream of changes: at most one row per key and micro-batch, when its newest observation is strictly newer than the held one.

    Held per key are two numbers, in the state store (call ``jobs.use_rocksdb`` first, to keep them on disk). On
    equal times the earliest arrival stays. Times travel as microseconds, which compare alike in the state and in rows.
    Keys go to Python in groups by their hash, so a call costs the same for one key or many. A checkpoint of the
    earlier form, which held a value per key, cannot be gone on with: begin a new one.
    """
    times = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType)]
    whole = {f.name: f.dataType for f in stream.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) and f.name != seq}
    sent = stream.withColumns({c: F.unix_micros(c) for c in times} | {c: F.col(c).cast("string") for c in whole})
    processor = _Latest(key, sent.schema[key].dataType, ts, seq, sent.columns)
    grouped = sent.withColumn(_GROUP, F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int")).groupBy(_GROUP)
    changed = grouped.transformWithStateInPandas(processor, sent.schema, "Append", "None")
    back = {c: F.timestamp_micros(c) for c in times} | {c: F.col(c).cast(kind) for c, kind in whole.items()}
    return changed.withColumns(back).select(*stream.columns)


def may_be_older(ts: str, arrived: str, hours: int = REPLAY_HOURS) -> Column:
    """Whether an id may have come before the horizon of ``stream_dedupe``.

    A repeat of an event has its time. An event may be observed up to MAX_FUTURE_HOURS after it first arrived, so one that comes
    back after ``hours`` was observed at least ``hours - MAX_FUTURE_HOURS`` before that.
    """
    return F.col(ts) <= F.col(arrived) - F.make_interval(hours=F.lit(hours - MAX_FUTURE_HOURS))


def exact_dedupe_sink(root: str, arrived: str = "ingested_at", group: str = "operational", hours: int = REPLAY_HOURS) -> BatchSink:
    """Insert by unseen id behind ``exact_dedupe``: only ids that may be older than the horizon are looked up in the table.

    Other events are compared with what other runs have stored, which is nothing as long as there is one checkpoint: the state
    of a new one knows no ids. So they are appended without a look at the table, however large it is.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            old, own = may_be_older("observed_at", arrived, hours), run_of(batch)
            others = read_batches(batch.sparkSession, f"{root}/raw", batch.schema).filter(F.col("run") != own)
            fresh = dedupe_first(batch.filter(~old)).join(others.select("event_id"), "event_id", "left_anti").select(*batch.columns)
            fresh.write.mode("overwrite").parquet(place(f"{root}/raw", f"{group}-new", own, batch_id))
            late = batch.filter(old)
            if not late.isEmpty():
                append_raw(late, f"{root}/raw", batch_id, f"{group}-late")
        finally:
            batch.unpersist()

    return run


def exact_dedupe(stream: DataFrame, arrived: str = "ingested_at", hours: int = REPLAY_HOURS) -> DataFrame:
    """The front of ``exact_dedupe_sink``: repeats inside the horizon go here, by ids in the state store, without any table.

    Of rows with one id in one micro-batch any one may stay; over batches the first does.
    """
    return stream_dedupe(stream, "event_id", arrived, hours)
