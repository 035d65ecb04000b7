"""What the sinks keep in versioned tables: rollups in levels, state in buckets, raw rows by day."""

from __future__ import annotations

import math
from base64 import b64decode
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, functions as F

from vantrail.operators.dedupe import collapse_versions
from vantrail.operators.rollups import merge_states
from vantrail.operators.state import latest_state, merge_state
from vantrail.sources.versions import BUCKET, DEPTH, FOLDER, Part, Snapshot, Table

#: Parts of one level that are merged into one of the next.
FANOUT = 4
#: Rows after which a bucket of the state is split, about.
BUCKET_ROWS = 1_000_000


# ---- rollups -----------------------------------------------------------------------------------------------------
def add_rollup(table: Table, state: DataFrame, writer: str, batch_id: int, fanout: int = FANOUT) -> None:
    """Add the partial rollup state of one batch, once, and merge full levels.

    A level holds fewer than ``fanout`` parts afterwards, so after n batches a reader opens at most (fanout - 1) * (log_fanout(n) + 1)
    of them, and each row is rewritten once per level.
    """
    add_level(table, state, writer, batch_id, merge_states, fanout, even=True)


def add_level(
    table: Table, rows: DataFrame, writer: str, batch_id: int, merge: Callable[[DataFrame], DataFrame], fanout: int = FANOUT, even: bool = False
) -> None:
    """Add one batch as a part of the lowest level, once; full levels go through ``merge`` into the next. ``even`` as in ``Table.write``."""
    now = table.snapshot()
    if not now.contains(writer, batch_id):
        now = table.commit(now, add=table.write(rows, even=even), applied=(writer, batch_id))
    compact(table, now, fanout, merge)


def compact(table: Table, now: Snapshot | None = None, fanout: int = FANOUT, merge: Callable[[DataFrame], DataFrame] = merge_states) -> Snapshot:
    """Merge every level that has ``fanout`` parts or more. What a reader makes of the table stays the same at every commit."""
    now = now or table.snapshot()
    while True:
        levels: dict[int, list[Part]] = defaultdict(list)
        for part in now.parts:
            levels[part.level].append(part)
        full = [level for level, parts in sorted(levels.items()) if len(parts) >= fanout]
        if not full:
            return now
        old = levels[full[0]]
        now = table.commit(now, add=table.write(merge(table.read_parts(old)), full[0] + 1, even=True), drop=old)


# ---- state -------------------------------------------------------------------------------------------------------
#: Bits of the hash by which the buckets that a batch writes share folders: 64 folders a batch at most, however many buckets.
FOLDER_BITS = 6
_SHARE = "_share"


def _bucket(key: str, depth: Column) -> Column:
    """The last ``depth`` bits of the hash of the key."""
    return F.xxhash64(key).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), depth) - 1)


def _placed(rows: DataFrame, now: Snapshot, key: str) -> DataFrame:
    """Rows with the depth and number of their bucket. There are few depths; the buckets tile the hashes."""
    spark = rows.sparkSession
    depths = sorted({p.depth for p in now.parts})
    if len(depths) == 1:
        depth = F.lit(depths[0])
        return rows.withColumn(DEPTH, depth).withColumn(BUCKET, _bucket(key, depth))
    buckets = spark.createDataFrame([(p.depth, p.bucket) for p in now.parts], f"{DEPTH} int, {BUCKET} long")
    tried = rows.withColumn(DEPTH, F.explode(F.array(*[F.lit(d) for d in depths])))
    return tried.withColumn(BUCKET, _bucket(key, F.col(DEPTH))).join(buckets, [DEPTH, BUCKET], "left_semi")


def _worn(now: Snapshot, dropped: set[Part]) -> list[Part]:
    """Parts in folders of which less than half would still count without ``dropped``."""
    folders: dict[str, list[Part]] = defaultdict(list)
    for part in now.parts:
        if part.name and part not in dropped:
            folders[part.name].append(part)
    return [p for its in folders.values() if its[0].stored and 2 * sum(p.rows for p in its) < its[0].stored for p in its]


def upsert_buckets(table: Table, batch: DataFrame, writer: str, batch_id: int, key: str = "icao24", bucket_rows: int = BUCKET_ROWS) -> Snapshot:
    """Merge a batch into the latest state, once, and rewrite only the buckets that it touches.

    Keys lie in buckets by the last bits of their hash. A bucket that may have grown beyond ``bucket_rows`` is
    split by further bits when it is rewritten, so the size of a bucket, and what one key costs, does not grow with the table.
    The buckets of a batch share a bounded number of folders, so small buckets do not mean small files. A folder of which
    less than half still counts is written anew with the batch, so at most as many rows lie idle as count.
    """
    now = table.snapshot()
    if now.contains(writer, batch_id):
        return now
    tiled = now if now.parts else Snapshot(now.version, (Part(""),))
    newest = _placed(latest_state(batch, key), tiled, key).persist()
    try:
        touched = {(r[DEPTH], r[BUCKET]): r["n"] for r in newest.groupBy(DEPTH, BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row a part
        if not touched:
            return table.commit(now, applied=(writer, batch_id))
        old = [p for p in tiled.parts if (p.depth, p.bucket) in touched]
        old += _worn(tiled, set(old))
        deeper = {(p.depth, p.bucket): max(0, math.ceil(math.log2(max(1, p.rows + touched.get((p.depth, p.bucket), 0)) / bucket_rows))) for p in old}
        held = table.read_parts(old)
        merged = merge_state(_placed(held, tiled, key), newest, key)
        if any(deeper.values()):
            more = table.spark.createDataFrame([(d, b, x) for (d, b), x in deeper.items()], f"{DEPTH} int, {BUCKET} long, _more int")
            merged = merged.join(more, [DEPTH, BUCKET]).withColumn(DEPTH, (F.col(DEPTH) + F.col("_more")).cast("int"))
            merged = merged.drop("_more").withColumn(BUCKET, _bucket(key, F.col(DEPTH)))
        folder = table.folder()
        share = F.concat_ws("-", F.least(DEPTH, F.lit(FOLDER_BITS)), F.col(BUCKET).bitwiseAND(F.lit((1 << FOLDER_BITS) - 1)))
        shared = merged.select(*table.schema.fieldNames(), DEPTH, BUCKET, share.alias(_SHARE)).withColumn(FOLDER, F.concat(F.lit(f"{folder}/{_SHARE}="), _SHARE))
        shared.hint("rebalance", _SHARE).sortWithinPartitions(_SHARE, DEPTH, BUCKET).write.partitionBy(_SHARE).parquet(f"{table.path}/{folder}")
    finally:
        newest.unpersist()
    parts = table.measured(folder, [DEPTH, BUCKET, FOLDER], lambda r: Part(r[FOLDER], depth=int(r[DEPTH]), bucket=int(r[BUCKET])))
    stored: dict[str, int] = defaultdict(int)
    for part in parts:
        stored[part.name] += part.rows
    new = {(p.depth, p.bucket): replace(p, stored=stored[p.name]) for p in parts}
    for (depth, bucket), more in deeper.items():  # buckets that got no rows are kept in the manifest, so that they tile the hashes
        for k in range(1 << more):
            place = depth + more, bucket + (k << depth)
            new.setdefault(place, Part("", depth=place[0], bucket=place[1]))
    return table.commit(now, add=new.values(), drop=old, applied=(writer, batch_id))


# ---- raw rows by day -----------------------------------------------------------------------------------------------
DAY = "_day"


def append_days(table: Table, batch: DataFrame, writer: str, batch_id: int) -> Snapshot:
    """Append all rows of a batch, once, as one part per day of the time column."""
    now = table.snapshot()
    if now.contains(writer, batch_id):
        return now
    folder = table.folder()
    batch.withColumn(DAY, F.date_format(table.time, "yyyy-MM-dd")).hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{table.path}/{folder}")
    parts = table.measured(folder, [DAY], lambda r: Part(f"{folder}/{DAY}={r[DAY]}"))
    return table.commit(now, add=parts, applied=(writer, batch_id))


def expire(table: Table, limit: datetime) -> Snapshot:
    """Delete the rows before ``limit``. Parts that lie wholly before it are dropped by the manifest alone; only those on the border are rewritten."""
    now = table.snapshot()
    old = [p for p in now.parts if p.low is not None and p.low.astimezone() < limit.astimezone()]
    border = [p for p in old if p.high.astimezone() >= limit.astimezone()]
    if not old:
        return now
    kept = table.write(table.read_parts(border).filter(F.col(table.time) >= F.lit(limit))) if border else []
    return table.commit(now, add=kept, drop=old)


# ---- columnar rows, collapsed as they merge ------------------------------------------------------------------------
def append_collapsing(table: Table, batch: DataFrame, writer: str, batch_id: int, fanout: int = FANOUT) -> None:
    """Append every delivery, once. Merges keep the last insert of each (aircraft, time, id), so repeats fade in the background."""
    add_level(table, batch, writer, batch_id, collapse_versions, fanout)


def read_collapsed(table: Table, version: int | None = None) -> DataFrame:
    """The rows as if all merges had been done: exact at any moment, and cheaper the more of them have been."""
    return collapse_versions(table.read(version))


def collapse_all(table: Table) -> Snapshot:
    """Merge all parts into one, after which a plain read is collapsed."""
    now = table.snapshot()
    if len(now.parts) < 2:
        return now
    return table.commit(now, add=table.write(collapse_versions(table.read(now)), max(p.level for p in now.parts) + 1), drop=now.parts)


# ---- lake ------------------------------------------------------------------------------------------------------------
#: Rows of a part of the lake that needs no more merging.
LAKE_ROWS = 5_000_000
_LAKE_DAY, _LAKE_TAG = "_day", "_tag"


def _write_lake_parts(table: Table, rows: DataFrame, by: str) -> list[Part]:
    """Rows by day and group, in order of time inside; one part per day and group."""
    folder = table.folder()
    placed = rows.withColumn(_LAKE_DAY, F.date_format(table.time, "yyyy-MM-dd")).withColumn(_LAKE_TAG, F.base64(F.encode(by, "utf-8")))
    ordered = placed.repartitionByRange(_LAKE_DAY, _LAKE_TAG, table.time).sortWithinPartitions(_LAKE_DAY, _LAKE_TAG, table.time)
    ordered.write.partitionBy(_LAKE_DAY, _LAKE_TAG).parquet(f"{table.path}/{folder}")
    return table.measured(folder, [_LAKE_DAY, _LAKE_TAG], lambda r: Part(f"{folder}/{_LAKE_DAY}={r[_LAKE_DAY]}/{_LAKE_TAG}={quote(r[_LAKE_TAG])}", tag=b64decode(r[_LAKE_TAG]).decode()))


def append_lake(table: Table, batch: DataFrame, writer: str, batch_id: int, by: str = "origin_country", lake_rows: int = LAKE_ROWS, fanout: int = FANOUT) -> Snapshot:
    """Append a batch to the lake, once, and merge the small parts of any day and group that has ``fanout`` of them."""
    now = table.snapshot()
    if not now.contains(writer, batch_id):
        now = table.commit(now, add=_write_lake_parts(table, batch, by), applied=(writer, batch_id))
    return compact_lake(table, now, by, lake_rows, fanout)


def compact_lake(table: Table, now: Snapshot | None = None, by: str = "origin_country", lake_rows: int = LAKE_ROWS, fanout: int = FANOUT) -> Snapshot:
    """Merge parts of fewer than ``lake_rows`` rows that share day and group, where there are ``fanout`` or more, in one job and one commit."""
    now = now or table.snapshot()
    small: dict[tuple, list[Part]] = defaultdict(list)
    for part in now.parts:
        if part.rows < lake_rows:
            small[part.tag, part.low.date()].append(part)
    old = [part for parts in small.values() if len(parts) >= fanout for part in parts]
    return table.commit(now, add=_write_lake_parts(table, table.read_parts(old), by), drop=old) if old else now


def read_lake_parts(table: Table, since: datetime | None = None, until: datetime | None = None, tags: Sequence[str] | None = None, by: str = "origin_country") -> DataFrame:
    """Lake rows of [since, until) and of the named groups. Which files to open is decided by the manifest, without listing folders."""
    rows = table.between(since, until, keep=lambda p: tags is None or p.tag is None or p.tag in tags)
    return rows if tags is None else rows.filter(F.col(by).isin(*tags))
