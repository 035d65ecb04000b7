"""Tables of immutable folders under a manifest.

Rows are written to a new folder each time; what counts is what the newest *version* names. A version is one small
file with a row per live part (a folder with its level, bucket, time range and number of rows) and a row per writer
with the last batch of it that is contained. It appears as a whole, when its file does, so

* a crash between data and commit leaves the table as it was, and the batch runs again;
* a batch that is already contained is skipped, however often it runs;
* a reader that keeps to one version sees the same rows until ``vacuum`` removes that version.

One writer at a time commits to a table; a second one that commits the same version fails and runs again.
The manifest lists folders, never rows: it grows with the number of parts, which compaction and buckets bound.
"""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from vantrail.sources.tables import read_if_there

MANIFEST = (
    StructType()
    .add("part", T.StringType())
    .add("level", T.IntegerType())
    .add("depth", T.IntegerType())
    .add("bucket", T.LongType())
    .add("low", T.TimestampType())
    .add("high", T.TimestampType())
    .add("rows", T.LongType())
    .add("tag", T.StringType())
    .add("stored", T.LongType())
    .add("writer", T.StringType())
    .add("batch_id", T.LongType())
)
PART_FIELDS = MANIFEST.fieldNames()[:-2]
#: Columns of the rows in a folder that buckets share: its own name, and the bucket.
FOLDER, DEPTH, BUCKET = "_folder", "_depth", "_bucket"
SHARED = StructType().add(FOLDER, T.StringType()).add(DEPTH, T.IntegerType()).add(BUCKET, T.LongType())


@dataclass(frozen=True)
class Part:
    """A live folder below the table; ``name`` is empty for a bucket without rows, ``tag`` the group that it holds alone.

    ``stored`` is how many rows lie in the folder where several buckets share it; then ``depth`` and ``bucket`` tell a part's rows.
    """

    name: str
    level: int = 0
    depth: int = 0
    bucket: int = 0
    low: datetime | None = None
    high: datetime | None = None
    rows: int = 0
    tag: str | None = None
    stored: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """What one version holds."""

    version: int
    parts: tuple[Part, ...] = ()
    applied: tuple[tuple[str, int], ...] = ()

    def contains(self, writer: str, batch_id: int) -> bool:
        return dict(self.applied).get(writer, -1) >= batch_id


class Conflict(Exception):
    """Another writer committed the version first."""


class Table:
    """A versioned table at ``path``. ``time`` names the column whose range is kept per part."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, time: str | None = None) -> None:
        self.spark, self.path, self.schema, self.time = spark, path.rstrip("/"), schema, time

    def _versions(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/versions", StructType([*MANIFEST.fields]).add("version", T.LongType()))

    def versions(self) -> list[int]:
        """The versions that can still be read."""
        return sorted(r["version"] for r in self._versions().select("version").distinct().collect())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the given one. A table without versions is version 0, without rows."""
        rows = self._versions()
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        if version is None or version == 0:
            return Snapshot(0)
        found = rows.filter(F.col("version") == version).collect()
        if not found:
            raise ValueError(f"version {version} of {self.path} does not exist (any more)")
        parts = [Part(*[r[c] for c in PART_FIELDS]) for r in found if r["part"] is not None]
        return Snapshot(version, tuple(parts), tuple((r["writer"], r["batch_id"]) for r in found if r["writer"] is not None))

    def commit(self, base: Snapshot, add: Iterable[Part] = (), drop: Iterable[Part] = (), applied: tuple[str, int] | None = None) -> Snapshot:
        """The version after ``base``, with parts added and dropped and a writer's batch marked as contained."""
        gone = set(drop)
        parts = [*[p for p in base.parts if p not in gone], *add]
        writers = dict(base.applied) | (dict([applied]) if applied else {})
        rows = [(p.name, p.level, p.depth, p.bucket, p.low, p.high, p.rows, p.tag, p.stored, None, None) for p in parts]
        rows += [(None,) * len(PART_FIELDS) + (writer, batch) for writer, batch in writers.items()]
        # A version that holds nothing must be told from one that was cut off while it was written.
        rows += [] if rows else [(None,) * len(PART_FIELDS) + ("", -1)]
        version = base.version + 1
        target = f"{self.path}/versions/version={version}"
        record = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        try:
            record.write.mode("errorifexists").parquet(target)
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise
            if not read_if_there(self.spark, target, MANIFEST).isEmpty():
                raise Conflict(f"version {version} of {self.path} was committed by another writer") from e
            record.write.mode("overwrite").parquet(target)  # left by a writer that was cut off
        return Snapshot(version, tuple(parts), tuple(writers.items()))

    def folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, level: int = 0, even: bool = False) -> list[Part]:
        """Rows as a new part, not yet committed; no part when there are none. Files get the session's advisory partition size.

        ``even`` rows come out of a shuffle by many keys, which sets the files; they are not shuffled again.
        """
        folder = self.folder()
        (df if even else df.hint("rebalance")).write.parquet(f"{self.path}/{folder}")
        return self.measured(folder, [], lambda row: Part(folder, level=level))

    def measured(self, folder: str, by: list[str], part: Callable[..., Part]) -> list[Part]:
        """The parts of a folder that has just been written, with their rows and time ranges; one per value of ``by``, which are its partition columns or those of SHARED."""
        schema = StructType([*self.schema.fields])
        for name in by:
            schema = schema.add(name, SHARED[name].dataType if name in SHARED.names else T.StringType())
        stats = [F.count(F.lit(1)).alias("rows"), *([F.min(self.time).alias("low"), F.max(self.time).alias("high")] if self.time else [])]
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").groupBy(*by).agg(*stats).collect()
        return [replace(part(r), rows=r["rows"], **({"low": r["low"], "high": r["high"]} if self.time else {})) for r in rows if r["rows"]]

    def read(self, version: int | Snapshot | None = None, keep: Callable[[Part], bool] = lambda part: True) -> DataFrame:
        """Rows of a version. Parts that ``keep`` refuses are not opened."""
        snapshot = version if isinstance(version, Snapshot) else self.snapshot(version)
        return self.read_parts(p for p in snapshot.parts if keep(p))

    def read_parts(self, parts: Iterable[Part]) -> DataFrame:
        """Rows of the parts. Of a folder that they share with parts that no longer count, or are not asked for, only theirs are kept."""
        folders: dict[str, list[Part]] = defaultdict(list)
        for part in parts:
            if part.name:
                folders[part.name].append(part)
        whole = [name for name, its in folders.items() if its[0].stored is None or its[0].stored == sum(p.rows for p in its)]
        some = {name: its for name, its in folders.items() if name not in set(whole)}
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{name}" for name in whole]) if whole else None
        if some:
            live = self.spark.createDataFrame([(p.name, p.depth, p.bucket) for its in some.values() for p in its], SHARED)
            stored = self.spark.read.schema(StructType([*self.schema.fields, *SHARED.fields])).parquet(*[f"{self.path}/{name}" for name in some])
            kept = stored.join(live, SHARED.fieldNames(), "left_semi").select(*self.schema.fieldNames())
            rows = kept if rows is None else rows.unionByName(kept)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def between(
        self, since: datetime | None = None, until: datetime | None = None, version: int | None = None, keep: Callable[[Part], bool] = lambda part: True
    ) -> DataFrame:
        """Rows of [since, until) of the time column; parts outside, or that ``keep`` refuses, are not opened."""
        if self.time is None:
            raise ValueError("this table keeps no time ranges")
        def meets(p: Part) -> bool:
            return (since is None or p.high is None or p.high.astimezone() >= since.astimezone()) and (until is None or p.low is None or p.low.astimezone() < until.astimezone())

        rows = self.read(version, lambda p: keep(p) and meets(p))
        if since is not None:
            rows = rows.filter(F.col(self.time) >= F.lit(since))
        return rows if until is None else rows.filter(F.col(self.time) < F.lit(until))

    def vacuum(self, keep: int = 2, hours: float = 24.0) -> None:
        """Remove all but the newest ``keep`` versions, and folders of data that none of those names.

        Only what was written more than ``hours`` ago goes, so that folders of a running batch and versions that a reader
        has just pinned stay.
        """
        rows = self._versions().collect()
        kept = sorted({r["version"] for r in rows})[-keep:] if keep else []
        named = {r["part"].split("/")[1] for r in rows if r["version"] in kept and r["part"]}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        before = (time.time() - hours * 3600) * 1000
        for folder, stays in (("versions", {f"version={v}" for v in kept}), ("data", named)):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            fs = path.getFileSystem(conf)
            if not fs.exists(path):
                continue
            for status in fs.listStatus(path):
                if status.getPath().getName() not in stays and status.getModificationTime() <= before:
                    fs.delete(status.getPath(), True)
