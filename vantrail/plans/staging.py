"""Feeding a table through streaming queries in arrival order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vantrail.session import shared_folder

STEP = "step"
#: Rows of a file at most. A file has few row groups, and only whole ones are shared out: a piece in few files is read by few tasks.
FILE_ROWS = 100_000


def steps(low: int, high: int, n: int) -> list[int]:
    """First arrival of each of ``n`` equal steps from ``low`` to ``high``."""
    width = (high - low) // n + 1
    return [low + k * width for k in range(n)]


@dataclass(frozen=True)
class Staged:
    """Arrivals that were computed and written once, cut at ``borders``: piece k lies in a folder of its own and begins at borders[k]."""

    spark: SparkSession
    path: str
    schema: StructType
    borders: tuple[int, ...]

    def _folders(self, since: int | None, until: int | None) -> list[str]:
        if not {since, until} <= {None, *self.borders}:
            raise ValueError("the arrivals are not cut there")
        return [str(k) for k, b in enumerate(self.borders) if (since is None or b >= since) and (until is None or b < until)]

    def read(self, since: int | None = None, until: int | None = None) -> DataFrame:
        """Arrivals of [since, until), which are borders."""
        paths = [f"{self.path}/{STEP}={k}" for k in self._folders(since, until)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def stream(self, since: int | None = None, until: int | None = None) -> DataFrame:
        """The same as a stream. One that goes on with a later ``until`` finds more folders, as if they had just landed."""
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/{STEP}={{{','.join(self._folders(since, until))}}}")


def ends(arrivals: DataFrame, seq: str = "seq") -> tuple[int, int]:
    """First and last arrival."""
    return tuple(arrivals.agg(F.min(seq), F.max(seq)).first())


def stage(arrivals: DataFrame, borders: Sequence[int], seq: str = "seq") -> Staged:
    """Compute and write ``arrivals`` once, in pieces that begin at ``borders``, each in many files; the first border is the first arrival."""
    spark, cuts = arrivals.sparkSession, tuple(sorted(set(borders)))
    path = shared_folder(spark, "landing")
    step = F.lit(0)
    for k, border in enumerate(cuts[1:], 1):
        step = F.when(F.col(seq) >= border, k).otherwise(step)
    arrivals.withColumn(STEP, step).write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(STEP).parquet(path)
    for k in range(len(cuts)):  # a piece without arrivals is an empty folder
        _make_folder(spark, f"{path}/{STEP}={k}")
    return Staged(spark, path, arrivals.schema, cuts)


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def replay(
    spark: SparkSession, arrivals: DataFrame, begin: Callable[[DataFrame], list[StreamingQuery]], rounds: int = 3, seq: str = "seq"
) -> None:
    """Let ``arrivals`` land in ``rounds`` steps and run the queries after each; ``replay_staged`` for arrivals that are written already."""
    cuts = steps(*ends(arrivals, seq), rounds)
    replay_staged(stage(arrivals, cuts, seq), begin, cuts)


def replay_staged(staged: Staged, begin: Callable[[DataFrame], list[StreamingQuery]], cuts: Sequence[int]) -> None:
    """Let the arrivals from cuts[0] on land in steps that begin at ``cuts``.

    Every step stops the queries and starts them again from their checkpoints,
    so a replay is as many micro-batches with restarts between them. The rows of
    one step are written by many tasks; order is by step, and by ``seq`` inside.
    """
    for until in [*cuts[1:], None]:
        queries = begin(staged.stream(cuts[0], until))
        try:
            for query in queries:
                query.awaitTermination()
        finally:
            for query in queries:
                query.stop()
