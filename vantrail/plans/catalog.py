"""Registry of the runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vantrail.operators.dedupe import dedupe_first
from vantrail.operators.state import latest_state, project_state
from vantrail.plans import adapter
from vantrail.plans.oracle import BASE
from vantrail.session import prepare


@dataclass
class Case:
    """One run of a query: the session, the data folder and common inputs."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def as_of(self):
        return adapter.as_of(self.spark, self.sf_dir)

    @cached_property
    def telemetry(self) -> DataFrame:
        return adapter.telemetry(self.spark, self.sf_dir)

    @cached_property
    def feed(self) -> DataFrame:
        return adapter.feed(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return dedupe_first(self.feed)

    @cached_property
    def state(self) -> DataFrame:
        return project_state(latest_state(self.feed))

    @cached_property
    def bodies(self) -> DataFrame:
        return adapter.bodies(self.spark, self.sf_dir)


Build = Callable[[Case], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def shown(df: DataFrame, rounded: tuple[str, ...], digits: int = 6) -> DataFrame:
    """Result form: times without zone, and the named sums and means rounded alike in both engines.

    The sum of doubles depends on their order in the last digit. The small shift
    keeps that digit from deciding how an exact half is rounded.
    """
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif field.name in rounded:
            c = F.round(c + 1e-9, digits)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def add(name: str, build: Build, sql: str | None = None, tables: str = "", rounded: tuple[str, ...] = ()) -> None:
    """Register a query. ``sql`` follows the shared views; ``tables`` adds more of them; ``rounded`` are its columns that depend on the order of a sum."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(build(Case(prepare(spark), sf_dir)), rounded)

    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = f"{BASE}{tables}\n{sql}"


def load() -> None:
    """Import the catalogs once; each registers its queries."""
    from vantrail.plans import (  # noqa: F401
        catalog_checks,
        catalog_columns,
        catalog_dashboards,
        catalog_ingest,
        catalog_keyed,
        catalog_rollups,
        catalog_stores,
        catalog_streams,
    )
