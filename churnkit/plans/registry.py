"""Registered queries: a DataFrame builder each, and the SQL its result is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.plans.medallion import Warehouse, stored_silver
from churnkit.plans.oracle_base import with_relations
from churnkit.session import kept, tune
from churnkit.sources import adapters
from churnkit.sources.adapters import AS_OF, EVENT_TYPES, Tables

NOW_TEXT = "2001-08-01 12:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SILVER: dict[tuple[str, str], Warehouse | DataFrame] = {}
ORACLES: dict[str, str] = {}


@dataclass
class Source:
    """The given tables of one folder, read as raw retention tables and planned up to gold."""

    spark: SparkSession
    folder: str

    @cached_property
    def t(self) -> Tables:
        return Tables(self.spark, self.folder)

    @cached_property
    def raw(self) -> adapters.RawTables:
        return adapters.RawTables(self.t)

    @cached_property
    def stored(self) -> Warehouse:
        """The conformed tables planned from raw, as they are stored."""
        return Warehouse(self.raw, AS_OF, self.now, EVENT_TYPES, checked=True)

    @cached_property
    def gold(self) -> Warehouse:
        """Gold planned on conformed tables, which are stored once per session and folder."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _SILVER:
            _SILVER[key] = stored_silver(self.raw, lambda name, df: kept(df, name), AS_OF, self.now, EVENT_TYPES)
        return _SILVER[key]

    @cached_property
    def lean(self) -> Warehouse:
        """For queries that read dimensions, health or features but no fact row by row: the conformed tables if they are stored already, else with lean facts, stored likewise once."""
        app = self.spark.sparkContext.applicationId
        if (app, self.folder) in _SILVER:
            return self.gold
        key = (app, f"{self.folder} lean")
        if key not in _SILVER:
            _SILVER[key] = stored_silver(self.raw, lambda name, df: kept(df, f"lean_{name}"), AS_OF, self.now, EVENT_TYPES, lean=True)
        return _SILVER[key]

    @cached_property
    def health(self) -> DataFrame:
        """Company health as the steps after it read it: stored, likewise once."""
        key = (self.spark.sparkContext.applicationId, f"{self.folder} health")
        if key not in _SILVER:
            _SILVER[key] = kept(self.lean.health, "agg_company_health_score")
        return _SILVER[key]

    @cached_property
    def predictions(self) -> DataFrame:
        return adapters.predictions(self.t)

    @cached_property
    def actions(self) -> DataFrame:
        return adapters.actions(self.t)

    @cached_property
    def labels(self) -> DataFrame:
        return adapters.scored_labels(self.t)

    @property
    def now(self):
        return F.lit(NOW_TEXT).cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """Time stamps without a zone, as the given files have them."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    )


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Source(tune(spark), folder)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_relations(sql)
        return build

    return register
