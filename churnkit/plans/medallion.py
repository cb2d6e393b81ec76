"""Raw tables to conformed tables to gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import agent_kpis, conform, features, health, quality
from churnkit.schemas import ACTIONS, COLUMN_COMMENTS, EVENT_TYPE_UNIVERSE, LAYER_COMMENTS, LAYERS, PREDICTIONS, TABLE_COMMENTS
from churnkit.sources.tables import ensure_layers, ensure_table, inline_rows, publish_table, write_table

WRITERS = 4
RAW_NAMES = {
    "agents": "raw_cs_agents",
    "companies": "raw_companies",
    "contacts": "raw_contacts",
    "subscriptions": "raw_subscriptions",
    "nps": "raw_nps_surveys",
    "tickets": "raw_support_tickets",
    "events": "raw_product_events",
}


@dataclass
class Warehouse:
    """Lazily planned layers over seven raw frames.

    With ``checked`` facts are filtered to known companies, as they are stored. Gold reads only join
    from the company table, so a plan straight from raw may skip that check. ``lean`` reads only the
    columns the gold tables use.
    """

    raw: Mapping[str, DataFrame]
    as_of: object = None
    computed_at: object = None
    universe: int = EVENT_TYPE_UNIVERSE
    checked: bool = True
    lean: bool = False

    @cached_property
    def companies(self) -> DataFrame:
        contracts = None if self.lean else self.raw["subscriptions"]
        return conform.dim_companies(self.raw["companies"], contracts, self.lean)

    @cached_property
    def company_keys(self) -> DataFrame:
        return conform.company_keys(self.raw["companies"])

    @property
    def _key_source(self) -> DataFrame | None:
        return self.company_keys if self.checked else None

    @cached_property
    def agents(self) -> DataFrame:
        return conform.dim_agents(self.raw["agents"], self.as_of)

    @cached_property
    def contacts(self) -> DataFrame:
        return conform.dim_contacts(self.raw["contacts"], self._key_source)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return conform.fact_subscriptions(self.raw["subscriptions"], self._key_source, self.lean)

    @cached_property
    def tickets(self) -> DataFrame:
        return conform.fact_tickets(self.raw["tickets"], self._key_source, self.lean)

    @cached_property
    def events(self) -> DataFrame:
        return conform.fact_events(self.raw["events"], self._key_source, self.lean)

    @cached_property
    def nps(self) -> DataFrame:
        return conform.fact_nps(self.raw["nps"], self._key_source, self.lean)

    @cached_property
    def health(self) -> DataFrame:
        return health.company_health(
            self.company_keys, self.events, self.tickets, self.nps, self.subscriptions, self.as_of, self.computed_at
        )

    @cached_property
    def features(self) -> DataFrame:
        return features.feature_store(
            self.companies, self.events, self.tickets, self.nps, self.subscriptions, self.contacts,
            self.as_of, self.computed_at, self.universe,
        )

    @cached_property
    def agent_performance(self) -> DataFrame:
        return agent_kpis.agent_performance(
            self.agents, self.companies, self.subscriptions, self.health, self.tickets, self.nps, self.as_of
        )

    def silver(self) -> dict[str, DataFrame]:
        return {
            "dim_cs_agents": self.agents,
            "dim_companies": self.companies,
            "dim_contacts": self.contacts,
            "fact_subscriptions": self.subscriptions,
            "fact_support_tickets": self.tickets,
            "fact_product_events": self.events,
            "fact_nps_scores": self.nps,
        }


SILVER_NAMES = {
    "agents": "dim_cs_agents",
    "contacts": "dim_contacts",
    "subscriptions": "fact_subscriptions",
    "tickets": "fact_support_tickets",
    "events": "fact_product_events",
    "nps": "fact_nps_scores",
}


def at_once(write: Callable[[str, DataFrame], DataFrame], frames: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Tables that do not read each other are written at the same time, so one table's last tasks do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        return list(pool.map(lambda item: write(*item), frames.items()))


def stored_silver(
    raw: Mapping[str, DataFrame], write: Callable[[str, DataFrame], DataFrame], as_of=None, computed_at=None,
    universe: int = EVENT_TYPE_UNIVERSE, lean: bool = False,
) -> Warehouse:
    """A warehouse whose conformed tables are written by ``write(name, frame)`` and read back; its gold tables are planned on those.

    With ``lean`` only the columns of the facts that health and features use are shuffled and written; the dimensions stay whole.
    """
    plan = Warehouse(raw, as_of, computed_at, universe, lean=lean)
    # The company table comes first: the other conformed tables check their keys against it.
    plan.companies = write("dim_companies", conform.dim_companies(raw["companies"], raw["subscriptions"]))
    plan.company_keys = plan.companies.select("company_id")
    written = at_once(write, {name: getattr(plan, short) for short, name in SILVER_NAMES.items()})
    for short, df in zip(SILVER_NAMES, written):
        setattr(plan, short, df)
    return plan


def run_all(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, as_of=None, universe: int = EVENT_TYPE_UNIVERSE,
    catalog: str | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """Build and store every layer under ``root``; each layer is read back before the next is planned.

    With ``catalog``, a prefix of database names, every table is made known in the database of its layer, with its comments.
    """
    stored: dict[tuple[str, str], DataFrame] = {}

    def writer(layer: str) -> Callable[[str, DataFrame], DataFrame]:
        def write(name: str, df: DataFrame) -> DataFrame:
            stored[layer.upper(), name] = write_table(df, root, layer, name)
            return stored[layer.upper(), name]

        return write

    bronze = at_once(writer("bronze"), {name: raw[short] for short, name in RAW_NAMES.items()})
    plan = stored_silver(dict(zip(RAW_NAMES, bronze)), writer("silver"), as_of, F.current_timestamp(), universe)
    gold = {"agg_company_health_score": plan.health, "feature_store_churn": plan.features}
    plan.health, plan.features = at_once(writer("gold"), gold)
    writer("gold")("agg_agent_performance", plan.agent_performance)
    # Filled by scoring and by the action steps; what they hold already stays.
    for name, schema, days in (("agg_churn_predictions", PREDICTIONS, ["prediction_date"]), ("agg_retention_actions", ACTIONS, [])):
        stored["GOLD", name] = ensure_table(spark, schema, root, "gold", name, days)
    if catalog is not None:
        publish_all(spark, stored, root, catalog)
    return stored


def publish_all(spark: SparkSession, stored: Mapping[tuple[str, str], DataFrame], root: str, prefix: str = "") -> list[str]:
    """Databases for the layers, and every stored table in them with its comments; rerun after a write to show what it committed."""
    ensure_layers(spark, prefix, LAYER_COMMENTS)
    schemas = {"agg_churn_predictions": PREDICTIONS, "agg_retention_actions": ACTIONS}
    return [
        publish_table(
            spark, root, layer.lower(), name, schemas.get(name, df.schema), prefix, TABLE_COMMENTS.get(name), COLUMN_COMMENTS.get(name)
        )
        for (layer, name), df in stored.items()
    ]


def catalog_report(spark: SparkSession, prefix: str = "") -> DataFrame:
    """What the catalog says of the layers: every table with its comment, its columns and how many carry a comment."""
    rows = []
    for layer in LAYERS:
        for table in spark.catalog.listTables(f"{prefix}{layer}"):
            columns = spark.catalog.listColumns(f"{prefix}{layer}.{table.name}")
            about = spark.catalog.getTable(f"{prefix}{layer}.{table.name}").description
            rows.append((layer, table.name, about, len(columns), sum(bool(c.description) for c in columns)))
    return inline_rows(spark, rows, "layer string, table_name string, table_comment string, n_columns int, n_commented int")


def quality_reports(tables: Mapping[tuple[str, str], DataFrame]) -> dict[str, DataFrame]:
    minima = {key: least for key, least in quality.ROW_MINIMA.items() if key in tables}
    silver = {name: df for (layer, name), df in tables.items() if layer == "SILVER"}
    return {
        "rowcount": quality.rowcount_report(tables, minima),
        "null_keys": quality.null_key_report(
            {
                "dim_companies key": (silver["dim_companies"], "company_id"),
                "dim_contacts key": (silver["dim_contacts"], "contact_id"),
                "dim_cs_agents key": (silver["dim_cs_agents"], "agent_id"),
                "fact_subscriptions key": (silver["fact_subscriptions"], "subscription_id"),
                "fact_support_tickets key": (silver["fact_support_tickets"], "ticket_id"),
                "feature_store target": (tables[("GOLD", "feature_store_churn")], "is_churned"),
            }
        ),
        "tiers": quality.tier_distribution(tables[("GOLD", "agg_company_health_score")]),
    }


