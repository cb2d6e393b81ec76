"""Star-schema tables read as the seven raw retention tables.

Each formula is deterministic arithmetic on the given columns, so the raw rows grow with the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions import factors_json, lookup, pick, quarter_label, right_closed_bins
from churnkit.schemas import ACTION_CHANNELS, ACTION_TYPES, ML_LOW_UP_TO, ML_MEDIUM_UP_TO

AS_OF = dt.date(2001, 8, 1)
EVENTS_END = dt.date(2024, 1, 31)
EVENT_TYPES = 5
ROLES = ("CEO", "CFO", "CTO", "VP Sales", "Office Manager", "Analyst")
FACTOR_STEPS = {
    "dau_last_30d": 7,
    "days_to_renewal": 11,
    "mrr_trend_90d": 13,
    "nps_latest": 17,
    "open_ticket_count": 19,
    "sentiment_trend": 23,
}


@dataclass
class Tables:
    """The given Parquet tables of one folder, each opened when first named."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table
        return table


def _load_stamp(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("_ingested_at", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")).withColumn(
        "_source", F.lit(source)
    )


def _as_ntz(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def agents(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("agent_id"),
        F.col("n_name").alias("first_name"),
        F.concat(F.lit("of "), F.col("r_name")).alias("last_name"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("@X.COM ")).alias("email"),
        F.col("r_name").alias("region"),
        pick(["enterprise", "midmarket", "small"], F.pmod(key, F.lit(3))).alias("specialization"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), key * 100).alias("hire_date"),
        (F.pmod(key, F.lit(5)) != 0).alias("is_active"),
    )
    return _load_stamp(rows, "hr")


def companies(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    first_order = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").cast("date").alias("subscription_start_date")
    )
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
    rows = (
        t.customer.join(first_order, "c_custkey", "left")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("company_id"),
            F.col("c_name").alias("company_name"),
            F.lpad(key.cast("string"), 9, "0").alias("siren"),
            F.substring("c_mktsegment", 1, 4).alias("sector_naf_code"),
            F.col("c_mktsegment").alias("sector_label"),
            F.when(F.col("c_acctbal") < 2000, "TPE")
            .when(F.col("c_acctbal") < 5000, "PME")
            .when(F.col("c_acctbal") < 8000, "ETI")
            .otherwise("GE")
            .alias("company_size"),
            (F.pmod(key, F.lit(500)) + 1).cast("int").alias("num_employees"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.lit("FR").alias("country"),
            F.concat(F.lower("c_name"), F.lit(".example")).alias("website"),
            "subscription_start_date",
            pick(["Starter", "Business", "Enterprise"], F.pmod(key, F.lit(3))).alias("plan_type"),
            F.floor("c_acctbal").cast("int").alias("base_mrr"),
            F.col("c_nationkey").alias("assigned_cs_agent_id"),
            F.concat(F.lit("profile_"), F.pmod(key, F.lit(4)).cast("string")).alias("churn_profile"),
        )
    )
    return _load_stamp(rows, "crm")


def contacts(t: Tables) -> DataFrame:
    """One to four people per customer."""
    key = F.col("person")
    role = F.pmod(key, F.lit(6))
    people = F.sequence(F.lit(0).cast("long"), F.pmod("c_custkey", F.lit(4)).cast("long"))
    rows = t.customer.withColumn("n", F.explode(people)).withColumn("person", F.col("c_custkey") * 4 + F.col("n")).select(
        key.alias("contact_id"),
        F.col("c_custkey").alias("company_id"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit("No "), key.cast("string")).alias("last_name"),
        F.when(F.pmod(key, F.lit(11)) != 10, F.concat(F.lit(" "), F.col("c_name"), F.lit("@X.COM "))).alias("email"),
        F.lpad(key.cast("string"), 8, "0").alias("phone"),
        pick(ROLES, role).alias("role"),
        (role < 3).alias("is_decision_maker"),
        (F.pmod(key, F.lit(4)) == 0).alias("is_primary_contact"),
        _as_ntz(F.date_add(F.lit(dt.date(1999, 1, 1)), F.pmod(key, F.lit(700)).cast("int"))).alias("created_at"),
    )
    return _load_stamp(rows, "crm")


def subscriptions(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    even = F.pmod(key, F.lit(2)) == 0
    start = F.col("o_orderdate").cast("date")
    mrr = F.floor(F.col("o_totalprice") / 50).cast("int")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.when(even, "churned").otherwise("renewed"))
        .when(F.col("o_orderstatus") == "O", "active")
        .otherwise(pick(["downgraded", "upgraded", "active"], F.pmod(key, F.lit(3))))
    )
    rows = t.orders.select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("company_id"),
        pick(["Starter", "Business", "Enterprise"], F.pmod(key, F.lit(3))).alias("plan_type"),
        F.when(even, "annual").otherwise("monthly").alias("billing_cycle"),
        mrr.alias("mrr"),
        (mrr * 12).alias("arr"),
        start.alias("start_date"),
        F.date_add(start, F.when(even, 365).otherwise(30)).alias("end_date"),
        status.alias("status"),
        (F.pmod(key, F.lit(2)) + 1).cast("int").alias("contract_version"),
        (F.pmod(key, F.lit(3)) != 0).alias("auto_renew"),
    )
    return _load_stamp(rows, "billing")


def _lines_with_company(t: Tables, lines: DataFrame) -> DataFrame:
    # The next exchange is on the ticket key, so a skewed order partition may be split by the adaptive join.
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("company_id"))
    return lines.join(owner, "l_orderkey").withColumn("line_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def tickets(t: Tables) -> DataFrame:
    even = F.pmod(F.col("l_orderkey"), F.lit(2)) == 0
    status = F.when(
        F.col("l_linestatus") == "O", F.when(even, "open").otherwise("in_progress")
    ).otherwise(F.when(even, "resolved").otherwise("closed"))
    hours = F.col("l_quantity").cast("int")
    rows = (
        _lines_with_company(t, t.lineitem)
        .withColumn("status", status)
        .select(
            F.col("line_key").alias("ticket_id"),
            "company_id",
            F.col("l_suppkey").alias("contact_id"),
            F.col("l_returnflag").alias("category"),
            F.concat(F.lit("P"), (F.pmod(hours, F.lit(4)) + 1).cast("string")).alias("priority"),
            "status",
            F.concat(F.lit("Ticket "), F.col("line_key").cast("string")).alias("subject"),
            F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("description"),
            ((F.lit(0.04) - F.col("l_tax")) * 25).cast("decimal(4,2)").alias("sentiment_score"),
            F.col("l_shipdate").alias("created_at"),
            F.when(
                F.col("status").isin("resolved", "closed"),
                _as_ntz(F.date_add(F.col("l_shipdate").cast("date"), F.ceil(hours / 24).cast("int") + 1)),
            ).alias("resolved_at"),
            hours.alias("ttr_hours"),
            F.pmod(F.col("l_suppkey"), F.lit(25)).cast("int").alias("assigned_agent_id"),
            F.col("l_shipdate").alias("_ingested_at"),
            F.lit("helpdesk").alias("_source"),
        )
    )
    return rows


def nps(t: Tables) -> DataFrame:
    on = F.col("l_shipdate").cast("date")
    rows = _lines_with_company(t, t.lineitem).select(
        F.col("line_key").alias("survey_id"),
        "company_id",
        F.col("l_suppkey").alias("contact_id"),
        F.round(F.col("l_discount") * 100).cast("int").alias("nps_score"),
        F.lit("unchecked").alias("nps_category"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("comment"),
        on.alias("survey_date"),
        quarter_label(on).alias("quarter"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.lit("survey").alias("_source"),
    )
    return rows


def product_events(t: Tables) -> DataFrame:
    age = F.datediff(F.lit(EVENTS_END), F.col("ts").cast("date"))
    on = F.date_sub(F.lit(AS_OF), age * 3)
    rows = t.events.select(
        "event_id",
        F.col("user_id").alias("company_id"),
        F.pmod(F.col("event_id"), F.lit(7)).alias("contact_id"),
        "event_type",
        (_as_ntz(on) + F.make_dt_interval(F.lit(0), F.hour("ts"), F.lit(0), F.lit(0))).alias("event_timestamp"),
        F.concat(F.lit("S-"), F.lpad((F.col("event_id") % 99999).cast("string"), 5, "0")).alias("session_id"),
        pick(["desktop", "desktop", "mobile"], F.col("event_id") % 3).alias("device_type"),
        pick(["b0", "b1", "b2", "b3"], F.col("event_id") % 4).alias("browser"),
    )
    return _load_stamp(rows, "analytics")


def contributions(key: Column) -> Column:
    entries = []
    for name, step in FACTOR_STEPS.items():
        entries += [F.lit(name), ((F.pmod(key * step, F.lit(201)) - 100) / 100).cast("double")]
    return F.create_map(*entries)


def predictions(t: Tables) -> DataFrame:
    """Two scored days per customer."""
    key = F.col("c_custkey")
    probability = F.pmod(key * 37 + F.col("n"), F.lit(1000)) / F.lit(1000.0)
    return (
        t.customer.select(key, F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
        .withColumn("churn_probability", probability.cast("double"))
        .select(
            key.alias("company_id"),
            F.date_add(F.lit(AS_OF), F.col("n") - 1).alias("prediction_date"),
            "churn_probability",
            right_closed_bins("churn_probability", [ML_LOW_UP_TO, ML_MEDIUM_UP_TO, 1.001], ["Low", "Medium", "High"])
            .alias("risk_tier"),
            factors_json(contributions(key), 5).alias("top_factors"),
            F.lit("1").alias("model_version"),
            F.lit("churn_gbt").alias("model_name"),
        )
    )


def actions(t: Tables) -> DataFrame:
    """A queue with every state in it: one action per customer."""
    key = F.col("c_custkey")
    turn = F.floor(key / 5)
    status = pick(["queued", "pending", "approved", "rejected", "completed"], F.pmod(turn, F.lit(5)))
    queued = F.pmod(turn, F.lit(5)) == 0
    created = _as_ntz(F.date_sub(F.lit(AS_OF), F.pmod(key, F.lit(30)).cast("int")))
    one_day = F.make_dt_interval(F.lit(1))
    meta = F.concat(
        F.lit('{"key_signals":["dau_last_30d","nps_latest"],"rationale":"Case '), key.cast("string"),
        F.lit('","urgency":"high","churn_probability":0.8}'),
    )
    return (
        t.customer.withColumn("status", status)
        .withColumn("action_type", pick(list(ACTION_TYPES), F.pmod(key, F.lit(4))))
        .select(
            F.md5(key.cast("string")).alias("action_id"),
            key.alias("company_id"),
            F.when(~queued, key * 4).alias("contact_id"),
            F.when(~queued, F.col("c_nationkey")).alias("agent_id"),
            "action_type",
            lookup("action_type", ACTION_CHANNELS, "email").alias("channel"),
            "status",
            F.when(queued, F.when(F.pmod(key, F.lit(3)) == 0, "not json").otherwise(meta))
            .otherwise(F.concat(F.lit("Text for "), F.col("c_name")))
            .alias("generated_content"),
            created.alias("created_at"),
            F.when(F.col("status").isin("approved", "rejected", "completed"), created + one_day).alias("approved_at"),
            F.when(F.col("status") == "completed", created + one_day + one_day).alias("executed_at"),
            F.when(F.col("status") == "completed", F.when(F.pmod(key, F.lit(3)) == 0, "saved").otherwise("churned"))
            .otherwise("pending")
            .alias("outcome"),
            F.lit("risk_detection").alias("created_by_agent"),
        )
    )


def scored_labels(t: Tables) -> DataFrame:
    """Labelled rows with a score that has many ties and leans towards the label."""
    return t.labels.select(
        "doc_id",
        F.col("quality").alias("label"),
        ((F.pmod(F.col("doc_id") * 7919, F.lit(70)) + F.col("quality") * 30) / 100).cast("double").alias("score"),
        F.pmod(F.col("doc_id"), F.lit(3)).cast("int").alias("part"),
    )


READERS = {
    "agents": agents,
    "companies": companies,
    "contacts": contacts,
    "subscriptions": subscriptions,
    "nps": nps,
    "tickets": tickets,
    "events": product_events,
}


class RawTables(Mapping):
    """The seven raw frames by short name, each planned when first asked for."""

    def __init__(self, tables: Tables):
        self._tables = tables
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = READERS[name](self._tables)
        return self._planned[name]

    def __iter__(self):
        return iter(READERS)

    def __len__(self) -> int:
        return len(READERS)
