"""Raw tables to typed, unique, key-checked tables.

``companies`` may be left out of a fact conform when the consumer joins from the company table anyway:
rows of unknown companies then fall away in that join and the key check would only cost a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import all_of, in_domain, in_range, normalise_email, round_dec, days_between, day
from churnkit.operators.relational import any_match, dedup_latest, fk_valid, look_up, max_per_key
from churnkit.schemas import (
    COMPANY_SIZES,
    NPS_PASSIVE,
    NPS_PROMOTER,
    NPS_RANGE,
    OPEN_STATUSES,
    SENTIMENT_NEGATIVE,
    SENTIMENT_POSITIVE,
    URGENT_PRIORITIES,
)
from churnkit.sources.tables import drop_meta

RECENCY = ("_ingested_at",)

# Order in which equally new copies of a key are compared. The columns the summaries use come first, so a
# lean read, which drops the columns behind them (free text above all), keeps the very same values.
COMPANY_ORDER = ("assigned_cs_agent_id", "company_size", "base_mrr", "subscription_start_date")
SUBSCRIPTION_ORDER = ("company_id", "mrr", "start_date", "end_date", "status", "billing_cycle")
TICKET_ORDER = ("company_id", "priority", "status", "sentiment_score", "created_at", "ttr_hours", "assigned_agent_id")
EVENT_ORDER = ("company_id", "event_type", "event_timestamp", "contact_id")
NPS_ORDER = ("company_id", "nps_score", "survey_date")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(all_of([F.col(c).isNotNull() for c in columns]))


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})


def _unique(raw: DataFrame, key: str, order: Sequence[str] = (), lean: bool = False) -> DataFrame:
    # The name of the source is dropped, so copies that differ in nothing else are equal and it need not be shuffled.
    rest = [c for c in raw.columns if c not in {key, *RECENCY, "_source", *order}]
    compared = [*order] if lean else [*order, *rest]
    rows = require(raw, [key]).select(key, *RECENCY, *compared)
    return drop_meta(dedup_latest(rows, [key], RECENCY, compared))


def _checked(df: DataFrame, companies: DataFrame | None) -> DataFrame:
    return df if companies is None else fk_valid(df, companies, "company_id")


def nps_class(score) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c >= NPS_PROMOTER, "promoter").when(c >= NPS_PASSIVE, "passive").otherwise("detractor")


def sentiment_class(score) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return (
        F.when(c >= F.lit(SENTIMENT_POSITIVE), "positive")
        .when(c <= F.lit(SENTIMENT_NEGATIVE), "negative")
        .otherwise("neutral")
    )


def dim_agents(raw: DataFrame, as_of=None) -> DataFrame:
    hired = F.col("hire_date").cast("date")
    return _unique(raw, "agent_id").select(
        "agent_id",
        "first_name",
        "last_name",
        normalise_email("email").alias("email"),
        "region",
        "specialization",
        hired.alias("hire_date"),
        round_dec(days_between(day(as_of), hired) / F.lit(365.25), 1).alias("years_of_service"),
        "is_active",
    )


def _valid_companies(raw: DataFrame) -> DataFrame:
    return raw.filter(in_domain("company_size", COMPANY_SIZES) & (F.col("base_mrr") > 0))


def company_keys(raw: DataFrame) -> DataFrame:
    """Keys of the valid companies only: no copy has to be chosen, so nothing is sorted."""
    return require(_valid_companies(raw), ["company_id"]).select("company_id").distinct()


def dim_companies(raw: DataFrame, raw_subscriptions: DataFrame | None, lean: bool = False) -> DataFrame:
    """Valid companies; with the raw contracts also ``is_active``."""
    rows = (
        _unique(_valid_companies(raw), "company_id", COMPANY_ORDER, lean)
        .withColumn("subscription_start_date", F.col("subscription_start_date").cast("date"))
        .withColumnRenamed("subscription_start_date", "customer_since")
    )
    if raw_subscriptions is None:
        return rows
    active = any_match(raw_subscriptions, "company_id", F.col("status") == "active", "is_active")
    return rows.join(active, "company_id", "left").withColumn("is_active", F.coalesce("is_active", F.lit(False)))


def dim_contacts(raw: DataFrame, companies: DataFrame | None) -> DataFrame:
    rows = _unique(raw, "contact_id").filter(F.col("email").isNotNull())
    return _checked(rows, companies).withColumns(
        {"email": normalise_email("email"), "created_at": F.col("created_at").cast("timestamp")}
    )


def fact_subscriptions(raw: DataFrame, companies: DataFrame | None, lean: bool = False) -> DataFrame:
    """Contracts with ``is_current_contract``: the start equals the company's newest raw start."""
    newest = max_per_key(raw, "company_id", "start_date", "_newest")
    if companies is not None:
        newest = newest.join(companies.select("company_id"), "company_id")
    valid = raw.filter(F.col("mrr") > 0)
    # One lookup join carries both the key check and the newest start.
    rows = _unique(valid, "subscription_id", SUBSCRIPTION_ORDER, lean)
    return (
        look_up(rows, newest, "company_id", "inner")
        .withColumns(
            {
                "duration_days": days_between("end_date", "start_date"),
                "is_current_contract": F.coalesce(F.col("start_date") == F.col("_newest"), F.lit(False)),
            }
        )
        .withColumns({"start_date": F.col("start_date").cast("date"), "end_date": F.col("end_date").cast("date")})
        .drop("_newest")
    )


def fact_tickets(raw: DataFrame, companies: DataFrame | None, lean: bool = False) -> DataFrame:
    rows = _unique(raw, "ticket_id", TICKET_ORDER, lean)
    urgent_open = in_domain("priority", URGENT_PRIORITIES) & in_domain("status", OPEN_STATUSES)
    typed = {"sentiment_score": "double", "created_at": "timestamp", "resolved_at": "timestamp", "ttr_hours": "int"}
    return cast_columns(
        _checked(rows, companies).withColumns(
            {
                "sentiment_category": sentiment_class("sentiment_score"),
                "is_escalated": F.coalesce(urgent_open, F.lit(False)),
            }
        ),
        {c: t for c, t in typed.items() if c in rows.columns},
    )


def fact_events(raw: DataFrame, companies: DataFrame | None, lean: bool = False) -> DataFrame:
    rows = _unique(raw, "event_id", EVENT_ORDER, lean)
    return _checked(rows, companies).withColumns(
        {
            "event_timestamp": F.col("event_timestamp").cast("timestamp"),
            "event_date": F.col("event_timestamp").cast("date"),
            "event_hour": F.hour("event_timestamp"),
        }
    )


def fact_nps(raw: DataFrame, companies: DataFrame | None, lean: bool = False) -> DataFrame:
    valid = raw.filter(in_range("nps_score", *NPS_RANGE))
    rows = _unique(valid, "survey_id", NPS_ORDER, lean)
    return _checked(rows, companies).withColumns(
        {
            "nps_score": F.col("nps_score").cast("int"),
            "nps_category": nps_class("nps_score"),
            "survey_date": F.col("survey_date").cast("date"),
        }
    )
