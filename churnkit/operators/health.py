"""Company health: four activity summaries, five component scores, one weighted score and tier.

Every fact is summed per company before it meets another table, so the joins only see one row per company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import (
    avg_if,
    band,
    clamp,
    count_if,
    day,
    days_between,
    health_tier,
    in_domain,
    or_default,
    since,
    trunc_int,
)
from churnkit.operators.relational import latest_per_key, one_row_per_key
from churnkit.schemas import (
    HEALTH_HIGH_BELOW,
    HEALTH_MEDIUM_BELOW,
    HEALTH_WEIGHTS_PCT,
    NEUTRAL_NPS,
    URGENT_PRIORITIES,
)


def usage_activity(events: DataFrame, as_of=None) -> DataFrame:
    """Event counts per window, distinct event types of the last 30 days, newest event date."""
    recent_type = F.when(since("event_date", as_of, 30), F.col("event_type"))
    # One row per company and recent type; all older events of a company fold into its NULL row.
    per_type = events.groupBy("company_id", recent_type.alias("_type")).agg(
        count_if(since("event_date", as_of, 30)).alias("events_30d"),
        count_if(since("event_date", as_of, 90)).alias("events_90d"),
        count_if(band("event_date", as_of, 60, 30)).alias("events_30_60d"),
        F.max("event_date").alias("last_event_date"),
    )
    return per_type.groupBy("company_id").agg(
        F.sum("events_30d").alias("events_30d"),
        F.sum("events_90d").alias("events_90d"),
        F.sum("events_30_60d").alias("events_30_60d"),
        F.count("_type").alias("distinct_features_30d"),
        F.max("last_event_date").alias("last_event_date"),
    )


def support_activity(tickets: DataFrame, as_of=None) -> DataFrame:
    recent = since("created_at", as_of, 30)
    return tickets.groupBy("company_id").agg(
        count_if(recent).alias("tickets_30d"),
        count_if(since("created_at", as_of, 90)).alias("tickets_90d"),
        avg_if(recent, "sentiment_score").alias("avg_sentiment_30d"),
        count_if(in_domain("priority", URGENT_PRIORITIES) & recent).alias("p1p2_count_30d"),
    )


def latest_nps(nps: DataFrame) -> DataFrame:
    newest = latest_per_key(nps, ["company_id"], [F.desc("survey_date"), F.desc("survey_id")])
    return one_row_per_key(newest.select("company_id", F.col("nps_score").alias("nps_latest"), "nps_category"), "company_id")


def current_contract(subscriptions: DataFrame) -> DataFrame:
    """One current contract per company; of two with the same start the higher id counts."""
    newest = latest_per_key(
        subscriptions.filter(F.col("is_current_contract")),
        ["company_id"],
        [F.desc("start_date"), F.desc("subscription_id")],
    )
    return one_row_per_key(newest, "company_id").select(*subscriptions.columns)


def contract_state(subscriptions: DataFrame, as_of=None) -> DataFrame:
    status = F.col("status")
    # Health in percent points: 100, 30 or 70.
    health = F.when(status == "active", 100).when(in_domain(status, ("downgraded", "churned")), 30).otherwise(70)
    return current_contract(subscriptions).select(
        "company_id",
        "mrr",
        status.alias("contract_status"),
        days_between("end_date", day(as_of)).alias("days_to_renewal"),
        health.alias("payment_health_pct"),
    )


def usage_score(events_30d, events_90d) -> Column:
    """Last 30 days against a third of the last 90, on decimals as the definition has it."""
    e30, e90 = F.coalesce(events_30d, F.lit(0)), F.coalesce(events_90d, F.lit(0))
    third = (e90.cast("decimal(20,0)") / F.lit(3).cast("decimal(2,1)")).cast("decimal(27,6)") + 1
    ratio = e30.cast("decimal(20,0)") * 100 / third.cast("decimal(28,6)")
    return F.when(e90 == 0, F.lit(0)).otherwise(clamp(ratio.cast("bigint"), 0, 100)).cast("int")


def support_score(tickets_30d, p1p2_30d, avg_sentiment) -> Column:
    raw = (
        F.lit(100)
        - F.coalesce(tickets_30d, F.lit(0)) * 5
        - F.coalesce(p1p2_30d, F.lit(0)) * 15
        + F.coalesce(avg_sentiment, F.lit(0.0)) * 20
    )
    return clamp(raw.cast("bigint"), 0, 100).cast("int")


def engagement_trend(events_30d, events_30_60d) -> Column:
    e30, before = F.coalesce(events_30d, F.lit(0)), F.coalesce(events_30_60d, F.lit(0))
    return F.when(before == 0, F.lit(50)).otherwise(clamp(50 + (e30 - before) * 5, 0, 100)).cast("int")


def component_scores(
    companies: DataFrame, usage: DataFrame, support: DataFrame, nps: DataFrame, contracts: DataFrame
) -> DataFrame:
    """All companies with their summaries, defaults for what is missing, and the five scores."""
    c = F.col
    joined = companies.select("company_id")
    for side in (usage, support, nps, contracts):
        joined = joined.join(side, "company_id", "left")
    return joined.select(
        "company_id",
        usage_score(c("events_30d"), c("events_90d")).alias("usage_score"),
        support_score(c("tickets_30d"), c("p1p2_count_30d"), c("avg_sentiment_30d")).alias("support_score"),
        F.coalesce(c("nps_latest") * 10, F.lit(50)).cast("int").alias("nps_score"),
        F.coalesce(c("payment_health_pct"), F.lit(50)).cast("int").alias("payment_score"),
        engagement_trend(c("events_30d"), c("events_30_60d")).alias("engagement_trend"),
        or_default("events_30d", 0).alias("events_30d"),
        or_default("events_90d", 0).alias("events_90d"),
        or_default("distinct_features_30d", 0).alias("distinct_features_30d"),
        "last_event_date",
        or_default("tickets_30d", 0).alias("tickets_30d"),
        or_default("avg_sentiment_30d", 0.0).alias("avg_sentiment_30d"),
        or_default("nps_latest", NEUTRAL_NPS).alias("nps_latest"),
        "nps_category",
        "mrr",
        "days_to_renewal",
        "contract_status",
    )


def with_health_score(scores: DataFrame) -> DataFrame:
    """Weighted score, cut to an integer, and the tier of the uncut sum."""
    points = sum((F.col(name) * weight for name, weight in HEALTH_WEIGHTS_PCT.items()), F.lit(0))
    return (
        scores.withColumn("_points", points)
        .withColumn("health_score", trunc_int(F.col("_points").cast("decimal(20,0)") / 100))
        .withColumn("risk_tier", health_tier("_points", HEALTH_HIGH_BELOW, HEALTH_MEDIUM_BELOW))
        .drop("_points")
    )


def company_health(
    companies: DataFrame,
    events: DataFrame,
    tickets: DataFrame,
    nps: DataFrame,
    subscriptions: DataFrame,
    as_of=None,
    computed_at=None,
) -> DataFrame:
    scored = with_health_score(
        component_scores(
            companies,
            usage_activity(events, as_of),
            support_activity(tickets, as_of),
            latest_nps(nps),
            contract_state(subscriptions, as_of),
        )
    )
    return scored.withColumn("last_computed_at", F.current_timestamp() if computed_at is None else computed_at)
