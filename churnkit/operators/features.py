"""Churn feature store: one row per company, 33 model inputs and the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import (
    avg_if,
    band,
    count_if,
    day,
    days_between,
    in_domain,
    lookup,
    or_default,
    round_dec,
    safe_ratio,
    since,
)
from churnkit.operators.relational import latest_and_previous, latest_per_key
from churnkit.schemas import (
    EVENT_TYPE_UNIVERSE,
    LABEL,
    NEUTRAL_NPS,
    NEVER_LOGGED_IN_DAYS,
    NPS_PASSIVE,
    NUMERIC_FEATURES,
    OPEN_STATUSES,
    SIZE_CODES,
)


#: Days of a mask; one bit stays for the sign.
MASK_DAYS = 63


def _day_mask(cond: Column, days_in: Column, name: str) -> Column:
    """The days of a span as bits of one number."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), days_in)
    return F.coalesce(F.bit_or(F.when(cond, bit)), F.lit(0).cast("bigint")).alias(name)


def usage_features(events: DataFrame, as_of=None, universe: int = EVENT_TYPE_UNIVERSE) -> DataFrame:
    """Active days, events, types and users of the trailing windows.

    Events are folded to one row per company and recent user, with days as bits, and these to one row per company, so nothing is counted
    as distinct but by its key. Types are made distinct by themselves, from recent events only. Trailing windows have no upper bound: days too far ahead for
    the mask are counted apart, by a filter that reads nothing where there are none.
    """
    on = F.col("event_date")
    recent, last90, today = since(on, as_of, 30), since(on, as_of, 90), day(as_of)
    far = days_between(on, today) >= MASK_DAYS - 30
    older = band(on, as_of, 90, 30)
    folded = events.groupBy("company_id", F.when(recent, F.col("contact_id")).alias("_contact")).agg(
        _day_mask(older, days_between(on, today) + 90, "_older"),
        _day_mask(recent & ~far, days_between(on, today) + 30, "_recent"),
        count_if(recent).alias("_30"), count_if(band(on, as_of, 60, 30)).alias("_60"), count_if(band(on, as_of, 90, 60)).alias("_90"),
        count_if(last90).alias("_all"), F.max(on).alias("_last"),
    )
    counted = folded.groupBy("company_id").agg(
        F.bit_or("_older").alias("_older"), F.bit_or("_recent").alias("_recent"), F.count("_contact").alias("active_users_30d"),
        F.sum("_30").alias("events_30d"), F.sum("_60").alias("events_30_60d"), F.sum("_90").alias("events_60_90d"),
        F.sum("_all").alias("events_90d"), F.max("_last").alias("_last"),
    )

    def kinds(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.select("company_id", column).distinct().groupBy("company_id").agg(F.count(column).alias(name))

    types = kinds(events.filter(recent), "event_type", "_types")
    ahead = kinds(events.filter(on >= F.date_add(today, MASK_DAYS - 30)), "event_date", "_ahead")
    rows = counted.join(types, "company_id", "left").join(ahead, "company_id", "left")
    late = F.coalesce("_ahead", F.lit(0))
    dau = F.bit_count("_recent") + late
    used = F.coalesce("_types", F.lit(0))
    return rows.select(
        "company_id",
        dau.alias("dau_last_30d"),
        (dau + F.bit_count("_older")).alias("dau_last_90d"),
        "events_30d", "events_30_60d", "events_60_90d", "events_90d",
        used.alias("distinct_features_used_30d"),
        "active_users_30d",
        round_dec(used / F.lit(float(universe)), 3).alias("feature_adoption_rate"),
        days_between(today, "_last").alias("days_since_last_login"),
    )


def support_features(tickets: DataFrame, as_of=None) -> DataFrame:
    opened = "created_at"
    last30, last90 = since(opened, as_of, 30), since(opened, as_of, 90)
    return tickets.groupBy("company_id").agg(
        count_if(last30).alias("ticket_count_30d"),
        count_if(last90).alias("ticket_count_90d"),
        count_if(since(opened, as_of, 14)).alias("ticket_velocity_14d"),
        count_if((F.col("priority") == "P1") & last30).alias("p1_ticket_count_30d"),
        round_dec(avg_if(last30, "sentiment_score"), 3).alias("avg_ticket_sentiment_30d"),
        round_dec(avg_if(last90, "sentiment_score"), 3).alias("avg_ticket_sentiment_90d"),
        count_if(in_domain("status", OPEN_STATUSES)).alias("open_ticket_count"),
        count_if(F.col("is_escalated") & last90).alias("escalation_count_90d"),
        round_dec(avg_if(last30, "ttr_hours"), 1).alias("avg_ttr_hours_30d"),
    )


def nps_features(nps: DataFrame) -> DataFrame:
    pair = latest_and_previous(nps, "company_id", [F.desc("survey_date"), F.desc("survey_id")], ["nps_score"])
    latest = F.col("nps_score_latest")
    previous = F.coalesce("nps_score_previous", latest)
    return pair.select(
        "company_id",
        latest.alias("nps_latest"),
        previous.alias("nps_previous"),
        (latest - previous).alias("nps_delta_vs_prev"),
        (latest < NPS_PASSIVE).cast("int").alias("is_detractor"),
    )


def contract_profile(subscriptions: DataFrame) -> DataFrame:
    """Per company the current contract (as in ``current_contract``) and what its past ones show.

    The current one is ranked, so a task sends one row per company on; the past ones are plain numbers, summed by hash.
    """
    current = F.col("is_current_contract")
    fields = ("start_date", "subscription_id", "mrr", "end_date", "duration_days", "billing_cycle", "status")
    newest = latest_per_key(
        subscriptions.filter(current).select("company_id", *fields), ["company_id"], [F.desc("start_date"), F.desc("subscription_id")]
    )
    past = subscriptions.filter(~current).groupBy("company_id").agg(
        F.max("mrr").alias("past_mrr"), count_if(F.col("status") == "upgraded").alias("_upgrades")
    )
    return newest.select("company_id", F.struct(*fields).alias("current")).join(past, "company_id", "left").select(
        "company_id", "current", "past_mrr", F.coalesce("_upgrades", F.lit(0)).cast("bigint").alias("past_upgrades")
    )


def _contract_columns(as_of) -> list[Column]:
    now = F.col("current")
    mrr = now["mrr"].cast("double")
    base = F.coalesce(F.col("past_mrr").cast("double"), mrr)
    return [
        now["mrr"].alias("mrr_current"),
        days_between(now["end_date"], day(as_of)).alias("days_to_renewal"),
        now["duration_days"].alias("contract_duration_days"),
        now["billing_cycle"].alias("billing_cycle"),
        (now["status"] == "downgraded").cast("int").alias("has_downgraded"),
        F.col("past_upgrades").alias("upgrade_count"),
        round_dec((mrr - base) / F.greatest(base, F.lit(1.0)) * 100, 2).alias("mrr_trend_90d"),
    ]


def _label_column() -> Column:
    return (F.col("current")["status"] == "churned").cast("int").alias(LABEL)


def contract_features(subscriptions: DataFrame, as_of=None) -> DataFrame:
    return contract_profile(subscriptions).select("company_id", *_contract_columns(as_of))


def contact_counts(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("contact_count"),
        count_if(F.col("is_decision_maker")).alias("decision_maker_count"),
    )


def churn_label(subscriptions: DataFrame) -> DataFrame:
    return contract_profile(subscriptions).select("company_id", _label_column())


def decline_30d(e30, e30_60) -> Column:
    before = F.coalesce(e30_60, F.lit(0))
    change = F.coalesce(e30, F.lit(0)) - before
    return F.when(before == 0, F.lit(0.0)).otherwise(round_dec(safe_ratio(change, before, 100), 2))


def decline_90d(e90, e60_90) -> Column:
    before = F.coalesce(e60_90, F.lit(0))
    monthly = round_dec(F.coalesce(e90, F.lit(0)) / F.lit(3.0), 6)
    return F.when(before == 0, F.lit(0.0)).otherwise(round_dec(safe_ratio(monthly - before, before, 100), 2))


def active_users_ratio(active_users, contacts) -> Column:
    return round_dec(safe_ratio(F.coalesce(active_users, F.lit(0)), F.coalesce(contacts, F.lit(1))), 3)


# Value of a feature for a company without any such fact.
DEFAULTS = {
    "dau_last_30d": 0,
    "dau_last_90d": 0,
    "distinct_features_used_30d": 0,
    "feature_adoption_rate": 0.0,
    "days_since_last_login": NEVER_LOGGED_IN_DAYS,
    "ticket_count_30d": 0,
    "ticket_count_90d": 0,
    "ticket_velocity_14d": 0,
    "p1_ticket_count_30d": 0,
    "avg_ticket_sentiment_30d": 0.0,
    "avg_ticket_sentiment_90d": 0.0,
    "open_ticket_count": 0,
    "escalation_count_90d": 0,
    "avg_ttr_hours_30d": 0.0,
    "nps_latest": NEUTRAL_NPS,
    "nps_previous": NEUTRAL_NPS,
    "nps_delta_vs_prev": 0,
    "is_detractor": 0,
    "mrr_current": 0,
    "mrr_trend_90d": 0.0,
    "days_to_renewal": 0,
    "contract_duration_days": 0,
    "billing_cycle": "unknown",
    "has_downgraded": 0,
    "upgrade_count": 0,
    LABEL: 0,
}


def feature_store(
    companies: DataFrame,
    events: DataFrame,
    tickets: DataFrame,
    nps: DataFrame,
    subscriptions: DataFrame,
    contacts: DataFrame,
    as_of=None,
    computed_at=None,
    universe: int = EVENT_TYPE_UNIVERSE,
) -> DataFrame:
    c = F.col
    rows = companies.select("company_id", "company_size", "customer_since")
    # The label sits on the same current contract as the contract features: one pass serves both.
    label_and_contract = contract_profile(subscriptions).select(
        "company_id", *_contract_columns(as_of), _label_column()
    )
    for side in (
        usage_features(events, as_of, universe),
        support_features(tickets, as_of),
        nps_features(nps),
        label_and_contract,
        contact_counts(contacts),
    ):
        rows = rows.join(side, "company_id", "left")
    derived = {
        "usage_decline_pct_30d": decline_30d(c("events_30d"), c("events_30_60d")),
        "usage_decline_pct_90d": decline_90d(c("events_90d"), c("events_60_90d")),
        "active_users_ratio": active_users_ratio(c("active_users_30d"), c("contact_count")),
        "sentiment_trend": round_dec(
            or_default("avg_ticket_sentiment_30d", 0.0) - or_default("avg_ticket_sentiment_90d", 0.0), 3
        ),
        "company_size_encoded": lookup("company_size", SIZE_CODES, SIZE_CODES["GE"]),
        "customer_tenure_days": days_between(day(as_of), "customer_since"),
        "num_contacts": or_default("contact_count", 0),
        "num_decision_makers": or_default("decision_maker_count", 0),
    }
    columns = [
        (derived[f] if f in derived else or_default(f, DEFAULTS[f])).alias(f)
        for f in (*NUMERIC_FEATURES, "billing_cycle", LABEL)
    ]
    at = F.current_timestamp() if computed_at is None else computed_at
    return rows.select("company_id", *columns, at.alias("feature_computed_at"))


