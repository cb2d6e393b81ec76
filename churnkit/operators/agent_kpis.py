"""Account-manager figures. Facts are summed per company before they are summed per manager."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import count_if, exact_avg, in_domain, or_default, round_dec, safe_ratio, since
from churnkit.operators.health import current_contract
from churnkit.schemas import NEUTRAL_NPS

KEPT_STATUSES = ("active", "renewed", "upgraded")


def _managed(companies: DataFrame) -> DataFrame:
    return companies.select("company_id", F.col("assigned_cs_agent_id").alias("agent_id"))


def agent_portfolio(companies: DataFrame, subscriptions: DataFrame, health: DataFrame) -> DataFrame:
    contracts = current_contract(subscriptions).select("company_id", "mrr")
    return (
        _managed(companies)
        .join(contracts, "company_id", "left")
        .join(health.select("company_id", "risk_tier"), "company_id", "left")
        .groupBy("agent_id")
        .agg(
            F.count("company_id").alias("portfolio_size"),
            F.sum(or_default("mrr", 0)).alias("total_mrr_managed"),
            count_if(F.col("risk_tier") == "High").alias("high_risk_count"),
        )
    )


def agent_churn(companies: DataFrame, subscriptions: DataFrame, as_of=None) -> DataFrame:
    """Lost and kept contracts started in the last 365 days. The kept ratio is per lost contract + 1."""
    recent = subscriptions.filter(since("start_date", as_of, 365))
    per_company = recent.groupBy("company_id").agg(
        count_if(F.col("status") == "churned").alias("_lost"),
        count_if(in_domain("status", KEPT_STATUSES)).alias("_kept"),
    )
    per_agent = (
        _managed(companies)
        .join(per_company, "company_id", "left")
        .groupBy("agent_id")
        .agg(
            F.count("company_id").alias("_companies"),
            F.sum(or_default("_lost", 0)).alias("_lost"),
            F.sum(or_default("_kept", 0)).alias("_kept"),
        )
    )
    return per_agent.select(
        "agent_id",
        round_dec(safe_ratio("_lost", "_companies", 100), 2).alias("churn_rate_12m"),
        round_dec(safe_ratio("_kept", F.col("_lost") + 1, 100), 2).alias("save_rate_12m"),
    )


def agent_response(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy(F.col("assigned_agent_id").alias("agent_id")).agg(
        round_dec(exact_avg("ttr_hours"), 1).alias("avg_response_time_hours")
    )


def agent_nps(companies: DataFrame, nps: DataFrame) -> DataFrame:
    per_company = nps.groupBy("company_id").agg(F.sum("nps_score").alias("_sum"), F.count("nps_score").alias("_n"))
    return (
        _managed(companies)
        .join(per_company, "company_id")
        .groupBy("agent_id")
        .agg(round_dec(F.sum("_sum").cast("double") / F.sum("_n"), 2).alias("avg_nps_portfolio"))
    )


def agent_performance(
    agents: DataFrame,
    companies: DataFrame,
    subscriptions: DataFrame,
    health: DataFrame,
    tickets: DataFrame,
    nps: DataFrame,
    as_of=None,
) -> DataFrame:
    rows = agents.select("agent_id")
    for side in (
        agent_portfolio(companies, subscriptions, health),
        agent_churn(companies, subscriptions, as_of),
        agent_response(tickets),
        agent_nps(companies, nps),
    ):
        rows = rows.join(side, "agent_id", "left")
    return rows.select(
        "agent_id",
        or_default("portfolio_size", 0).alias("portfolio_size"),
        or_default("total_mrr_managed", 0).alias("total_mrr_managed"),
        or_default("high_risk_count", 0).alias("high_risk_count"),
        or_default("churn_rate_12m", 0.0).alias("churn_rate_12m"),
        or_default("save_rate_12m", 0.0).alias("save_rate_12m"),
        or_default("avg_response_time_hours", 0.0).alias("avg_response_time_hours"),
        or_default("avg_nps_portfolio", float(NEUTRAL_NPS)).alias("avg_nps_portfolio"),
    )
