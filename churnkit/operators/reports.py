"""Portfolio, risk and action reports. Predictions are always those of the newest day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnkit.functions import (
    amount_text,
    category_rank,
    col,
    count_if,
    exact_avg,
    factor_names,
    num,
    parse_factors,
    percent_text,
    ratio_or_null,
    round_dec,
    text_or,
)
from churnkit.operators.actions import filter_predictions
from churnkit.operators.relational import latest_only, look_up, named_in, pivot_counts, top_k, union_all, with_share
from churnkit.schemas import ACTION_STATUSES

TIER_ORDER = ("High", "Medium", "Low")


def _latest(predictions: DataFrame) -> DataFrame:
    return latest_only(predictions, "prediction_date")


def kpi_summary(predictions: DataFrame, actions: DataFrame, health: DataFrame) -> DataFrame:
    """One row of headline figures. Each source is summed once; the two one-row sums are then added up."""
    zero = F.lit(0).cast("bigint")
    scored = _latest(predictions).agg(
        F.count(F.lit(1)).alias("total_companies"), count_if(F.col("risk_tier") == "High").alias("high_risk")
    )
    # Pending actions per company first, so the join sees one row per company.
    per_company = actions.groupBy("company_id").agg(
        count_if(F.col("status") == "pending").alias("_pending"),
        count_if(F.col("status") == "approved").alias("_approved"),
        count_if(F.col("status") == "rejected").alias("_rejected"),
    )
    queue = per_company.join(health.select("company_id", "mrr"), "company_id", "left").agg(
        F.sum("_pending").alias("pending_actions"),
        F.sum("_approved").alias("approved_actions"),
        F.sum("_rejected").alias("rejected_actions"),
        F.sum(F.col("_pending") * F.col("mrr").cast("decimal(18,4)")).alias("_mrr"),
    )
    money = "decimal(38,4)"
    both = union_all(
        scored.select("total_companies", "high_risk", zero.alias("pending_actions"), zero.alias("approved_actions"),
                      zero.alias("rejected_actions"), F.lit(None).cast(money).alias("_mrr")),
        queue.select(zero.alias("total_companies"), zero.alias("high_risk"), "pending_actions", "approved_actions",
                     "rejected_actions", F.col("_mrr").cast(money).alias("_mrr")),
    )
    names = ("total_companies", "high_risk", "pending_actions", "approved_actions", "rejected_actions")
    return both.agg(
        *[F.coalesce(F.sum(n), zero).alias(n) for n in names], F.round(F.sum("_mrr"), 0).cast("double").alias("mrr_at_risk")
    )


def scored_companies(predictions: DataFrame, companies: DataFrame, health: DataFrame) -> DataFrame:
    """Newest prediction of each company with its profile and health."""
    return (
        _latest(predictions)
        .select("company_id", "prediction_date", "churn_probability", "risk_tier", "top_factors")
        .join(
            companies.select("company_id", "company_name", F.col("sector_label").alias("industry"), "company_size"),
            "company_id",
        )
        .join(
            health.select(
                "company_id", "mrr", "health_score", F.col("risk_tier").alias("health_risk_tier"), "days_to_renewal"
            ),
            "company_id",
        )
    )


def top10_risk_profile(scored: DataFrame, k: int = 10) -> DataFrame:
    return top_k(scored, [F.desc("churn_probability"), F.asc("company_id")], k).select(
        "company_name", "industry", "company_size", "mrr", "health_score", "health_risk_tier", "days_to_renewal",
        "churn_probability", "top_factors",
    )


def portfolio_stats(predictions: DataFrame, health: DataFrame) -> DataFrame:
    tier = F.col("risk_tier")
    joined = _latest(predictions).select("company_id", "risk_tier").join(health.select("company_id", "mrr"), "company_id")
    at_risk = F.sum(F.when(tier == "High", F.col("mrr")).otherwise(0).cast("decimal(18,4)"))
    return joined.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(tier == "High").alias("n_high"),
        count_if(tier == "Medium").alias("n_medium"),
        count_if(tier == "Low").alias("n_low"),
        F.round(at_risk, 0).cast("double").alias("mrr_high_risk"),
    )


def action_distribution(actions: DataFrame) -> DataFrame:
    return (
        actions.groupBy("action_type", "status").agg(F.count(F.lit(1)).alias("n")).orderBy("action_type", "status")
    )


PORTFOLIO_SECTIONS = ("All companies", "Ten companies most likely to leave", "Retention actions")


def portfolio_text(predictions: DataFrame, companies: DataFrame, health: DataFrame, actions: DataFrame) -> DataFrame:
    """The summary as numbered text lines: a heading for each section (line 0), totals, the ten riskiest companies with their factors,
    actions by type and status."""
    stats = portfolio_stats(predictions, health)
    whole = lambda c: F.col(c).cast("bigint").cast("string")
    totals = (
        F.concat(F.lit("Companies: "), whole("total")),
        F.concat(F.lit("High: "), whole("n_high"), F.lit(" | Medium: "), whole("n_medium"), F.lit(" | Low: "), whole("n_low")),
        F.concat(F.lit("MRR at high risk: "), whole("mrr_high_risk")),
    )
    lines = [(i, 0, F.lit(f"=== {title} ===")) for i, title in enumerate(PORTFOLIO_SECTIONS, 1)] + [(1, i, text) for i, text in enumerate(totals, 1)]
    head = stats.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("section"), F.lit(n).alias("line_no"), text.alias("line")) for i, n, text in lines]))
    )
    line = F.concat_ws(
        " | ",
        "company_name",
        "industry",
        "company_size",
        F.concat(F.lit("MRR "), text_or(F.floor("mrr"), "N/A")),
        F.concat(F.lit("Health "), F.col("health_score").cast("string"), F.lit("/100")),
        F.concat(F.lit("Churn "), percent_text("churn_probability")),
        "health_risk_tier",
        F.concat(F.lit("Renewal in "), text_or("days_to_renewal", "N/A")),
        F.concat(F.lit("Factors: "), text_or("top_factors", "N/A")),
    )
    scored = scored_companies(predictions, companies, health)
    riskiest = top_k(scored, [F.desc("churn_probability"), F.asc("company_id")], 10)
    # Ten rows and one row per type and status: numbering them in one task is bounded.
    by_risk = F.row_number().over(W.orderBy(F.desc("churn_probability"), F.asc("company_id")))
    by_type = F.row_number().over(W.orderBy(F.asc("action_type"), F.asc("status")))
    body = riskiest.select(F.lit(2).alias("section"), by_risk.alias("line_no"), line.alias("line"))
    tail = (
        actions.groupBy("action_type", "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit(3).alias("section"),
            by_type.alias("line_no"),
            F.concat_ws(" / ", "action_type", "status", F.col("n").cast("string")).alias("line"),
        )
    )
    return union_all(head, body, tail).orderBy("section", "line_no")


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Count, mean probability and share per tier, riskiest tier first."""
    latest = _latest(predictions)
    means = latest.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n"), round_dec(exact_avg("churn_probability") * 100, 1).alias("avg_prob")
    )
    return with_share(means).orderBy(category_rank("risk_tier", TIER_ORDER))


def pending_actions(view: DataFrame) -> DataFrame:
    return view.orderBy(F.desc("mrr"), F.desc_nulls_last("churn_probability"), F.asc("action_id"))


def pending_total(view: DataFrame) -> DataFrame:
    return view.agg(F.count(F.lit(1)).alias("n"), F.sum(num("mrr").cast("decimal(18,4)")).cast("double").alias("mrr_total"))


def all_actions(actions: DataFrame, companies: DataFrame, health: DataFrame) -> DataFrame:
    profile = (
        named_in(companies, actions, "company_id")
        .select("company_id", "company_name")
        .join(health.select("company_id", "mrr"), "company_id")
    )
    rows = actions.select("action_id", "company_id", "action_type", "status", "outcome", "created_at", "approved_at")
    return look_up(rows, profile, "company_id", "inner")


def recent_actions(listed: DataFrame, k: int = 10) -> DataFrame:
    return top_k(listed, [F.desc("created_at"), F.asc("action_id")], k).select(
        "action_id", "company_name", "mrr", "action_type", "status", "created_at"
    )


def predictions_view(
    scored: DataFrame, tiers: Sequence[str] = (), min_prob: float = 0.0, sizes: Sequence[str] = ()
) -> DataFrame:
    """Filtered list for display: probability in percent, whole MRR."""
    return (
        filter_predictions(scored, tiers, min_prob, sizes)
        .select(
            "company_id", "company_name", "industry", "company_size",
            round_dec(num("mrr"), 0).cast("bigint").alias("mrr"),
            "days_to_renewal", "health_score",
            round_dec(F.col("churn_probability") * 100, 1).alias("churn_pct"),
            "risk_tier", "prediction_date",
        )
        .orderBy(F.desc("churn_pct"), F.asc("company_id"))
    )


def action_crosstab(actions: DataFrame, statuses: Sequence[str] = ACTION_STATUSES) -> DataFrame:
    counts = actions.groupBy("action_type", "status").agg(F.count(F.lit(1)).alias("n"))
    return pivot_counts(counts, "action_type", "status", statuses).orderBy("action_type")


def action_stats(actions: DataFrame) -> DataFrame:
    status, kind = F.col("status"), F.col("action_type")
    done = status == "completed"
    return actions.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(status == "pending").alias("pending"),
        count_if(status == "approved").alias("approved"),
        count_if(status == "rejected").alias("rejected"),
        count_if(done & (F.col("outcome") == "saved")).alias("saved"),
        count_if(done & (F.col("outcome") == "churned")).alias("churned"),
        count_if(kind == "email").alias("n_email"),
        count_if(kind == "call").alias("n_call"),
        count_if(kind == "discount").alias("n_discount"),
        count_if(kind == "escalation").alias("n_escalation"),
    )


def save_rate(actions: DataFrame) -> DataFrame:
    """Saved share of the closed actions; NULL when none is closed."""
    s = action_stats(actions)
    return s.select("saved", "churned", ratio_or_null("saved", col("saved") + col("churned")).alias("save_rate"))


def action_card(view: DataFrame) -> DataFrame:
    """Display texts of one action per row."""
    return view.select(
        "action_id",
        F.upper("action_type").alias("action_type"),
        "channel",
        "risk_tier",
        percent_text("churn_probability").alias("churn"),
        amount_text("mrr", "EUR per month").alias("mrr"),
        F.concat(text_or("company_name", "?"), F.lit(" ("), text_or("industry", "?"), F.lit(", "),
                 text_or("company_size", "?"), F.lit(")")).alias("company"),
        F.concat(text_or("contact_name", "N/A"), F.lit(" - "), text_or("contact_role", "?"), F.lit(" ("),
                 text_or("contact_email", "?"), F.lit(")")).alias("contact"),
        F.concat(text_or("agent_name", "N/A"), F.lit(" ("), text_or("agent_region", "?"), F.lit(")")).alias("manager"),
        F.concat(text_or("days_to_renewal", "?"), F.lit(" days")).alias("renewal"),
        F.concat(text_or("health_score", "?"), F.lit("/100")).alias("health"),
        F.array_join(factor_names(parse_factors("top_factors"), 3), ", ").alias("signals"),
        F.substring(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), 1, 16).alias("created"),
        F.col("generated_content").alias("content"),
    )
