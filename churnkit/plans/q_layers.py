"""Queries for the conformed tables, health, features, account managers and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnkit.operators import agent_kpis as K
from churnkit.operators import features as FS
from churnkit.operators import health as H
from churnkit.operators import quality as Q
from churnkit.operators.relational import union_all
from churnkit.plans.medallion import RAW_NAMES, catalog_report, run_all
from churnkit.plans.oracle_base import rnd
from churnkit.plans.registry import query
from churnkit.schemas import COLUMN_COMMENTS, LAYERS, TABLE_COMMENTS
from churnkit.session import ensure_checkpoint_dir
from churnkit.sources.adapters import AS_OF, EVENT_TYPES

def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


# --- conformed tables -------------------------------------------------------------


@query("silver_agents", "SELECT * FROM dim_agents")
def _(s):
    return s.stored.agents


@query("silver_companies", "SELECT * FROM dim_companies")
def _(s):
    return s.stored.companies


@query("silver_contacts", "SELECT * FROM dim_contacts")
def _(s):
    return s.stored.contacts


@query("silver_subscriptions", "SELECT * FROM fact_subscriptions")
def _(s):
    return s.stored.subscriptions


@query("silver_tickets", "SELECT * FROM fact_tickets")
def _(s):
    return s.stored.tickets


@query("silver_events", "SELECT * FROM fact_events")
def _(s):
    return s.stored.events


@query("silver_nps", "SELECT * FROM fact_nps")
def _(s):
    return s.stored.nps


# --- health -----------------------------------------------------------------------

@query("health_usage", "SELECT * FROM usage_activity")
def _(s):
    return H.usage_activity(s.gold.events, AS_OF)


@query("health_support", "SELECT * FROM support_activity")
def _(s):
    return H.support_activity(s.gold.tickets, AS_OF)


@query("health_nps", "SELECT * FROM latest_nps")
def _(s):
    return H.latest_nps(s.gold.nps)


@query("health_contract", "SELECT * FROM contract_state")
def _(s):
    return H.contract_state(s.gold.subscriptions, AS_OF)


@query("health_components", "SELECT company_id, usage_score, support_score, nps_score, payment_score, engagement_trend FROM components")
def _(s):
    return s.gold.health.select(
        "company_id", "usage_score", "support_score", "nps_score", "payment_score", "engagement_trend"
    )


@query("health_score", "SELECT company_id, health_score, risk_tier FROM health")
def _(s):
    return s.gold.health.select("company_id", "health_score", "risk_tier")


@query("company_health", "SELECT * FROM health")
def company_health(s):
    return s.gold.health.drop("last_computed_at")


# --- features ---------------------------------------------------------------------

@query("feat_usage", "SELECT * FROM usage_features")
def _(s):
    return FS.usage_features(s.gold.events, AS_OF, EVENT_TYPES)


@query("feat_support", "SELECT * FROM support_features")
def _(s):
    return FS.support_features(s.gold.tickets, AS_OF)


@query("feat_nps", "SELECT * FROM nps_features")
def _(s):
    return FS.nps_features(s.gold.nps)


@query("feat_contract", "SELECT * FROM contract_features")
def _(s):
    return FS.contract_features(s.gold.subscriptions, AS_OF)


@query("feat_contacts", "SELECT * FROM contact_counts")
def _(s):
    return FS.contact_counts(s.gold.contacts)


@query("feat_label", "SELECT * FROM churn_label")
def _(s):
    return FS.churn_label(s.gold.subscriptions)


@query("feat_declines", f"""
    SELECT company_id,
           CASE WHEN events_30_60d = 0 THEN 0.0::DOUBLE ELSE {rnd("CAST(events_30d - events_30_60d AS DOUBLE) * 100 / events_30_60d", 2)} END AS usage_decline_pct_30d,
           CASE WHEN events_60_90d = 0 THEN 0.0::DOUBLE ELSE {rnd("(" + rnd("events_90d / 3.0::DOUBLE", 6) + " - events_60_90d) * 100 / events_60_90d", 2)} END AS usage_decline_pct_90d
    FROM usage_features""")
def _(s):
    usage = FS.usage_features(s.gold.events, AS_OF, EVENT_TYPES)
    return usage.select(
        "company_id",
        FS.decline_30d(F.col("events_30d"), F.col("events_30_60d")).alias("usage_decline_pct_30d"),
        FS.decline_90d(F.col("events_90d"), F.col("events_60_90d")).alias("usage_decline_pct_90d"),
    )


@query("feat_ratios", """
    SELECT company_id, active_users_ratio, sentiment_trend, customer_tenure_days, company_size_encoded FROM feature_store""")
def _(s):
    return s.gold.features.select(
        "company_id", "active_users_ratio", "sentiment_trend", "customer_tenure_days", "company_size_encoded"
    )


@query("feature_store", "SELECT * FROM feature_store")
def _(s):
    return s.gold.features.drop("feature_computed_at")


# --- account managers ----------------------------------------------------------------

@query("agent_portfolio", "SELECT * FROM agent_portfolio")
def _(s):
    return K.agent_portfolio(s.gold.companies, s.gold.subscriptions, s.gold.health)


@query("agent_churn", "SELECT * FROM agent_churn")
def _(s):
    return K.agent_churn(s.gold.companies, s.gold.subscriptions, AS_OF)


@query("agent_response", "SELECT * FROM agent_response")
def _(s):
    return K.agent_response(s.gold.tickets)


@query("agent_nps", "SELECT * FROM agent_nps")
def _(s):
    return K.agent_nps(s.gold.companies, s.gold.nps)


def _agent_performance(s, w=None):
    w = w or s.gold
    return K.agent_performance(w.agents, w.companies, w.subscriptions, s.health, w.tickets, w.nps, AS_OF)


@query("agent_performance", "SELECT * FROM agent_performance")
def _(s):
    return _agent_performance(s)


# --- quality --------------------------------------------------------------------------

_RELATIONS = {
    "raw_cs_agents": "raw_agents", "raw_nps_surveys": "raw_nps", "raw_support_tickets": "raw_tickets", "raw_product_events": "raw_events",
    "dim_cs_agents": "dim_agents", "fact_support_tickets": "fact_tickets", "fact_product_events": "fact_events", "fact_nps_scores": "fact_nps",
    "agg_company_health_score": "health", "feature_store_churn": "feature_store", "agg_churn_predictions": "predictions",
    "agg_retention_actions": "actions", "agg_agent_performance": "agent_performance",
}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count, {least} AS least FROM {_RELATIONS.get(name, name)}"
    for (layer, name), least in Q.ROW_MINIMA.items()
)


def _tables(s):
    """All tables of the three layers, by the names they are stored under; to be counted, so lean facts will do."""
    w = s.lean
    frames = {name: s.raw[short] for short, name in RAW_NAMES.items()} | w.silver() | {
        "agg_company_health_score": w.health,
        "feature_store_churn": w.features,
        "agg_churn_predictions": s.predictions,
        "agg_retention_actions": s.actions,
        "agg_agent_performance": _agent_performance(s, w),
    }
    return {(layer, name): frames[name] for layer, name in Q.ROW_MINIMA}


@query("rowcount_report", f"""
    SELECT layer, table_name, row_count, CASE WHEN least > 0 AND row_count < least THEN 'WARN: too few rows'
           WHEN row_count = 0 AND least = 0 THEN 'OK (empty as expected)' ELSE 'OK' END AS quality_status
    FROM ({_COUNTS}) ORDER BY layer DESC, table_name""")
def _(s):
    return Q.rowcount_report(_tables(s), Q.ROW_MINIMA)


@query("layer_counts", f"SELECT layer, table_name, row_count, row_count = 0 AS is_empty FROM ({_COUNTS})")
def _(s):
    return Q.layer_counts(_tables(s))


_KEYS = {
    "dim_companies": "company_id", "dim_contacts": "contact_id", "dim_cs_agents": "agent_id", "fact_subscriptions": "subscription_id",
    "fact_support_tickets": "ticket_id",
}


@query("null_key_report", " UNION ALL ".join(
    f"SELECT '{name} key' AS check_name, COUNT(*) FILTER (WHERE {key} IS NULL) AS violations FROM {_RELATIONS.get(name, name)}" for name, key in _KEYS.items()
) + """ UNION ALL SELECT 'feature_store target', COUNT(*) FILTER (WHERE is_churned IS NULL) FROM feature_store
    UNION ALL SELECT 'raw_contacts email', COUNT(*) FILTER (WHERE email IS NULL) FROM raw_contacts""")
def _(s):
    silver = s.gold.silver()
    checks = {f"{name} key": (silver[name], key) for name, key in _KEYS.items()}
    checks["feature_store target"] = (s.gold.features, "is_churned")
    checks["raw_contacts email"] = (s.raw["contacts"], "email")
    return Q.null_key_report(checks)


@query("tier_distribution", f"""
    SELECT risk_tier, COUNT(*) AS company_count, {rnd('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()', 1)} AS pct
    FROM health GROUP BY risk_tier ORDER BY risk_tier""")
def _(s):
    return Q.tier_distribution(s.gold.health)


# --- catalog --------------------------------------------------------------------------

_WIDTHS = {
    "agg_churn_predictions": (7, 7), "agg_retention_actions": (13, 13),
}
_CATALOG = " UNION ALL ".join(
    f"SELECT '{layer.lower()}' AS layer, '{name}' AS table_name, {_text(TABLE_COMMENTS.get(name))} AS table_comment, "
    f"{_WIDTHS[name][1] if name in _WIDTHS else len(COLUMN_COMMENTS.get(name, ()))} AS n_commented, "
    + ("0 AS row_count" if name in _WIDTHS else f"(SELECT COUNT(*) FROM {_RELATIONS.get(name, name)}) AS row_count")
    for layer, name in Q.ROW_MINIMA
)


@query("catalog_report", _CATALOG)
def _(s):
    """The whole job, its tables registered in layer databases; names, comments and rows as the catalog gives them."""
    prefix = f"ck{uuid.uuid4().hex[:8]}_"
    root = f"{ensure_checkpoint_dir(s.spark)}/{prefix}lake"
    run_all(s.spark, s.raw, root, AS_OF, EVENT_TYPES, catalog=prefix)
    told = catalog_report(s.spark, prefix)
    counts = union_all(*[
        s.spark.table(f"{prefix}{layer.lower()}.{name}").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer.lower()).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        for layer, name in Q.ROW_MINIMA
    ])
    for layer in LAYERS:
        s.spark.sql(f"DROP DATABASE {prefix}{layer} CASCADE")
    return told.join(counts, ["layer", "table_name"]).drop("n_columns")
