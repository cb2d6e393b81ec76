"""Row counts, key checks and tier shares over the layer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import count_if
from churnkit.operators.relational import distribution, union_all

# --- fixed values: least rows expected per table, 0 for tables filled from outside ---
ROW_MINIMA = {
    ("BRONZE", "raw_cs_agents"): 15,
    ("BRONZE", "raw_companies"): 400,
    ("BRONZE", "raw_contacts"): 1800,
    ("BRONZE", "raw_subscriptions"): 500,
    ("BRONZE", "raw_nps_surveys"): 1800,
    ("BRONZE", "raw_support_tickets"): 10000,
    ("BRONZE", "raw_product_events"): 50000,
    ("SILVER", "dim_cs_agents"): 15,
    ("SILVER", "dim_companies"): 400,
    ("SILVER", "dim_contacts"): 1800,
    ("SILVER", "fact_subscriptions"): 500,
    ("SILVER", "fact_support_tickets"): 10000,
    ("SILVER", "fact_product_events"): 50000,
    ("SILVER", "fact_nps_scores"): 1800,
    ("GOLD", "agg_company_health_score"): 400,
    ("GOLD", "feature_store_churn"): 400,
    ("GOLD", "agg_churn_predictions"): 0,
    ("GOLD", "agg_retention_actions"): 0,
    ("GOLD", "agg_agent_performance"): 15,
}
# --- end of fixed values ---

Tables = Mapping[tuple[str, str], DataFrame]


def layer_counts(tables: Tables) -> DataFrame:
    """Rows per table. An empty table is marked, not left out."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    return union_all(*counted).withColumn("is_empty", F.col("row_count") == 0)


def rowcount_report(tables: Tables, minima: Mapping[tuple[str, str], int]) -> DataFrame:
    counts = layer_counts(tables).drop("is_empty")
    floor = F.coalesce(
        *[
            F.when((F.col("layer") == layer) & (F.col("table_name") == name), F.lit(least))
            for (layer, name), least in minima.items()
        ],
        F.lit(0),
    )
    status = (
        F.when((floor > 0) & (F.col("row_count") < floor), "WARN: too few rows")
        .when((F.col("row_count") == 0) & (floor == 0), "OK (empty as expected)")
        .otherwise("OK")
    )
    return counts.withColumn("quality_status", status).orderBy(F.desc("layer"), "table_name")


def null_key_report(checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per check whose key (or target) is missing."""
    return union_all(
        *[
            df.agg(count_if(F.col(key).isNull()).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
            for name, (df, key) in checks.items()
        ]
    )


def tier_distribution(health: DataFrame) -> DataFrame:
    return distribution(health, "risk_tier", "company_count", "pct").orderBy("risk_tier")
