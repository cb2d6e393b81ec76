"""Choosing and publishing: best qualifying run, daily predictions, riskiest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import factor_names, parse_factors, round_dec
from churnkit.operators.merge import merge_upsert
from churnkit.operators.relational import latest_per_key, top_k
from churnkit.schemas import MIN_CHAMPION_AUC, PREDICTIONS
from churnkit.sources.tables import overwrite_partitions, read_table

PREDICTION_KEYS = ("company_id", "prediction_date")


def select_champion(
    metrics: DataFrame, versions: DataFrame, min_auc: float = MIN_CHAMPION_AUC, run_id: str | None = None
) -> DataFrame:
    """Per model the finished run with the highest mean fold ROC-AUC over the gate, with its version.

    ``metrics`` has one row per model, run and fold; a named run is taken whatever its state and score.
    """
    wanted = F.col("status") == "FINISHED" if run_id is None else F.col("run_id") == run_id
    runs = metrics.filter(wanted).groupBy("model_name", "run_id").agg(round_dec(F.avg("roc_auc"), 6).alias("cv_roc_auc"))
    fit = runs.filter(F.col("cv_roc_auc") >= min_auc) if run_id is None else runs
    best = latest_per_key(fit, ["model_name"], [F.desc("cv_roc_auc"), F.asc("run_id")])
    return best.join(versions.select("model_name", "run_id", "version"), ["model_name", "run_id"])


def require_champion(metrics: DataFrame, versions: DataFrame, min_auc: float = MIN_CHAMPION_AUC, run_id: str | None = None) -> DataFrame:
    """As ``select_champion``; an error where no run qualifies, so that nothing is promoted by mistake."""
    best = select_champion(metrics, versions, min_auc, run_id)
    if best.isEmpty():
        raise ValueError(f"no run reaches a mean ROC-AUC of {min_auc}" if run_id is None else f"run {run_id} has no metrics or no version")
    return best


def publish_predictions(target: DataFrame, scored: DataFrame) -> DataFrame:
    """Target with the scored days upserted: running a day twice changes nothing."""
    return merge_upsert(target, scored.select(*target.columns), PREDICTION_KEYS)


def store_predictions(scored: DataFrame, root: str, day, name: str = "agg_churn_predictions") -> None:
    """Upsert one scored day into the stored table, which is partitioned by day.

    Only that day's partition is read and replaced; the history is not touched.
    """
    columns = PREDICTIONS.fieldNames()
    on_day = F.col("prediction_date") == F.lit(day)
    rows = scored.select(*columns).filter(on_day)
    same_day = read_table(scored.sparkSession, root, "gold", name, rows.schema).filter(on_day)
    overwrite_partitions(publish_predictions(same_day, rows), root, "gold", name, ["prediction_date"])


def published_check(predictions: DataFrame, day) -> DataFrame:
    today = predictions.filter(F.col("prediction_date") == F.lit(day))
    return today.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("risk_tier") == "High").alias("high"))


def top_risk(predictions: DataFrame, k: int = 10) -> DataFrame:
    ordered = top_k(predictions, [F.desc("churn_probability"), F.asc("company_id")], k)
    return ordered.select(
        "company_id",
        "churn_probability",
        "risk_tier",
        F.array_join(factor_names(parse_factors("top_factors"), 3), ", ").alias("top_factor_names"),
    )
