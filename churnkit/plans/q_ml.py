"""Queries for the model matrix, folds, metrics, training, explanation and publishing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnkit.functions import factors_json
from churnkit.ml import explain, folds, matrix, metrics, select, train
from churnkit.operators.relational import column_spread
from churnkit.plans.oracle_base import DAY, rnd
from churnkit.plans.registry import query
from churnkit.schemas import MODEL_INPUTS, NUMERIC_FEATURES
from churnkit.session import ensure_checkpoint_dir, kept
from churnkit.sources.adapters import AS_OF

_MATRIX = "SELECT company_id, " + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in NUMERIC_FEATURES) + (
    ", CASE WHEN billing_cycle = 'annual' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS billing_cycle_annual, is_churned FROM feature_store"
)


def _matrix(s):
    return matrix.model_matrix(s.lean.features)


def _stored_matrix(s):
    """An iterative fit reads the matrix many times."""
    return kept(_matrix(s), "matrix")


@query("ml_matrix", _MATRIX)
def _(s):
    return _matrix(s)


@query("ml_class_balance", """
    SELECT COUNT(*) FILTER (WHERE is_churned = 1) AS positives, COUNT(*) FILTER (WHERE is_churned = 0) AS negatives,
           CAST(COUNT(*) FILTER (WHERE is_churned = 0) AS DOUBLE) / GREATEST(COUNT(*) FILTER (WHERE is_churned = 1), 1) AS ratio
    FROM feature_store""")
def _(s):
    return matrix.class_balance(_matrix(s))


# The constant column shows a hit; the model inputs are the real check.
_WATCHED = (*MODEL_INPUTS, "always_one")
_SPREADS = " UNION ALL ".join(f"SELECT '{c}' AS feature, stddev_samp({c}) = 0 AS is_constant FROM inputs" for c in _WATCHED)


@query("zero_variance", f"SELECT * FROM (WITH inputs AS MATERIALIZED (SELECT *, 1 AS always_one FROM ({_MATRIX})) {_SPREADS})")
def _(s):
    return column_spread(_matrix(s).withColumn("always_one", F.lit(1.0)), _WATCHED).select("feature", "is_constant")


@query("ml_folds", """
    SELECT company_id, is_churned, CAST((row_number() OVER (PARTITION BY is_churned
           ORDER BY md5(company_id || ':42'), company_id) - 1) % 5 AS INTEGER) AS fold FROM feature_store""")
def _(s):
    rows = s.lean.features.select("company_id", "is_churned")
    return folds.stratified_folds(rows, "is_churned", "company_id", 5, 42)


_GROUPS = "SELECT part, score, COUNT(*) AS n, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored_labels GROUP BY part, score"
_AUC = f"""
    SELECT part, {rnd("CAST(SUM(pos * (2 * neg_before + neg)) AS DOUBLE) / 2 / (CAST(SUM(pos) AS DOUBLE) * SUM(neg))", 6)} AS roc_auc
    FROM (SELECT *, SUM(neg) OVER (PARTITION BY part ORDER BY score) - neg AS neg_before FROM ({_GROUPS})) GROUP BY part"""
_AP = f"""
    SELECT part, {rnd("CAST(SUM(CAST(pos * (CAST(pos_through AS DOUBLE) / n_through) AS DECIMAL(28,12))) AS DOUBLE) / SUM(pos)", 6)} AS pr_auc
    FROM (SELECT *, SUM(pos) OVER (PARTITION BY part ORDER BY score DESC) AS pos_through,
                 SUM(n) OVER (PARTITION BY part ORDER BY score DESC) AS n_through FROM ({_GROUPS})) GROUP BY part"""


@query("ml_roc_auc", _AUC)
def _(s):
    return metrics.roc_auc(s.labels, "score", "label", "part")


@query("ml_pr_auc", _AP)
def _(s):
    return metrics.average_precision(s.labels, "score", "label", "part")


_CONFUSION = """SELECT part, COUNT(*) FILTER (WHERE score >= 0.4 AND label = 1) AS tp, COUNT(*) FILTER (WHERE score >= 0.4 AND label = 0) AS fp,
    COUNT(*) FILTER (WHERE score < 0.4 AND label = 1) AS fn, COUNT(*) FILTER (WHERE score < 0.4 AND label = 0) AS tn FROM scored_labels"""


@query("ml_threshold_metrics", f"""
    SELECT part, tp + fp + fn + tn AS val_size, tp + fn AS positives, {rnd('CAST(tp AS DOUBLE) / (tp + fp)', 6)} AS precision,
           {rnd('CAST(tp AS DOUBLE) / (tp + fn)', 6)} AS recall, {rnd('CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn)', 6)} AS f1
    FROM ({_CONFUSION} GROUP BY part)""")
def _(s):
    return metrics.threshold_metrics(s.labels, "score", "label", 0.4, "part")


@query("ml_pr_curve", f"""
    SELECT threshold, {rnd('CAST(pos_through AS DOUBLE) / n_through', 6)} AS precision, {rnd('CAST(pos_through AS DOUBLE) / p', 6)} AS recall,
           {rnd('CAST(p AS DOUBLE) / total', 6)} AS baseline
    FROM (SELECT score AS threshold, SUM(pos) OVER (ORDER BY score DESC) AS pos_through, SUM(n) OVER (ORDER BY score DESC) AS n_through,
                 SUM(pos) OVER () AS p, SUM(n) OVER () AS total
          FROM (SELECT score, COUNT(*) AS n, SUM(label) AS pos FROM scored_labels GROUP BY score))""")
def _(s):
    return metrics.pr_curve(s.labels, "score", "label")


@query("ml_class_report", f"""
    SELECT unnest(['no_churn', 'churn', 'accuracy', 'macro avg', 'weighted avg']) AS "row",
           unnest([{rnd('p0', 6)}, {rnd('p1', 6)}, {rnd('acc', 6)}, {rnd('(p0 + p1) / 2', 6)}, {rnd('(p0 * s0 + p1 * s1) / total', 6)}]) AS precision,
           unnest([{rnd('r0', 6)}, {rnd('r1', 6)}, {rnd('acc', 6)}, {rnd('(r0 + r1) / 2', 6)}, {rnd('(r0 * s0 + r1 * s1) / total', 6)}]) AS recall,
           unnest([{rnd('f0', 6)}, {rnd('f1', 6)}, {rnd('acc', 6)}, {rnd('(f0 + f1) / 2', 6)}, {rnd('(f0 * s0 + f1 * s1) / total', 6)}]) AS f1,
           unnest([s0, s1, total, total, total]) AS support
    FROM (SELECT CAST(tn AS DOUBLE) / (tn + fn) AS p0, CAST(tn AS DOUBLE) / (tn + fp) AS r0, CAST(2 * tn AS DOUBLE) / (2 * tn + fn + fp) AS f0,
                 CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1,
                 CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS acc, tn + fp AS s0, tp + fn AS s1, tp + fp + fn + tn AS total
          FROM ({_CONFUSION.replace('SELECT part, ', 'SELECT ')}))""")
def _(s):
    return metrics.classification_report(s.labels, "score", "label", 0.4)


@query("ml_tiers", """
    SELECT company_id, prediction_date, risk_tier, CAST(churn_probability >= 0.4 AS INTEGER) AS predicted_churn, churn_probability FROM predictions""")
def _(s):
    rows = s.predictions.select("company_id", "prediction_date", "churn_probability")
    return train.tiered(rows, "churn_probability", 0.4)


@query("ml_tier_summary", f"""
    SELECT risk_tier, COUNT(*) AS n, {rnd('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()', 1)} AS pct FROM predictions GROUP BY risk_tier""")
def _(s):
    return train.tier_summary(s.predictions)


_TRAINED: dict[tuple[str, str], tuple] = {}


def _trained(s):
    """The matrix, the model fitted on all of it and its nodes. The queries on the model share one fit per session and folder."""
    key = (s.spark.sparkContext.applicationId, s.folder)
    if key not in _TRAINED:
        rows = _stored_matrix(s)
        model = train.train_gbt(rows)
        _TRAINED[key] = rows, model, explain.node_table(model, f"{ensure_checkpoint_dir(s.spark)}/model_{uuid.uuid4().hex}")
    return _TRAINED[key]


def _validated(s):
    """Fold metrics of the five models, likewise once per session and folder."""
    key = (s.spark.sparkContext.applicationId, f"{s.folder} folds")
    if key not in _TRAINED:
        _TRAINED[key] = (train.cross_validate(_stored_matrix(s)),)
    return _TRAINED[key][0]


def _scores(s):
    rows, model, nodes = _trained(s)
    return train.score(model, rows, AS_OF, "churn_gbt", "1", nodes)


def _explained(s):
    rows, model, nodes = _trained(s)
    return explain.contributions(train.probabilities(model, rows), nodes, MODEL_INPUTS)


def _importance(s):
    _, model, nodes = _trained(s)
    return train.feature_importance(model, nodes)


@query("ml_train_score")
def _(s):
    return _scores(s)


@query("ml_cross_validate")
def _(s):
    return _validated(s)


@query("ml_importance")
def _(s):
    return _importance(s)


@query("ml_explain")
def _(s):
    return _explained(s).select("company_id", "probability", "base_value", factors_json("contributions", 5).alias("top_factors"))


# What a model gives cannot be stated in SQL, but what must hold of it can: the queries below put the same results to such tests.

@query("ml_score_check", f"""
    SELECT company_id, {DAY} AS prediction_date, 'churn_gbt' AS model_name, '1' AS model_version, is_churned AS actual_churn,
           5 AS n_factors, TRUE AS in_range, TRUE AS tier_follows, TRUE AS flag_follows FROM feature_store""")
def _(s):
    # Rounded to four digits, a probability says on which side of an edge it lies unless it is the edge.
    p = F.col("churn_probability")
    tier = F.when(p < 0.4, "Low").when((p > 0.4) & (p < 0.7), "Medium").when(p > 0.7, "High").otherwise(F.col("risk_tier"))
    flag = F.when(p == 0.4, F.col("predicted_churn")).otherwise((p > 0.4).cast("int"))
    return _scores(s).select(
        "company_id", "prediction_date", "model_name", "model_version", "actual_churn",
        F.size(F.from_json("top_factors", "map<string,double>")).alias("n_factors"),
        p.between(0, 1).alias("in_range"), (tier == F.col("risk_tier")).alias("tier_follows"), (flag == F.col("predicted_churn")).alias("flag_follows"),
    )


@query("ml_explain_check", f"SELECT company_id, {len(MODEL_INPUTS)} AS n_inputs, TRUE AS adds_up FROM feature_store")
def _(s):
    total = F.aggregate(F.map_values("contributions"), F.col("base_value"), lambda a, b: a + b)
    odds = F.log(F.col("probability") / (1 - F.col("probability")))
    return _explained(s).select("company_id", F.size("contributions").alias("n_inputs"), (F.abs(total - odds) < 1e-6).alias("adds_up"))


@query("ml_importance_check", f"""
    SELECT unnest([{', '.join(f"'{c}'" for c in MODEL_INPUTS)}]) AS feature, TRUE AS in_range, TRUE AS gain_where_split, 1.0::DOUBLE AS total""")
def _(s):
    gain, split = F.col("importance_gain"), F.col("importance_split")
    rows = _importance(s)
    return rows.select(
        "feature", gain.between(0, 1).alias("in_range"), ((gain > 0) == (split > 0)).alias("gain_where_split"),
        F.round(rows.select(F.sum("importance_gain")).scalar(), 9).alias("total"),
    )


@query("ml_cv_check", """
    SELECT coalesce(fold, 'mean') AS fold, COUNT(*) AS val_size, CAST(SUM(is_churned) AS BIGINT) AS positives, TRUE AS in_range, TRUE AS rounds_kept
    FROM (SELECT is_churned, CAST((row_number() OVER (PARTITION BY is_churned ORDER BY md5(company_id || ':42'), company_id) - 1) % 5 AS VARCHAR) AS fold
          FROM feature_store) GROUP BY ROLLUP (fold)""")
def _(s):
    shares = [F.col(c).between(0, 1) for c in ("roc_auc", "pr_auc", "f1", "precision", "recall")]
    return _validated(s).select(
        "fold", "val_size", "positives", F.forall(F.array(*shares), lambda ok: ok).alias("in_range"),
        F.col("rounds").between(1, train.DEFAULT_PARAMS["maxIter"]).alias("rounds_kept"),
    )


_NEW = f"""SELECT company_id, prediction_date, CAST((company_id * 13) % 1000 AS DOUBLE) / 1000.0::DOUBLE AS churn_probability, 'Low' AS risk_tier, '2' AS model_version
    FROM predictions WHERE company_id % 3 = 0 AND prediction_date = {DAY}"""


@query("publish_predictions", f"""
    SELECT p.company_id, p.prediction_date, COALESCE(n.churn_probability, p.churn_probability) AS churn_probability,
           COALESCE(n.risk_tier, p.risk_tier) AS risk_tier, top_factors, COALESCE(n.model_version, p.model_version) AS model_version, model_name
    FROM predictions p LEFT JOIN ({_NEW}) n ON n.company_id = p.company_id AND n.prediction_date = p.prediction_date""")
def _(s):
    today = s.predictions.filter((F.col("prediction_date") == F.lit(AS_OF)) & (F.pmod("company_id", F.lit(3)) == 0))
    scored = today.withColumns(
        {
            "churn_probability": (F.pmod(F.col("company_id") * 13, F.lit(1000)) / F.lit(1000.0)).cast("double"),
            "risk_tier": F.lit("Low"),
            "model_version": F.lit("2"),
        }
    )
    return select.publish_predictions(s.predictions, scored)


@query("top_risk", """
    SELECT company_id, churn_probability, risk_tier, names AS top_factor_names FROM latest_predictions JOIN top3_names USING (company_id)
    ORDER BY churn_probability DESC, company_id LIMIT 10""")
def _(s):
    from churnkit.operators.relational import latest_only

    return select.top_risk(latest_only(s.predictions, "prediction_date"))


@query("champion_select", f"""
    SELECT 'churn_gbt' AS model_name, 'run_' || part AS run_id, roc_auc AS cv_roc_auc, part + 1 AS version
    FROM ({_AUC}) WHERE part <> 2 AND roc_auc >= 0.6 ORDER BY roc_auc DESC, part LIMIT 1""")
def _(s):
    run = F.concat(F.lit("run_"), F.col("part").cast("string"))
    fold_rows = metrics.roc_auc(s.labels, "score", "label", "part").select(
        F.lit("churn_gbt").alias("model_name"), run.alias("run_id"),
        F.when(F.col("part") == 2, "FAILED").otherwise("FINISHED").alias("status"), F.lit(0).alias("fold"), "roc_auc",
    )
    versions = s.labels.select("part").distinct().select(
        F.lit("churn_gbt").alias("model_name"), run.alias("run_id"), (F.col("part") + 1).alias("version")
    )
    return select.require_champion(fold_rows, versions, 0.60)
