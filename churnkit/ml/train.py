"""Boosted-tree training, cross-validation, scoring and input importance on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions import factors_json, right_closed_bins, round_dec
from churnkit.ml.explain import contributions, node_table
from churnkit.ml.folds import stratified_folds
from churnkit.ml.matrix import class_balance, with_vector
from churnkit.ml.metrics import fold_metrics, with_mean
from churnkit.operators.relational import distribution, union_all
from churnkit.schemas import DECISION_THRESHOLD, LABEL, ML_LOW_UP_TO, ML_MEDIUM_UP_TO, MODEL_INPUTS

# --- fixed values: training defaults ---
DEFAULT_PARAMS = {
    "maxIter": 300,
    "stepSize": 0.03,
    "maxDepth": 4,
    "minInstancesPerNode": 5,
    "featureSubsetStrategy": "0.8",
    "subsamplingRate": 0.8,
    "seed": 42,
}
FOLDS = 5
FOLD_SEED = 42
PATIENCE = 50
TIERS = ("Low", "Medium", "High")
# --- end of fixed values ---

#: Rows a task of an iterative fit takes at least, and the most that are put into one to keep the tasks to one wave.
TASK_ROWS = 20_000
MOST_TASK_ROWS = 500_000


def with_class_weight(df: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Positives weigh as much as there are negatives per positive."""
    ratio = class_balance(df, label).select("ratio").scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fit_tasks(rows: int, slots: int) -> int:
    """Tasks of each short job of a fit: one wave over the cluster's slots, fewer where there are few rows, more only where a task would hold too many.

    What a task costs whatever its rows, and what it sends to the driver, comes up in every one of a fit's thousands of stages.
    """
    return max(1, min(math.ceil(rows / TASK_ROWS), slots), math.ceil(rows / MOST_TASK_ROWS))


def train_gbt(matrix: DataFrame, params: Mapping | None = None) -> GBTClassificationModel:
    """Fit on the model matrix.

    A fit is a chain of short jobs, several a round, so its rows are dealt out evenly to few tasks (``fit_tasks``).
    """
    rows = with_vector(with_class_weight(matrix)).select("features", "weight", F.col(LABEL).cast("double").alias("label"))
    tasks = fit_tasks(matrix.count(), matrix.sparkSession.sparkContext.defaultParallelism)
    settings = {**DEFAULT_PARAMS, **(params or {})}
    dealt = rows.repartition(tasks) if tasks > 1 else rows.coalesce(tasks)
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", **settings).fit(dealt)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds."""
    trees, weights = list(model._java_obj.trees())[:rounds], list(model.treeWeights)[:rounds]
    context = SparkSession.active().sparkContext
    tree_class = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    java = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{rounds}",
        GBTClassificationModel._new_java_array(trees, tree_class),
        GBTClassificationModel._new_java_array(weights, context._jvm.double),
        model.numFeatures,
        model.numClasses,
    )
    return model._copyValues(GBTClassificationModel(java))


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: those up to the lowest loss that is reached before ``patience`` rounds in a row bring no gain."""
    least, best = math.inf, 0
    for done, loss in enumerate(losses, 1):
        if loss < least:
            least, best = loss, done
        elif done - best >= patience:
            break
    return best or len(losses)


def train_until_no_gain(
    matrix: DataFrame, validation: DataFrame, params: Mapping | None = None, patience: int = PATIENCE
) -> tuple[GBTClassificationModel, int]:
    """Fit with early stopping: the model of the best round by log-loss on the validation rows, and that round.

    A round does not depend on later ones nor on the validation rows, so the rounds are worked out first and judged in one pass;
    what remains is the model that stopping at that point would have left.
    """
    model = train_gbt(matrix, params)
    held = with_vector(validation).select("features", F.lit(1.0).alias("weight"), F.col(LABEL).cast("double").alias("label"))
    losses = model.evaluateEachIteration(held)
    if not all(map(math.isfinite, losses)):
        return model, len(losses)  # no validation rows to judge by
    rounds = best_round(losses, patience)
    return first_rounds(model, rounds), rounds


def churn_tier(probability) -> F.Column:
    """Tier on the unrounded probability, bins closed on the right."""
    return right_closed_bins(probability, [ML_LOW_UP_TO, ML_MEDIUM_UP_TO, 1.001], list(TIERS))


def probabilities(model: GBTClassificationModel, matrix: DataFrame) -> DataFrame:
    scored = model.transform(with_vector(matrix))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop("rawPrediction", "prediction")


def tiered(df: DataFrame, probability: str, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    p = F.col(probability)
    return df.withColumns(
        {
            "risk_tier": churn_tier(p),
            "predicted_churn": (p >= F.lit(threshold)).cast("int"),
            "churn_probability": round_dec(p, 4),
        }
    )


def score(
    model: GBTClassificationModel,
    matrix: DataFrame,
    prediction_date,
    model_name: str,
    model_version: str,
    nodes: DataFrame | str | None = None,
    threshold: float = DECISION_THRESHOLD,
    top_k: int = 5,
    id_col: str = "company_id",
) -> DataFrame:
    """Prediction rows; with ``nodes``, the model's node table or a shared folder to store the model in, also the strongest contributions."""
    rows = tiered(probabilities(model, matrix), "probability", threshold)
    if nodes is None:
        factors = F.lit(None).cast("string")
    else:
        rows = contributions(rows, node_table(model, nodes) if isinstance(nodes, str) else nodes, MODEL_INPUTS)
        factors = factors_json("contributions", top_k)
    actual = [F.col(LABEL).alias("actual_churn")] if LABEL in matrix.columns else []
    return rows.select(
        id_col,
        F.lit(prediction_date).cast("date").alias("prediction_date"),
        "churn_probability",
        "risk_tier",
        factors.alias("top_factors"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_name).alias("model_name"),
        "predicted_churn",
        *actual,
    )


def cross_validate(
    matrix: DataFrame, params: Mapping | None = None, k: int = FOLDS, id_col: str = "company_id",
    threshold: float = DECISION_THRESHOLD, patience: int = PATIENCE,
) -> DataFrame:
    """Metrics per fold, their mean, and the rounds each fold's model kept; the held-out fold stops the rounds early.

    The k models are independent and are trained at the same time; the driver loop is over them only.
    """
    # The folds are read by k iterative fits; losing a cached block only costs its recomputation.
    folded = stratified_folds(matrix, LABEL, id_col, k, FOLD_SEED).persist()
    folded.count()

    def one(fold: int) -> tuple[DataFrame, int]:
        inside, outside = folded.filter(F.col("fold") == fold), folded.filter(F.col("fold") != fold)
        model, rounds = train_until_no_gain(outside.drop("fold"), inside.drop("fold"), params, patience)
        return probabilities(model, inside).select("fold", F.col(LABEL).alias("label"), F.col("probability").alias("score")), rounds

    with ThreadPoolExecutor(max_workers=k) as pool:
        done = list(pool.map(inheritable_thread_target(matrix.sparkSession)(one), range(k)))
    kept = matrix.sparkSession.createDataFrame([(fold, float(rounds)) for fold, (_, rounds) in enumerate(done)], "fold int, rounds double")
    per_fold = fold_metrics(union_all(*[scored for scored, _ in done]), "score", "label", "fold", threshold).join(kept, "fold")
    metrics = with_mean(per_fold, extra=("rounds",))
    rows = metrics.collect()  # a row per fold; what was cached for them is not needed any more
    folded.unpersist()
    return matrix.sparkSession.createDataFrame(rows, metrics.schema)


def feature_importance(model: GBTClassificationModel, nodes: DataFrame, names=MODEL_INPUTS) -> DataFrame:
    """Gain share and number of splits per input, strongest first; built from the stored trees."""
    spark: SparkSession = nodes.sparkSession
    gains = spark.createDataFrame(
        [(i, n, float(model.featureImportances[i])) for i, n in enumerate(names)],
        "feature_index int, feature string, importance_gain double",
    )
    splits = (
        nodes.filter(F.col("left") >= 0)
        .groupBy("feature_index")
        .agg(F.count(F.lit(1)).alias("importance_split"))
    )
    return (
        gains.join(splits, "feature_index", "left")
        .select("feature", "importance_gain", F.coalesce("importance_split", F.lit(0)).alias("importance_split"))
        .orderBy(F.desc("importance_gain"), "feature")
    )


def tier_summary(predictions: DataFrame) -> DataFrame:
    return distribution(predictions, "risk_tier", "n", "pct")
