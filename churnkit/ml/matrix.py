"""Model matrix and class balance."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import count_if, num, safe_ratio
from churnkit.schemas import LABEL, MODEL_INPUTS, NUMERIC_FEATURES


def model_matrix(features: DataFrame, id_col: str = "company_id") -> DataFrame:
    """All inputs as doubles; unreadable or missing numbers become 0, the billing cycle a 0/1 flag."""
    label = [num(LABEL).cast("int").alias(LABEL)] if LABEL in features.columns else []
    return features.select(
        id_col,
        *[num(c).alias(c) for c in NUMERIC_FEATURES],
        F.when(F.col("billing_cycle") == "annual", 1.0).otherwise(0.0).alias("billing_cycle_annual"),
        *label,
    )


def with_vector(matrix: DataFrame, inputs=MODEL_INPUTS, name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol=name).transform(matrix)


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    counts = df.agg(count_if(F.col(label) == 1).alias("positives"), count_if(F.col(label) == 0).alias("negatives"))
    return counts.withColumn("ratio", safe_ratio("negatives", "positives"))
