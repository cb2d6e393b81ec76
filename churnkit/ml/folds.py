"""Stratified folds: a repeatable shuffle inside each class, dealt out in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.operators.relational import hash_ordered_rank


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; fold sizes differ by at most one inside a class."""
    digest = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    ranked = hash_ordered_rank(df, label, digest, id_col, "_position")
    return ranked.withColumn(name, F.pmod(F.col("_position") - 1, F.lit(k)).cast("int")).drop("_position")
