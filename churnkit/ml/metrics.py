"""Exact classification metrics on DataFrames.

Rows are first summed per distinct score; the ordered part then runs on those sums, cut into ranges
(see ``running_totals``), so neither a frequent score nor many distinct scores land in one task.
``by`` splits the metrics, for instance per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import count_if, ratio_or_null, round_dec
from churnkit.operators.relational import running_totals, union_all

WIDE = "decimal(38,0)"


def _grouped(df: DataFrame, score: str, label: str, by: str | None) -> tuple[DataFrame, str]:
    name = by or "_all"
    group = F.col(by) if by else F.lit(0)
    return (
        df.groupBy(group.alias(name), F.col(score).alias("score"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            count_if(F.col(label) == 1).alias("pos"),
            count_if(F.col(label) == 0).alias("neg"),
        ),
        name,
    )


def _named(df: DataFrame, name: str, by: str | None) -> DataFrame:
    return df if by else df.drop(name)


def roc_auc(df: DataFrame, score: str, label: str, by: str | None = None, digits: int = 6) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half; 0.5 with one class only."""
    groups, name = _grouped(df, score, label, by)
    ranked = running_totals(groups, name, "score", ["neg"])
    halves = F.sum(F.col("pos").cast(WIDE) * (F.col("neg_before") * 2 + F.col("neg")).cast("decimal(19,0)"))
    sums = ranked.groupBy(name).agg(halves.alias("_halves"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    pairs = F.col("_p").cast("double") * F.col("_n")
    auc = F.coalesce(ratio_or_null(F.col("_halves").cast("double") / 2, pairs), F.lit(0.5))
    return _named(sums.select(name, round_dec(auc, digits).alias("roc_auc")), name, by)


def average_precision(df: DataFrame, score: str, label: str, by: str | None = None, digits: int = 6) -> DataFrame:
    """Sum over falling thresholds of the recall step times the precision; 0 without positives."""
    groups, name = _grouped(df, score, label, by)
    ranked = running_totals(groups, name, "score", ["pos", "n"], descending=True)
    step = F.col("pos") * (F.col("pos_through") / F.col("n_through"))
    sums = ranked.groupBy(name).agg(
        F.sum(step.cast("decimal(28,12)")).cast("double").alias("_area"), F.sum("pos").alias("_p")
    )
    ap = F.coalesce(ratio_or_null("_area", "_p"), F.lit(0.0))
    return _named(sums.select(name, round_dec(ap, digits).alias("pr_auc")), name, by)


def pr_curve(df: DataFrame, score: str, label: str, digits: int = 6) -> DataFrame:
    """One point per distinct score, with the share of positives as the baseline."""
    groups, name = _grouped(df, score, label, None)
    ranked = running_totals(groups, name, "score", ["pos", "n"], descending=True)
    totals = groups.agg(F.sum("pos").alias("_p"), F.sum("n").alias("_n"))
    positives = totals.select("_p").scalar()
    rows = totals.select("_n").scalar()
    return ranked.select(
        F.col("score").alias("threshold"),
        round_dec(F.col("pos_through") / F.col("n_through"), digits).alias("precision"),
        round_dec(F.coalesce(ratio_or_null("pos_through", positives), F.lit(0.0)), digits).alias("recall"),
        round_dec(positives / rows, digits).alias("baseline"),
    )


def _confusion(score: str, label: str, threshold: float) -> Sequence[Column]:
    hit = F.col(score) >= F.lit(threshold)
    positive = F.col(label) == 1
    return (
        count_if(hit & positive).alias("tp"),
        count_if(hit & ~positive).alias("fp"),
        count_if(~hit & positive).alias("fn"),
        count_if(~hit & ~positive).alias("tn"),
    )


def _rate(num: Column, den: Column) -> Column:
    return F.coalesce(ratio_or_null(num, den), F.lit(0.0))


def threshold_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.4, by: str | None = None, digits: int = 6
) -> DataFrame:
    """Precision, recall and F1 at a threshold; 0 where the denominator is 0."""
    keys = [by] if by else []
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        df.groupBy(*keys)
        .agg(*_confusion(score, label, threshold))
        .select(
            *keys,
            (tp + fp + fn + F.col("tn")).alias("val_size"),
            (tp + fn).alias("positives"),
            round_dec(_rate(tp, tp + fp), digits).alias("precision"),
            round_dec(_rate(tp, tp + fn), digits).alias("recall"),
            round_dec(_rate(tp * 2, tp * 2 + fp + fn), digits).alias("f1"),
        )
    )


def classification_report(
    df: DataFrame, score: str, label: str, threshold: float = 0.4, names=("no_churn", "churn"), digits: int = 6
) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, from one row of counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = df.agg(*_confusion(score, label, threshold))
    total = tp + fp + fn + tn

    def scores(hit: Column, false_hit: Column, missed: Column) -> tuple[Column, Column, Column, Column]:
        return (
            _rate(hit, hit + false_hit),
            _rate(hit, hit + missed),
            _rate(hit * 2, hit * 2 + false_hit + missed),
            hit + missed,
        )

    zero, one = scores(tn, fn, fp), scores(tp, fp, fn)
    accuracy = _rate(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_rate(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3])]
    lines = [
        (names[0], *zero),
        (names[1], *one),
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", *macro, total),
        ("weighted avg", *weighted, total),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("row"),
                round_dec(p, digits).alias("precision"),
                round_dec(r, digits).alias("recall"),
                round_dec(f, digits).alias("f1"),
                s.cast("bigint").alias("support"),
            )
            for n, p, r, f, s in lines
        ]
    )
    return counts.select(F.inline(rows))


def fold_metrics(df: DataFrame, score: str, label: str, fold: str = "fold", threshold: float = 0.4) -> DataFrame:
    """All metrics per fold. A fold without positives has ROC-AUC 0.5 and PR-AUC 0."""
    return (
        threshold_metrics(df, score, label, threshold, fold)
        .join(roc_auc(df, score, label, fold), fold)
        .join(average_precision(df, score, label, fold), fold)
    )


def with_mean(metrics: DataFrame, fold: str = "fold", extra: Sequence[str] = ()) -> DataFrame:
    """The fold rows plus their mean, labelled ``mean``."""
    names = ("roc_auc", "pr_auc", "f1", "precision", "recall", *extra)
    rows = metrics.select(F.col(fold).cast("string").alias(fold), "val_size", "positives", *names)
    mean = rows.agg(
        F.lit("mean").alias(fold),
        F.sum("val_size").alias("val_size"),
        F.sum("positives").alias("positives"),
        *[round_dec(F.avg(n), 6).alias(n) for n in names],
    )
    return union_all(rows, mean)
