"""Ranking measures with exact tie handling: ROC area, average precision, precision-recall curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import safe_divide
from .ordering import running_counts


def score_steps(
    scored: DataFrame, keys: list[str], score: str = "y_proba", truth: str = "y_true"
) -> DataFrame:
    """One row per key and distinct score: positives and negatives there, below it and in all."""
    label = F.col(truth)
    counts = (
        scored.where(F.col(score).isNotNull() & label.isNotNull())
        .groupBy(*keys, score)
        .agg(F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg"))
    )
    return running_counts(counts, keys, score, ["pos", "neg"])


def _both_classes() -> Column:
    return (F.col("pos_total") > 0) & (F.col("neg_total") > 0)


def _at_or_above(side: str) -> Column:
    return F.col(f"{side}_total") - F.col(f"{side}_before")


def _precision() -> Column:
    return safe_divide(_at_or_above("pos"), _at_or_above("pos") + _at_or_above("neg"))


def ranking_metrics(
    scored: DataFrame, keys: list[str] | None = None, score: str = "y_proba", truth: str = "y_true"
) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` (average precision) per key; null when a class is absent."""
    keys = keys or []
    pairs_won = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    auc = safe_divide(F.sum(pairs_won), F.first("pos_total").cast("double") * F.first("neg_total"))
    recall_step = safe_divide("pos", "pos_total")
    both = F.first(_both_classes())
    return (
        score_steps(scored, keys, score, truth)
        .groupBy(*keys)
        .agg(
            F.when(both, auc).alias("roc_auc"),
            F.when(both, F.sum(recall_step * _precision())).alias("pr_auc"),
        )
    )


def roc_auc(scored: DataFrame, keys: list[str] | None = None, **columns) -> DataFrame:
    return ranking_metrics(scored, keys, **columns).drop("pr_auc")


def avg_precision(scored: DataFrame, keys: list[str] | None = None, **columns) -> DataFrame:
    return ranking_metrics(scored, keys, **columns).drop("roc_auc")


def pr_curve(
    scored: DataFrame, keys: list[str] | None = None, score: str = "y_proba", truth: str = "y_true"
) -> DataFrame:
    """Precision and recall at every distinct score, and the end point (recall 0, precision 1)."""
    keys = keys or []
    steps = score_steps(scored, keys, score, truth)
    points = steps.select(
        *keys,
        F.col(score).alias("threshold"),
        _precision().alias("precision"),
        safe_divide(_at_or_above("pos"), "pos_total").alias("recall"),
        (F.col("pos_before") + F.col("neg_before") == 0).alias("_first"),
    )
    end = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall"))
    here = F.struct("threshold", "precision", "recall")
    rows = F.when(F.col("_first"), F.array(here, end)).otherwise(F.array(here))
    return points.select(*keys, F.inline(rows))
