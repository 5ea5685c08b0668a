"""Confusion counts and the measures made of them, at one threshold, a grid, or many policies.

Rows are counted once per score level between thresholds; the counts at every threshold come from
those few levels. A table of any size is thus read and shuffled once, whatever the grid.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_col, rate
from .curves import ranking_metrics

# The grid of candidate thresholds and the costs of the two errors.
GRID = [round(0.10 + 0.05 * step, 2) for step in range(13)]
MISS_COST, FALSE_ALARM_COST = 5, 1
COUNTS = ["tp", "fp", "tn", "fn"]


@dataclass(frozen=True)
class Policy:
    """A decision rule: the scores of one model, cut at one threshold."""

    name: str
    model_name: str
    threshold: float
    display_name: str = ""


def counts_when(flagged: Column, truth: str = "y_true") -> list[Column]:
    positive, negative = F.col(truth) == 1, F.col(truth) == 0
    return [
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & negative).alias("fp"),
        F.count_if(~flagged & negative).alias("tn"),
        F.count_if(~flagged & positive).alias("fn"),
    ]


def _level(thresholds: list[float], score: str) -> Column:
    """How many of the thresholds a score reaches."""
    return reduce(add, [(F.col(score) >= F.lit(float(t))).cast("int") for t in thresholds])


def level_counts(
    scored: DataFrame, thresholds: list[float], keys: list[str], score: str, truth: str
) -> DataFrame:
    """Rows and score sums per key, outcome and score level; only rows labelled 0 or 1 count."""
    table = scored.where(F.col(score).isNotNull() & F.col(truth).isin(0, 1))
    return (
        table.withColumn("_level", _level(sorted(thresholds), score))
        .groupBy(*keys, F.col(truth).alias("_truth"), "_level")
        .agg(F.count("*").alias("_n"), F.sum(score).alias("_score"))
    )


def _from_levels(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key from level rows that carry ``_reach``, the level that gets flagged."""
    flagged, positive = F.col("_level") >= F.col("_reach"), F.col("_truth") == 1
    conditions = {
        "tp": flagged & positive,
        "fp": flagged & ~positive,
        "tn": ~flagged & ~positive,
        "fn": ~flagged & positive,
    }
    return levels.groupBy(*keys).agg(
        *[F.sum(F.when(c, F.col("_n")).otherwise(0)).alias(n) for n, c in conditions.items()],
        F.sum("_score").alias("score_sum"),
    )


def counts_at_thresholds(
    scored: DataFrame,
    thresholds: list[float],
    keys: list[str] | None = None,
    score: str = "y_proba",
    truth: str = "y_true",
) -> DataFrame:
    """``keys, threshold, tp, fp, tn, fn, score_sum`` for every threshold."""
    keys = keys or []
    ordered = sorted(thresholds)
    points = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.lit(i).alias("_reach"))
            for i, t in enumerate(ordered, 1)
        ]
    )
    levels = level_counts(scored, ordered, keys, score, truth)
    spread = levels.select("*", F.inline(points))
    return _from_levels(spread, [*keys, "threshold"])


def counts_by_policy(
    scored: DataFrame,
    policies: list[Policy],
    keys: list[str] | None = None,
    score: str = "y_proba",
    truth: str = "y_true",
) -> DataFrame:
    """Counts of every policy on its model's scores: ``policy, display_name, threshold, keys``."""
    keys = keys or []
    ordered = sorted({p.threshold for p in policies})
    rules = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.display_name or p.name).alias("display_name"),
                F.lit(p.model_name).alias("_model"),
                F.lit(float(p.threshold)).alias("threshold"),
                F.lit(ordered.index(p.threshold) + 1).alias("_reach"),
            )
            for p in policies
        ]
    )
    levels = level_counts(scored, ordered, ["model_name", *keys], score, truth)
    spread = levels.select("*", F.inline(rules)).where("model_name = _model")
    return _from_levels(spread, ["policy", "display_name", "model_name", "threshold", *keys])


def join_policy(scored: DataFrame, policies: list[Policy]) -> DataFrame:
    """Every scored row under every policy of its model, with the decision.

    The policy table is written in the program, so it is small and safe to send to all tasks.
    """
    rules = scored.sparkSession.createDataFrame(
        [(p.name, p.model_name, float(p.threshold)) for p in policies],
        "policy string, model_name string, threshold double",
    )
    joined = scored.join(F.broadcast(rules), "model_name")
    high_risk = (F.col("y_proba") >= F.col("threshold")).cast("int")
    return joined.withColumn("predicted_high_risk", high_risk)


def _beta_score(beta: int) -> Column:
    tp, fp, fn = as_col("tp"), as_col("fp"), as_col("fn")
    weight = beta * beta
    return rate((1 + weight) * tp, (1 + weight) * tp + weight * fn + fp)


def measures() -> dict[str, Column]:
    """The measures of one row of counts, by name."""
    tp, fp, tn, fn = (F.col(name) for name in COUNTS)
    n = tp + fp + tn + fn
    recall = rate(tp, tp + fn)
    return {
        "accuracy": rate(tp + tn, n),
        "precision": rate(tp, tp + fp),
        "recall": recall,
        "specificity": rate(tn, tn + fp),
        "f1": _beta_score(1),
        "f2": _beta_score(2),
        "false_positive_rate": rate(fp, fp + tn),
        "false_negative_rate": rate(fn, fn + tp),
        "true_positives": tp,
        "false_positives": fp,
        "true_negatives": tn,
        "false_negatives": fn,
        "predicted_default_rate": rate(tp + fp, n),
        "predicted_non_default_rate": rate(tn + fn, n),
        "approval_support_rate": rate(tn + fn, n),
        "default_capture_rate": recall,
        "expected_cost": MISS_COST * fn + FALSE_ALARM_COST * fp,
    }


def _with_measures(counts: DataFrame, keys: list[str], names: list[str] | None = None) -> DataFrame:
    chosen = measures()
    return counts.select(*keys, *[chosen[n].alias(n) for n in names or chosen])


def confusion(
    scored: DataFrame,
    threshold: float,
    keys: list[str] | None = None,
    score: str = "y_proba",
    truth: str = "y_true",
) -> DataFrame:
    """All measures at one threshold."""
    keys = keys or []
    flagged = F.col(score) >= F.lit(float(threshold))
    counts = scored.where(F.col(score).isNotNull()).groupBy(*keys).agg(*counts_when(flagged, truth))
    table = counts.withColumn("threshold", F.lit(float(threshold)))
    return _with_measures(table, [*keys, "threshold"])


def threshold_grid(
    scored: DataFrame, keys: list[str] | None = None, thresholds: list[float] | None = None,
    **columns,
) -> DataFrame:
    """All measures at every threshold of the grid, per key (candidate, split)."""
    keys = keys or []
    counts = counts_at_thresholds(scored, thresholds or GRID, keys, **columns)
    return _with_measures(counts, [*keys, "threshold"])


REPORT = ["accuracy", "precision", "recall", "f1", "f2"]


def classification_report(
    scored: DataFrame, threshold: float = 0.50, keys: list[str] | None = None
) -> DataFrame:
    """Threshold measures and ranking measures, one row per key."""
    keys = keys or []
    names = [*REPORT, "approval_support_rate", "predicted_default_rate"]
    cut = confusion(scored, threshold, keys).select(*keys, *names)
    cut = cut.withColumnRenamed("predicted_default_rate", "predicted_high_risk_rate")
    return add_ranking(cut, scored, keys)


def add_ranking(rows: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    """Join the ranking measures of each key to its rows (both sides hold a row per key)."""
    ranks = ranking_metrics(scored, keys)
    if keys:
        return rows.join(ranks, keys, "left")
    both = rows.withColumn("_ranks", ranks.select(F.struct("*")).scalar())
    return both.select("*", "_ranks.roc_auc", "_ranks.pr_auc").drop("_ranks")
