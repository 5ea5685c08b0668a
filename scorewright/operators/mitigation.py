"""Reweighing, per-group thresholds, randomised equalised odds and class weights."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_share, rate
from ..schema import TARGET
from .confusion import COUNTS, GRID, counts_at_thresholds
from .ordering import looked_up, running_counts, small_lookup


def reweigh(df: DataFrame, group: str = "SEX", target: str = TARGET) -> DataFrame:
    """Adds ``weight``: P(group) * P(class) / P(group, class).

    Weights come from the counts of the few cells and are read from a small map, so the table
    itself is not shuffled by its two or three hot keys.
    """
    cells = df.groupBy(group, target).agg(F.count("*").alias("n"))
    whole, of_group, of_class = (Window.partitionBy(*c) for c in ([F.lit(0)], [group], [target]))
    expected = (
        F.sum("n").over(of_group).cast("double") * F.sum("n").over(of_class) / F.sum("n").over(whole)
    )
    weights = cells.withColumn("weight", expected / F.col("n"))
    lookup = small_lookup(weights, [group, target], "weight")
    return looked_up(df, "weight", lookup, [group, target]).na.fill({"weight": 1.0})


def reweigh_binary(df: DataFrame, group: str = "SEX", target: str = TARGET) -> DataFrame:
    """Reweighing on two sides: the first group in text order against all others."""
    first = df.agg(F.min(F.col(group).cast("string"))).scalar()
    sided = df.withColumn("_first", first).withColumn(
        "_side", (F.col(group).cast("string") == F.col("_first")).cast("int")
    )
    return reweigh(sided, "_side", target).drop("_first", "_side")


# The class weights tried, before the imbalance ratio.
WEIGHTS = [1, 2, 3, 4, 5, 7, 10]


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Positive-class weights to try, in order, without repeats: ``position, weight``."""
    ratio = F.when(F.col("ones") > 0, F.col("zeros") / F.col("ones")).otherwise(1.0)
    values = F.array(*[F.lit(float(w)) for w in WEIGHTS], F.round(ratio, 4))
    counts = df.agg(
        F.count_if(F.col(target) == 0).cast("double").alias("zeros"),
        F.count_if(F.col(target) == 1).cast("double").alias("ones"),
    )
    return counts.select(F.posexplode(F.array_distinct(values)).alias("position", "weight"))


def balanced_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Weight of each class: rows / (classes * rows of the class)."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))
    total, classes = F.sum("n").over(whole).cast("double"), F.count("*").over(whole)
    return counts.select(target, "n", (total / (classes * F.col("n"))).alias("weight"))


def matched_thresholds(
    scored: DataFrame,
    group: str = "SEX",
    thresholds: list[float] | None = None,
) -> DataFrame:
    """One threshold per group, so that the groups' error rates are as close as the grid allows.

    For each threshold of the first group every other group takes the one closest to it in
    true- and false-positive rate; the smallest largest gap wins, then the higher accuracy. A
    deterministic choice on the grid, without randomised mixing of thresholds.
    """
    counts = counts_at_thresholds(scored.where(F.col(group).isNotNull()), thresholds or GRID, [group])
    points = counts.select(
        group,
        "threshold",
        rate("tp", F.col("tp") + F.col("fn")).alias("tpr"),
        rate("fp", F.col("fp") + F.col("tn")).alias("fpr"),
        (F.col("tp") + F.col("tn")).alias("right"),
        *COUNTS,
    )
    first = points.agg(F.min(group)).scalar()
    marked = points.withColumn("_first", F.col(group) == first)
    anchors = marked.where("_first").agg(
        F.collect_list(F.struct("threshold", "tpr", "fpr"))
    ).scalar()
    paired = marked.withColumn("_anchors", anchors).select(
        *marked.columns, F.explode("_anchors").alias("at")
    ).where(~F.col("_first") | (F.col("threshold") == F.col("at.threshold")))
    gap = F.greatest(
        F.abs(F.col("tpr") - F.col("at.tpr")), F.abs(F.col("fpr") - F.col("at.fpr"))
    )
    close = paired.withColumn("gap", F.round(gap, 9)).withColumn("anchor", F.col("at.threshold"))
    place = F.row_number().over(
        Window.partitionBy("anchor", group).orderBy("gap", F.desc("right"), "threshold")
    )
    choices = close.withColumn("_place", place).where("_place = 1")
    ranked = choices.groupBy("anchor").agg(
        F.max("gap").alias("odds_gap"), F.sum("right").alias("total_right")
    )
    best = ranked.orderBy("odds_gap", F.desc("total_right"), "anchor").limit(1)
    return choices.join(best, "anchor").select(
        group, "threshold", "tpr", "fpr", "odds_gap", *COUNTS
    )


#: Steps of the false-positive rates that are tried.
ODDS_STEPS = 1000
#: Score levels of a part of a group's curve, whose hull one task finds.
CURVE_PART = 100_000
_POINT = "fp long, tp long, threshold double, positives long, negatives long"


def _hull(points: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Upper hull of (fp, tp, threshold), by rising fp; points on its edges stay. Whole numbers, so exact."""
    best: dict[int, tuple[int, float]] = {}
    for fp, tp, threshold in points:
        if fp not in best or tp > best[fp][0]:
            best[fp] = (tp, threshold)
    made: list[tuple[int, int, float]] = []
    for fp in sorted(best):
        point = (fp, *best[fp])
        while len(made) > 1:
            (a, b, _), (c, d, _) = made[-2:]
            if (d - b) * (fp - a) >= (point[1] - b) * (c - a):
                break
            made.pop()
        made.append(point)
    return made


def roc_hulls(scored: DataFrame, group: str, score: str = "y_proba", truth: str = "y_true") -> DataFrame:
    """Vertices of every group's upper ROC hull: ``group, fp, tp, threshold, positives, negatives``.

    A row is flagged at a vertex if its score is at least ``threshold``; none is flagged where it is null.
    Groups without both classes have no curve; rows without a group, score or class of 0 or 1 count nowhere.
    Equal scores are counted first; a curve is cut into parts of its levels, and the hull of the parts'
    hulls is the hull of all.
    """
    rows = scored.where(F.col(group).isNotNull() & F.col(score).isNotNull() & F.col(truth).isin(0, 1))
    levels = rows.groupBy(group, (-F.col(score).cast("double")).alias("_order")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg")
    )
    parts = max(1, -(-levels.count() // CURVE_PART))
    ranked = running_counts(levels, [group], "_order", ["pos", "neg"]).where("pos_total > 0 and neg_total > 0")
    points = ranked.select(
        group,
        (F.col("neg_before") + F.col("neg")).alias("fp"),
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (-F.col("_order")).alias("threshold"),
        F.col("pos_total").alias("positives"),
        F.col("neg_total").alias("negatives"),
    )
    place = (F.col("fp") + F.col("tp")) / (F.col("positives") + F.col("negatives"))
    points = points.withColumn("_part", F.least(F.floor(place * parts), F.lit(parts - 1)))
    kind = points.schema[group].dataType.simpleString()

    def hull(frame: pd.DataFrame, start: bool) -> pd.DataFrame:
        found = list(zip(frame["fp"].tolist(), frame["tp"].tolist(), frame["threshold"].tolist()))
        if start:
            found = [(0, 0, math.nan), *found]
        made = _hull(found)
        out = pd.DataFrame({"fp": [p[0] for p in made], "tp": [p[1] for p in made], "threshold": [p[2] for p in made]})
        out.insert(0, group, frame[group].iloc[0])
        return out.assign(positives=frame["positives"].iloc[0], negatives=frame["negatives"].iloc[0])

    schema = f"`{group}` {kind}, {_POINT}"
    if parts > 1:
        points = points.groupBy(group, "_part").applyInPandas(lambda f: hull(f, False), schema)
    whole = points.groupBy(group).applyInPandas(lambda f: hull(f.drop(columns="_part", errors="ignore"), True), schema)
    return whole.withColumn("threshold", F.when(~F.isnan("threshold"), F.col("threshold")))


def equalised_odds(
    scored: DataFrame, group: str = "SEX", score: str = "y_proba", truth: str = "y_true", steps: int = ODDS_STEPS
) -> DataFrame:
    """One randomised rule per group, so that all groups have the same true- and false-positive rate.

    For each of ``steps`` + 1 false-positive rates the common true-positive rate is the lowest of the groups'
    hulls; the rate with the highest accuracy counts, the lower one of equals. A group reaches its hull there
    by mixing two neighbouring vertices (``low_share`` of the decisions at ``low_threshold``, the others at
    ``high_threshold``), and comes down to the common rate by ignoring the score in a share ``ignored`` of the
    decisions, which then flag with the probability ``fpr``.
    """
    hulls = roc_hulls(scored, group, score, truth)
    edge = Window.partitionBy(group).orderBy("fp")
    ends = hulls.withColumns({f"{c}_1": F.lead(c).over(edge) for c in ("fp", "tp", "threshold")})
    # steps i with fp <= i * negatives / steps < fp_1
    ceil_div = lambda value: F.expr(f"({value} + negatives - 1) div negatives")
    first = ceil_div(f"{steps} * fp")
    last = F.when(F.col("fp_1").isNull(), F.lit(steps)).otherwise(ceil_div(f"{steps} * fp_1") - 1)
    grid = ends.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    grid = grid.withColumn("step", F.explode(F.sequence("_first", "_last")))
    beyond = F.col("step") * F.col("negatives") - steps * F.col("fp")
    share = F.when(beyond == 0, 0.0).otherwise(beyond / (F.lit(float(steps)) * (F.col("fp_1") - F.col("fp"))))
    grid = grid.withColumn("low_share", share).withColumn(
        "own_tpr", (F.col("tp") + F.col("low_share") * F.coalesce(F.col("tp_1") - F.col("tp"), F.lit(0))) / F.col("positives")
    )
    x = F.col("step") / F.lit(float(steps))
    right = F.sum("positives") * F.min("own_tpr") + F.sum("negatives") * (1 - F.first("step") / F.lit(float(steps)))
    common = grid.groupBy("step").agg(
        F.min("own_tpr").alias("tpr"), (right / (F.sum("positives") + F.sum("negatives"))).alias("accuracy")
    )
    best = common.orderBy(F.desc(F.round("accuracy", 9)), "step").limit(1)
    above = F.col("own_tpr") - F.col("tpr")
    return grid.join(F.broadcast(best), "step").select(  # one row
        group,
        x.alias("fpr"),
        "tpr",
        "own_tpr",
        F.col("threshold").alias("high_threshold"),
        F.when(F.col("low_share") > 0, F.col("threshold_1")).otherwise(F.col("threshold")).alias("low_threshold"),
        "low_share",
        F.when(above > 0, above / (F.col("own_tpr") - x)).otherwise(0.0).alias("ignored"),
        "accuracy",
    )


def mixed_decision(
    scored: DataFrame, plan: DataFrame, group: str, key: str, score: str = "y_proba", seed: int = 42
) -> DataFrame:
    """Adds ``flag_probability`` and ``flagged``, drawn by a hash of the key: the same row is always decided alike.

    Rows of a group that the plan lacks are cut at 0.50; rows without a score are not flagged.
    """
    lookup = small_lookup(plan, [group], F.struct("fpr", "high_threshold", "low_threshold", "low_share", "ignored"))
    placed = looked_up(scored, "_plan", lookup, [group])

    def reaches(name: str):
        return F.coalesce(F.col(score) >= F.col(f"_plan.{name}"), F.lit(False)).cast("double")

    share, ignored = F.col("_plan.low_share"), F.col("_plan.ignored")
    mixed = (1 - share) * reaches("high_threshold") + share * reaches("low_threshold")
    planned = ignored * F.col("_plan.fpr") + (1 - ignored) * mixed
    simple = (F.col(score) >= 0.50).cast("double")
    chance = F.when(F.col(score).isNull(), 0.0).otherwise(F.coalesce(planned, simple))
    drawn = placed.withColumn("flag_probability", chance)
    return drawn.withColumn("flagged", hash_share(key, seed=seed) < F.col("flag_probability")).drop("_plan")
