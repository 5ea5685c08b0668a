"""Group outcomes, group errors, fairness gaps and group calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import age_group, sex_fields, sex_group_lower
from ..functions.scalar import as_col, rate
from .confusion import (
    COUNTS,
    GRID,
    REPORT,
    Policy,
    add_ranking,
    counts_at_thresholds,
    counts_by_policy,
    measures,
)

GROUP = ["sex_code", "sex_group", "group"]


def with_sex_group(df: DataFrame, column: str = "SEX") -> DataFrame:
    code, group, label = sex_fields(column)
    return df.select("*", code, group, label)


def _group_size() -> Column:
    return F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")


def group_confusion(
    scored: DataFrame, policies: list[Policy], keys: list[str] | None = None
) -> DataFrame:
    """Counts and error rates of every policy in every group."""
    keys = keys or GROUP
    made = measures()
    tn, fn = F.col("tn"), F.col("fn")
    counts = counts_by_policy(scored, policies, keys)
    return counts.select(
        "policy",
        "threshold",
        *keys,
        _group_size().alias("n"),
        *[
            made[name].alias(name)
            for name in ("true_positives", "false_positives", "true_negatives", "false_negatives")
        ],
        made["accuracy"].alias("accuracy"),
        made["precision"].alias("precision"),
        made["precision"].alias("positive_predictive_value"),
        made["recall"].alias("recall"),
        made["recall"].alias("true_positive_rate"),
        made["false_positive_rate"].alias("false_positive_rate"),
        made["false_negative_rate"].alias("false_negative_rate"),
        made["specificity"].alias("specificity"),
        made["specificity"].alias("true_negative_rate"),
        rate(tn, tn + fn).alias("negative_predictive_value"),
    )


def _group_rates() -> dict[str, Column]:
    """Rates of one group; approval (a score below the threshold) is the favourable outcome."""
    tp, fp, tn, fn = (F.col(name) for name in COUNTS)
    n = _group_size()
    return {
        "approved": rate(tn + fn, n),
        "approved_good": rate(tn, tn + fp),
        "approved_bad": rate(fn, fn + tp),
        "flagged_good": rate(fp, fp + tn),
        "missed_bad": rate(fn, fn + tp),
        "flagged": rate(tp + fp, n),
    }


def _spread(name: str) -> Column:
    return F.max(name) - F.min(name)


def _impact(name: str = "approved") -> Column:
    return F.when(F.max(name) > 0, F.min(name) / F.max(name)).otherwise(1.0)


def fairness_gaps(
    counts: DataFrame, keys: list[str], group: str = "group", skip_unknown: bool = False
) -> DataFrame:
    """Largest differences between groups, from one row of counts per key and group."""
    known = counts
    if skip_unknown:
        known = counts.where(F.col(group).isNotNull() & ~F.col(group).startswith("Unknown"))
    rates = known.select(*keys, *[c.alias(n) for n, c in _group_rates().items()])
    return rates.groupBy(*keys).agg(
        _spread("approved").alias("demographic_parity_difference"),
        _impact().alias("disparate_impact_ratio"),
        _spread("approved_good").alias("equal_opportunity_difference"),
        F.greatest(_spread("approved_good"), _spread("approved_bad")).alias(
            "equalized_odds_difference"
        ),
        _spread("flagged_good").alias("false_positive_rate_difference"),
        _spread("missed_bad").alias("false_negative_rate_difference"),
        _spread("flagged").alias("high_risk_rate_difference"),
    )


def four_gaps(counts: DataFrame, keys: list[str], group: str) -> DataFrame:
    """The four approval gaps; rows without a group are left out, one group alone has no impact."""
    rates = counts.where(F.col(group).isNotNull()).select(
        *keys, *[c.alias(n) for n, c in _group_rates().items()]
    )
    return rates.groupBy(*keys).agg(
        _spread("approved").alias("demographic_parity_difference"),
        F.greatest(_spread("approved_good"), _spread("approved_bad")).alias(
            "equalized_odds_difference"
        ),
        _spread("approved_good").alias("equal_opportunity_difference"),
        F.when(F.count("*") < 2, 1.0).otherwise(_impact()).alias("disparate_impact_ratio"),
    )


def policy_gaps(
    scored: DataFrame, policies: list[Policy], keys: list[str] | None = None
) -> DataFrame:
    """All seven gaps per policy."""
    counts = counts_by_policy(scored, policies, keys or GROUP)
    return fairness_gaps(counts, ["policy", "threshold"])


def fairness_metrics4(scored: DataFrame, policies: list[Policy], group: str = "SEX") -> DataFrame:
    counts = counts_by_policy(scored, policies, [group])
    return four_gaps(counts, ["policy", "model_name", "threshold"], group)


def group_outcome(scored: DataFrame, policies: list[Policy]) -> DataFrame:
    """Outcome and flag rates per policy and group, with the policy's gaps."""
    counts = counts_by_policy(scored, policies, GROUP)
    n, flagged = _group_size(), rate(F.col("tp") + F.col("fp"), _group_size())
    rows = counts.select(
        "policy",
        "display_name",
        "threshold",
        *GROUP,
        n.alias("n"),
        rate(F.col("tp") + F.col("fn"), n).alias("actual_default_rate"),
        rate("score_sum", n).alias("mean_predicted_default_probability"),
        flagged.alias("predicted_high_risk_rate"),
        (1 - flagged).alias("predicted_low_risk_rate"),
        (1 - flagged).alias("approval_support_rate"),
    )
    gaps = fairness_gaps(counts, ["policy"])
    return rows.join(gaps, "policy")


# Attributes of the wider check, with the code that turns a column into a group name.
ATTRIBUTES = {"SEX": ("SEX", sex_group_lower), "AGE_GROUP": ("AGE", age_group)}


def fairness_ext(scored: DataFrame, threshold: float = 0.50) -> DataFrame:
    """The four gaps for every model and every attribute, in one pass over the scores."""
    groups = [
        F.struct(F.lit(name).alias("attribute"), label(F.col(column)).alias("value"))
        for name, (column, label) in ATTRIBUTES.items()
    ]
    tall = scored.select("model_name", "y_true", "y_proba", F.inline(F.array(*groups)))
    counts = counts_at_thresholds(tall, [threshold], ["model_name", "attribute", "value"])
    return four_gaps(counts, ["model_name", "attribute"], "value")


def threshold_frontier(
    scored: DataFrame, keys: list[str] | None = None, thresholds: list[float] | None = None
) -> DataFrame:
    """Classification and fairness measures at every threshold."""
    keys = keys or []
    points = [*keys, "threshold"]
    by_group = counts_at_thresholds(scored, thresholds or GRID, [*keys, "group"])
    made = measures()
    whole = by_group.groupBy(*points).agg(*[F.sum(name).alias(name) for name in COUNTS])
    cut = whole.select(
        *points,
        *[made[name].alias(name) for name in REPORT],
        made["approval_support_rate"].alias("approval_support_rate"),
        made["predicted_default_rate"].alias("predicted_high_risk_rate"),
    )
    ranked = add_ranking(cut, scored, keys)
    return ranked.join(fairness_gaps(by_group, points), points)


def fairness_before_after(
    scored: DataFrame, before: Policy, after: Policy, group: str = "SEX"
) -> DataFrame:
    """The four gaps under two policies, side by side."""
    gaps = fairness_metrics4(scored, [before, after], group)
    names = [c for c in gaps.columns if c not in ("policy", "model_name", "threshold")]

    def under(policy: Policy, name: str) -> Column:
        return F.max(F.when(F.col("policy") == policy.name, F.col(name)))

    return gaps.agg(
        *[under(before, name).alias(f"{name}_before") for name in names],
        *[under(after, name).alias(f"{name}_after") for name in names],
        *[(under(after, name) - under(before, name)).alias(f"{name}_change") for name in names],
    )


CALIBRATION_EDGES = [round(0.1 * step, 2) for step in range(11)]


def calibration_bins(
    scored: DataFrame,
    keys: list[str] | None = None,
    edges: list[float] | None = None,
    score: str = "y_proba",
    truth: str = "y_true",
) -> DataFrame:
    """Observed and predicted rate per group and score bin; bins without rows are kept.

    Bins are closed on the left, the last one on both sides; other scores are left out.
    """
    keys = GROUP if keys is None else keys
    edges = edges or CALIBRATION_EDGES
    labels = [f"{low:.2f}-{high:.2f}" for low, high in zip(edges, edges[1:])]
    value = F.col(score)
    bin_of = F.when(value == edges[-1], len(labels) - 1)
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        bin_of = bin_of.when((value >= low) & (value < high), i)
    counts = (
        scored.withColumn("_bin", bin_of)
        .where(F.col("_bin").isNotNull())
        .groupBy(*keys, "_bin")
        .agg(F.count("*").alias("_n"), F.sum(score).alias("_p"), F.sum(truth).alias("_y"))
    )
    bins = F.array(
        *[F.struct(F.lit(i).alias("_at"), F.lit(n).alias("bin")) for i, n in enumerate(labels)]
    )

    def in_bin(name: str) -> Column:
        return F.sum(F.when(F.col("_bin") == F.col("_at"), F.col(name)))

    rows = counts.select("*", F.inline(bins)).groupBy(*keys, "bin").agg(
        F.coalesce(in_bin("_n"), F.lit(0)).alias("n"),
        (in_bin("_p") / in_bin("_n")).alias("mean_predicted_probability"),
        (in_bin("_y") / in_bin("_n")).alias("observed_default_rate"),
    )
    gap = F.col("observed_default_rate") - F.col("mean_predicted_probability")
    return rows.withColumn("calibration_gap", gap)


def max_calibration_gap(bins: DataFrame, keys: list[str] | None = None) -> DataFrame:
    largest = F.max(F.abs(as_col("calibration_gap"))).alias("largest_absolute_calibration_gap")
    return bins.where("n > 0").groupBy(*(keys or [])).agg(largest)


def metric_lookup(table: DataFrame, metric: str, policies: list[str], codes: dict[int, str]):
    """One row with a metric for every wanted policy and group, named ``<policy>_<group>_<metric>``."""
    cells = [
        F.max(
            F.when((F.col("policy") == policy) & (F.col("sex_code") == code), F.col(metric))
        ).alias(f"{policy}_{word}_{metric}")
        for policy in policies
        for code, word in codes.items()
    ]
    return table.agg(*cells)
