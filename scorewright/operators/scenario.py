"""What-if tables: the same applicants under other limits, delays, bills and payments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import group_label, sex_code, sex_group
from ..functions.scalar import as_col, row_mean
from ..schema import BASE, BILLS, PAY_STATUS, PAYMENTS, PROTECTED
from .prepare import add_features

# A scorer adds the column ``probability`` to a table of base columns.
Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Scorecard:
    """A fixed logistic score: log-odds are a sum over features, missing ones count as 0."""

    intercept: float
    coefficients: dict[str, float] = field(default_factory=dict)

    def log_odds(self) -> Column:
        terms = [
            f"{weight!r}D * coalesce(cast(`{name}` as double), 0D)"
            for name, weight in self.coefficients.items()
        ]
        return F.expr(" + ".join([f"{self.intercept!r}D", *terms]))

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.log_odds()))

    def __call__(self, df: DataFrame) -> DataFrame:
        return add_features(df).withColumn("probability", self.probability())


def _limits(low: Column, high: Column, points: int) -> Column:
    """Evenly spaced values with both ends, as an array."""
    step = (high - low) / float(points - 1)
    return F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.when(i == points - 1, high).otherwise(low + i.cast("double") * step),
    )


# Lowest limit tried, number of limits, and the notes of the three outcomes.
LOWEST_LIMIT, EXPOSURE_POINTS, CURVE_POINTS = 10_000.0, 24, 12
NO_LIMIT_NOTE = "No positive target credit amount was entered for simulation."
FOUND_NOTE = "Highest simulated target credit amount below the manual-review threshold."
NONE_NOTE = "No simulated target credit amount stayed below the manual-review threshold."


def scenario_exposure(df: DataFrame, scorer: Scorer, threshold: float, key: str) -> DataFrame:
    """Per applicant, the highest of 24 limits up to the present one that keeps the score low.

    The limits of one applicant are made and merged again in the same task before the shuffle.
    """
    current = F.greatest(F.coalesce(F.col("LIMIT_BAL").cast("double"), F.lit(0.0)), F.lit(0.0))
    lowest = F.least(F.lit(LOWEST_LIMIT), current)
    limits = F.when(current > 0, _limits(lowest, current, EXPOSURE_POINTS)).otherwise(
        F.array(F.lit(0.0))
    )
    tall = df.select(key, *BASE).withColumn("_limit", F.explode(limits))
    scores = scorer(tall.withColumn("LIMIT_BAL", F.col("_limit"))).select(
        key, "_limit", F.when(F.col("_limit") > 0, F.col("probability")).alias("p")
    )
    fits = F.when(F.col("p") < F.lit(threshold), F.struct("_limit", "p"))
    best = scores.groupBy(key).agg(
        F.max(fits).alias("best"), F.min("p").alias("lowest"), F.max("_limit").alias("current")
    )
    note = (
        F.when(F.col("current") <= 0, NO_LIMIT_NOTE)
        .when(F.col("best").isNotNull(), FOUND_NOTE)
        .otherwise(NONE_NOTE)
    )
    return best.select(
        key,
        F.coalesce("best._limit", F.lit(0.0)).alias("max_exposure"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce("best.p", "lowest").alias("probability_at_exposure"),
        note.alias("note"),
    )


def scenario_curve(df: DataFrame, scorer: Scorer, key: str) -> DataFrame:
    """Score of every applicant at 12 limits from 0.4 to 1.2 times the present one."""
    current = F.greatest(F.coalesce(F.col("LIMIT_BAL").cast("double"), F.lit(1.0)), F.lit(1.0))
    low = F.greatest(current * 0.4, F.lit(1.0))
    high = F.greatest(current * 1.2, low)
    tall = df.select(key, *BASE).select(
        "*", F.posexplode(_limits(low, high, CURVE_POINTS)).alias("point", "_limit")
    )
    scores = scorer(tall.withColumn("LIMIT_BAL", F.col("_limit")))
    return scores.select(
        key,
        "point",
        F.col("_limit").alias("target_credit_amount"),
        F.col("probability").alias("predicted_default_risk"),
    )


@dataclass(frozen=True)
class Adjustment:
    """New values for all months; ``first_delay`` sets the latest month apart."""

    name: str
    limit: float
    delay: int
    bill: float
    payment: float
    first_delay: int | None = None


def scenario_adjust(df: DataFrame, adjustments: list[Adjustment], key: str) -> DataFrame:
    """Every applicant under every adjustment, as base columns ready to be scored."""
    options = F.array(
        *[
            F.struct(
                F.lit(a.name).alias("scenario"),
                F.lit(float(a.limit)).alias("limit"),
                F.lit(a.delay if a.first_delay is None else a.first_delay).alias("first"),
                F.lit(a.delay).alias("delay"),
                F.lit(float(a.bill)).alias("bill"),
                F.lit(float(a.payment)).alias("payment"),
            )
            for a in adjustments
        ]
    )
    changed = {
        "LIMIT_BAL": F.col("_s.limit"),
        **{name: F.col("_s.delay") for name in PAY_STATUS},
        PAY_STATUS[0]: F.col("_s.first"),
        **{name: F.col("_s.bill") for name in BILLS},
        **{name: F.col("_s.payment") for name in PAYMENTS},
    }
    tall = df.select(key, *BASE).withColumn("_s", F.explode(options))
    return tall.withColumns(changed).select(key, F.col("_s.scenario").alias("scenario"), *BASE)


def applicant_ratios() -> dict[str, Column]:
    """Average bill and payment, utilisation, payment ratio and longest delay of one row."""
    limit = F.greatest(F.coalesce(F.col("LIMIT_BAL").cast("double"), F.lit(0.0)), F.lit(1.0))
    bill = F.coalesce(row_mean(BILLS), F.lit(0.0))
    payment = F.coalesce(row_mean(PAYMENTS), F.lit(0.0))
    return {
        "average_bill": bill,
        "average_payment": payment,
        "utilization": bill / limit,
        "payment_ratio": F.when(bill != 0, payment / bill).otherwise(0.0),
        "max_delay": F.coalesce(F.greatest(*PAY_STATUS), F.lit(0)),
    }


# Limits and texts of the shortcoming rules.
HIGH_UTILIZATION, LOW_PAYMENT, NOT_LOW_RISK = 0.45, 0.08, 0.30
SHORTCOMINGS = {
    "delay": (
        "Recent repayment delay is high.",
        "Recent delinquency is a strong signal of near-term default risk.",
        "Maintain on-time repayments for future billing cycles before requesting higher exposure.",
    ),
    "utilization": (
        "Bill balance is high relative to the target credit amount.",
        "High utilization leaves less repayment capacity buffer.",
        "Reduce outstanding bill balances before increasing the target credit amount.",
    ),
    "payment": (
        "Repayment amount is low relative to bills.",
        "Low repayment intensity can indicate weaker short-term repayment capacity.",
        "Increase regular repayments relative to outstanding bills.",
    ),
    "risk": (
        "Predicted default risk is above the low-risk band.",
        "The score suggests the profile needs manual review before higher exposure.",
        "Lower the requested exposure or improve repayment behavior before applying.",
    ),
    "none": (
        "No major shortcoming is visible in the current simulation.",
        "The current repayment, utilization, and payment profile is comparatively low risk.",
        "Maintain payment consistency and avoid increasing utilization sharply.",
    ),
}


def shortcomings(df: DataFrame, key: str, probability: str = "probability") -> DataFrame:
    """Which of four rules an applicant breaks, in order; one plain row when none."""
    rated = df.withColumns(applicant_ratios())
    broken = {
        "delay": F.col("max_delay") > 0,
        "utilization": F.col("utilization") > HIGH_UTILIZATION,
        "payment": F.col("payment_ratio") < LOW_PAYMENT,
        "risk": F.col(probability) >= NOT_LOW_RISK,
    }

    def entry(name: str) -> Column:
        fields = zip(("shortcoming", "why", "action"), SHORTCOMINGS[name])
        return F.struct(*[F.lit(text).alias(column) for column, text in fields])

    found = F.array(*[F.when(rule, entry(name)) for name, rule in broken.items()])
    present = F.filter(found, lambda e: e.isNotNull())
    listed = F.when(F.size(present) > 0, F.slice(present, 1, 4)).otherwise(F.array(entry("none")))
    return rated.select(key, F.posexplode(listed).alias("position", "_e")).select(
        key, (F.col("position") + 1).alias("position"), "_e.*"
    )


def sensitivity_flip(
    df: DataFrame,
    scorer: Scorer,
    key: str,
    codes: tuple[int, int],
    truth: str,
    baseline: float = 0.50,
    tuned: float = 0.25,
) -> DataFrame:
    """Both scores of every row, as it is and with the protected code flipped, in one pass."""
    kept = df.select(key, truth, *BASE)
    first = scorer(kept).select(
        *kept.columns, F.col("probability").alias("original_probability")
    )
    value = F.col(PROTECTED)
    flipped_code = F.when(value == codes[0], codes[1]).when(value == codes[1], codes[0])
    turned = first.withColumns({"_was": value, PROTECTED: flipped_code})
    second = scorer(turned).withColumnRenamed("probability", "flipped_probability")
    original, flipped = as_col("original_probability"), as_col("flipped_probability")

    def group(prefix: str, code: str) -> list[Column]:
        column = F.col(code)
        return [
            sex_code(column).alias(f"{prefix}_sex_code"),
            sex_group(column).alias(f"{prefix}_sex_group"),
            group_label(column).alias(f"{prefix}_group"),
        ]

    def changed(limit: float) -> Column:
        return (original >= F.lit(limit)) != (flipped >= F.lit(limit))

    return second.select(
        key,
        *group("original", "_was"),
        *group("flipped", PROTECTED),
        F.col(truth).alias("actual_default"),
        "original_probability",
        "flipped_probability",
        F.abs(flipped - original).alias("absolute_probability_change"),
        changed(baseline).alias("baseline_decision_changed"),
        changed(tuned).alias("recall_policy_decision_changed"),
    )


def join_original_flipped(original: DataFrame, flipped: DataFrame, key: str) -> DataFrame:
    """Two scored versions of the same applicants, matched on their id."""
    left = original.select(key, F.col("probability").alias("original_probability"))
    right = flipped.select(key, F.col("probability").alias("flipped_probability"))
    change = F.abs(F.col("flipped_probability") - F.col("original_probability"))
    return left.join(right, key).withColumn("absolute_probability_change", change)


def sensitivity_summary(flips: DataFrame) -> DataFrame:
    return flips.agg(
        F.max("absolute_probability_change").alias("max_absolute_probability_change"),
        F.count_if("baseline_decision_changed").alias("baseline_decision_changes"),
        F.count_if("recall_policy_decision_changed").alias("recall_policy_decision_changes"),
    )
