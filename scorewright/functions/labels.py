"""Codes to readable labels, as column expressions and small literal lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BILLS, PAYMENTS
from .scalar import as_col, numeric

# Label tables.
SEX_LABELS = {1: "Male", 2: "Female"}
PAY_STATUS_LABELS = {
    -2: "No use / no balance",
    -1: "Paid in full",
    0: "On time",
    1: "1 month delayed",
    2: "2 months delayed",
    3: "3 months delayed",
    4: "4 months delayed",
    5: "5 months delayed",
    6: "6 months delayed",
    7: "7 months delayed",
    8: "8+ months delayed",
}
FEATURE_LABELS = {
    "LIMIT_BAL": "Credit Limit",
    "SEX": "Sex",
    "EDUCATION": "Education",
    "MARRIAGE": "Marriage",
    "AGE": "Age",
    "PAY_0": "Most Recent Repayment Status",
    **{f"PAY_{k}": f"Repayment Status {k}" for k in range(2, 7)},
    "BILL_AMT1": "Most Recent Bill Amount",
    **{name: f"Bill Amount {k}" for k, name in enumerate(BILLS[1:], start=2)},
    "PAY_AMT1": "Most Recent Payment Amount",
    **{name: f"Payment Amount {k}" for k, name in enumerate(PAYMENTS[1:], start=2)},
    "AvgBillToLimitRatio": "Average Bill-to-Limit Ratio",
    "AvgPaymentToBillRatio": "Average Payment-to-Bill Ratio",
    "RecentPaymentDelay": "Recent Payment Delay",
    "MaxPaymentDelay": "Maximum Payment Delay",
    "NumDelayedMonths": "Number of Delayed Months",
    "AvgBillAmount": "Average Bill Amount",
    "AvgPaymentAmount": "Average Payment Amount",
    "PaymentToLimitRatio": "Payment-to-Limit Ratio",
}
AGE_BANDS = [(0, 26, "18-25"), (26, 36, "26-35"), (36, 46, "36-45"), (46, 56, "46-55"),
             (56, 66, "56-65")]
OLDEST_BAND = (66, "66+")
CATEGORY_FIELDS = ["SEX", "EDUCATION", "MARRIAGE"]
LOW_RISK_BELOW, MEDIUM_RISK_UP_TO = 0.30, 0.60


def lookup(table: dict, key) -> Column:
    """Value of a small literal table for a key column, null when it has none."""
    literal = F.create_map(*[F.lit(item) for item in chain.from_iterable(table.items())])
    return F.try_element_at(literal, as_col(key))


def sex_code(value) -> Column:
    """Whole part of the parsed code; anything unparseable or infinite is null."""
    return numeric(value).try_cast("int")


def sex_group(value) -> Column:
    return F.coalesce(lookup(SEX_LABELS, sex_code(value)), F.lit("Unknown"))


def group_label(value, missing: str = "None") -> Column:
    """Label with its code, such as ``Male (SEX=1)``; an unparseable code is shown as given."""
    shown = F.coalesce(
        sex_code(value).cast("string"), as_col(value).cast("string"), F.lit(missing)
    )
    return F.concat(sex_group(value), F.lit(" (SEX="), shown, F.lit(")"))


def sex_fields(value="SEX") -> list[Column]:
    return [
        sex_code(value).alias("sex_code"),
        sex_group(value).alias("sex_group"),
        group_label(value).alias("group"),
    ]


def code_in_label(label) -> Column:
    """Code inside an older text label such as ``SEX=2`` or ``SEX 2``."""
    return F.regexp_extract(as_col(label), r"SEX=?\s*(\d+)", 1).try_cast("int")


def sex_group_lower(value) -> Column:
    number = numeric(value)
    return F.when(number == 1, "male").when(number == 2, "female").otherwise("unknown")


def age_group(value) -> Column:
    age = numeric(value)
    band = F.when(age >= OLDEST_BAND[0], OLDEST_BAND[1])
    for low, high, label in AGE_BANDS:
        band = band.when((age >= low) & (age < high), label)
    return band.otherwise("unknown")


def category_code(value) -> Column:
    return numeric(value).try_cast("int").cast("string")


def risk_band(probability) -> Column:
    p = as_col(probability)
    return (
        F.when(p < LOW_RISK_BELOW, "Low Risk")
        .when(p <= MEDIUM_RISK_UP_TO, "Medium Risk")
        .otherwise("High Risk")
    )


def recommendation(probability) -> Column:
    p = as_col(probability)
    return (
        F.when(p < LOW_RISK_BELOW, "Low predicted default risk / low review priority")
        .when(p <= MEDIUM_RISK_UP_TO, "Manual review recommended")
        .otherwise("High predicted default risk / strong review required")
    )


def review_flag(probability, threshold) -> Column:
    return F.when(as_col(probability) >= threshold, "Manual review recommended").otherwise(
        "No manual review flag"
    )


def pay_status_label(code) -> Column:
    other = F.concat(as_col(code).cast("string"), F.lit(" months delayed"))
    return F.coalesce(lookup(PAY_STATUS_LABELS, code), other)


def friendly_name(name, table: dict[str, str]) -> Column:
    plain = F.initcap(F.regexp_replace(as_col(name), "_", " "))
    return F.coalesce(lookup(table, name), plain) if table else plain


def raw_feature(name) -> Column:
    """Source column of a transformed feature name (``num__X``, ``cat__X_level``)."""
    text = as_col(name)
    core = F.regexp_replace(text, "^(num|cat)__", "")
    field = F.regexp_extract(core, f"^({'|'.join(CATEGORY_FIELDS)})_", 1)
    return F.when(text.startswith("cat__") & (field != ""), field).otherwise(core)


def display_name(name) -> Column:
    text = as_col(name)
    base = raw_feature(text)
    label = F.coalesce(lookup(FEATURE_LABELS, base), base)
    core = F.regexp_replace(text, "^cat__", "")
    level = F.substring(core, F.length(base) + 2, F.length(core))
    return (
        F.when(text.startswith("cat__") & (core != base), F.concat(label, F.lit(": "), level))
        .when(text.startswith("cat__"), F.regexp_replace(core, "_", " "))
        .otherwise(label)
    )
