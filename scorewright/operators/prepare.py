"""Header clean-up, typing, target parsing and feature engineering of applicant tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import category_code
from ..functions.scalar import (
    as_col,
    count_positive,
    divide_text,
    inf_to_null,
    mean_text,
    numeric,
)
from ..schema import (
    APPLICANT_SCHEMA,
    BASE,
    BILL_RATIOS,
    BILLS,
    ENGINEERED,
    IDENTIFIERS,
    PAY_STATUS,
    PAYMENTS,
    TARGET,
    TARGET_HEADERS,
    feature_columns,
    require_columns,
)

_HEADERS = {f"X{position}": name for position, name in enumerate(BASE, start=1)}
_HEADERS.update({header: TARGET for header in TARGET_HEADERS})
_HEADERS.update({name.upper(): name for name in [TARGET, *ENGINEERED, *APPLICANT_SCHEMA.names]})

STRING_CODES = ["SEX", "EDUCATION", "MARRIAGE", *PAY_STATUS]


def clean_header(name: str) -> str:
    return re.sub("_{2,}", "_", re.sub(r"[.\- ]", "_", name.strip())).upper()


def norm_columns(df: DataFrame) -> DataFrame:
    """Clean the header, give coded columns their names, and number repeated names."""
    names: list[str] = []
    for header in df.columns:
        key = clean_header(header)
        name = _HEADERS.get(key, key)
        names.append(f"{name}_{len(set(names))}" if name in names else name)
    return df.toDF(*names)


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns as doubles; cells that are no numbers become null."""
    present = [name for name in names if name in df.columns]
    return df.withColumns({name: numeric(name) for name in present})


def adapt_schema(df: DataFrame) -> DataFrame:
    """Any accepted header and typing to the applicant table with features.

    Rows without a target are dropped; a missing column raises. Adapting twice changes nothing.
    """
    table = require_columns(norm_columns(df), [*BASE, TARGET], "applicant table")
    typed = coerce_numeric(table, [*BASE, TARGET]).na.drop(subset=[TARGET])
    return add_features(typed.withColumn(TARGET, F.col(TARGET).cast("int")))


def norm_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Target as 0/1: Yes/No words, numbers, and 0 for anything else."""
    require_columns(df, [target], "target table")
    text = F.col(target).cast("string")
    code = F.when(text.isin("Yes", "Y"), 1.0).when(text.isin("No", "N"), 0.0).otherwise(
        numeric(target)
    )
    return df.withColumn(target, F.coalesce(code, F.lit(0.0)).cast("int"))


def bill_to_limit() -> dict[str, str]:
    return {name: divide_text(bill, "LIMIT_BAL") for name, bill in zip(BILL_RATIOS, BILLS)}


def averages() -> dict[str, str]:
    """Row means, over the bill ratios and the base columns."""
    paid = [divide_text(pay, f"abs({bill})") for pay, bill in zip(PAYMENTS, BILLS)]
    return {
        "AvgBillToLimitRatio": mean_text(BILL_RATIOS),
        "AvgPaymentToBillRatio": mean_text(paid),
        "AvgBillAmount": mean_text(BILLS),
        "AvgPaymentAmount": mean_text(PAYMENTS),
        "PaymentToLimitRatio": divide_text(mean_text(PAYMENTS), "LIMIT_BAL"),
    }


def delay_features() -> dict[str, Column]:
    return {
        "RecentPaymentDelay": F.col("PAY_0"),
        "MaxPaymentDelay": F.greatest(*PAY_STATUS),
        "NumDelayedMonths": count_positive(PAY_STATUS),
    }


def add_features(df: DataFrame) -> DataFrame:
    """The 14 engineered columns, computed row by row; infinities become null."""
    ratios = df.withColumns({name: inf_to_null(F.expr(f)) for name, f in bill_to_limit().items()})
    return ratios.withColumns(
        {
            **{name: inf_to_null(F.expr(f)) for name, f in averages().items()},
            **delay_features(),
        }
    )


def date_parts(df: DataFrame, column: str = "LoanStartDate") -> DataFrame:
    """Year, month and quarter in place of the date; nothing relative to other rows' dates."""
    if column not in df.columns:
        return df
    stem = column.removesuffix("Date")
    date = F.try_to_timestamp(F.col(column).cast("string"))
    parts = {
        f"{stem}Year": F.year(date),
        f"{stem}Month": F.month(date),
        f"{stem}Quarter": F.quarter(date),
    }
    return df.withColumns(parts).drop(column)


def prepare_table(df: DataFrame, target: str = TARGET, drop: list[str] | None = None) -> DataFrame:
    """Target, date parts, features (where the table has the base columns), then ids dropped."""
    table = norm_target(df, target).transform(date_parts)
    needed = {"LIMIT_BAL", *PAY_STATUS, *BILLS, *PAYMENTS}
    if needed <= set(table.columns):
        table = add_features(coerce_numeric(table, sorted(needed)))
    return table.drop(*(drop or IDENTIFIERS))


def select_features(
    df: DataFrame,
    feature_set: str = "full_public_diagnostic",
    keep: list[str] | None = None,
    target: str = TARGET,
) -> DataFrame:
    """Features of a named set plus the target, and the row keys named in ``keep``."""
    return df.select(*(keep or []), *feature_columns(df, feature_set), target)


def categorical_codes(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    return df.withColumns({name: category_code(name) for name in names or STRING_CODES})


def applicant_row(inputs: DataFrame, defaults: DataFrame, columns: list[str]) -> DataFrame:
    """Full feature rows from the given inputs.

    Features are computed from the inputs, and every other wanted column is filled from the
    one-row table of column defaults.
    """
    table = add_features(coerce_numeric(inputs, BASE))
    filled = table.withColumn("_defaults", defaults.select(F.struct("*")).scalar())
    missing = [name for name in columns if name not in table.columns]
    filled = filled.withColumns({name: as_col(f"_defaults.{name}") for name in missing})
    keys = [name for name in inputs.columns if name not in BASE and name not in columns]
    return filled.select(*keys, *columns)
