"""Numeric expressions with the null rules of the audit tables.

A missing value is always SQL NULL, never NaN; a rate over an empty base is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def numeric(value) -> Column:
    """Parse as double; text that is no number, and NaN, become null."""
    number = as_col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def divide_text(numerator: str, denominator: str) -> str:
    """SQL text of a division: 0 for a zero or missing denominator, a missing numerator stays."""
    return (
        f"(case when ({denominator}) is null or ({denominator}) = 0 then 0D "
        f"else cast(({numerator}) as double) / cast(({denominator}) as double) end)"
    )


def mean_text(values: list[str]) -> str:
    """SQL text of the mean over those values of one row that are present; null when none is."""
    total = " + ".join(f"coalesce(cast({v} as double), 0D)" for v in values)
    present = " + ".join(f"cast(({v}) is not null as int)" for v in values)
    return f"(({total}) / nullif({present}, 0))"


def safe_divide(numerator, denominator) -> Column:
    """0 for a zero or missing denominator; a missing numerator stays missing."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(divide_text(numerator, denominator))
    top, bottom = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.when(bottom.isNull() | (bottom == 0), F.lit(0.0)).otherwise(top / bottom)


def rate(numerator, denominator) -> Column:
    """Share of a count in another; 0 over an empty base, never null."""
    return F.coalesce(safe_divide(numerator, denominator), F.lit(0.0))


def row_mean(values: list[str]) -> Column:
    return F.expr(mean_text(values))


def count_positive(names: list[str]) -> Column:
    """How many columns of a row are above zero; missing ones are not."""
    return F.expr(" + ".join(f"(case when {n} > 0 then 1 else 0 end)" for n in names))


def inf_to_null(value) -> Column:
    """Infinite values and NaN become null."""
    column = as_col(value)
    return F.when(~F.isnan(column) & (F.abs(column) != F.lit(float("inf"))), column)


def cell_text(value, dtype: str, places: int | None = None) -> Column:
    """Exact text of one cell; with ``places``, fractions are written as whole units of 10^-places.

    Engines print doubles differently, so a signature to be compared with another engine's uses
    the number of places the data really has (2 for money).
    """
    column = as_col(value)
    if places is not None and dtype in ("double", "float"):
        column = F.round(column * float(10**places)).cast("decimal(38,0)")
    return F.coalesce(column.cast("string"), F.lit("nan"))


def row_signature(df, names: list[str], places: int | None = None) -> Column:
    """md5 over the cells of the named columns; equal rows share it, whatever their ids."""
    types = dict(df.dtypes)
    return F.md5(F.concat_ws("||", *[cell_text(n, types[n], places) for n in names]))


def hash_order(*values, seed: int = 42) -> Column:
    """Fixed random order of rows: md5 of their key and a seed."""
    return F.md5(F.concat_ws("|", *[as_col(v).cast("string") for v in values], F.lit(str(seed))))


def hash_share(*values, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the values and a seed."""
    return F.pmod(F.xxhash64(*[as_col(v) for v in values], F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
