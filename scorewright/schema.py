"""Column groups of the applicant table and checks on a table's header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the applicant table and of its engineered features.
TARGET = "Default_Flag"
MONTHS = range(1, 7)
PROFILE = ["SEX", "EDUCATION", "MARRIAGE", "AGE"]
PAY_STATUS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILLS = [f"BILL_AMT{month}" for month in MONTHS]
PAYMENTS = [f"PAY_AMT{month}" for month in MONTHS]
BASE = ["LIMIT_BAL", *PROFILE, *PAY_STATUS, *BILLS, *PAYMENTS]
BILL_RATIOS = [f"BillToLimitRatio_{month}" for month in MONTHS]
DELAY_FEATURES = ["RecentPaymentDelay", "MaxPaymentDelay", "NumDelayedMonths"]
ENGINEERED = [
    *BILL_RATIOS,
    "AvgBillToLimitRatio",
    "AvgPaymentToBillRatio",
    *DELAY_FEATURES,
    "AvgBillAmount",
    "AvgPaymentAmount",
    "PaymentToLimitRatio",
]
IDENTIFIERS = ["ID", "CLIENT_ID", "CustomerID", "LoanID"]
SENSITIVE = ["SEX", "AGE", "MARRIAGE", "EDUCATION"]
PROTECTED = "SEX"
TARGET_HEADERS = ["Y", "DEFAULT_PAYMENT_NEXT_MONTH", "DEFAULT_PAYMENT_NEXT_MONTH_"]
UTILISATION_FEATURES = ["AvgBillToLimitRatio", "AvgPaymentToBillRatio", "PaymentToLimitRatio"]

DIAGNOSTIC_FEATURES = [*BASE, *ENGINEERED]
PUBLIC_FEATURES = [name for name in DIAGNOSTIC_FEATURES if name != PROTECTED]
# Features whose distribution is compared between protected groups.
INTERPRETABLE_FEATURES = [name for name in PUBLIC_FEATURES if name not in SENSITIVE]

FEATURE_SETS = {
    "application_public": PUBLIC_FEATURES,
    "legacy_behavioral": PUBLIC_FEATURES,
    "full_public_diagnostic": DIAGNOSTIC_FEATURES,
    "application": PUBLIC_FEATURES,
    "behavioral": PUBLIC_FEATURES,
    "full_diagnostic": DIAGNOSTIC_FEATURES,
}

# The blocks of the coverage audit.
COVERAGE_BLOCKS = {
    "Borrower Profile": PROFILE,
    "Credit History": PAY_STATUS,
    "Loan / Exposure": ["LIMIT_BAL"],
    "Financial Health": [*BILLS, *PAYMENTS, *ENGINEERED],
    "Target": [TARGET],
}

_MONEY = {"LIMIT_BAL", *BILLS, *PAYMENTS}
APPLICANT_SCHEMA = T.StructType(
    [T.StructField("applicant_id", T.LongType(), False)]
    + [
        T.StructField(name, T.DoubleType() if name in _MONEY else T.IntegerType())
        for name in BASE
    ]
    + [T.StructField(TARGET, T.IntegerType())]
)
PREDICTION_COLUMNS = ["y_true", "y_proba", "model_name", "split"]


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {', '.join(missing)}")
    return df


def feature_columns(df: DataFrame, feature_set: str = "full_public_diagnostic") -> list[str]:
    """Members of a named feature set that the table has, in the set's order."""
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"Unsupported feature set: {feature_set}")
    present = set(df.columns)
    return [name for name in FEATURE_SETS[feature_set] if name in present]
