"""Reading applicant tables and prediction exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PREDICTION_COLUMNS, TARGET, require_columns

# Columns that may serve as the protected attribute, in order of preference.
PROTECTED_CANDIDATES = ["SEX", "AGE", "MARRIAGE", "EDUCATION", "Gender", "Nationality", "City"]


def src_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, pattern: str | None = None
) -> DataFrame:
    """CSV with a header; without a schema every column is text, to be typed by ``adapt_schema``."""
    reader = spark.read.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """By suffix: Parquet, ORC or JSON; anything else is read as CSV."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix in ("parquet", "orc", "json"):
        return getattr(spark.read, suffix)(path)
    return src_csv(spark, path, schema)


def src_local(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The table and a one-row table about it: name, target and protected columns present."""
    df = read_table(spark, path)
    about = spark.createDataFrame(
        [
            (
                path.rstrip("/").rsplit("/", 1)[-1],
                "local",
                TARGET if TARGET in df.columns else None,
                [c for c in PROTECTED_CANDIDATES if c in df.columns],
                path,
            )
        ],
        "dataset_name string, source string, target_column string, "
        "protected_attributes_available array<string>, path string",
    )
    return df, about


def src_detect(spark: SparkSession, folder: str) -> str:
    """First data file of a folder by name, CSV before Parquet; an error when there is none."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(status.getPath().toString() for status in files)
    found = [n for suffix in (".csv", ".parquet") for n in names if n.lower().endswith(suffix)]
    if not found:
        raise FileNotFoundError(f"No CSV or Parquet files found in {folder}")
    return found[0]


def src_concat_cols(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Features and targets side by side, matched on the row key."""
    return features.join(targets, key)


def scan_predictions(export: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Whether an export fits the expected labels: ``rows, expected_rows, mismatches, accepted``."""
    require_columns(export, [key, *PREDICTION_COLUMNS], "prediction export")
    left = export.select(key, F.col("y_true").alias("exported"), F.lit(True).alias("in_export"))
    right = expected.select(key, F.col("y_true").alias("wanted"), F.lit(True).alias("in_expected"))
    both = left.join(right, key, "full_outer")
    return both.agg(
        F.count("in_export").alias("rows"),
        F.count("in_expected").alias("expected_rows"),
        F.count_if(
            F.col("in_export").isNull()
            | F.col("in_expected").isNull()
            | ~F.col("exported").eqNullSafe(F.col("wanted"))
        ).alias("mismatches"),
    ).withColumn("accepted", (F.col("mismatches") == 0) & (F.col("rows") > 0))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(spark.read.parquet(path), PREDICTION_COLUMNS, "prediction export")
