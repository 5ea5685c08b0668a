"""Writing result tables, summaries and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def sink_json(df: DataFrame, path: str) -> None:
    """One JSON document per row; structs and arrays stay nested, missing values stay visible."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def sink_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions in folders per model and split, so that readers skip the others."""
    sink_parquet(predictions, path, "model_name", "split")


def nested_summary(**parts: Column) -> Column:
    """Struct of named parts, for a summary document."""
    return F.struct(*[column.alias(name) for name, column in parts.items()])
