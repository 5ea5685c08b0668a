"""Where queries and their SQL twins are collected."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All doubles rounded, so that engines that sum in another order still agree."""
    return df.select(
        *[F.round(n, places).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for a table that a query writes and reads back."""
    return f"{shared_folder(spark)}/scorewright/{name}-{uuid.uuid4().hex}"
