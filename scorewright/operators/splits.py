"""Reproducible splits, samples and shuffles, decided row by row against a cut-off.

Membership follows the md5 order of a row's key, so it never depends on partitioning or on a
re-run. The cut-off hash of each class is found once from counted ranges; rows are then compared
with it where they are, without a shuffle of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_order, row_signature
from ..schema import TARGET, require_columns
from .ordering import by_hash_prefix, looked_up, rank_cutoff, with_range

TEST_SHARE = 0.20
VALIDATION_SHARE = 0.25


def stratified_sizes(counts: DataFrame, keys: list[str], share: float) -> DataFrame:
    """How many of each class go to the held-out side: ``keys, take``.

    The held-out side has ``ceil(share * n)`` rows in all; the other side gets its exact share of
    every class, rounded down, and the rows still missing go to the largest remainders.
    """
    if not keys:
        return counts.select(F.ceil(F.lit(share) * F.col("n")).alias("take"))
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    kept = total - F.ceil(F.lit(share) * total)
    exact = F.col("kept") * F.col("n") / F.col("total").cast("double")
    parts = (
        counts.withColumns({"total": total, "kept": kept})
        .withColumn("exact", exact)
        .withColumn("whole", F.floor("exact"))
    )
    missing = F.col("kept") - F.sum("whole").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc(F.col("exact") - F.col("whole")), *keys))
    extra = F.when(place <= missing, 1).otherwise(0)
    return parts.select(*keys, (F.col("n") - F.col("whole") - extra).alias("take"))


def _held_out(
    df: DataFrame, units: DataFrame, order: str, share: float, strata: list[str], ranged: DataFrame
) -> DataFrame:
    """Flag ``_held``: the row's order value is within its class's held-out part.

    ``units`` holds one row per thing to be split, with ``strata`` and its ``order`` value.
    """
    counts = units.groupBy(*strata).agg(F.count("*").alias("n"))
    takes = stratified_sizes(counts, strata, share)
    cutoff = rank_cutoff(units, order, takes, strata, ranged)
    with_limit = looked_up(df, "_limit", cutoff, strata)
    held = F.coalesce(F.col(order) <= F.col("_limit"), F.lit(False))
    return with_limit.withColumn("_held", held).drop("_limit")


def split_group_stratified(
    df: DataFrame,
    names: list[str],
    target: str = TARGET,
    share: float = TEST_SHARE,
    seed: int = 42,
    places: int | None = None,
) -> DataFrame:
    """Adds ``split``: train or test, with all copies of a row on one side.

    Rows equal in the named columns and the target are one unit; copies are merged before they
    are shuffled, so a row copied any number of times is still one record per task.
    """
    signed = df.withColumn("_signature", row_signature(df, [*names, target], places))
    signed = signed.withColumn("_order", hash_order("_signature", seed=seed))
    units = signed.groupBy(target, "_order").agg(F.count("*").alias("copies"))
    held = _held_out(signed, units, "_order", share, [target], by_hash_prefix(units, "_order"))
    side = F.when(F.col("_held"), "test").otherwise("train")
    return held.withColumn("split", side).drop("_signature", "_order", "_held")


def _split_rows(df: DataFrame, key: str, share: float, strata: list[str], seed: int) -> DataFrame:
    ordered = df.withColumn("_order", hash_order(key, seed=seed))
    units = ordered.select(*strata, "_order")
    return _held_out(ordered, units, "_order", share, strata, by_hash_prefix(units, "_order"))


def split_simple(
    df: DataFrame, key: str, target: str = TARGET, share: float = TEST_SHARE, seed: int = 42
) -> DataFrame:
    """Adds ``split``: a row split, stratified by the target (one class needs no strata)."""
    held = _split_rows(df, key, share, [target], seed)
    side = F.when(F.col("_held"), "test").otherwise("train")
    return held.withColumn("split", side).drop("_order", "_held")


def split_validation(
    df: DataFrame, key: str, target: str = TARGET, share: float = VALIDATION_SHARE, seed: int = 42
) -> DataFrame:
    """Turns a quarter of the train rows into validation rows, stratified by the target."""
    train = df.where("split = 'train'")
    units = train.select(target, hash_order(key, seed=seed).alias("_order"))
    ordered = df.withColumn("_order", hash_order(key, seed=seed))
    held = _held_out(ordered, units, "_order", share, [target], by_hash_prefix(units, "_order"))
    moved = F.when(F.col("_held") & (F.col("split") == "train"), "validation")
    return held.withColumn("split", moved.otherwise(F.col("split"))).drop("_order", "_held")


def split_temporal(df: DataFrame, date: str, key: str, share: float = TEST_SHARE) -> DataFrame:
    """Adds ``split``: the first ``max(1, int(n * (1 - share)))`` rows by date, then key, train.

    Rows without a date are dropped. A table whose test side would be empty raises.
    """
    require_columns(df, [date], "temporal split table")
    dated = df.where(F.col(date).isNotNull()).withColumn("_order", F.struct(date, key))
    units = dated.select("_order")
    n = F.count("*")
    size = F.greatest(F.lit(1), F.floor(n * F.lit(1.0 - share)))
    empty = F.raise_error(F.lit("temporal split has an empty test side")).cast("bigint")
    takes = units.agg(F.when(size < n, size).otherwise(empty).alias("take"))
    cutoff = rank_cutoff(units, "_order", takes, [], with_range(units, [], "_order"))
    last = looked_up(dated, "_limit", cutoff, [])
    within = F.col("_order") <= F.col("_limit")
    side = F.when(within, "train").otherwise("test")
    return last.withColumn("split", side).drop("_order", "_limit")


def target_shuffle(df: DataFrame, key: str, target: str = TARGET, seed: int = 42) -> DataFrame:
    """The table with a randomly permuted 0/1 target.

    A permutation of a 0/1 column is settled by which rows hold the ones: the rows with the
    lowest hashes, as many as there are ones.
    """
    ordered = df.withColumn("_order", hash_order(key, seed=seed))
    units = ordered.select("_order")
    ones = df.agg(F.coalesce(F.sum(target), F.lit(0)).alias("take"))
    cutoff = rank_cutoff(units, "_order", ones, [], by_hash_prefix(units, "_order"))
    with_limit = looked_up(ordered, "_limit", cutoff, [])
    within = F.col("_order") <= F.col("_limit")
    shuffled = F.coalesce(within, F.lit(False)).cast("int")
    return with_limit.withColumn(target, shuffled).drop("_order", "_limit")


def distinct_group(df: DataFrame, names: list[str], key: str, places: int | None = None):
    """First row, by key, of every group of equal rows, and the group's size."""
    signed = df.withColumn("signature", row_signature(df, names, places))
    return signed.groupBy("signature").agg(
        F.min(F.struct(key, *names)).alias("first"), F.count("*").alias("copies")
    ).select("signature", "first.*", "copies")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, those with the lowest hashes; tasks pass on only their own lowest."""
    ordered = df.withColumn("_order", hash_order(key, seed=seed))
    return ordered.orderBy("_order", key).limit(n).drop("_order")


def stratified_sample(
    df: DataFrame, group: str, max_rows: int, key: str, seed: int = 42
) -> DataFrame:
    """Per group ``min(size, max_rows // 2)`` rows by hash.

    The rank filter is applied inside each map task before the shuffle, so a large group
    never meets in one task.
    """
    place = F.row_number().over(
        Window.partitionBy(group).orderBy(hash_order(key, seed=seed), F.col(key))
    )
    return df.withColumn("_place", place).where(F.col("_place") <= max(1, max_rows // 2)).drop(
        "_place"
    )


def overlap_check(
    df: DataFrame,
    key: str,
    features: list[str],
    target: str = TARGET,
    ids: list[str] | None = None,
    places: int | None = None,
) -> DataFrame:
    """How many distinct keys, rows, feature rows and ids are on both sides of ``split``.

    All kinds are counted in one pass; equal values are merged in the map tasks first.
    """
    kinds = {
        "source_index": F.col(key).cast("string"),
        "selected_rows": row_signature(df, [*features, target], places),
        "feature_signatures": row_signature(df, features, places),
        **{f"id_{name}": F.col(name).cast("string") for name in ids or []},
    }
    entries = F.array(
        *[F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in kinds.items()]
    )
    seen = (
        df.select("split", F.inline(entries))
        .groupBy("kind", "value")
        .agg(
            F.bool_or(F.col("split") == "train").alias("in_train"),
            F.bool_or(F.col("split") == "test").alias("in_test"),
        )
    )
    return seen.groupBy("kind").agg(
        F.count_if("in_train").alias("train_values"),
        F.count_if("in_test").alias("test_values"),
        F.count_if(F.col("in_train") & F.col("in_test")).alias("overlap"),
    )


def intersect_signatures(left: DataFrame, right: DataFrame, names: list[str], places=None):
    """Distinct row signatures present in both tables."""

    def signatures(df: DataFrame) -> DataFrame:
        return df.select(row_signature(df, names, places).alias("signature"))

    return signatures(left).intersect(signatures(right))


def semi_by_split(df: DataFrame, members: DataFrame, keys: list[str], inside: bool) -> DataFrame:
    """Rows whose key is (or is not) in the member list."""
    return df.join(members, keys, "left_semi" if inside else "left_anti")


def sample_size_row(df: DataFrame, features: list[str], name: str) -> DataFrame:
    """Train and test row counts and the number of features of one experiment."""
    return df.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    ).select(
        F.lit(name).alias("model_name"),
        "train_rows",
        "test_rows",
        F.lit(len(features)).alias("feature_count"),
    )


def class_counts(df: DataFrame, target: str = TARGET) -> list[Column]:
    return [
        F.count_if(F.col(target) == 0).alias("negatives"),
        F.count_if(F.col(target) == 1).alias("positives"),
    ]
