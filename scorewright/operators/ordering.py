"""Global order without a global sort: running counts, exact quantiles and cut-offs by rank.

A window over a whole table would put it into one task. Here the order values are first cut into
ranges of about equal size, each range is counted, and only the few range totals are summed in
order; the rows then need just a window inside their own range. The cut points are the order
values of the rows with the smallest hashes, that is an even random sample of the distinct
values: a range stays small however unevenly the values are spread, and a re-run after a lost
executor finds the same cut points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import as_col
from ..session import reliable_checkpoint

RANGES = 256
LOOKUP_LIMIT = 10_000


def cut_points(df: DataFrame, keys: list[str], order: str, ranges: int = RANGES) -> Column:
    """Sorted order values that cut the rows of ``df``, as one array (a scalar subquery)."""
    sample = df.orderBy(F.xxhash64(*keys, order), order, *keys).limit(ranges - 1)
    return sample.agg(F.array_sort(F.collect_list(order))).scalar()


def range_number(cuts: str, value: str, ranges: int = RANGES) -> Column:
    """How many cut points are not above the value, by halving steps."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(ranges.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at
        + F.when(F.get(F.col(cuts), at + step - 1) <= F.col(value), step).otherwise(0),
    )


def with_range(df: DataFrame, keys: list[str], order: str, ranges: int = RANGES) -> DataFrame:
    cuts = cut_points(df, keys, order, ranges)
    numbered = df.withColumn("_cuts", cuts)
    return numbered.withColumn("_range", range_number("_cuts", order, ranges)).drop("_cuts")


def running_counts(
    counts: DataFrame, keys: list[str], order: str, measures: list[str], ranges: int = RANGES
) -> DataFrame:
    """For every row, the sum of each measure over the key's lower order values, and its total.

    ``counts`` has one row per key and order value, so ties are already one row. Adds
    ``<measure>_before`` and ``<measure>_total``.
    """
    key = F.struct(*keys) if keys else F.lit(0)
    ranged = with_range(counts, keys, order, ranges).withColumn("_key", key)
    totals = ranged.groupBy("_key", "_range").agg(*[F.sum(m).alias(m) for m in measures])
    lower = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_key")
    offsets = totals.select(
        "_key",
        "_range",
        *[F.coalesce(F.sum(m).over(lower), F.lit(0)).alias(f"{m}_lower") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = (
        Window.partitionBy("_key", "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = {
        f"{m}_before": F.col(f"{m}_lower") + F.coalesce(F.sum(m).over(inside), F.lit(0))
        for m in measures
    }
    return (
        ranged.join(offsets, ["_key", "_range"])
        .withColumns(before)
        .drop("_key", "_range", *[f"{m}_lower" for m in measures])
    )


def key_text(keys: list[str]) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
    return F.concat_ws("\u0001", *parts) if keys else F.lit("")


def small_lookup(df: DataFrame, keys: list[str], value) -> DataFrame:
    """Key text and value, one row per group or class, to be read with ``looked_up``."""
    return df.select(key_text(keys).alias("_key_text"), as_col(value).alias("_value"))


def looked_up(df: DataFrame, name: str, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Add the lookup's value for each row's key as column ``name``.

    Up to ``LOOKUP_LIMIT`` entries, counted before they are gathered, become one map that rows read
    without a shuffle; more of them are joined.
    """
    if keys and lookup.limit(LOOKUP_LIMIT + 1).count() > LOOKUP_LIMIT:
        renamed = lookup.withColumnRenamed("_value", name)
        return df.withColumn("_key_text", key_text(keys)).join(renamed, "_key_text", "left").drop("_key_text")
    entries = F.map_from_entries(F.collect_list(F.struct("_key_text", "_value")))
    with_map = df.withColumn("_lookup", lookup.agg(entries).scalar())
    return with_map.withColumn(name, F.try_element_at("_lookup", key_text(keys))).drop("_lookup")


def by_feature(df: DataFrame, names: list[str], value: str) -> Column:
    """The value of each named feature as one struct (a scalar subquery), for wide rows."""
    fields = ", ".join(f"max(case when feature = '{n}' then {value} end) as `{n}`" for n in names)
    return df.agg(F.expr(f"struct({fields})")).scalar()


def long_values(df: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """One row per table row and named column: keys, ``feature``, ``value`` (double)."""
    cells = ", ".join(f"struct('{n}' as feature, cast(`{n}` as double) as value)" for n in names)
    return df.select(*keys, F.expr(f"inline(array({cells}))"))


def exact_quantiles(
    df: DataFrame, names: list[str], probabilities: list[float], keys: list[str] | None = None
) -> DataFrame:
    """Exact interpolated quantiles of many columns: ``keys, feature, n, quantiles`` (array).

    Equal values are counted once, with map-side combine, and the counts are written; the ranks are
    then found by running counts over ranges of the distinct values. Any number of rows will do:
    a group of one row has that row's value as every quantile, and one without values has no row.

    Runs at once: the counts and the result are checkpointed, so that a plan that uses them does not
    repeat these passes.
    """
    keys = keys or []
    values = long_values(df, names, keys).where(F.col("value").isNotNull())
    counts = values.groupBy(*keys, "feature", "value").agg(F.count("*").alias("n"))
    ranked = running_counts(reliable_checkpoint(counts), [*keys, "feature"], "value", ["n"])

    def at_rank(rank: Column) -> Column:
        hit = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    position = {i: p * (F.col("n_total") - 1) for i, p in enumerate(probabilities)}
    found = ranked.groupBy(*keys, "feature").agg(
        F.first("n_total").alias("n"),
        *[at_rank(F.floor(at)).alias(f"_low{i}") for i, at in position.items()],
        *[at_rank(F.ceil(at)).alias(f"_high{i}") for i, at in position.items()],
    )

    def between(i: int, p: float) -> Column:
        at = p * (F.col("n") - 1)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return low + (high - low) * (at - F.floor(at))

    quantiles = F.array(*[between(i, p) for i, p in enumerate(probabilities)])
    return reliable_checkpoint(found.select(*keys, "feature", "n", quantiles.alias("quantiles")))


def rank_cutoff(
    df: DataFrame, order: str, takes: DataFrame, keys: list[str], ranged: DataFrame | None = None
) -> DataFrame:
    """Per key, the order value of the ``take``-th row in order, as a lookup.

    ``df`` has unique order values per key; ``takes`` has ``keys, take``. Ranges are counted,
    and only rows of the one range where a key's cut-off lies are sorted. Runs at once: the
    cut-offs, a row per key, are checkpointed, so using a split does not find them again.
    """
    rows = ranged if ranged is not None else with_range(df, keys, order)
    counts = rows.groupBy(*keys, "_range").agg(F.count("*").alias("n"))
    lower = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    with_take = looked_up(counts, "take", small_lookup(takes, keys, "take"), keys)
    reached = with_take.withColumn(
        "_left", F.col("take") - F.coalesce(F.sum("n").over(lower), F.lit(0))
    ).where((F.col("_left") > 0) & (F.col("_left") <= F.col("n")))
    goal = small_lookup(reached, keys, F.struct("_range", "_left"))
    in_range = looked_up(rows, "_goal", goal, keys).where(F.col("_goal._range") == F.col("_range"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    last = in_range.withColumn("_place", place).where(F.col("_place") == F.col("_goal._left"))
    return small_lookup(reliable_checkpoint(last.select(*keys, order)), keys, order)


def by_hash_prefix(df: DataFrame, order: str) -> DataFrame:
    """Ranges for an md5 order: its first four digits already spread the rows evenly."""
    return df.withColumn("_range", F.substring(order, 1, 4))
