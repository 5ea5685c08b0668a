"""Table audits: coverage, profile, value counts, defaults, correlation and mutual information."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import COVERAGE_BLOCKS, TARGET
from ..session import reliable_checkpoint
from .ordering import by_feature, exact_quantiles, long_values, running_counts


def coverage_audit(df: DataFrame, blocks: dict[str, list[str]] | None = None) -> DataFrame:
    """Per block: expected and present columns, and the share of its cells that are filled."""
    blocks = blocks or COVERAGE_BLOCKS
    present = set(df.columns)
    expected = [
        (block, position, name)
        for block, names in blocks.items()
        for position, name in enumerate(names)
    ]
    filled = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(name).alias(f"_{i}") for i, (_, _, name) in enumerate(expected) if name in present],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(block).alias("block"),
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(name in present).alias("available"),
                (F.col(f"_{i}") if name in present else F.lit(None).cast("bigint")).alias("filled"),
            )
            for i, (block, position, name) in enumerate(expected)
        ]
    )

    def names_of(wanted: Column) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(wanted, F.struct("position", "column"))))
        return F.array_join(F.transform(pairs, lambda p: p["column"]), ", ")

    here = F.col("available")
    return filled.select("_rows", F.inline(cells)).groupBy("block").agg(
        names_of(F.lit(True)).alias("columns"),
        names_of(here).alias("available_columns"),
        F.count_if(here).alias("available_count"),
        F.count("*").alias("expected_count"),
        F.coalesce(
            F.try_divide(F.sum("filled").cast("double"), F.sum(F.when(here, F.col("_rows")))),
            F.lit(0.0),
        ).alias("fill_rate"),
    )


def profile(df: DataFrame, names: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Missing and distinct values (missing counts as one value) per column.

    Equal cells are merged in the map tasks before the shuffle; ``exact=False`` counts distinct
    values by sketch and shuffles only one record per column and task.
    """
    names = names or df.columns
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"),
                (F.col(n) if t == "string" else F.col(n).cast("string")).alias("value"),
            )
            for n, t in df.select(*names).dtypes
        ]
    )
    tall = df.select(F.inline(cells))
    if not exact:
        return tall.groupBy("column").agg(
            F.count_if(F.col("value").isNull()).alias("missing_values"),
            (F.approx_count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias(
                "unique_values"
            ),
        )
    values = tall.groupBy("column", "value").agg(F.count("*").alias("n"))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return values.groupBy("column").agg(
        missing.alias("missing_values"), F.count("*").alias("unique_values")
    )


def value_counts(df: DataFrame, *names: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count("*").alias("n"))


def column_modes(df: DataFrame, names: list[str]) -> DataFrame:
    """Most frequent value per text column, the smallest of equals; ``Unknown`` when all missing."""
    cells = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("value")) for n in names])
    counts = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value"))))
    return counts.groupBy("column").agg(F.coalesce(best["value"], F.lit("Unknown")).alias("mode"))


def column_medians(df: DataFrame, names: list[str]) -> DataFrame:
    """One row with the median of every numeric column, 0 where all are missing."""
    found = exact_quantiles(df, names, [0.5])
    return found.agg(
        *[
            F.expr(f"coalesce(max(case when feature = '{n}' then quantiles[0] end), 0D) as `{n}`")
            for n in names
        ]
    )


def column_defaults(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """One row with the default of every column: median of numbers, mode of text."""
    row = column_medians(df, numeric)
    if not text:
        return row
    modes = column_modes(df, text)
    chosen = modes.agg(*[F.max(F.when(F.col("column") == n, F.col("mode"))).alias(n) for n in text])
    both = row.withColumn("_text", chosen.select(F.struct("*")).scalar())
    return both.select(*numeric, *[F.col(f"_text.{n}").alias(n) for n in text])


def correlation_text(x: str, y: str) -> str:
    """Pearson correlation over the rows where both are present; null for a constant column."""
    a, b = f"(case when {y} is not null then {x} end)", f"(case when {x} is not null then {y} end)"
    spread = f"sqrt(var_pop({a}) * var_pop({b}))"
    return f"(case when {spread} > 0 then covar_pop({a}, {b}) / {spread} end)"


def feature_target_corr(df: DataFrame, features: list[str], target: str = TARGET) -> DataFrame:
    """Correlation of every feature with the target, one pass over the table."""
    numbers = df.select(
        F.col(target).cast("double").alias("_y"),
        *[F.expr(f"cast(`{n}` as double) as `{n}`") for n in features],
    )
    row = numbers.agg(*[F.expr(f"{correlation_text(f'`{n}`', '_y')} as `{n}`") for n in features])
    return row.unpivot([], features, "feature", "correlation_with_target")


MI_BINS = 10


def _binned_information(counts: DataFrame, keys: list[str], code: str, label: str) -> DataFrame:
    """Mutual information (nats) from joint counts ``keys, code, label, n``."""
    by_code = Window.partitionBy(*keys, code)
    by_label = Window.partitionBy(*keys, label)
    whole = Window.partitionBy(*keys)
    n = F.col("n").cast("double")
    parts = counts.select(
        *keys,
        (
            n / F.sum("n").over(whole)
            * F.log(n * F.sum("n").over(whole) / (F.sum("n").over(by_code) * F.sum("n").over(by_label)))
        ).alias("part"),
    )
    total = F.greatest(F.lit(0.0), F.sum("part"))
    return parts.groupBy(*keys).agg(total.alias("mutual_information"))


def binned_information(
    df: DataFrame,
    features: list[str],
    target: str = TARGET,
    text: list[str] | None = None,
    bins: int = MI_BINS,
) -> DataFrame:
    """Mutual information of every feature with a class column, from bins.

    Numbers (missing ones as the median) are cut at their deciles; text values are classes of
    their own, with ``Missing`` for none. This is the plug-in estimate on bins, which differs
    from a nearest-neighbour estimate.
    """
    levels = [i / bins for i in range(1, bins)]
    found = exact_quantiles(df, features, [*levels, 0.5])
    edges = by_feature(found, features, "quantiles")
    wide = df.select(target, *features).withColumn("_edges", edges)

    def code(name: str) -> str:
        value = f"coalesce(cast(`{name}` as double), get(_edges.`{name}`, {len(levels)}), 0D)"
        cuts = f"slice(_edges.`{name}`, 1, {len(levels)})"
        return f"coalesce(size(filter({cuts}, edge -> edge <= {value})), 0)"

    cells = ", ".join(f"struct('{n}' as feature, string({code(n)}) as code)" for n in features)
    coded = wide.select(target, F.expr(f"inline(array({cells}))"))
    if text:
        cells = F.array(
            *[
                F.struct(
                    F.lit(n).alias("feature"),
                    F.coalesce(F.col(n).cast("string"), F.lit("Missing")).alias("code"),
                )
                for n in text
            ]
        )
        coded = coded.unionByName(df.select(target, F.inline(cells)))
    counts = coded.groupBy("feature", "code", target).agg(F.count("*").alias("n"))
    return _binned_information(counts, ["feature"], "code", target)


#: Neighbours of a row within its class whose distance is the row's radius.
NEIGHBOURS = 3


def digamma(n: Column) -> Column:
    """The digamma function of whole numbers from 1 on, by its series 8 steps further up."""
    z = n.cast("double") + 8
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6)
    return series - sum(1 / (n.cast("double") + i) for i in range(8))


def _radii(counts: DataFrame, target: str, k: int) -> DataFrame:
    """Per ``feature, target, value`` the open interval (``low``, ``high``) up to the k-th neighbour in the class.

    Distinct values of a class are numbered in order; each looks up the ``k`` next to it on both sides by
    number. Where a value has more than k rows the radius is 0 and ``low`` and ``high`` are null. Classes of
    one row have no neighbours and are left out.
    """
    keys = ["feature", target]
    numbered = running_counts(counts.withColumn("one", F.lit(1)), keys, "value", ["one", "n"]).where("n_total > 1")
    numbered = numbered.select(
        *keys, "value", "n", "n_total", F.col("one_before").alias("at"), F.least(F.lit(k), F.col("n_total") - 1).alias("k")
    )
    numbered = reliable_checkpoint(numbered)
    asked = numbered.where("n <= k").withColumn("_step", F.explode(F.array(*[F.lit(s) for s in range(-k, k + 1) if s])))
    asked = asked.withColumn("_at", F.col("at") + F.col("_step"))
    givers = numbered.select(*keys, F.col("at").alias("_at"), F.col("value").alias("_value"), F.col("n").alias("_n"))
    near = asked.join(givers, [*keys, "_at"]).withColumn("_gap", F.abs(F.col("_value") - F.col("value")))
    cells = F.array_sort(F.collect_list(F.struct("_gap", "_value", "_n")))
    found = near.groupBy(*keys, "value").agg(
        F.first("n").alias("n"), F.first("n_total").alias("n_total"), F.first("k").alias("k"), cells.alias("_near")
    )
    # the gap at which the rows counted so far, without the row itself, reach k
    reached = F.expr(
        "aggregate(_near, struct(n - 1 as seen, cast(null as double) as gap),"
        " (s, c) -> struct(s.seen + c._n as seen, if(s.gap is null and s.seen + c._n >= k, c._gap, s.gap) as gap)).gap"
    )
    found = found.withColumn("_gap", reached)
    left = F.expr("get(filter(_near, c -> c._gap = _gap and c._value < value), 0)._value")
    right = F.expr("get(filter(_near, c -> c._gap = _gap and c._value > value), 0)._value")
    open_ = found.select(
        *keys, "value", "n", "n_total", "k",
        F.coalesce(left, F.col("value") - F.col("_gap")).alias("low"),
        F.coalesce(right, F.col("value") + F.col("_gap")).alias("high"),
    )
    shut = numbered.where("n > k").select(
        *keys, "value", "n", "n_total", "k", *[F.lit(None).cast("double").alias(c) for c in ("low", "high")]
    )
    return open_.unionByName(shut)


def mutual_info_target(
    df: DataFrame, features: list[str], target: str = TARGET, text: list[str] | None = None, k: int = NEIGHBOURS
) -> DataFrame:
    """Mutual information of every feature with a class column, by nearest neighbours.

    A row's radius is the distance to its k-th neighbour among the rows of its class; all rows nearer than
    that are counted (with a radius of 0 those of equal value). Missing numbers are the median; equal values
    stay equal, without added noise. Rows of a class with one row, and without a class, count nowhere. Text
    values are classes of their own, with ``Missing`` for none, and give the plug-in estimate.

    Equal rows are counted once. Numbers of rows below a point are running counts over ranges of the distinct
    values and asked points, so no task sees a whole feature.
    """
    middle = by_feature(exact_quantiles(df, features, [0.5]), features, "quantiles[0]")
    wide = df.where(F.col(target).isNotNull()).select(target, *features).withColumn("_middle", middle)
    cells = ", ".join(f"struct('{n}' as feature, coalesce(cast(`{n}` as double), _middle.`{n}`, 0D) as value)" for n in features)
    tall = wide.select(target, F.expr(f"inline(array({cells}))"))
    counts = reliable_checkpoint(tall.groupBy("feature", target, "value").agg(F.count("*").alias("n")))
    rows = reliable_checkpoint(_radii(counts, target, k))
    own = rows.groupBy("feature", "value").agg(F.sum("n").alias("n"))  # of classes with neighbours
    points = rows.select("feature", F.explode(F.array("low", "high")).alias("value")).where("value is not null")
    points = own.unionByName(points.withColumn("n", F.lit(0).cast("long")))
    ranked = running_counts(points.groupBy("feature", "value").agg(F.sum("n").alias("n")), ["feature"], "value", ["n"])
    ranked = reliable_checkpoint(ranked.select("feature", "value", "n", F.col("n_before").alias("below")))
    of = lambda column, *names: ranked.select("feature", F.col("value").alias(column), *names)
    inside = (
        rows.join(of("low", (F.col("below") + F.col("n")).alias("_up_to")), ["feature", "low"], "left")
        .join(of("high", F.col("below").alias("_below")), ["feature", "high"], "left")
        .join(of("value", F.col("n").alias("_equal")), ["feature", "value"])
    )
    m = F.coalesce(F.col("_below") - F.col("_up_to"), F.col("_equal"))
    part = F.col("n") * (digamma(F.col("k")) - digamma(F.col("n_total")) - digamma(m))
    total = inside.groupBy("feature").agg(F.sum("n").alias("n"), F.sum(part).alias("part"))
    score = F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("part") / F.col("n"))
    found = total.select("feature", score.alias("mutual_information"))
    if text:
        cells = F.array(
            *[F.struct(F.lit(n).alias("feature"), F.coalesce(F.col(n).cast("string"), F.lit("Missing")).alias("code")) for n in text]
        )
        coded = df.select(target, F.inline(cells)).groupBy("feature", "code", target).agg(F.count("*").alias("n"))
        found = found.unionByName(_binned_information(coded, ["feature"], "code", target))
    return found


def mi_review_flag(scores: DataFrame, share: float = 0.95) -> DataFrame:
    """Features whose mutual information reaches the given quantile of all features'."""
    cut = scores.agg(F.percentile("mutual_information", share)).scalar()
    flagged = scores.withColumn("review_threshold", cut)
    return flagged.where(F.col("mutual_information") >= F.col("review_threshold"))


def difference_summary(
    df: DataFrame, value: str = "probability_difference", large: float = 0.10
) -> DataFrame:
    """Mean, median, 90th percentile and number above a limit of one column."""
    spread = exact_quantiles(df, [value], [0.5, 0.9]).select("quantiles")
    counts = df.agg(
        F.avg(value).alias("average_probability_difference"),
        F.count_if(F.col(value) > F.lit(large)).alias("large_difference_count"),
    ).withColumn("_q", spread.scalar())
    return counts.select(
        "average_probability_difference",
        F.col("_q")[0].alias("median_probability_difference"),
        F.col("_q")[1].alias("p90_probability_difference"),
        "large_difference_count",
    )


def feature_group_assoc(
    df: DataFrame, features: list[str], group: str = "SEX", bins: int = MI_BINS
) -> DataFrame:
    """How differently every feature is spread in the two groups of a binary attribute.

    The lower code is group a, the next one group b. Means, missing rates and variances come from
    one pass; medians and the bins of mutual information from the exact quantiles.
    """
    ends = df.where(F.col(group).isNotNull()).agg(F.min(group).alias("a"), F.max(group).alias("b"))
    tagged = df.where(F.col(group).isNotNull()).withColumn("_ends", ends.select(F.struct("*")).scalar())
    tagged = tagged.withColumn("in_b", (F.col(group) == F.col("_ends.b")).cast("int"))
    tall = long_values(tagged, features, [group, "in_b"])
    sides = {"a": F.col("in_b") == 0, "b": F.col("in_b") == 1}

    def of(side: str, column: str = "value") -> Column:
        return F.when(sides[side], F.col(column))

    rows = tall.groupBy("feature").agg(
        *[F.min(of(s, group)).alias(f"group_{s}_sex_code") for s in sides],
        *[F.avg(of(s)).alias(f"group_{s}_mean") for s in sides],
        *[F.var_samp(of(s)).alias(f"_var_{s}") for s in sides],
        *[
            F.try_divide(
                F.count_if(sides[s] & F.col("value").isNull()).cast("double"), F.count_if(sides[s])
            ).alias(f"group_{s}_missing_rate")
            for s in sides
        ],
        F.expr(f"coalesce({correlation_text('value', 'in_b')}, 0D)").alias(
            "correlation_with_sex_binary"
        ),
    )
    by_side = _side_medians(tagged, features)
    information = binned_information(tagged, features, "in_b", bins=bins)
    pooled = F.sqrt((F.coalesce("_var_a", F.lit(0.0)) + F.coalesce("_var_b", F.lit(0.0))) / 2)
    gap = F.col("group_b_mean") - F.col("group_a_mean")
    smd = F.when(pooled > 0, gap / pooled).otherwise(0.0)
    return (
        rows.join(by_side, "feature", "left")
        .join(information, "feature", "left")
        .withColumn("standardized_mean_difference", smd)
        .withColumn("absolute_standardized_mean_difference", F.abs("standardized_mean_difference"))
        .withColumnRenamed("mutual_information", "mutual_information_with_sex")
        .drop("_var_a", "_var_b")
    )


def _side_medians(tagged: DataFrame, features: list[str]) -> DataFrame:
    medians = exact_quantiles(tagged, features, [0.5], ["in_b"])
    middle = F.col("quantiles")[0]
    return medians.groupBy("feature").agg(
        F.max(F.when(F.col("in_b") == 0, middle)).alias("group_a_median"),
        F.max(F.when(F.col("in_b") == 1, middle)).alias("group_b_median"),
    )


def impute_scale(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Features with missing values set to the median, then centred and divided by their spread.

    The spread is the population standard deviation; a constant feature is only centred.
    """
    medians = column_medians(df, features).select(F.struct("*")).scalar()
    held = df.select(*keep, *features).withColumn("_medians", medians)
    whole = held.select(
        *keep,
        *[F.expr(f"coalesce(cast(`{n}` as double), _medians.`{n}`) as `{n}`") for n in features],
    )
    stats = whole.agg(
        *[
            F.expr(f"struct(avg(`{n}`) as mean, nullif(stddev_pop(`{n}`), 0D) as spread) as `{n}`")
            for n in features
        ]
    )
    scaled = whole.withColumn("_stats", stats.select(F.struct("*")).scalar())
    return scaled.select(
        *keep,
        *[
            F.expr(f"(`{n}` - _stats.`{n}`.mean) / coalesce(_stats.`{n}`.spread, 1D) as `{n}`")
            for n in features
        ],
    )


def median_relation(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """Whether each value of a row is above or below its column's median (equal is below)."""
    medians = column_medians(df, features).select(F.struct("*")).scalar()
    wide = df.select(key, *features).withColumn("_medians", medians)
    cells = ", ".join(
        f"struct('{n}' as feature, cast(`{n}` as double) as value, _medians.`{n}` as median)"
        for n in features
    )
    relation = F.when(F.col("value") > F.col("median"), "above").otherwise("below")
    return wide.select(key, F.expr(f"inline(array({cells}))")).withColumn("relation", relation)
