"""Choosing thresholds, candidates and experiments from tables of measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .confusion import FALSE_ALARM_COST, MISS_COST

# Rule names, with the precision floor and the order of each rule.
RULE_A = "maximize_recall_precision_050"
RULE_B = "maximize_f2"
RULE_C = "maximize_recall_precision_045"
RULE_D = "maximize_f1"
RULE_E = f"lowest_expected_cost_{MISS_COST}_{FALSE_ALARM_COST}"
RULES = {
    RULE_A: (0.50, ["-recall", "-f2", "-precision"]),
    RULE_B: (None, ["-f2", "-recall", "-precision"]),
    RULE_C: (0.45, ["-recall", "-f2", "-precision"]),
    RULE_D: (None, ["-f1", "-f2", "-recall"]),
    RULE_E: (None, ["expected_cost", "-recall", "-f2"]),
}


def _ordering(names: list[str]) -> list[Column]:
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in names]


def _best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def select_rule(grid: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """The grid row a rule picks for every candidate; ties go to the lowest threshold."""
    if rule not in RULES:
        raise ValueError(f"Unsupported threshold selection rule: {rule}")
    floor, order = RULES[rule]
    eligible = grid if floor is None else grid.where(F.col("precision") >= F.lit(floor))
    picked = _best(eligible, keys, [*_ordering(order), F.asc("threshold")])
    return picked.withColumn("selection_rule", F.lit(rule))


def selection_summary(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Every candidate under every rule, also where the rule picks nothing (``available`` false).

    All rules are ranked in one pass over the grid, each on its own copy of the rows.
    """
    rules = F.array(*[F.lit(rule) for rule in RULES])
    tagged = grid.withColumn("selection_rule", F.explode(rules))
    rule = F.col("selection_rule")
    fits = F.lit(True)
    first, second, third = F.lit(None), F.lit(None), F.lit(None)
    for name, (floor, order) in RULES.items():
        if floor is not None:
            fits = fits & ((rule != name) | (F.col("precision") >= F.lit(floor)))
        signed = [
            -F.col(o[1:]).cast("double") if o.startswith("-") else F.col(o).cast("double")
            for o in order
        ]
        first = F.when(rule == name, signed[0]).otherwise(first)
        second = F.when(rule == name, signed[1]).otherwise(second)
        third = F.when(rule == name, signed[2]).otherwise(third)
    ranked = tagged.withColumn("available", fits)
    order = [F.desc("available"), first.asc(), second.asc(), third.asc(), F.asc("threshold")]
    picked = _best(ranked, [*keys, "selection_rule"], order)
    values = [c for c in grid.columns if c not in keys]
    return picked.select(
        *keys,
        "selection_rule",
        "available",
        *[F.when(F.col("available"), F.col(name)).alias(name) for name in values],
    )


def select_preferred(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Rule A's row, or rule B's with ``fallback_used`` where A picks nothing."""
    first = select_rule(grid, RULE_A, keys).withColumn("fallback_used", F.lit(False))
    other = select_rule(grid, RULE_B, keys).withColumn("fallback_used", F.lit(True))
    return _best(first.unionByName(other), keys, [F.asc("fallback_used")])


def choose_policy(
    candidates: DataFrame, keys: list[str] | None = None, include_resampled: bool = False
) -> DataFrame:
    """The best candidate: among those chosen by rule A by recall, else among all by f2.

    ``candidates`` has ``position`` (input order, the last tie-break), ``fallback_used``,
    ``resampled``, ``precision``, ``recall``, ``f2`` and ``validation_pr_auc``.
    """
    pool = candidates if include_resampled else candidates.where(~F.col("resampled"))
    preferred = ~F.col("fallback_used") & (F.col("precision") >= F.lit(0.50))
    lead = F.when(preferred, F.col("recall")).otherwise(F.col("f2"))
    follow = F.when(preferred, F.col("f2")).otherwise(F.col("recall"))
    order = [preferred.desc(), lead.desc(), follow.desc(), F.desc("validation_pr_auc"),
             F.asc("position")]
    return _best(pool, keys or [], order) if keys else pool.orderBy(*order).limit(1)


def choose_experiment(experiments: DataFrame) -> DataFrame:
    """Name of the experiment with the highest validation average precision."""
    return experiments.agg(
        F.max_by("model_name", "validation_pr_auc").alias("source_experiment"),
        F.max("validation_pr_auc").alias("validation_pr_auc"),
    )


def policy_record(
    chosen: DataFrame, policy_name: str, measures: list[str], test_measures: list[str]
) -> DataFrame:
    """Record of the chosen policy: where it comes from, its rule, and its measures as structs."""
    return chosen.select(
        F.lit(policy_name).alias("policy_name"),
        F.col("model_name").alias("source_experiment"),
        F.col("threshold").alias("selected_threshold"),
        "selection_rule",
        "fallback_used",
        F.lit("validation").alias("selection_split"),
        F.lit("untouched_test").alias("evaluation_split"),
        F.struct(*measures).alias("validation_metrics"),
        F.struct(*[F.col(f"test_{name}").alias(name) for name in test_measures]).alias(
            "test_metrics"
        ),
    )


RECORD_KEYS = [
    "policy_name",
    "source_experiment",
    "selected_threshold",
    "selection_rule",
    "selection_split",
    "evaluation_split",
    "test_metrics",
]


def valid_records(records: DataFrame) -> DataFrame:
    """Records that hold every required entry and a threshold between 0 and 1."""
    if not set(RECORD_KEYS) <= set(records.columns):
        return records.limit(0)
    return records.where(F.col("selected_threshold").between(0.0, 1.0))


def model_ranking(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("roc_auc"), F.desc("accuracy"))


def topk(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def policy_summary(
    grid: DataFrame, preferred: DataFrame, baseline: str, best_weighted: str, resampled: str | None
) -> DataFrame:
    """Rows to compare: the baseline at 0.50 and tuned, the best weighted and the best resampled.

    ``grid`` and ``preferred`` hold the test measures per candidate (``model_name``).
    """
    at_half = grid.where(
        (F.col("model_name") == baseline) & (F.round("threshold", 2) == F.lit(0.50))
    )
    names = [c for c in grid.columns if c in preferred.columns]

    def rows(df: DataFrame, note: str) -> DataFrame:
        return df.select(*names, F.lit(note).alias("note"))

    parts = [
        rows(at_half, "baseline at 0.50"),
        rows(preferred.where(F.col("model_name") == baseline), "baseline, tuned threshold"),
        rows(preferred.where(F.col("model_name") == best_weighted), "best class weight"),
    ]
    if resampled:
        parts.append(rows(preferred.where(F.col("model_name") == resampled), "best resampled"))
    return union_frames(parts)


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; columns a table lacks become null."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def comparison_table(recomputed: DataFrame, older: DataFrame) -> DataFrame:
    """Rows recomputed from predictions, then the older table's for models not yet covered."""
    rest = older.join(recomputed.select("model_name").distinct(), "model_name", "left_anti")
    return union_frames([recomputed, rest])
