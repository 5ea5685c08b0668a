"""Why a score is what it is: attributions, drivers, reason texts, surrogates, counterfactuals.

Drivers of one applicant are an array in the applicant's own row, so ranking them and turning
them into text needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import display_name, lookup, raw_feature, risk_band
from ..functions.scalar import as_col
from ..schema import BILL_RATIOS, BILLS, DELAY_FEATURES, PAY_STATUS, PAYMENTS, SENSITIVE
from ..session import reliable_checkpoint
from .audit import column_medians
from .boosting import Boosted, Tree
from .ordering import exact_quantiles
from .scenario import Scorecard
from .splits import sample_n

TOP_DRIVERS, SHOWN_DRIVERS, MAX_TEXTS, SURROGATE_TERMS = 5, 3, 3, 12


def linear_drivers(df: DataFrame, card: Scorecard, key: str, keep: list[str] | None = None):
    """Adds ``drivers``: coefficient times distance from the column mean, for every feature.

    For a linear score with independent features this is the exact Shapley value.
    """
    names = list(card.coefficients)
    means = df.agg(*[F.expr(f"avg(cast(`{n}` as double)) as `{n}`") for n in names])
    medians = column_medians(df, names)
    wide = df.select(key, *(keep or []), *names).withColumns(
        {
            "_means": means.select(F.struct("*")).scalar(),
            "_medians": medians.select(F.struct("*")).scalar(),
        }
    )
    drivers = ", ".join(
        f"struct('{n}' as feature, {weight!r}D * (coalesce(cast(`{n}` as double), 0D) - _means.`{n}`)"
        f" as value, case when `{n}` > _medians.`{n}` then 'above' else 'below' end as relation)"
        for n, weight in card.coefficients.items()
    )
    return wide.select(key, *(keep or []), F.expr(f"array({drivers})").alias("drivers"))


def attribution_long(df: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    return df.select(key, *(keep or []), F.inline("drivers"))


def attribution_summary(df: DataFrame) -> DataFrame:
    """Mean absolute and mean attribution per feature."""
    return df.select(F.inline("drivers")).groupBy("feature").agg(
        F.avg(F.abs("value")).alias("mean_abs_attribution"), F.avg("value").alias("mean_attribution")
    )


def _strongest_first(drivers: Column) -> Column:
    """Sorted by absolute value, largest first, then by name."""
    keyed = F.transform(
        drivers,
        lambda d: F.struct(
            (-F.abs(d["value"])).alias("order"),
            d["feature"].alias("feature"),
            d["value"].alias("value"),
            d["relation"].alias("relation"),
        ),
    )
    return F.array_sort(keyed)


def ranked_drivers(df: DataFrame) -> DataFrame:
    """Adds ``positive`` and ``negative``: the five strongest drivers in each direction."""
    ranked = df.withColumn("_ranked", _strongest_first(F.col("drivers")))
    return ranked.withColumns(
        {
            "positive": F.slice(F.filter("_ranked", lambda d: d["value"] > 0), 1, TOP_DRIVERS),
            "negative": F.slice(F.filter("_ranked", lambda d: d["value"] < 0), 1, TOP_DRIVERS),
        }
    ).drop("_ranked")


def topk_drivers(df: DataFrame, key: str, top: int = TOP_DRIVERS) -> DataFrame:
    """The strongest drivers of every row in long form: key, direction, place, feature, value."""
    ranked = ranked_drivers(df)
    rows = [
        ranked.select(
            key,
            F.lit(word).alias("direction"),
            F.posexplode(F.slice(side, 1, top)).alias("place", "d"),
        )
        for side, word in (("positive", "Increasing Risk"), ("negative", "Reducing Risk"))
    ]
    return rows[0].unionByName(rows[1]).select(
        key,
        "direction",
        (F.col("place") + 1).alias("place"),
        F.col("d.feature").alias("feature"),
        display_name("d.feature").alias("display_name"),
        F.col("d.value").alias("value"),
    )


def actionable(drivers) -> Column:
    """Drivers an applicant can act on; all of them if there is no such driver."""
    column = as_col(drivers)
    free = F.filter(column, lambda d: ~raw_feature(d["feature"]).isin(*SENSITIVE))
    return F.when(F.size(free) > 0, free).otherwise(column)


# Which features share a text, and the texts.
DELAY_GROUP = [*PAY_STATUS, *DELAY_FEATURES]
UTILISATION_GROUP = [*BILL_RATIOS, "AvgBillToLimitRatio"]
REPAYMENT_GROUP = ["AvgPaymentToBillRatio", "PaymentToLimitRatio"]
GUIDANCE = [
    (DELAY_GROUP,
     "Maintaining timely repayment over recent months may reduce predicted default risk."),
    ([*UTILISATION_GROUP, "AvgBillAmount"],
     "Lowering revolving utilization or bill balances relative to the credit limit may reduce "
     "predicted risk."),
    ([*REPAYMENT_GROUP, "AvgPaymentAmount", *PAYMENTS],
     "Increasing repayment amounts relative to outstanding bills may reduce predicted risk."),
]
DEFAULT_GUIDANCE = (
    "Reducing recent repayment delays, lowering bill-to-limit utilization, and strengthening "
    "repayment relative to bill amounts may reduce predicted risk."
)


def guidance_texts(positive) -> Column:
    """Up to three different pieces of advice for the risk-increasing drivers, in their order."""
    table = {name: text for names, text in GUIDANCE for name in names}
    texts = F.transform(
        actionable(positive), lambda d: lookup(table, raw_feature(d["feature"]))
    )
    kept = F.slice(F.array_distinct(F.filter(texts, lambda t: t.isNotNull())), 1, MAX_TEXTS)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(DEFAULT_GUIDANCE)))


#: Features, what to say where they raise the score, and where they lower it.
REASONS = [
    (DELAY_GROUP, "repayment delay in the last months raises the score", "bills paid without repayment delay lower the score"),
    (UTILISATION_GROUP, "the bill-to-limit share raises the score", "the bill-to-limit share lowers the score"),
    (REPAYMENT_GROUP, "payments small for the bills raise the score", "payments large for the bills lower the score"),
    ([*BILLS, "AvgBillAmount"], "the size of the bills raises the score", "the size of the bills lowers the score"),
    ([*PAYMENTS, "AvgPaymentAmount"], "the size of the payments raises the score", "the size of the payments lowers the score"),
    (["LIMIT_BAL"], "the credit limit raises the score", "the credit limit lowers the score"),
]
OTHER = (" raises the score", " lowers the score")


def reason_text(driver: Column) -> Column:
    """What one driver does to the score, read from the table of reasons."""
    up = driver["value"] > 0
    more = lookup({n: said for names, said, _ in REASONS for n in names}, raw_feature(driver["feature"]))
    less = lookup({n: said for names, _, said in REASONS for n in names}, raw_feature(driver["feature"]))
    other = F.concat(F.lower(display_name(driver["feature"])), F.when(up, OTHER[0]).otherwise(OTHER[1]))
    return F.coalesce(F.when(up, more).otherwise(less), other)


def interpretation(driver: Column) -> Column:
    """One driver as a line of a report."""
    return F.concat(display_name(driver["feature"]), F.lit(": "), reason_text(driver))


def explanation_text(probability: str = "probability") -> Column:
    """The risk band and up to three different reasons for it (needs ranked drivers)."""
    low = F.col(probability) < 0.30
    chosen = F.when(low, actionable("negative")).otherwise(actionable("positive"))
    reasons = F.array_distinct(F.transform(F.slice(chosen, 1, SHOWN_DRIVERS), reason_text))
    band = F.concat(F.lit("Default next month: "), F.lower(risk_band(probability)))
    listed = F.concat(F.lit(". Main reasons: "), F.array_join(reasons, "; "), F.lit("."))
    return F.concat(band, F.when(F.size(chosen) > 0, listed).otherwise(". No feature stands out."))


def group_attribution(long: DataFrame, groups: list[str]) -> DataFrame:
    """Mean absolute and mean attribution per group and feature, with the groups' difference.

    The difference is that of the second group minus the first, in text order of ``group``.
    """
    rows = long.groupBy(*groups, "feature").agg(
        F.avg(F.abs("value")).alias("mean_abs_attribution"),
        F.avg("value").alias("mean_attribution"),
        F.count("*").alias("n"),
    )
    by_feature = Window.partitionBy("feature").orderBy("group")
    everything = by_feature.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, second = (F.nth_value("mean_abs_attribution", i).over(everything) for i in (1, 2))
    return rows.withColumn("mean_abs_difference", second - first)


class Path:
    """The way to one leaf: per feature on it, the tests it takes and the share of the training rows that go
    the same way wherever the feature is unknown."""

    def __init__(self, tree: Tree, leaf: int):
        steps, node = [], leaf
        while node:
            parent = (node - 1) // 2
            steps.append((parent, node == 2 * parent + 1))
            node = parent
        self.value = float(tree.value[leaf])
        self.tests: dict[int, list[tuple[float, bool, bool]]] = {}
        self.shares: dict[int, float] = {}
        for parent, left in reversed(steps):
            feature = int(tree.feature[parent])
            child = 2 * parent + (1 if left else 2)
            self.tests.setdefault(feature, []).append((float(tree.cut[parent]), bool(tree.missing_left[parent]), left))
            self.shares[feature] = self.shares.get(feature, 1.0) * tree.cover[child] / tree.cover[parent]

    def taken(self, feature: int, x: np.ndarray) -> np.ndarray:
        """1 for rows that go this way at every test of the feature, else 0."""
        value, on = x[:, feature], np.ones(len(x), bool)
        for cut, missing_left, left in self.tests[feature]:
            on &= np.where(np.isnan(value), missing_left, value < cut) == left
        return on.astype(float)


def tree_paths(trees: list[Tree]) -> list[Path]:
    found = []
    for tree in trees:
        waiting = [0]
        while waiting:
            node = waiting.pop()
            if tree.feature[node] < 0:
                found.append(Path(tree, node))
            else:
                waiting += [2 * node + 1, 2 * node + 2]
    return found


def _extended(weights: list[np.ndarray], share: float, taken: np.ndarray) -> list[np.ndarray]:
    """The weights of subsets by size, with one more feature on the path."""
    n = len(weights)
    out = [share * w * (n - k) / (n + 1) for k, w in enumerate(weights)] + [np.zeros_like(taken)]
    for k, w in enumerate(weights):
        out[k + 1] = out[k + 1] + taken * w * (k + 1) / (n + 1)
    return out


def _unwound_sum(weights: list[np.ndarray], share: float, taken: np.ndarray) -> np.ndarray:
    """The sum of the weights as they were without one of the features."""
    last = len(weights) - 1
    total, carried = np.zeros_like(taken), weights[last]
    on = taken > 0
    for k in reversed(range(last)):
        with_it = carried * (last + 1) / (k + 1)
        without = weights[k] * (last + 1) / (share * (last - k))
        own = np.where(on, with_it, without)
        carried = np.where(on, weights[k] - own * share * (last - k) / (last + 1), carried)
        total += own
    return total


def tree_values(paths: list[Path], x: np.ndarray) -> np.ndarray:
    """Shapley values of the margin for every row and input; what an unknown feature does is told by the
    training rows' shares at its splits. A row's values add up to its margin less `expected_margin`."""
    out = np.zeros(x.shape)
    for path in paths:
        taken = {f: path.taken(f, x) for f in path.tests}
        weights = [np.ones(len(x))]
        for f, on in taken.items():
            weights = _extended(weights, path.shares[f], on)
        for f, on in taken.items():
            out[:, f] += _unwound_sum(weights, path.shares[f], on) * (on - path.shares[f]) * path.value
    return out


def expected_margin(model: Boosted) -> float:
    """The margin of a row of which no feature is known."""
    return model.base + sum(p.value * float(np.prod(list(p.shares.values()))) for p in tree_paths(model.trees))


def attribution_tree(df: DataFrame, model: Boosted, key: str, keep: list[str] | None = None) -> DataFrame:
    """Exact tree Shapley values of a boosted model's margin: ``key, keep, feature, value`` for every row.

    Each leaf's path is extended feature by feature and unwound for each of them, for a whole Arrow batch at
    once; nothing is sampled or shuffled. The levels of a text column add up to the column. A row without
    any value has the shares of missing values.
    """
    inputs = model.encoding.inputs
    names = list(dict.fromkeys(name for name, _ in inputs))
    place = np.array([names.index(name) for name, _ in inputs])
    paths = tree_paths(model.trees)
    kept = [key, *(keep or [])]

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f"x{k}").to_numpy(zero_copy_only=False).astype(float) for k in range(len(inputs))])
            values = tree_values(paths, x)
            summed = np.zeros((len(x), len(names)))
            np.add.at(summed.T, place, values.T)
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(names)
            array = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(summed.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), array], [*kept, "_values"])

    table = df.select(*kept, *model.encoding.values())
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("_values", T.ArrayType(T.DoubleType()))])
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("_values").alias("value"))
    made = table.mapInArrow(explain, schema).select(*kept, F.explode(cells).alias("_cell"))
    return made.select(*kept, F.col("_cell.feature").alias("feature"), F.col("_cell.value").alias("value"))


#: Quantiles of a feature between which draws are made, a multiple of the four quartiles.
DRAW_LEVELS = 64


def quantile_table(train: DataFrame, names: list[str], levels: int = DRAW_LEVELS) -> np.ndarray:
    """[feature, level]: exact quantiles of every feature from its least to its largest value, 0 where it has none."""
    found = exact_quantiles(train, names, [k / levels for k in range(levels + 1)]).collect()
    by_name = {r["feature"]: r["quantiles"] for r in found}
    return np.array([by_name.get(n, [0.0] * (levels + 1)) for n in names], float)


def quartile_codes(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """0 to 3 by the quartiles that lie below a value; a value equal to one is still below it."""
    levels = table.shape[1] - 1
    cuts = table[:, [levels // 4, levels // 2, 3 * levels // 4]]
    return (x[..., None] > cuts).sum(axis=-1)


def drawn_rows(row_key: int, x: np.ndarray, table: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """The row itself, then rows whose features are drawn one by one from their train distribution."""
    rng = np.random.Generator(np.random.Philox(key=[seed, row_key & ((1 << 64) - 1)]))
    at = rng.random((samples - 1, len(x))) * (table.shape[1] - 1)
    low = at.astype(int)
    feature = np.arange(len(x))
    values = table[feature, low] + (table[feature, low + 1] - table[feature, low]) * (at - low)
    return np.vstack([x, values])


def surrogate(same: np.ndarray, scores: np.ndarray, terms: int) -> tuple[list[int], np.ndarray]:
    """Features of a weighted ridge fit in the order a forward path takes them, and their slopes.

    ``same`` is 1 where a draw's feature has the quartile of the row (the first one); a draw weighs by how
    many it shares. Each step takes the feature that explains most, the first of equals; all slopes come
    from the last fit."""
    width = same.shape[1]
    gap = np.sqrt((1 - same).sum(axis=1))
    weight = np.exp(-(gap**2) / (0.75 * np.sqrt(width)) ** 2)
    weight /= weight.sum()
    x = same - weight @ same
    y = scores - weight @ scores
    gram, moment = x.T @ (x * weight[:, None]), x.T @ (weight * y)
    penalty = 1.0 / len(scores)
    chosen: list[int] = []

    def fit(some: list[int]) -> tuple[float, np.ndarray]:
        own = gram[np.ix_(some, some)]
        slopes = np.linalg.solve(own + penalty * np.eye(len(some)), moment[some])
        return round(float(2 * slopes @ moment[some] - slopes @ own @ slopes), 12), slopes

    while len(chosen) < min(terms, width):
        tries = [(-fit([*chosen, k])[0], k) for k in range(width) if k not in chosen]
        chosen.append(min(tries)[1])
    return chosen, fit(chosen)[1]


def local_surrogate(
    rows: DataFrame, train: DataFrame, score: Callable[[np.ndarray], np.ndarray], names: list[str], key: str,
    samples: int = 500, terms: int = SURROGATE_TERMS, seed: int = 42,
) -> DataFrame:
    """A weighted linear model on quartile-coded features around every given row: ``key, feature, low, high, weight, place``.

    The draws, their codes, scores and the fit of a row are made within its Arrow batch; nothing is shuffled.
    ``score`` maps a matrix of the features to probabilities. A slope says what it changes that a feature
    lies in the row's quartile, from ``low`` (null for the first) to ``high`` (null for the last). ``train`` gives
    the quartiles and the draws; missing values of a row are the train median. Keys are whole numbers.
    """
    table = quantile_table(train, names)
    middle = table[:, (table.shape[1] - 1) // 2]
    levels = table.shape[1] - 1
    edges = [None, levels // 4, levels // 2, 3 * levels // 4, None]

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            values = np.column_stack([batch.column(f"x{k}").to_numpy(zero_copy_only=False).astype(float) for k in range(len(names))])
            values = np.where(np.isnan(values), middle, values)
            for row_key, x in zip(batch.column(key).to_pylist(), values, strict=True):
                draws = drawn_rows(row_key or 0, x, table, samples, seed)
                codes = quartile_codes(draws, table)
                chosen, slopes = surrogate((codes == codes[0]).astype(float), score(draws), terms)
                for place, (k, slope) in enumerate(zip(chosen, slopes), 1):
                    low, high = (None if e is None else float(table[k, e]) for e in edges[codes[0, k] : codes[0, k] + 2])
                    out.append((row_key, names[k], low, high, float(slope), place))
            kinds = [batch.schema.field(key).type, pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int32()]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [key, "feature", "low", "high", "weight", "place"])

    wide = rows.select(key, *[F.col(n).cast("double").alias(f"x{k}") for k, n in enumerate(names)])
    kind = wide.schema[key].dataType.simpleString()
    return wide.mapInArrow(explain, f"`{key}` {kind}, feature string, low double, high double, weight double, place int")


#: Rows whose versions one task makes; a row has some hundred.
VERSION_ROWS = 8192
#: Java does not compile a method of more bytes; a score's formula is longer. Spark then splits it.
METHOD_BYTES = 8000
#: Sizes of the sets of features that are taken from a donor, before all of them.
TAKEN = (1, 2, 3, 5, 8, 12)


class Donors:
    """Donors of one side: a bounded pool for every profile, and those furthest on their side."""

    def __init__(self, pools: dict[int, np.ndarray], strongest: np.ndarray):
        self.pools, self.strongest = pools, strongest

    def near(self, x: np.ndarray, profile: int, scale: np.ndarray, wanted: int) -> np.ndarray:
        """[row, donor, feature]: for rows of one profile the nearest donors of it, then the strongest of all."""
        ends = np.broadcast_to(self.strongest, (len(x), *self.strongest.shape))
        pool = self.pools.get(profile)
        if pool is None or not len(pool):
            return ends
        gaps = np.nan_to_num(np.abs(pool - x[:, None])) / scale
        order = np.argsort(gaps.sum(axis=2), axis=1, kind="stable")[:, :wanted]
        return np.concatenate([pool[order], ends], axis=1)


def profile_code(names: list[str], cuts: dict[str, list[float]]) -> Column:
    """The quarters that a row's values of a few features lie in, as one number; a missing value is in the first."""
    code = F.lit(0)
    for name in names:
        above = [F.coalesce((F.col(name) > F.lit(float(c))).cast("int"), F.lit(0)) for c in cuts.get(name, [])]
        code = code * 4 + sum(above, F.lit(0))
    return code


def donor_index(
    scored: DataFrame, features: list[str], profile: Column, key: str, threshold: float, pool: int, strongest: int
) -> dict[bool, Donors]:
    """The donors of each side, flagged or not: at most ``pool`` for a profile, by hash, and ``strongest`` more.

    These bounds are all that reaches the driver; the ranks are cut within the map tasks first."""
    own = F.array(*[F.col(f).cast("double") for f in features])
    rows = scored.where(F.col("probability").isNotNull()).select(
        key, own.alias("x"), (F.col("probability") >= threshold).alias("side"), profile.alias("profile"), "probability"
    )
    drawn = F.row_number().over(Window.partitionBy("side", "profile").orderBy(F.xxhash64(key), key))
    outmost = F.when(F.col("side"), -F.col("probability")).otherwise(F.col("probability"))
    far = F.row_number().over(Window.partitionBy("side").orderBy(outmost, F.xxhash64(key), key))
    pools = rows.withColumn("_rank", drawn).where(F.col("_rank") <= pool).orderBy("side", "profile", "_rank").collect()
    ends = rows.withColumn("_rank", far).where(F.col("_rank") <= strongest).orderBy("side", "_rank").collect()
    made = {}
    for side in (False, True):
        by_profile: dict[int, list] = {}
        for r in pools:
            if r["side"] == side:
                by_profile.setdefault(r["profile"], []).append(r["x"])
        last = np.array([r["x"] for r in ends if r["side"] == side], float).reshape(-1, len(features))
        made[side] = Donors({p: np.array(x, float) for p, x in by_profile.items()}, last)
    return made


def partial_copies(x: np.ndarray, donors: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, ...]:
    """Versions of rows with more and more of each donor's values, the widest gaps first.

    From [row, feature] and [row, donor, feature]: row, donor, changed features, distance and the values of each version."""
    width = x.shape[1]
    own = np.broadcast_to(x[:, None], donors.shape)
    new = np.where(np.isnan(donors), own, donors)
    differs = ~((new == own) | (np.isnan(new) & np.isnan(own)))
    gap = np.nan_to_num(np.abs(new - own)) / scale
    order = np.argsort(np.where(differs, -gap, np.inf), axis=2, kind="stable")
    rank = np.argsort(order, axis=2, kind="stable")
    widest = np.take_along_axis(gap, order, 2)
    most = differs.sum(axis=2)
    sums = np.stack([widest[..., :n].sum(axis=2) for n in range(width + 1)], axis=2)
    taken = np.stack([*(np.where(n < most, n, 0) for n in TAKEN), most], axis=2)  # 0: no version
    row, donor, at = np.nonzero(taken)
    changed = taken[row, donor, at]
    values = np.where(rank[row, donor] < changed[:, None], new[row, donor], x[row])
    return row, donor, changed, sums[row, donor, changed], values


def diverse(row: np.ndarray, donor: np.ndarray, changed: np.ndarray, distance: np.ndarray, values: np.ndarray, wanted: int) -> np.ndarray:
    """A few versions of every row, as their places by row and choice: fewest changes first, then those that
    differ in most values from all chosen before. One of each donor, more of one only if needed."""
    order = np.lexsort((donor, distance, changed, row))
    row, donor, values = row[order], donor[order], values[order]
    if not len(row):
        return order
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(row)]))
    by_donor = np.lexsort((donor, of))  # stable: the first of a donor is its best
    leading = np.zeros(len(row), bool)
    leading[by_donor[np.r_[True, (of[by_donor[1:]] != of[by_donor[:-1]]) | (donor[by_donor[1:]] != donor[by_donor[:-1]])]]] = True
    apart, places, chosen = np.ones(len(row), int), np.arange(len(row)), []
    for _ in range(wanted):
        score = np.where(leading, apart, 0)
        score = np.where(np.maximum.reduceat(score, starts)[of] > 0, score, apart)
        best = np.maximum.reduceat(score, starts)
        first = np.minimum.reduceat(np.where(score == best[of], places, len(row)), starts)
        chosen.append(np.where(best > 0, first, -1))
        last = values[first[of]]
        apart = np.minimum(apart if len(chosen) > 1 else values.shape[1], ((values != last) & ~(np.isnan(values) & np.isnan(last))).sum(axis=1))
    picked = np.stack(chosen, axis=1).ravel()
    return order[picked[picked >= 0]]


def counterfactual(
    queries: DataFrame, donors: DataFrame, scorer, features: list[str], spread: dict[str, float],
    key: str, context: list[str], wanted: int = 3, pool: int = 64, near: int = 10, strongest: int = 8,
    profile: list[str] | None = None, threshold: float = 0.50,
) -> DataFrame:
    """For every row, up to ``wanted`` changed versions with the opposite decision: ``key, place, changed_features,
    distance, probability`` and the changed features.

    Donors are rows of the other side, found by an index of their profiles (quarters of a few features, three
    by default): the nearest of the row's profile, and those furthest on their side, which can turn whatever
    else can. A version takes a donor's values for its widest gaps first, as few as turn the decision. Chosen
    are versions that differ most. ``context`` columns never change. The index is bounded; versions are made,
    scored and chosen where the row is; only the rows themselves are dealt to enough tasks. Lowers the session's
    limit of generated methods, which is read when the result is. Rows that no donor can turn, or without a
    score, have no version; missing values of a donor leave the row's own.
    """
    on = profile or features[:3]
    cuts = {r["feature"]: r["quantiles"] for r in exact_quantiles(donors, on, [0.25, 0.5, 0.75]).collect()}
    code = profile_code(on, cuts)
    # scored and written once, so that a score's formula is not repeated in every expression on it
    known = reliable_checkpoint(scorer(donors).select(key, "probability", *dict.fromkeys([*features, *on])))
    index = queries.sparkSession.sparkContext.broadcast(donor_index(known, features, code, key, threshold, pool, strongest))
    scale = np.array([float(spread.get(f) or 1.0) for f in features])
    inner = ["_row", "_was", "donor", "changed_features", "distance"]

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features])
            was, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_was", "_profile"))
            order = np.lexsort((own, was))
            edges = np.flatnonzero(np.r_[True, (was[order][1:] != was[order][:-1]) | (own[order][1:] != own[order][:-1])]) if len(order) else []
            for group in np.split(order, edges[1:]) if len(order) else []:
                side, profile_of = bool(was[group[0]]), int(own[group[0]])
                for k in range(0, len(group), 200):
                    some = group[k : k + 200]
                    row, donor, changed, distance, values = partial_copies(x[some], index.value[not side].near(x[some], profile_of, scale, near), scale)
                    columns = [batch.column(c).take(pa.array(some[row])) for c in (key, *context)]
                    columns += [pa.array(v, t) for v, t in ((number + row, pa.int64()), (np.full(len(row), side), pa.bool_()), (donor, pa.int32()), (changed, pa.int32()), (distance, pa.float64()))]
                    columns += [pa.array(values[:, j], pa.float64(), mask=np.isnan(values[:, j])) for j in range(len(features))]
                    number += len(some)
                    yield pa.RecordBatch.from_arrays(columns, [key, *context, *inner, *features])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # what has turned of the last row, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column("_row")[batch.num_rows - 1].as_py()
            turned = pc.not_equal(pc.greater_equal(batch.column("probability"), threshold), batch.column("_was"))
            found = pa.Table.from_batches([batch.filter(turned)])  # a null is no turn
            found = pa.concat_tables([held, found]) if held is not None else found
            ended = pc.less(found["_row"], last)
            held = found.filter(pc.invert(ended))
            yield from written(found.filter(ended))
        if held is not None:
            yield from written(held)

    def written(found: pa.Table) -> Iterator[pa.RecordBatch]:
        number, donor, changed, distance = (found[c].to_numpy() for c in ("_row", "donor", "changed_features", "distance"))
        values = np.column_stack([found[f].to_numpy().astype(float) for f in features])
        chosen = diverse(number, donor, changed, distance, values, wanted)
        out, number = found.take(pa.array(chosen, pa.int64())), number[chosen]
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.empty(0, int)
        place = np.arange(len(number)) - np.repeat(starts, np.diff(np.r_[starts, len(number)])) + 1
        names = ["changed_features", "distance", "probability", *features]
        yield from pa.table([out[key], pa.array(place, pa.int32()), *[out[c] for c in names]], [key, "place", *names]).to_batches()

    scored = reliable_checkpoint(scorer(queries).select(key, "probability", *dict.fromkeys([*context, *features, *on])))
    base = scored.where(F.col("probability").isNotNull()).select(
        key, *context, *[F.col(f).cast("double").alias(f) for f in features], (F.col("probability") >= threshold).alias("_was"), code.alias("_profile")
    )
    tasks = math.ceil(scored.count() / VERSION_ROWS)
    if tasks > scored.rdd.getNumPartitions():
        base = base.repartition(tasks)
    conf, limit = queries.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    conf.set(limit, min(METHOD_BYTES, int(conf.get(limit))))
    same = [base.schema[c] for c in (key, *context)]
    kinds = [T.LongType(), T.BooleanType(), T.IntegerType(), T.IntegerType(), T.DoubleType(), *[T.DoubleType()] * len(features)]
    schema = T.StructType([*same, *(T.StructField(n, t) for n, t in zip([*inner, *features], kinds))])
    scored = scorer(base.mapInArrow(versions, schema)).select(key, *inner, *features, "probability")
    numbers = ", ".join(f"`{f}` double" for f in features)
    return scored.mapInArrow(choose, f"`{key}` {base.schema[key].dataType.simpleString()}, place int, changed_features int, distance double, probability double, {numbers}")
