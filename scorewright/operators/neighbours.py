"""Exact nearest neighbours between two tables of vectors.

The rows of both sides are dealt into a few parts, and every pair of parts is one task, so a row travels
only as often as the other side has parts, whatever the vectors are like. A task orders both parts by
halving them along their widest axis, cuts them into tiles, and takes pairs of tiles from the nearest on. A
pair whose boxes are further apart than all neighbours found so far is left out (for clustered vectors that
is most of them). In the others one product of matrices of single precision gives all distances within a
known error; only pairs within that error of a row's best are measured exactly. The same product serves
both directions. A task returns only the best of each row, never its pairs.

Finding the parts runs two counts; the search itself is lazy. Work grows with rows times rows, memory and
disk with the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import group_label, sex_code, sex_group
from ..functions.scalar import hash_order
from ..session import reliable_checkpoint
from .ordering import by_hash_prefix, looked_up, rank_cutoff

#: Rows of a tile.
BLOCK = 1024
#: Pairs of rows that a task compares, until a side has ``PARTS`` parts; bytes of vectors and payload of a part.
PAIRS, PARTS, PART_BYTES = 1 << 28, 4, 64 << 20
#: Pairs measured at once.
_MEASURED = 1 << 16


def _squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of equal rows, summed feature by feature so that equal rows are exactly 0 apart."""
    total = np.zeros(len(left))
    for feature in range(left.shape[1]):
        gap = left[:, feature] - right[:, feature]
        total += gap * gap
    return total


def _halved(x: np.ndarray, block: int) -> tuple[np.ndarray, list[slice]]:
    """An order of the rows, and its tiles of up to ``block`` rows: halves along the axis of widest range."""
    order, tiles, open_ = np.arange(len(x)), [], [(0, len(x))]
    while open_:
        low, high = open_.pop()
        if high - low <= block:
            tiles.append(slice(low, high))
            continue
        own = order[low:high]
        axis = int(np.argmax(np.ptp(x[own], axis=0)))
        middle = (high - low) // 2
        order[low:high] = own[np.argpartition(x[own, axis], middle)]
        open_ += [(low, low + middle), (low + middle, high)]
    return order, tiles


class _Side:
    """Rows of a part in tiles, with the best neighbours found so far."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, block: int, k: int):
        self.order, self.tiles = _halved(x, block)
        self.x, self.ids = x[self.order], ids[self.order]
        self.low = np.array([self.x[t].min(axis=0) for t in self.tiles])
        self.high = np.array([self.x[t].max(axis=0) for t in self.tiles])
        self.distance = np.full((len(x), k), np.inf)  # squared
        self.at = np.full((len(x), k), -1)
        self.worst = np.full(len(self.tiles), np.inf)  # the largest distance of a tile's last neighbours

    def take(self, tile: int, near: np.ndarray, margin: float, unit: float, other: _Side, there: slice) -> None:
        """Offer the rows of a tile those of the other side's tile: [row, other row] approximate distances in ``unit``."""
        here, k = self.tiles[tile], self.distance.shape[1]
        known = self.distance[here, -1] * unit
        least = near.min(axis=1)
        asked = np.flatnonzero(least <= known + margin)  # not for nan
        if not len(asked):
            return
        rows = near[asked]
        if k > 1:
            least = np.partition(rows, k - 1, axis=1)[:, k - 1] if rows.shape[1] >= k else np.full(len(rows), np.inf)
        else:
            least = least[asked]
        i, j = np.nonzero(rows <= (np.minimum(known[asked], least + margin) + margin)[:, None])
        at, to = asked[i] + here.start, j + there.start
        real = np.isfinite(rows[i, j])
        at, to = at[real], to[real]
        exact = np.empty(len(at))
        for n in range(0, len(at), _MEASURED):
            some = slice(n, n + _MEASURED)
            exact[some] = _squared(self.x[at[some]], other.x[to[some]])
        changed = np.unique(at)
        old = self.at[changed].ravel()
        filled = old >= 0
        at = np.concatenate([at, np.repeat(changed, k)[filled]])
        to = np.concatenate([to, old[filled]])
        exact = np.concatenate([exact, self.distance[changed].ravel()[filled]])
        best = np.lexsort((other.ids[to], exact, at))
        at, to, exact = at[best], to[best], exact[best]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, int)
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        kept = place < k
        self.distance[at[kept], place[kept]], self.at[at[kept], place[kept]] = exact[kept], to[kept]
        self.worst[tile] = self.distance[here, -1].max()


def _search(left: _Side, right: _Side, both: bool, exclude_self: bool) -> None:
    """Find the best of every left row, and with ``both`` of every right row too."""
    width = left.x.shape[1]
    middle = left.x.mean(axis=0)
    sides = [side.x - middle for side in (left, right)]
    longest = max(float(np.sqrt((x * x).sum(axis=1)).max()) for x in sides) or 1.0
    a, b = (x / longest for x in sides)
    a2, b2 = ((x * x).sum(axis=1) for x in (a, b))
    rows = np.column_stack([-2 * a, np.ones(len(a)), a2]).astype(np.float32)
    columns = np.ascontiguousarray(np.column_stack([b, b2, np.ones(len(b))]).astype(np.float32).T)
    far = [np.sqrt([v[t].max() for t in side.tiles]) for side, v in ((left, a2), (right, b2))]
    apart = np.zeros((len(left.tiles), len(right.tiles)))
    for f in range(width):
        gap = np.maximum(0, np.maximum(left.low[:, None, f] - right.high[None, :, f], right.low[None, :, f] - left.high[:, None, f]))
        apart += gap * gap
    apart *= 1 - 1e-12  # rounding never makes a pair of tiles too far
    unit = 1 / longest**2
    for at in np.argsort(apart, axis=None, kind="stable"):
        i, j = divmod(int(at), len(right.tiles))
        asked = (apart[i, j] <= left.worst[i], both and apart[i, j] <= right.worst[j])
        if not any(asked):
            continue
        here, there = left.tiles[i], right.tiles[j]
        near = rows[here] @ columns[:, there]
        # a product of n terms of single precision is off by less than n units of rounding of the terms' sum
        margin = (width + 8) * 2.0**-23 * (far[0][i] + far[1][j]) ** 2 + 1e-30
        if exclude_self:
            own = np.argsort(left.ids[here], kind="stable")
            sorted_ids = left.ids[here][own]
            first, last = (np.searchsorted(sorted_ids, right.ids[there], side) for side in ("left", "right"))
            for c in np.flatnonzero(first < last):
                near[own[first[c] : last[c]], c] = np.inf
        if asked[0]:
            left.take(i, near, margin, unit, right, there)
        if asked[1]:
            right.take(j, near.T, margin, unit, left, here)


def _matches(
    left: DataFrame, right: DataFrame, payload: list[str], k: int, exclude_self: bool, block: int, both: bool
) -> DataFrame:
    """``side`` (0: a left row's neighbours, 1: a right row's), and the columns of ``nearest``."""
    sizes = [max(1, df.count()) for df in (left, right)]
    width = len((left.select("vector").where(F.col("vector").isNotNull()).first() or {"vector": []})["vector"])
    parts = min(PARTS, math.ceil(math.sqrt(sizes[0] * sizes[1] / PAIRS)))
    parts = [min(n, max(parts, math.ceil(8 * n * (width + len(payload) + 1) / PART_BYTES))) for n in sizes]

    def dealt(df: DataFrame, own: int, copies: int, name: Column, prefix: str) -> DataFrame:
        """Every row in one part of its side, once for each part of the other; with own names, as both may be one table."""
        part = F.pmod(F.xxhash64("id", "vector"), F.lit(own)).cast("int")
        spread = df.where(F.col("vector").isNotNull()).select(
            F.col("id").alias(f"{prefix}id"), F.col("vector").alias(f"{prefix}vector"),
            *[F.col(p).cast("double").alias(f"{prefix}{p}") for p in payload], part.alias("_own"),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_other"),
        )
        return spread.withColumn("cell", name).drop("_own", "_other").repartition(4 * parts[0] * parts[1], "cell")

    a = dealt(left, parts[0], parts[1], F.col("_own") * parts[1] + F.col("_other"), "")
    b = dealt(right, parts[1], parts[0], F.col("_other") * parts[1] + F.col("_own"), "to_")
    names = ["side", "id", "neighbour_id", "distance", *payload, *[f"neighbour_{p}" for p in payload]]

    def table_of(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """The rows whose vectors are finite, these, and their ids; a missing id comes last."""
        vectors = rows["vector"].combine_chunks()
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows.num_rows, -1) if rows.num_rows else np.empty((0, 0))
        finite = np.isfinite(x).all(axis=1)
        if not finite.all():
            rows, x = rows.filter(pa.array(finite)), x[finite]
        return rows, x, rows["id"].fill_null(np.iinfo(np.int64).max).to_numpy()

    def best_of_parts(rows: pa.Table, others: pa.Table) -> pa.Table:
        tables, found = [], []
        others = others.rename_columns([n.removeprefix("to_") for n in others.column_names])
        if rows.num_rows and others.num_rows:
            tables = [table_of(rows), table_of(others)]
        if tables and all(t.num_rows for t, _, _ in tables):
            sides = [_Side(x, ids, block, k) for _, x, ids in tables]
            _search(*sides, both, exclude_self)
            for n in range(1 + both):
                own, other = sides[n], sides[1 - n]
                at, place = np.nonzero(own.at >= 0)
                mine, theirs = (t[0].take(pa.array(side.order[p])) for t, side, p in ((tables[n], own, at), (tables[1 - n], other, own.at[at, place])))
                columns = [np.full(len(at), n, np.int32), mine["id"], theirs["id"], np.sqrt(own.distance[at, place])]
                found.append(pa.table([*columns, *[mine[p] for p in payload], *[theirs[p] for p in payload]], names))
        empty = pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * (1 + 2 * len(payload)))], names)
        return pa.concat_tables([t.cast(empty.schema) for t in found]) if found else empty

    doubles = ", ".join(f"`{n}` double" for n in names[3:])
    found = a.groupBy("cell").cogroup(b.groupBy("cell")).applyInArrow(best_of_parts, f"side int, id bigint, neighbour_id bigint, {doubles}")
    place = F.row_number().over(Window.partitionBy("side", "id").orderBy("distance", "neighbour_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def nearest(
    sources: DataFrame,
    targets: DataFrame,
    payload: list[str],
    k: int = 1,
    exclude_self: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest targets of every source: ``id, neighbour_id, distance, rank``.

    Both tables have ``id``, ``vector`` (array of numbers without nulls, compared as doubles) and the ``payload``
    columns, which come back as ``<name>`` and ``neighbour_<name>``. Equal distances go to the
    lower id. Rows whose vector is missing or not finite have no neighbours and are none.
    """
    return _matches(sources, targets, payload, k, exclude_self, block, False).drop("side")


def nearest_both(left: DataFrame, right: DataFrame, payload: list[str], block: int = BLOCK) -> DataFrame:
    """The nearest right row of every left row (``side`` 0) and the nearest left row of every right row (1), in one search."""
    return _matches(left, right, payload, 1, False, block, True)


def join_nearest(
    df: DataFrame, features: list[str], group: str, codes: tuple[int, int], payload: list[str]
) -> DataFrame:
    """For every row of either group the nearest row of the other group, on complete features.

    The vectors are checkpointed first, as the search passes over them several times.
    """
    vectors = reliable_checkpoint(
        df.select(
            "id",
            group,
            F.array(*[F.col(n).cast("double") for n in features]).alias("vector"),
            *[F.col(p).cast("double").alias(p) for p in payload],
        )
    )
    found = nearest_both(*[vectors.where(F.col(group) == code) for code in codes], payload)
    own, other = (F.when(F.col("side") == 0, a).otherwise(b) for a, b in (codes, codes[::-1]))
    return found.withColumns({"group_code": own, "other_code": other}).drop("side", "rank")


def cross_group_table(matches: DataFrame, score: str = "y_proba", truth: str = "y_true"):
    """Neighbour rows with group labels and the difference of the two scores."""

    def side(prefix: str, code: str) -> list[Column]:
        value = F.col(code)
        return [
            sex_code(value).alias(f"{prefix}sex_code"),
            sex_group(value).alias(f"{prefix}sex_group"),
            group_label(value).alias(f"{prefix}group"),
        ]

    return matches.select(
        F.col("id").alias("applicant_id"),
        *side("", "group_code"),
        F.col("neighbour_id").alias("nearest_other_group_id"),
        *side("nearest_other_", "other_code"),
        F.col("distance").alias("feature_distance"),
        F.col(score).alias("original_probability"),
        F.col(f"neighbour_{score}").alias("neighbour_probability"),
        F.abs(F.col(score) - F.col(f"neighbour_{score}")).alias("probability_difference"),
        F.col(truth).cast("int").alias("original_actual_default"),
        F.col(f"neighbour_{truth}").cast("int").alias("neighbour_actual_default"),
    )


def oversample_minority(
    df: DataFrame, features: list[str], target: str, key: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """New minority rows between a row and one of its nearest minority rows, until classes match.

    ``df`` is a train table with complete, scaled features and 0/1 target, 1 the rarer one. Every
    minority row makes the same number of new rows, and the first ones in hash order one more.
    """
    minority = df.where(F.col(target) == 1).select(
        F.col(key).alias("id"),
        F.array(*[F.col(n).cast("double") for n in features]).alias("vector"),
        *[F.col(n).cast("double").alias(n) for n in features],
    )
    minority = reliable_checkpoint(minority)
    near = nearest(minority, minority, features, k=k, exclude_self=True)
    sizes = df.agg(
        F.count_if(F.col(target) == 0).alias("zeros"), F.count_if(F.col(target) == 1).alias("ones")
    ).select(
        F.greatest(F.lit(0), F.col("zeros") - F.col("ones")).alias("missing"),
        F.greatest("ones", F.lit(1)).alias("ones"),
        F.least(F.lit(k), F.greatest(F.col("ones") - 1, F.lit(1))).alias("choices"),
    )
    units = minority.select(hash_order("id", seed=seed).alias("_order"))
    rest = sizes.select((F.col("missing") % F.col("ones")).alias("take"))
    cutoff = rank_cutoff(units, "_order", rest, [], by_hash_prefix(units, "_order"))
    planned = looked_up(near.withColumn("_n", sizes.select(F.struct("*")).scalar()), "_cut", cutoff, [])
    one_more = F.coalesce(hash_order("id", seed=seed) <= F.col("_cut"), F.lit(False))
    copies = F.floor(F.col("_n.missing") / F.col("_n.ones")) + F.when(one_more, 1).otherwise(0)

    def uniform(copy: Column, salt: str) -> Column:
        """Number in [0, 1) fixed by the row, the copy and a salt."""
        bits = F.pmod(F.xxhash64(F.col("id"), copy, F.lit(f"{salt}{seed}")), F.lit(1 << 40))
        return bits / F.lit(float(1 << 40))

    numbers = F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int")))
    own = F.filter(
        numbers,
        lambda c: F.floor(uniform(c, "pick") * F.col("_n.choices")) + 1 == F.col("rank"),
    )
    made = planned.withColumn("copy", F.explode(own)).withColumn(
        "_part", uniform(F.col("copy"), "part")
    )
    return made.select(
        F.col("id").alias("made_from"),
        "copy",
        *[(F.col(n) + (F.col(f"neighbour_{n}") - F.col(n)) * F.col("_part")).alias(n)
          for n in features],
        F.lit(1).alias(target),
    )
