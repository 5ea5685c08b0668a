"""Gradient-boosted trees of second order on binned features, many models in one pass.

Features are cut at exact shares of their rows into at most 255 bins, missing values in a bin of their own, and the rows
are written once as blocks of bin numbers. A tree grows level by level: each task adds up gradients and
hessians by (model, node, feature, bin), the sums are added by (model, node), and where they meet the best
split of that node is found; only the splits, a few numbers a node, come to the driver. All models share the
blocks and the pass, so eight class weights cost one set of jobs.

Sums are whole numbers (gradients in fixed steps), so no order of tasks changes them: a task that is run
again after a lost executor gives the same trees. The margins of finished trees are added to the blocks after
every few trees, and the blocks are then checkpointed, so a lineage never grows with the trees.

Where all blocks fit one task (``ONE_TASK`` bytes), a model is fitted by a task of its own instead, without a job
a level. It adds the same whole numbers, of the drawn features and of the lighter child of a split alone (the other is
what is left of the parent), so the trees are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TARGET
from ..session import reliable_checkpoint, shared_folder
from .ordering import long_values, running_counts

# Learner settings.
TREES, DEPTH, RATE, SHARE = 150, 4, 0.05, 0.9
PENALTY, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6
#: Share by which gains may differ and still count as equal.
TIE = 1e-7
SEED = 42
#: Bins of present values, at most; the number after them is that of missing values.
BINS = 255
MISSING = 255
#: Rows of a block, which one task holds as arrays.
BLOCK_ROWS = 65_536
#: Trees after which margins are added to the blocks.
REFRESH = 10
#: Bytes of blocks, margins and sums that one task may hold to fit a model by itself.
ONE_TASK = 256 << 20


@dataclass
class Tree:
    """Nodes in level order (children of node k: 2k + 1 and 2k + 2); a leaf has feature -1."""

    feature: np.ndarray
    bin: np.ndarray  # goes left below this bin
    cut: np.ndarray  # goes left below this value
    missing_left: np.ndarray
    value: np.ndarray  # of leaves, with the rate
    gain: np.ndarray
    cover: np.ndarray  # sum of hessians

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << depth + 1) - 1
        zeros = lambda kind: np.zeros(n, kind)
        return cls(np.full(n, -1, np.int32), zeros(np.int32), zeros(float), zeros(bool), zeros(float), zeros(float), zeros(float))

    def leaves_of_bins(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node each row of bin numbers has reached after so many levels."""
        node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(levels):
            feature = self.feature[node]
            code = codes[rows, np.maximum(feature, 0)]
            left = np.where(code == MISSING, self.missing_left[node], code < self.bin[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)
        return node

    def leaves_of_columns(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The same for bin numbers by feature, [feature, row]: each node's rows read one feature."""
        node, rows = np.zeros(codes.shape[1], np.int64), {0: np.arange(codes.shape[1])}
        for k in range((1 << levels) - 1):
            if self.feature[k] >= 0 and k in rows:
                own = rows.pop(k)
                code = codes[self.feature[k]][own]
                left = np.where(code == MISSING, self.missing_left[k], code < self.bin[k])
                rows[2 * k + 1], rows[2 * k + 2] = own[left], own[~left]
                node[rows[2 * k + 1]], node[rows[2 * k + 2]] = 2 * k + 1, 2 * k + 2
        return node

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of values; NaN is missing."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            feature = self.feature[node]
            if (feature < 0).all():
                return node
            value = x[rows, np.maximum(feature, 0)]
            left = np.where(np.isnan(value), self.missing_left[node], value < self.cut[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)


@dataclass
class Encoding:
    """Features as numbers: numeric columns as they are, one 0/1 number for each level of a text column."""

    features: list[str]
    inputs: list[tuple[str, str | None]] = field(default_factory=list)

    @classmethod
    def of(cls, df: DataFrame, features: list[str]) -> Encoding:
        types, inputs = dict(df.dtypes), []
        for name in features:
            if types[name] == "string":
                levels = df.where(F.col(name).isNotNull()).select(name).distinct().orderBy(name)
                inputs += [(name, row[0]) for row in levels.collect()]
            else:
                inputs.append((name, None))
        return cls(features, inputs)

    def values(self) -> list[Column]:
        """Doubles; null and NaN are missing. An unknown level is 0 for each level."""

        def number(name: str, level: str | None) -> Column:
            return F.col(name).cast("double") if level is None else (F.col(name) == level).cast("double")

        return [number(name, level).alias(f"x{k}") for k, (name, level) in enumerate(self.inputs)]


class Boosted:
    """A fitted model that adds ``probability`` (of class 1) to a table of features."""

    def __init__(self, encoding: Encoding, base: float, trees: list[Tree]):
        self.encoding, self.base, self.trees = encoding, base, trees
        self.features = encoding.features

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.value[tree.leaves(x)]
        return total

    def margin(self) -> Column:
        @F.pandas_udf("double")
        def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
                yield pd.Series(self.margins(x))

        return score(*self.encoding.values())

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", 1 / (1 + F.exp(-self.margin())))

    def predictions(self, df: DataFrame, key: str, name: str, target: str = TARGET) -> DataFrame:
        """The scored contract: key, ``y_true, y_proba, model_name, split``."""
        return self(df).select(
            key, F.col(target).cast("int").alias("y_true"), F.col("probability").alias("y_proba"),
            F.lit(name).alias("model_name"), "split",
        )

    def importances(self) -> dict[str, float]:
        """Mean gain of a feature's splits, as shares of their sum."""
        total, times = {n: 0.0 for n in self.features}, {n: 0 for n in self.features}
        for tree in self.trees:
            for k in np.flatnonzero(tree.feature >= 0):
                name = self.encoding.inputs[tree.feature[k]][0]
                total[name] += tree.gain[k]
                times[name] += 1
        mean = {n: total[n] / times[n] if times[n] else 0.0 for n in total}
        whole = sum(mean.values())
        return {n: m / whole if whole else 0.0 for n, m in mean.items()}


def many_predictions(models: dict[str, Boosted], df: DataFrame, key: str, target: str = TARGET) -> DataFrame:
    """The scored contract of several models with the same features: every row is read once."""
    names, all_models = list(models), list(models.values())

    @F.pandas_udf("array<double>")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
            yield pd.Series(list(1 / (1 + np.exp(-np.column_stack([m.margins(x) for m in all_models])))))

    scored = df.select(key, F.col(target).cast("int").alias("y_true"), "split", score(*all_models[0].encoding.values()).alias("_p"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_at") + 1)
    return scored.select("*", F.posexplode("_p").alias("_at", "y_proba")).select(
        key, "y_true", "y_proba", name.alias("model_name"), "split"
    )


@dataclass(frozen=True)
class Spec:
    """One model of a pass: class 1 counts ``positive_weight`` times, ``weight`` is a column or None."""

    positive_weight: float = 1.0
    weight: str | None = None
    seed: int = SEED


def _cuts(df: DataFrame, encoding: Encoding) -> list[np.ndarray]:
    """Ascending cut points of each input: where the exact share of lower values passes the next 255th.

    Up to 255 rows keep all their distinct values apart. Equal values are counted once, and ranks are
    running counts over ranges of the distinct values, so no task sees a whole column.
    """
    table = df.select(*encoding.values())
    names = table.columns
    values = long_values(table, names, []).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = reliable_checkpoint(values.groupBy("feature", "value").agg(F.count("*").alias("n")))
    ranked = running_counts(counts, ["feature"], "value", ["n"])
    share = F.floor(F.lit(BINS) * F.col("n_before") / F.col("n_total"))
    found = ranked.groupBy("feature", share.alias("share")).agg(F.min("value").alias("cut"))
    cuts: dict[str, list[float]] = {}
    for row in found.where("share > 0").collect():
        cuts.setdefault(row["feature"], []).append(row["cut"])
    return [np.sort(np.array(cuts.get(n, []), float)) for n in names]


def _blocks(df: DataFrame, encoding: Encoding, cuts: list[np.ndarray], specs: list[Spec], target: str):
    """An RDD of (block number, bin numbers, classes, weights by model), read from a written table."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(cuts)
    width = len(cuts)

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, width), np.uint8)
            for k, own in enumerate(shared.value):
                x = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
                codes[:, k] = np.where(np.isnan(x), MISSING, np.searchsorted(own, x, "right"))
            ends = pa.py_buffer((np.arange(batch.num_rows + 1) * width).astype(np.int32))
            packed = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([packed, *(batch.column(k) for k in range(width, batch.num_columns))], ["codes", "y", "w"])

    weights = [F.when(F.col(target) == 1, float(s.positive_weight)).otherwise(1.0) * (F.col(s.weight).cast("double") if s.weight else F.lit(1.0)) for s in specs]
    path = f"{shared_folder(spark)}/scorewright/binned-{spark.sparkContext.applicationId}-{id(cuts)}-{np.random.randint(1 << 62)}"
    rows = df.where(F.col(target).isNotNull()).select(*encoding.values(), (F.col(target) == 1).cast("int").alias("y"), F.array(*weights).alias("w"))
    rows.mapInArrow(bin_rows, "codes binary, y int, w array<double>").write.parquet(path)
    written = spark.read.schema("codes binary, y int, w array<double>").parquet(path)
    models = len(specs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield whole(held)
                held, size = [], 0
        if held:
            yield whole(held)

    def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        codes = b"".join(table["codes"].to_pylist())
        y = table["y"].to_numpy().astype(np.uint8).tobytes()
        w = np.concatenate(table["w"].to_pylist()).astype(float).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (codes, y, w)], ["codes", "y", "w"])

    def unpacked(part: int, packed) -> Iterator[tuple]:
        for k, r in enumerate(packed):
            codes = np.frombuffer(r["codes"], np.uint8).reshape(-1, width)
            yield (part << 20) + k, codes, np.frombuffer(r["y"], np.uint8).astype(float), np.frombuffer(r["w"], float).reshape(-1, models)

    return written.mapInArrow(pack, "codes binary, y binary, w binary").rdd.mapPartitionsWithIndex(unpacked)


def _node_sums(codes: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """[node, feature, bin, (g, h)] in whole numbers; rows at node -1 are left out."""
    width, bins = codes.shape[1], MISSING + 1
    kept = node >= 0
    codes, node, g, h = codes[kept], node[kept] * bins, g[kept], h[kept]
    sums = np.empty((nodes, width, bins, 2), np.int64)
    for k in range(width):
        at = node + codes[:, k]
        for side, values in enumerate((g, h)):
            sums[:, k, :, side] = np.bincount(at, values, nodes * bins).reshape(nodes, bins)  # whole numbers below 2^53: exact
    return sums


def best_split(sums: np.ndarray, allowed: np.ndarray, steps: float) -> tuple | None:
    """The split of one node with the highest gain: (gain, feature, bin, missing_left, sums of the left side).

    ``sums`` are [feature, bin, (g, h)] in whole steps. Of equal gains (but for rounding) missing values to
    the right, then the first feature, then the lowest bin count."""
    values = sums.astype(float) / steps
    whole = values[0].sum(axis=0)
    present = np.cumsum(values[:, :MISSING], axis=1)  # what lies below bin 1, 2, ...; below the last, all
    missing = values[:, MISSING][:, None]

    def score(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (x[..., 1] + PENALTY)

    sides = []
    for missing_left in (False, True):
        left = present + missing if missing_left else present
        right = whole - left
        gain = score(left) + score(right) - score(whole)
        fits = (left[..., 1] >= LEAST_HESSIAN) & (right[..., 1] >= LEAST_HESSIAN) & allowed[:, None]
        sides.append((missing_left, left, np.where(fits, gain, -np.inf)))
    most = max(float(gain.max()) for *_, gain in sides)
    if not most > LEAST_GAIN:
        return None
    for missing_left, left, gain in sides:
        near = gain >= most * (1 - TIE)
        if near.any():
            f, b = divmod(int(np.argmax(near)), gain.shape[1])
            return float(gain[f, b]), f, b + 1, missing_left, *(float(x) for x in left[f, b])


def _gradients(y: np.ndarray, w: np.ndarray, margin: np.ndarray, steps: float) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return np.rint(w * (p - y) * steps), np.rint(w * np.maximum(p * (1 - p), 1e-16) * steps)


def _drawn(seed: int, tree: int, block: int, rows: int, share: float) -> np.ndarray:
    """Rows of a block that a tree sees; the same ones whenever a task is run."""
    return np.random.Generator(np.random.Philox(key=[seed, tree], counter=[0, 0, 0, block])).random(rows) < share


def _leaf_values(tree: Tree, totals: np.ndarray) -> None:
    """Cover and leaf values from the (g, h) of every node."""
    tree.cover[:] = totals[:, 1]
    leaf = tree.feature < 0
    tree.value[leaf] = -RATE * totals[leaf, 0] / (totals[leaf, 1] + PENALTY)


def _take(tree: Tree, totals: np.ndarray, node: int, best: tuple, cuts: list[np.ndarray]) -> None:
    """Write a split found by ``best_split`` and the sums of its sides."""
    gain, f, b, missing_left, left_g, left_h = best
    tree.feature[node], tree.bin[node], tree.cut[node] = f, b, cuts[f][b - 1] if b - 1 < len(cuts[f]) else np.inf
    tree.missing_left[node], tree.gain[node] = missing_left, gain
    totals[2 * node + 1] = left_g, left_h
    totals[2 * node + 2] = totals[node] - totals[2 * node + 1]


def _allowed(spec: Spec, number: int, width: int, share: float) -> np.ndarray:
    """The features that a tree may split."""
    chosen = np.zeros(width, bool)
    chosen[np.random.default_rng([spec.seed, number]).permutation(width)[: max(1, round(width * share))]] = True
    return chosen


def _grow_alone(
    blocks: Iterator[tuple], m: int, spec: Spec, base: float, cuts: list[np.ndarray], steps: float, trees: int, depth: int, share: float
) -> list[Tree]:
    """All trees of one model from all blocks, as the passes of ``boost_many`` make them."""
    held = [(number, np.ascontiguousarray(codes.T), y, w[:, m].copy(), np.full(len(y), base)) for number, codes, y, w in blocks]
    width, bins, done = len(cuts), MISSING + 1, []

    def sums(tree_rows: list[tuple], at: list[np.ndarray], features: np.ndarray) -> np.ndarray:
        """[feature, bin, (g, h)] of the given rows of every block, in whole numbers."""
        total = np.zeros((len(features), bins, 2), np.int64)
        for (codes, g, h), rows in zip(tree_rows, at):
            own_g, own_h = g[rows], h[rows]
            for k, f in enumerate(features):
                code = codes[f][rows].astype(np.intp)
                total[k, :, 0] += np.bincount(code, own_g, bins).astype(np.int64)  # below 2^53: exact
                total[k, :, 1] += np.bincount(code, own_h, bins).astype(np.int64)
        return total

    for number in range(trees):
        tree, totals = Tree.empty(depth), np.zeros(((1 << depth + 1) - 1, 2))
        features = np.flatnonzero(_allowed(spec, number, width, share))
        drawn = [(codes, *_gradients(y, w, margin, steps)) for _, codes, y, w, margin in held]
        at = {0: [np.flatnonzero(_drawn(spec.seed, number, block, len(y), share)) for block, _, y, _, _ in held]}
        found = {0: sums(drawn, at[0], features)}
        for level in range(depth):
            first = (1 << level) - 1
            for node in [n for n in range(first, 2 * first + 1) if n in found]:
                own, rows = found.pop(node), at.pop(node)
                if not own[0, :, 1].any():
                    continue
                totals[node] = own[0].sum(axis=0) / steps
                best = best_split(own, np.ones(len(features), bool), steps)
                if best is None:
                    continue
                _take(tree, totals, node, (best[0], int(features[best[1]]), *best[2:]), cuts)
                if level + 1 == depth:
                    continue
                f, left, right = tree.feature[node], 2 * node + 1, 2 * node + 2
                goes = [np.where((c := codes[f][r]) == MISSING, tree.missing_left[node], c < tree.bin[node]) for (codes, _, _), r in zip(drawn, rows)]
                at[left], at[right] = [r[g] for r, g in zip(rows, goes)], [r[~g] for r, g in zip(rows, goes)]
                less, more = (left, right) if sum(map(len, at[left])) <= sum(map(len, at[right])) else (right, left)
                found[less] = sums(drawn, at[less], features)
                found[more] = own - found[less]
        _leaf_values(tree, totals)
        done.append(tree)
        for _, codes, _, _, margin in held:
            margin += tree.value[tree.leaves_of_columns(codes, depth)]
    return done


def boost_many(
    df: DataFrame, features: list[str], specs: dict[str, Spec], target: str = TARGET, trees: int = TREES,
    depth: int = DEPTH, share: float = SHARE,
) -> dict[str, Boosted]:
    """Fit several models on the same rows and features, all in the same passes.

    Each level of a tree adds, for every row, the first and second derivative of the logistic loss to its
    node's sums; a leaf is -G / (H + 1) times the rate. Every tree sees ``share`` of the rows and of the
    features, drawn by its number. Missing values go to the side with the higher gain. Rows without a
    target are left out; a table without rows, or of one class, gives models without splits.
    """
    names, all_specs = list(specs), list(specs.values())
    encoding = Encoding.of(df, features)
    cuts = _cuts(df, encoding)
    blocks = _blocks(df, encoding, cuts, all_specs, target).persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))

    def sizes(block: tuple) -> tuple[np.ndarray, np.ndarray, int]:
        _, _, y, w = block
        return w.sum(axis=0), (w * y[:, None]).sum(axis=0), len(y)

    weight, ones, rows = blocks.map(sizes).fold((0.0, 0.0, 0), lambda a, b: tuple(x + z for x, z in zip(a, b)))
    if not rows:
        blocks.unpersist()
        return {n: Boosted(encoding, 0.0, []) for n in names}
    mean = np.clip(ones / weight, 1e-6, 1 - 1e-6)
    base = np.log(mean / (1 - mean))
    # whole steps of the sums: below 2^53 in a block, below 2^62 in all
    steps = 2.0 ** min(30, 61 - math.ceil(math.log2(max(2.0, float(weight.max())))))
    models = len(names)
    width = len(encoding.inputs)
    if rows * (width + 8 * models + 64) <= ONE_TASK:

        def alone(m: int):
            return lambda part: iter([(m, _grow_alone(part, m, all_specs[m], float(base[m]), cuts, steps, trees, depth, share))])

        grown = dict(context.union([blocks.coalesce(1).mapPartitions(alone(m)) for m in range(models)]).collect())
        blocks.unpersist()
        return {n: Boosted(encoding, float(base[m]), grown[m]) for m, n in enumerate(names)}
    blocks.unpersist()
    done: list[list[Tree]] = [[] for _ in names]
    state = blocks.map(lambda b: (*b, np.tile(base, (len(b[2]), 1)))).persist(StorageLevel.MEMORY_AND_DISK)
    fresh: list[list[Tree]] = [[] for _ in names]  # trees whose margins the blocks do not have yet
    parts = state.getNumPartitions()

    def with_margins(block: tuple, recent: list[list[Tree]]) -> tuple:
        number, codes, y, w, margin = block
        margin = margin.copy()
        for m, own in enumerate(recent):
            for tree in own:
                margin[:, m] += tree.value[tree.leaves_of_bins(codes, depth)]
        return number, codes, y, w, margin

    for number in range(trees):
        growing = [Tree.empty(depth) for _ in names]
        allowed = [_allowed(spec, number, width, share) for spec in all_specs]
        totals = np.zeros((models, (1 << depth + 1) - 1, 2))
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            recent = [list(x) for x in fresh]

            def sums(part: Iterator[tuple], growing=growing, recent=recent, first=first, nodes=nodes, level=level, number=number) -> Iterator[tuple]:
                """The sums of one task's blocks, by (model, node)."""
                total: dict[tuple[int, int], np.ndarray] = {}
                for block in part:
                    block_number, codes, y, w, margin = with_margins(block, recent)
                    for m, spec in enumerate(all_specs):
                        tree = growing[m]
                        if level and tree.feature[0] < 0:
                            continue
                        node = tree.leaves_of_bins(codes, level) - first
                        node[~_drawn(spec.seed, number, block_number, len(codes), share)] = -1  # not drawn, or in a leaf above
                        node[node < 0] = -1
                        found = _node_sums(codes, node, nodes, *_gradients(y, w[:, m], margin[:, m], steps))
                        for k in range(nodes):
                            if found[k, 0, :, 1].any():
                                key = (m, first + k)
                                total[key] = total[key] + found[k] if key in total else found[k]
                yield from total.items()

            def split(pair: tuple, allowed=allowed) -> tuple:
                (m, node), found = pair
                return m, node, found[0].sum(axis=0) / steps, best_split(found, allowed[m], steps)

            partial = state.mapPartitions(sums)
            if parts > 1:  # else the one task's sums are whole
                partial = partial.reduceByKey(np.add, min(parts, models * nodes))
            found = partial.map(split).collect()
            for m, node, whole, best in found:
                totals[m, node] = whole
                if best is not None:
                    _take(growing[m], totals[m], node, best, cuts)
            if not any(b is not None for *_, b in found):
                break
        for m, tree in enumerate(growing):
            _leaf_values(tree, totals[m])
            done[m].append(tree)
            fresh[m].append(tree)
        if len(fresh[0]) == REFRESH and number + 1 < trees:
            added = [list(x) for x in fresh]
            old, state = state, state.map(lambda b, added=added: with_margins(b, added)).persist(StorageLevel.MEMORY_AND_DISK)
            state.checkpoint()
            state.count()
            old.unpersist()
            fresh = [[] for _ in names]
    state.unpersist()
    return {n: Boosted(encoding, float(base[m]), done[m]) for m, n in enumerate(names)}
