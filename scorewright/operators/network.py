"""A small network with batch normalisation and dropout, trained in mini-batches over written blocks.

The rows are scaled and written once, and read as blocks of arrays. A step takes a slice of every block, each
task sends the sum of its gradients, and these are added in a tree; only the sums, as many numbers as the
network has weights, come to the driver, which takes the step (Adam). Batch normalisation uses the slice of
a block, as is usual where batches are spread. Gradients are added in whole steps, and slices and dropout
follow from the epoch and the block's number: a task run again after a lost executor changes nothing.

Tables of up to ``ONE_TASK`` bytes are trained by one task that holds all blocks, in the same steps: thousands
of steps are then no jobs. The numbers are the same either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TARGET
from ..session import shared_folder

# Layers, dropout, Adam and stopping.
LAYERS, DROPOUT, NORMALISED = [64, 32, 16], [0.30, 0.20, 0.0], [True, False, False]
RATE, MOMENTA, EPSILON = 0.001, (0.9, 0.999), 1e-7
BATCH, EPOCHS, PATIENCE = 256, 75, 8
NORM_MOMENTUM, NORM_EPSILON = 0.99, 1e-3
SEED = 42
#: Rows of a block, and steps of an epoch at most: with more rows the batches grow, not their number.
BLOCK_ROWS, STEPS = 65_536, 64
#: Bytes of vectors, train and validation, that one task trains on by itself; larger tables take a job a step.
ONE_TASK = 256 << 20
#: Scores are told apart to this many levels for the area that stops the training.
LEVELS = 1 << 14
_WHOLE = float(1 << 40)

Weights = dict[str, np.ndarray]


def start(width: int, seed: int = SEED) -> Weights:
    """Weights drawn evenly within the limits of their layer's width, everything else at rest."""
    rng, weights, last = np.random.default_rng(seed), {}, width
    for k, n in enumerate([*LAYERS, 1]):
        limit = np.sqrt(6 / (last + n))
        weights[f"w{k}"], weights[f"b{k}"] = rng.uniform(-limit, limit, (last, n)), np.zeros(n)
        if k < len(LAYERS) and NORMALISED[k]:
            weights[f"scale{k}"], weights[f"shift{k}"] = np.ones(n), np.zeros(n)
        last = n
    return weights


def at_rest() -> Weights:
    """Running means and variances of the normalised layers."""
    return {f"{name}{k}": np.full(n, value) for k, n in enumerate(LAYERS) if NORMALISED[k] for name, value in (("mean", 0.0), ("var", 1.0))}


def forward(weights: Weights, running: Weights, x: np.ndarray) -> np.ndarray:
    """Probability of class 1, without dropout and with the running statistics."""
    for k in range(len(LAYERS)):
        x = np.maximum(x @ weights[f"w{k}"] + weights[f"b{k}"], 0)
        if NORMALISED[k]:
            x = (x - running[f"mean{k}"]) / np.sqrt(running[f"var{k}"] + NORM_EPSILON) * weights[f"scale{k}"] + weights[f"shift{k}"]
    last = len(LAYERS)
    return 1 / (1 + np.exp(-np.clip((x @ weights[f"w{last}"] + weights[f"b{last}"]).ravel(), -60, 60)))


def gradients(weights: Weights, x: np.ndarray, y: np.ndarray, w: np.ndarray, rng: np.random.Generator | None) -> tuple[float, Weights, Weights]:
    """Loss (sum over the rows of weight times cross-entropy), its derivatives, and the slice's statistics.

    Dropout is drawn from ``rng``; without one nothing is dropped."""
    kept, seen = [], {}
    for k in range(len(LAYERS)):
        into, z = x, x @ weights[f"w{k}"] + weights[f"b{k}"]
        active = z > 0
        x = z * active
        normal = spread = None
        if NORMALISED[k]:
            mean, var = x.mean(axis=0), x.var(axis=0)
            seen[f"mean{k}"], seen[f"var{k}"] = mean, var
            spread = np.sqrt(var + NORM_EPSILON)
            normal = (x - mean) / spread
            x = normal * weights[f"scale{k}"] + weights[f"shift{k}"]
        mask = None
        if rng is not None and DROPOUT[k]:
            mask = (rng.random(x.shape) >= DROPOUT[k]) / (1 - DROPOUT[k])
            x = x * mask
        kept.append((into, active, normal, spread, mask))
    last = len(LAYERS)
    z = np.clip((x @ weights[f"w{last}"] + weights[f"b{last}"]).ravel(), -60, 60)
    p = 1 / (1 + np.exp(-z))
    loss = float(np.sum(w * (np.logaddexp(0, z) - y * z)))
    back = (w * (p - y))[:, None]
    out = {f"w{last}": x.T @ back, f"b{last}": back.sum(axis=0)}
    back = back @ weights[f"w{last}"].T
    for k in reversed(range(len(LAYERS))):
        into, active, normal, spread, mask = kept[k]
        if mask is not None:
            back = back * mask
        if NORMALISED[k]:
            out[f"scale{k}"], out[f"shift{k}"] = (back * normal).sum(axis=0), back.sum(axis=0)
            own = back * weights[f"scale{k}"]
            back = (own - own.mean(axis=0) - normal * (own * normal).mean(axis=0)) / spread
        back = back * active
        out[f"w{k}"], out[f"b{k}"] = into.T @ back, back.sum(axis=0)
        back = back @ weights[f"w{k}"].T
    return loss, out, seen


def area_of_levels(counts: np.ndarray) -> float:
    """Average precision from (positive, negative) rows by rising score level."""
    tp, fp = np.cumsum(counts[::-1, 0]), np.cumsum(counts[::-1, 1])
    if not tp[-1]:
        return 0.0
    return float(np.sum(counts[::-1, 0] / tp[-1] * tp / np.maximum(tp + fp, 1)))


class Network:
    """A fitted network that adds ``probability`` (of class 1) to a table of features."""

    def __init__(self, prepared: PipelineModel, features: list[str], as_double, weights: Weights, running: Weights, history: list[float]):
        self.prepared, self.features, self.as_double = prepared, features, as_double
        self.weights, self.running, self.history = weights, running, history

    def __call__(self, df: DataFrame) -> DataFrame:
        weights, running = self.weights, self.running

        @F.pandas_udf("double")
        def score(vectors: pd.Series) -> pd.Series:
            return pd.Series(forward(weights, running, np.stack(vectors.tolist()).astype(float)) if len(vectors) else np.empty(0))

        made = self.prepared.transform(self.as_double(df, self.features))
        return made.withColumn("_p", score(vector_to_array("features"))).select(*df.columns, F.col("_p").alias("probability"))

    def predictions(self, df: DataFrame, key: str, name: str, target: str = TARGET) -> DataFrame:
        """The scored contract: key, ``y_true, y_proba, model_name, split``."""
        return self(df).select(
            key, F.col(target).cast("int").alias("y_true"), F.col("probability").alias("y_proba"), F.lit(name).alias("model_name"), "split"
        )


def _blocks(vectors: DataFrame):
    """An RDD of (number, x, y) read from a written table of ``_x`` and ``_y``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def whole() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            x = np.concatenate([c.flatten().to_numpy() for c in table["_x"].chunks])
            y = table["_y"].to_numpy().astype(float)
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["x", "y"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield whole()
                held, size = [], 0
        if held:
            yield whole()

    def unpacked(part: int, rows) -> Iterator[tuple]:
        for k, r in enumerate(rows):
            y = np.frombuffer(r["y"], float)
            yield (part << 20) + k, np.frombuffer(r["x"], float).reshape(len(y), -1), y

    path = f"{shared_folder(vectors.sparkSession)}/scorewright/vectors-{uuid.uuid4().hex}"
    vectors.write.parquet(path)
    read = vectors.sparkSession.read.schema("_x array<double>, _y double").parquet(path)
    return read.mapInArrow(pack, "x binary, y binary").rdd.mapPartitionsWithIndex(unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def _total(blocks: Iterable[tuple], each: Callable) -> tuple | None:
    """The sum of each(block), None without blocks."""
    total = None
    for block in blocks:
        own = each(block)
        total = own if total is None else tuple(a + b for a, b in zip(total, own))
    return total


def _summed(rdd, each, zero):
    """The sum of each(block) over all blocks: within tasks, then in a tree where there are several."""

    def within(part: Iterator[tuple]) -> Iterator[tuple]:
        total = _total(part, each)
        if total is not None:
            yield total

    add = lambda a, b: tuple(x + y for x, y in zip(a, b))
    partial = rdd.mapPartitions(within)
    if rdd.getNumPartitions() == 1:
        return next(iter(partial.collect()), zero)
    return partial.treeAggregate(None, lambda a, b: b if a is None else add(a, b), lambda a, b: b if a is None else a if b is None else add(a, b)) or zero


def fit_network(train: DataFrame, validation: DataFrame, balanced: bool, epochs: int = EPOCHS, batch: int = BATCH, seed: int = SEED) -> tuple[Weights, Weights, list[float]]:
    """Weights, running statistics and the validation areas of each epoch, for tables of ``_x`` (array) and ``_y`` (0 or 1).

    With ``balanced`` the classes weigh the same in all. Stops when the validation average precision has not
    risen for some epochs, and returns the weights of the best one. Without train rows the weights of the
    start, without validation rows those of the last epoch.
    """
    own, held = _blocks(train), _blocks(validation)

    def sizes(block: tuple) -> tuple:
        return len(block[2]), float(block[2].sum()), block[1].nbytes

    rows, ones, size = _summed(own, sizes, (0, 0.0, 0))
    held_size = _summed(held, sizes, (0, 0.0, 0))[2]
    width = _summed(own, lambda b: (b[1].shape[1] * (b[0] == 0),), (0,))[0] or len((validation.first() or {"_x": [0]})["_x"])
    of_class = np.ones(2)
    if balanced and 0 < ones < rows:
        of_class = np.array([rows / (2 * (rows - ones)), rows / (2 * ones)])
    plan = (rows, width, of_class, epochs, batch, seed)
    if size + held_size <= ONE_TASK:

        def alone(part: Iterator[tuple]) -> Iterator[tuple]:
            sides: tuple[list, list] = ([], [])
            for side, *block in part:
                sides[side].append(block)
            yield _train(*(lambda each, zero, blocks=blocks: _total(blocks, each) or zero for blocks in sides), *plan)

        both = own.map(lambda b: (0, *b)).union(held.map(lambda b: (1, *b)))
        found = both.coalesce(1).mapPartitions(alone).collect()
        fitted = found[0] if found else (start(width, seed), at_rest(), [])
    else:
        fitted = _train(lambda each, zero: _summed(own, each, zero), lambda each, zero: _summed(held, each, zero), *plan)
    own.unpersist()
    held.unpersist()
    return fitted


def _train(
    sum_own: Callable, sum_held: Callable, rows: int, width: int, of_class: np.ndarray, epochs: int, batch: int, seed: int
) -> tuple[Weights, Weights, list[float]]:
    """The training itself; the two functions add up what a function makes of each train or validation block."""
    weights, running = start(width, seed), at_rest()
    names = list(weights)
    steps = max(1, min(STEPS, -(-rows // batch)))
    moments: tuple[Weights, Weights] = tuple({n: np.zeros_like(weights[n]) for n in names} for _ in range(2))
    best, history, taken = (-1.0, weights, running), [], 0
    for epoch in range(epochs if rows else 0):
        slices: dict[int, list[np.ndarray]] = {}  # of the blocks, in this epoch
        for step in range(steps):

            def partial(block: tuple, weights=weights, epoch=epoch, step=step, slices=slices) -> tuple:
                number, x, y = block
                if number not in slices:
                    order = np.random.Generator(np.random.Philox(key=[seed, epoch], counter=[0, 0, 0, number])).permutation(len(y))
                    slices[number] = np.array_split(order, steps)
                chosen = slices[number][step]
                sums = [np.zeros(weights[n].shape, np.int64) for n in names]
                stats = [np.zeros(v.shape, np.int64) for v in at_rest().values()]
                if len(chosen) > 1:
                    rng = np.random.Generator(np.random.Philox(key=[seed, epoch], counter=[1, 0, step, number]))
                    _, found, seen = gradients(weights, x[chosen], y[chosen], of_class[y[chosen].astype(int)], rng)
                    sums = [np.rint(found[n] * _WHOLE).astype(np.int64) for n in names]
                    stats = [np.rint(v * len(chosen) * _WHOLE / BLOCK_ROWS).astype(np.int64) for v in (seen[n] for n in at_rest())]
                return (len(chosen) * (len(chosen) > 1), *sums, *stats)

            n, *sums = sum_own(partial, (0,))
            if not n:
                continue
            taken += 1
            found = dict(zip(names, (s / _WHOLE / n for s in sums)))
            seen = dict(zip(at_rest(), (s * BLOCK_ROWS / _WHOLE / n for s in sums[len(names) :])))
            running = {k: NORM_MOMENTUM * running[k] + (1 - NORM_MOMENTUM) * seen[k] for k in running}
            moments = (
                {k: MOMENTA[0] * moments[0][k] + (1 - MOMENTA[0]) * found[k] for k in names},
                {k: MOMENTA[1] * moments[1][k] + (1 - MOMENTA[1]) * found[k] ** 2 for k in names},
            )
            rate = RATE * np.sqrt(1 - MOMENTA[1] ** taken) / (1 - MOMENTA[0] ** taken)
            weights = {k: weights[k] - rate * moments[0][k] / (np.sqrt(moments[1][k]) + EPSILON) for k in names}

        def levels(block: tuple, weights=weights, running=running) -> tuple:
            _, x, y = block
            level = np.minimum((forward(weights, running, x) * LEVELS).astype(int), LEVELS - 1)
            return (np.stack([np.bincount(level[y == c], minlength=LEVELS) for c in (1, 0)], axis=1),)

        counts = sum_held(levels, (np.zeros((LEVELS, 2), np.int64),))[0]
        history.append(area_of_levels(counts))
        if history[-1] > best[0] or not counts.sum():
            best = (history[-1], weights, running)
        elif len(history) - 1 - int(np.argmax(history)) >= PATIENCE:
            break
    return best[1], best[2], history
