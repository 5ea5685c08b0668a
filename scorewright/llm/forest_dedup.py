"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors are one class. Each tree splits the space by random hyperplanes at the median of a bounded
sample, again and again until a leaf is small; vectors near a split go to both sides (spill), each to the few
leaves of a tree that are nearest to it: the work for a vector does not grow with the depth of the trees. A node as
narrow as a linked pair is not split: a group of near copies stays in one leaf, whatever its size. All
vectors are sent down all trees, by the map tasks. Vectors that share a leaf are compared in double
precision, in blocks of bounded size; a pair that shares several leaves counts in the first of them only.
A leaf's links leave the task as counts and as a spanning forest, never as pairs, and are united across leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, lists, rows_of, stored
from .graph import components

#: The sample that the splits are fitted on; the wanted size of a leaf; members of a block.
SAMPLE, LEAF, BLOCK = 20_000, 256, 2_048
#: Leaves of a tree that a vector goes to at most.
PROBES = 4


def _fit_tree(sample: np.ndarray, rng: np.random.Generator, leaf: float, spill: float, reach: float) -> list[tuple]:
    """Nodes (direction, threshold, margin, left, right); a leaf is (None, number). leaf: sample rows.

    The margin is the spill quantile, but `reach` at least; where that sends too many rows to both sides, the node
    is as narrow as the linked pairs in it, and stays a leaf."""
    nodes: list[tuple] = []
    leaves = 0
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][3 + side] = at
        direction = rng.standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        along = sample[rows] @ direction
        low, high = (along.min(), along.max()) if len(rows) else (0, 0)
        if len(rows) <= max(leaf, 8) or low == high:
            nodes.append([None, leaves, 0, 0, 0])
            leaves += 1
            continue
        middle = np.median(along)
        margin = max(np.quantile(np.abs(along - middle), spill), reach)
        left, right = rows[along <= middle + margin], rows[along > middle - margin]
        if max(len(left), len(right)) > 0.9 * len(rows) or len(left) + len(right) > (1 + 1.5 * spill) * len(rows):
            nodes.append([None, leaves, 0, 0, 0])
            leaves += 1
            continue
        nodes.append([direction, middle, margin, -1, -1])
        todo += [(left, at, 0), (right, at, 1)]
    return nodes


class Tree:
    """A fitted tree as flat arrays, for many vectors at once."""

    def __init__(self, nodes: list[tuple], width: int):
        inner = np.array([n[0] is not None for n in nodes])
        self.direction = np.array([n[0] if n[0] is not None else np.zeros(width) for n in nodes], np.float32).reshape(len(nodes), width)
        self.middle = np.array([n[1] if i else 0 for n, i in zip(nodes, inner)], np.float32)
        self.margin = np.array([n[2] for n in nodes], np.float32)
        self.children = np.array([n[3:] for n in nodes], np.int32)
        self.leaf = np.array([-1 if i else n[1] for n, i in zip(nodes, inner)], np.int32)

    def leaves(self, vectors: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): for each row of `vectors` its own leaf and the nearest ones across splits that it lies near to,
        `probes` in all at most. How far a leaf is: the squared distances to the splits in between, summed. A node's
        nearest leaf is as far as the node, so no leaf is lost by keeping the `probes` nearest nodes on each level."""
        row, node, cost = np.arange(len(vectors)), np.zeros(len(vectors), np.int32), np.zeros(len(vectors), np.float32)
        while True:
            inner = np.flatnonzero(self.leaf[node] < 0)
            if not len(inner):
                return row, self.leaf[node]
            at = node[inner]
            along = np.einsum("ij,ij->i", vectors[row[inner]], self.direction[at]) - self.middle[at]
            over = (along > 0).astype(np.int64)
            near = np.abs(along) <= self.margin[at]
            node[inner] = self.children[at, over]
            row = np.append(row, row[inner[near]])
            node = np.append(node, self.children[at[near], 1 - over[near]])
            cost = np.append(cost, cost[inner[near]] + along[near] ** 2)
            order = np.lexsort((node, cost, row))
            begins = np.searchsorted(row[order], np.arange(len(vectors)))
            kept = order[np.arange(len(order)) - begins[row[order]] < probes]
            row, node, cost = row[kept], node[kept], cost[kept]


def near_vectors(
    table: DataFrame,
    threshold: float = 0.95,
    trees: int = 8,
    spill: float = 0.2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 7,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    probes: int = PROBES,
) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable by links), kept (vec_id = component_id).

    A vector goes to `probes` leaves of each tree at most. Rows link when a shared leaf shows their cosine, in double precision, to reach the threshold; pairs
    that share no leaf are missed, none below the threshold is linked. Vectors that are null, empty, zero,
    or hold null or non-finite components link with nothing, and so do those whose length is not the
    table's most frequent one. Equal vectors are linked. `table` needs an integer id and an array of
    numbers; other columns are ignored, whatever their names. A null id is kept: it counts as a linked
    row, has its class's component, and kept = false. Rows that repeat an id each get a row. An empty
    table gives no rows. The splits are fitted on about `sample` vectors; all vectors are in the index.
    """
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    lengths = rows.filter(sound).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    width = lengths[0]["d"] if lengths else 0
    rows = rows.withColumn("sound", sound & (F.size("v") == width))
    classes = stored(
        rows.filter("sound").groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .select(F.xxhash64("v").alias("draw"), "v", "first_id", "copies")
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    total = classes.count()
    share = F.lit(int(min(1.0, sample / max(total, 1)) * (1 << 30)))
    drawn = classes.filter(F.pmod("draw", F.lit(1 << 30)) <= share).orderBy("draw").limit(2 * sample).select("v").collect()
    points = np.array([r["v"] for r in drawn], np.float64).reshape(len(drawn), width)
    points = _unit(points)
    rng = np.random.default_rng(seed)
    wanted = leaf * len(points) / max(total, 1)
    # half the length that the difference of two vectors at the threshold has along a random direction
    reach = 0.5 * np.sqrt(2 * (1 - threshold) / max(width, 1))
    fitted = [_fit_tree(points, rng, wanted, spill, reach) for _ in range(trees)]
    offsets = np.cumsum([0] + [sum(n[0] is None for n in tree) for tree in fitted]).tolist()
    forest = classes.sparkSession.sparkContext.broadcast([(first, Tree(nodes, width)) for first, nodes in zip(offsets, fitted)])
    # floats travel as they came; their unit vectors are computed anew in double precision
    kind = np.float32 if dict(table.dtypes)[vector_col] == "array<float>" else np.float64

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 2000):
            n = batch.num_rows
            raw = batch.column("v").flatten().to_numpy().reshape(n, width)
            v = _unit(raw).astype(np.float32)
            reached = [(row, leaf + first) for first, tree in forest.value for row, leaf in [tree.leaves(v, probes)]]
            row, reached = (np.concatenate(x) for x in zip(*reached, strict=True))
            reached = reached[np.lexsort((reached, row))]
            sent = raw.astype(kind)
            ends = np.arange(n + 1, dtype=np.int32) * np.int32(width * sent.itemsize)
            sent = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(sent)])
            reached = lists(np.split(reached, np.cumsum(np.bincount(row, minlength=n))[:-1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), sent, reached], ["node", "copies", "v", "leaves"])

    routed = stored(
        classes.select("node", "copies", "v").mapInArrow(route, "node long, copies long, v binary, leaves array<int>"),
        "routed",
    )
    sizes = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"))
    large = stored(sizes.filter(F.col("n") > BLOCK).select("leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large_leaves")
    # a member carries all its leaves: a pair counts in the first leaf that it shares
    members = (
        routed.select("node", "copies", "v", "leaves", F.explode("leaves").alias("leaf"))
        .join(large, "leaf", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("leaf", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "copies", "v", "leaves")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pair of blocks after the other, sorted by (leaf, x, y)."""
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("leaf", "x", "y")], axis=1)
            begins = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in pairwise([0, *begins.tolist(), batch.num_rows]):
                if (own := tuple(keys[a].tolist())) != key:
                    if held:
                        yield _linked(key, pa.concat_batches(held), threshold, kind)
                    key, held = own, []
                held.append(batch.slice(a, b - a))
        if held:
            yield _linked(key, pa.concat_batches(held), threshold, kind)

    links = stored(
        members.repartition("leaf", "x", "y")
        .sortWithinPartitions("leaf", "x", "y")
        .mapInArrow(compare, "a long, b long, n long"),
        "links",
    )
    counts = links.filter("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(links.select("a", "b"))
    named = (
        classes.select("node", "first_id", "copies", "v")
        .join(roots, "node", "left")
        .join(counts, "node", "left")
        .select("v", "first_id", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("v", "n_links", "component_id")
    return (
        rows.withColumn("v", F.when(F.col("sound"), F.col("v")))
        .join(named, "v", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; first scaled by their largest component, so that no square over- or underflows."""
    if not v.size:
        return v
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _linked(key: tuple, held: pa.RecordBatch, threshold: float, kind: type) -> pa.RecordBatch:
    """Links of one pair of blocks: (a, b, n), b a partner or root, n the rows that a links with here."""
    leaf, x, y = key
    own, node, copies = (held.column(c).to_numpy() for c in ("own", "node", "copies"))
    v = _unit(bytes_of(held.column("v"))[0].view(kind).reshape(len(own), -1).astype(np.float64))
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    counts, root = np.zeros(len(own), np.int64), np.arange(len(own))
    earlier = None
    for k in range(0, len(left), 512):
        part = left[k : k + 512]
        near = v[part] @ v[right].T >= threshold
        near &= (part[:, None] < right[None, :]) if x == y else True
        p, q = np.nonzero(near)
        if not len(p):
            continue
        if earlier is None:
            earlier = _earlier_leaves(held.column("leaves"), leaf)
        p, q = part[p], right[q]
        step = max(1, (1 << 20) // earlier.shape[1])
        for a in range(0, len(p), step):
            i, j = p[a : a + step], q[a : a + step]
            new = ~(earlier[i] & earlier[j]).any(axis=1)
            np.add.at(counts, i[new], copies[j[new]])
            np.add.at(counts, j[new], copies[i[new]])
        for a, b in pairwise([0, *(np.flatnonzero(np.diff(p)) + 1).tolist(), len(p)]):
            known = np.unique(np.append(root[q[a:b]], root[p[a]]))
            if len(known) > 1:
                root[np.isin(root, known)] = known[0]
    out = (counts > 0) | (root != np.arange(len(own)))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (node[out], node[root[out]], counts[out])], ["a", "b", "n"])


def _earlier_leaves(leaves: pa.ListArray, leaf: int) -> np.ndarray:
    """A row of 64-bit words for each member, with a bit for each leaf before this one that two members or more are in."""
    member = np.repeat(np.arange(len(leaves)), leaves.value_lengths().to_numpy())
    all_ = leaves.flatten().to_numpy()
    member, all_ = member[all_ < leaf], all_[all_ < leaf]
    _, code, n = np.unique(all_, return_inverse=True, return_counts=True)
    several = n > 1
    chosen = several[code]
    member, column = member[chosen], (np.cumsum(several) - 1)[code[chosen]]
    words = np.zeros((len(leaves), max(1, -(-int(several.sum()) // 64))), np.uint64)
    np.bitwise_or.at(words, (member, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    return words
