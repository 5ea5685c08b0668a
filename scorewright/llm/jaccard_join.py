"""N-gram Jaccard join by T-occurrence search.

A document is the set of its word shingles. Two sets of sizes m and n reach the similarity only if they
share T shingles, so of the lists that a document's shingles open, all but the L longest must be merged: a
partner occurs at least T - L times in the short ones (the DivideSkip split). The short
lists are merged by a shuffle on the shingle; the long ones are probed afterwards by binary search in the
partner's sorted set, which gives the exact overlap.

What keeps it linear where copies abound:

* equal sets are one class, found with map-side combine, before any list is opened;
* a list first links its members to its least altered one only, a star instead of all pairs;
* pairs are asked for only where a list still holds several components; stars between the components'
  least altered members come first;
* the rest is asked in full, by the few shortest lists that must show one of a pair's T - L common entries.

Which lists are long is read from a sketch of shingle counts over all documents (2**20 counters, fixed
size): it sets the order in which lists are merged, never which links are found. Lists that the sketch
calls very long are dealt over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lists, rows_of, shingle_set, signed, stored
from .graph import components

#: Counters of the sketch, sent in blocks; 4 MB in all, whatever the corpus.
CELLS, BLOCKS = 1 << 20, 64
#: A list of more members than this, by the sketch, is dealt over several tasks.
LONG_LIST = 50_000
#: Rounds of stars before the round that asks in full, whatever the corpus.
STARS = 2
#: Classes whose texts are fetched by a broadcast of their ids; more are fetched by a shuffle.
MAX_WANTED = 500_000


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def _words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text is not None else []


def _texts(batch: pa.RecordBatch, name: str = "text") -> list:
    return batch.column(name).to_pylist()


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """Counters of all documents' shingles, summed in steps of 64 tasks each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(CELLS, np.uint32)
        for batch in rows_of(batches):
            sets = [shingle_set(_words(t), size) for t in _texts(batch)]
            if sets:
                total += np.bincount(_cells(np.concatenate(sets)), minlength=CELLS).astype(np.uint32)
        parts = [p.tobytes() for p in np.split(total, BLOCKS)]
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(range(BLOCKS), pa.int32()), "team": pa.array([TaskContext.get().partitionId()] * BLOCKS, pa.int64()), "counts": pa.array(parts, pa.binary())}
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS // BLOCKS, np.uint64)
        for batch in batches:
            for part in batch.column("counts"):
                total += np.frombuffer(part.as_buffer(), np.uint32)
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array([key[0].as_py()], pa.int32()), "team": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())}
        )

    schema = "block int, team long, counts binary"
    counts = texts.select("text").mapInArrow(count, schema)
    for _ in range(3):  # 64 ** 3 tasks at the first step
        counts = (
            counts.withColumn("team", F.floor(F.col("team") / 64).cast("long"))
            .groupBy("block", "team")
            .applyInArrow(add, schema)
        )
    total = np.zeros((BLOCKS, CELLS // BLOCKS), np.uint64)
    for row in counts.collect():  # at most 64 blocks of 64 kB for each 262,144 tasks
        total[row["block"]] += np.frombuffer(row["counts"], np.uint32)
    return total.reshape(-1)


def _signatures(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, node, n, w, short): fingerprint and size of each set, how common the shingles of its short lists
    are (mean of log2, in thousandths), and those shingles. In a group of near copies w is high for the least altered."""
    counts = texts.sparkSession.sparkContext.broadcast(shingle_counts(texts, size))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for batch in rows_of(batches):
            nodes, sizes, common, shorts, parts = [], [], [], [], []
            for text in _texts(batch):
                s = shingle_set(_words(text), size)
                n = len(s)
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63)
                sizes.append(n)
                seen = often[_cells(s)]
                first = np.lexsort((s, seen))[: n - -(-percent * n // 100) + 1] if n else np.empty(0, np.int64)
                shorts.append(signed(s[first]))
                common.append(int(1000 * np.log2(seen[first]).mean()) if n else 0)
                parts.append((seen[first] // LONG_LIST).astype(np.int64) + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "node": pa.array(nodes, pa.int64()),
                    "n": pa.array(sizes, pa.int64()),
                    "w": pa.array(common, pa.int64()),
                    "short": lists(shorts, pa.int64()),
                    "parts": lists(parts, pa.int64()),
                }
            )

    return texts.mapInArrow(sign, "doc_id long, node long, n long, w long, short array<long>, parts array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the similarity."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (None, None)
        for batch in rows_of(batches, 200):
            linked = []
            for a, left, right in zip(batch.column("a").to_pylist(), _texts(batch, "left"), _texts(batch, "right"), strict=True):
                if kept[0] != a:
                    kept = (a, shingle_set(_words(left), size))
                x, y = kept[1], shingle_set(_words(right), size)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    return (
        pairs.join(sets.toDF("b", "right"), "b")
        .join(sets.toDF("a", "left"), "a")
        .select("a", "b", "left", "right")
        .mapInArrow(probe, "a long, b long")
    )


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    `docs` needs an integer id and a text; other columns are ignored, whatever their names. Words are
    runs without ASCII white space, with A-Z in lower case. Two documents link when 100 * shared >=
    percent * united. Null, empty and blank texts have no shingles: they link with nothing and are
    their own component. A null id is kept: its row has the component of its equals, null without any.
    Rows with the same text, or that repeat an id, each get a row. An empty table gives no rows. Equal
    sets are told by a 64-bit fingerprint of the set's 64-bit shingle hashes.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    signed_docs = stored(_signatures(texts, size, percent), "signatures")
    short = F.first(F.struct("n", "w", "short", "parts")).alias("s")
    entries = (
        signed_docs.filter("n > 0 and doc_id is not null")
        .groupBy("node")
        .agg(short)
        .select("node", F.col("s.n").cast("int").alias("n"), F.col("s.w").cast("int").alias("w"), F.explode(F.arrays_zip("s.short", "s.parts")).alias("e"))
        .select("node", "n", "w", F.col("e.short").alias("shingle"), F.col("e.parts").alias("parts"))
        .select("shingle", "node", "n", "w", F.when(F.col("parts") > 1, F.pmod("node", "parts").cast("int")).alias("part"))
    )
    of_list = Window.partitionBy("shingle", "part")
    entries = entries.select(
        "shingle", "part", F.struct("w", "node", "n").alias("x"), F.max(F.struct("w", "node", "n")).over(of_list).alias("hub"), F.count("*").over(of_list).alias("size")
    ).filter("size > 1 or part is not null")
    entries = stored(entries.drop("size"), "lists")
    classes = stored(
        signed_docs.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id")), "classes"
    )

    hot = entries.filter("part is not null")
    tops = hot.groupBy("shingle").agg(F.max("hub").alias("top"))
    stars = entries.select(F.col("hub").alias("x"), F.col("x").alias("y"))
    stars = stars.union(hot.select("shingle", "hub").distinct().join(tops, "shingle").select("top", "hub"))
    pairs = _counted(stars, percent)
    asked, roots, sets = None, None, None
    for k in range(STARS + 1):
        if asked is not None:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        fetched = stored(_class_texts(texts, stored(wanted.join(classes, "node"), "wanted"), size), "sets")
        sets = fetched if sets is None else sets.union(fetched)
        found = stored(_verified(pairs, sets, size, percent), "links")
        asked = pairs if asked is None else asked.union(pairs)
        roots = stored(components(found) if roots is None else _united(roots, found), "roots")
        if k == STARS:
            break
        members = entries.join(roots, F.col("x.node") == F.col("node"), "left").select(
            "shingle", "x", F.coalesce("root", "x.node").alias("root")
        )
        mixed = members.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
        members = members.join(mixed.filter("lo <> hi").select("shingle", "lo", "size"), "shingle")
        if k == STARS - 1:  # the last round asks in full
            pairs = _across(stored(members, "members"), percent)
        else:
            firsts = members.groupBy("shingle", "root", "lo").agg(F.max("x").alias("x"))
            hub = firsts.filter("root = lo").select("shingle", F.col("x").alias("hub"))
            stars = firsts.filter("root <> lo").join(hub, "shingle").select(F.col("hub").alias("x"), F.col("x").alias("y"))
            pairs = _counted(stars, percent)

    named = classes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("node", "component_id")
    return (
        signed_docs.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(named, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _united(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after further links: only the links between roots are walked."""
    for end in ("a", "b"):
        to = roots.select(F.col("node").alias(end), F.col("root").alias("to"))
        links = links.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    merged = stored(components(links.select("a", "b")), "merged")
    known = roots.join(merged.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return known.union(merged.join(roots, "node", "left_anti").select("node", "root"))


def _needed(percent: int, n: str, m: str) -> str:
    """Common entries that the short lists of two linked sets of sizes n and m hold at least.

    Sets that reach the similarity share T = ceil(t (n + m) / (1 + t)) shingles, all but
    L = ceil(t max(n, m)) - 1 of them in the short lists of either.
    """
    return f"ceil({percent} * ({n} + {m}) / {100 + percent}) - ceil({percent} * greatest({n}, {m}) / 100) + 1"


def _across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs across components that can have enough common entries, from members (shingle, x, root, size).

    For each size m that its lists hold, a set has c entries. A linked partner of that size shares k of them at
    least, so one of both sides' c - k + 1 entries of the shortest lists is common: only those are joined, and
    a set with fewer than k entries asks nobody.
    """
    sizes = members.select("shingle", F.col("x.n").alias("m")).distinct()
    able = (
        members.select("shingle", "root", "size", "x.node", "x.n")
        .join(sizes, "shingle")
        .filter(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    )
    of_size = Window.partitionBy("node", "m")
    able = able.select(
        "*", F.count("*").over(of_size).alias("c"), F.row_number().over(of_size.orderBy("size", "shingle")).alias("i")
    )
    able = stored(able.filter(f"i <= c - ({_needed(percent, 'n', 'm')}) + 1").select("shingle", "node", "n", "m", "root"), "able")
    other = able.toDF("shingle", "partner", "m", "n", "other")
    pairs = able.join(other, ["shingle", "n", "m"]).filter("root < other")
    return pairs.select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()


def _counted(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a star, hubs x and others y as structs (w, node, n). A star shows only some of a pair's
    common entries: a quarter of those needed is enough, and y asks its best hub x only."""
    pairs = pairs.filter("x.node <> y.node")
    counted = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m")).agg(F.count("*").alias("c"))
    enough = counted.filter(f"100 * least(n, m) >= {percent} * greatest(n, m) and c * 4 >= {_needed(percent, 'n', 'm')}")
    enough = enough.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a"))
    return enough.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _class_texts(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, text): a text for each wanted class. Where rows repeat an id, only the class's own text stays."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            right = [
                xxhash.xxh3_64_intdigest(shingle_set(_words(t), size).tobytes()) - 2**63 == node
                for t, node in zip(_texts(batch), batch.column("node").to_pylist(), strict=True)
            ]
            yield batch.filter(pa.array(right, pa.bool_()))

    few = wanted.count() <= MAX_WANTED  # two longs each
    return (
        texts.join(F.broadcast(wanted) if few else wanted, F.col("doc_id") == F.col("first_id"))
        .select("node", "text")
        .mapInArrow(own, "node long, text binary")
    )
