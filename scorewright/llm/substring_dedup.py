"""Substring dedup by super-k-mers: word windows that another document has already had are removed.

Each window of words has a minimiser, the smallest hash of its runs of four words; equal windows have equal
minimisers. Consecutive windows that share one are a super-k-mer: its words form one packed string.

1. The minimisers of all windows are counted (narrow rows, map-side combine). One that only a single
   document has can't hold a repeat; its windows need not travel.
2. The packed strings of the others go to the bucket of their minimiser, each distinct string once per
   map task with the smallest id it saw. A task numbers the words of its buckets and sorts their windows:
   every window gets the smallest id that has it, by comparing whole words.
3. An occurrence in a document other than its string's first one is a repeat as a whole; the first
   document loses just those windows that stand in some other string of a smaller id.

Buckets with very many occurrences (a passage in a third of all documents) are in no single task: the
windows of their distinct strings are told by 128-bit hashes in a narrow aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, lists, mixed, pieces_of, rows_of, signed, stored, text_hashes, window_hashes, word_hashes

#: Words of the runs whose smallest hash is a window's minimiser.
RUN = 4
#: Occurrences of one minimiser from which its bucket is not in a single task.
SHARD = 20_000
#: Packed strings that a map task remembers having sent.
SENT = 50_000
#: Bytes of packed strings from which a bucket task compares them.
HELD = 4 << 20
#: Pairs of windows whose words are compared at once.
PAIRS = 20_000
_FACTOR = 0x9E3779B97F4A7C15

_SENT = "minimiser long, hot boolean, string long, string2 long, doc_id long, row long, start int, n_words int, packed binary"
_RANGES = "string long, string2 long, first_id long, ranges array<struct<a:int,b:int>>"


def _super_kmers(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and end (exclusive) of each super-k-mer."""
    return _of_hashes(word_hashes(words), window)


def _of_hashes(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none
    runs = window_hashes(hashes, min(RUN, window))
    width = window - min(RUN, window) + 1
    least = runs[:n].copy()
    for k in range(1, width):
        np.minimum(least, runs[k : k + n], out=least)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[first], first, np.append(first[1:], n)


def _removed(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, start, end): word ranges to remove; `row` tells apart texts that share an id."""

    def minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = [np.unique(_of_hashes(h, window)[0], return_counts=True) for h in text_hashes(batch.column("text"))]
            sizes = [len(least) for least, _ in found]
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            least, times = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(at),
                    "row": batch.column("row").take(at),
                    "minimiser": pa.array(signed(least)),
                    "times": pa.array(times, pa.int64()),
                }
            )

    docs = docs.filter("doc_id is not null and text is not null")
    seen = stored(docs.mapInArrow(minimisers, "doc_id long, row long, minimiser long, times long"), "minimisers")
    shared = (
        seen.groupBy("minimiser")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum("times").alias("n"))
        .filter("lo <> hi")
        .select("minimiser", (F.col("n") >= SHARD).alias("hot"))
    )
    asked = (
        seen.join(shared, "minimiser")
        .groupBy("doc_id", "row")
        .agg(F.collect_set(F.struct("minimiser", "hot")).alias("asked"))
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}
        for batch in rows_of(batches, 200):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "asked"))
            for doc_id, row, text, asked, hashes in zip(*columns, text_hashes(batch.column("text")), strict=True):
                words = text.split()
                hot = {a["minimiser"]: a["hot"] for a in asked}
                ends = np.cumsum([len(w) + 1 for w in words])
                joined = b" ".join(words)
                least, first, end = _of_hashes(hashes, window)
                for m, i, j in zip(signed(least).tolist(), first.tolist(), end.tolist(), strict=True):
                    if m in hot:
                        j += window - 1
                        packed = joined[ends[i - 1] if i else 0 : ends[j - 1] - 1]
                        h = xxhash.xxh3_128_digest(packed)
                        if sent.get(h, doc_id + 1) <= doc_id:
                            packed = None
                        else:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent[h] = doc_id
                        h1, h2 = np.frombuffer(h, np.int64).tolist()
                        rows.append((m, hot[m], h1, h2, doc_id, row, i, j - i, packed))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64(), pa.bool_()] + [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
            names = ["minimiser", "hot", "string", "string2", "doc_id", "row", "start", "n_words", "packed"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    occurrences = stored(
        docs.join(asked, ["doc_id", "row"]).select("doc_id", "row", "text", "asked").mapInArrow(send, _SENT),
        "super-kmers",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One bucket after the other, sorted by minimiser; many small ones are compared at once."""
        key, size, bucket, alone, strings = None, 0, {}, {}, {}
        for batch in rows_of(batches, 2000):
            for m, packed, doc_id in zip(*(batch.column(c).to_pylist() for c in ("minimiser", "packed", "doc_id")), strict=True):
                if m != key:
                    (strings if len(bucket) > 1 else alone).update(bucket)  # no other string could share a window with a lone one
                    if size >= HELD:
                        yield _verdicts(strings, alone, window)
                        size, alone, strings = 0, {}, {}
                    key, bucket = m, {}
                if packed not in bucket:
                    size += len(packed)
                bucket[packed] = min(doc_id, bucket.get(packed, doc_id))
        (strings if len(bucket) > 1 else alone).update(bucket)
        yield _verdicts(strings, alone, window)

    sent = occurrences.filter("packed is not null")
    exact = (
        sent.filter("not hot")
        .select("minimiser", "packed", "doc_id")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(count, _RANGES)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 200):
            hashes = [_digests(packed, window) for packed in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("string", "string2", "first_id")), *(lists([h[:, k] for h in hashes], pa.int64()) for k in (0, 1))],
                ["string", "string2", "first_id", "w1", "w2"],
            )

    cuts = stored(
        sent.filter("hot")
        .groupBy("string", "string2")
        .agg(F.min("doc_id").alias("first_id"), F.first("packed").alias("packed"))
        .mapInArrow(cut, "string long, string2 long, first_id long, w1 array<long>, w2 array<long>"),
        "windows",
    )
    windows = cuts.select("string", "string2", "first_id", F.posexplode(F.arrays_zip("w1", "w2")).alias("at", "w")).select(
        "string", "string2", "first_id", "at", F.col("w.w1").alias("w1"), F.col("w.w2").alias("w2")
    )
    least = windows.groupBy("w1", "w2").agg(F.min("first_id").alias("least"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows by string and place become one row a string, or two where a batch ends within it."""
        for batch in batches:
            if batch.num_rows:
                string, string2, first_id, at, low = (batch.column(c).to_numpy() for c in ("string", "string2", "first_id", "at", "least"))
                new = np.ones(len(at), bool)
                new[1:] = (string[1:] != string[:-1]) | (string2[1:] != string2[:-1])
                yield _ranges(string[new], string2[new], first_id[new], *_stretches(np.cumsum(new) - 1, at, low < first_id, window))

    settled = (
        windows.join(least, ["w1", "w2"])
        .select("string", "string2", "first_id", "at", "least")
        .repartition("string", "string2")
        .sortWithinPartitions("string", "string2", "at")
        .mapInArrow(merge, _RANGES)
    )

    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n_words").alias("b")))
    return (
        occurrences.select("string", "string2", "doc_id", "row", "start", "n_words")
        .join(exact.unionByName(settled), ["string", "string2"])  # a string has one minimiser, so it is in one of them
        .filter("doc_id > first_id or size(ranges) > 0")
        .select("doc_id", "row", "start", F.explode(F.when(F.col("doc_id") > F.col("first_id"), whole).otherwise(F.col("ranges"))).alias("r"))
        .select("doc_id", "row", (F.col("start") + F.col("r.a")).alias("start"), (F.col("start") + F.col("r.b")).alias("end"))
    )


def _digests(packed: bytes, window: int) -> np.ndarray:
    """128 bits of each window of a string, as two columns."""
    ends = np.cumsum([len(w) + 1 for w in packed.split(b" ")]).tolist()
    begins = [0, *ends]
    found = b"".join(xxhash.xxh3_128_digest(packed[begins[k] : ends[k + window - 1] - 1]) for k in range(len(ends) - window + 1))
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def _verdicts(strings: dict[bytes, int], alone: dict[bytes, int], window: int) -> pa.RecordBatch:
    """What the buckets say of their strings: where a string's first document has windows that a smaller id has too."""
    first_ids = np.fromiter((*strings.values(), *alone.values()), np.int64, len(strings) + len(alone))
    string = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, (*strings, *alone))), np.int64).reshape(-1, 2)
    return _ranges(string[:, 0], string[:, 1], first_ids, *_repeated(list(strings), first_ids[: len(strings)], window))


def _ranges(
    string: np.ndarray, string2: np.ndarray, first_ids: np.ndarray, which: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> pa.RecordBatch:
    """A row for each string, with those of the ranges that are of its number."""
    offsets = np.append(0, np.cumsum(np.bincount(which, minlength=len(first_ids)))).astype(np.int32)
    ranges = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["a", "b"])
    return pa.RecordBatch.from_arrays(
        [pa.array(string), pa.array(string2), pa.array(first_ids), pa.ListArray.from_arrays(pa.array(offsets), ranges)],
        ["string", "string2", "first_id", "ranges"],
    )


def _stretches(owner: np.ndarray, at: np.ndarray, hit: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of each stretch of words under the windows that are hit; windows are by owner and place."""
    found = np.flatnonzero(hit)
    owner, at = owner[found], at[found]
    new = np.ones(len(found), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (np.diff(at) > window)  # closer windows touch or overlap
    last = np.ones(len(found), bool)
    last[:-1] = new[1:]
    return owner[new], at[new], at[last] + window


def _repeated(strings: list[bytes], first_ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String's number, start and end of each stretch of windows that a string of a smaller id has too. Windows
    are places in one array of word numbers: none is an object of its own, however many a bucket has."""
    if not strings:
        return (np.empty(0, np.int64),) * 3
    codes, bounds, _ = pieces_of(pa.array(strings, pa.binary()), SPACES)
    sizes = np.diff(bounds) - window + 1
    owner = np.repeat(np.arange(len(strings)), sizes)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    group = _equal_windows(codes, bounds[owner] + at, window)
    own = first_ids[owner]
    least = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, own)
    return _stretches(owner, at, least[group] < own, window)


def _equal_windows(codes: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """A number for each window of word numbers, the same for equal windows only."""
    hashes = _run_hashes(codes, window)[places]
    order = np.argsort(hashes)
    ranked = hashes[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    ordered, runs = places[order], np.lib.stride_tricks.sliding_window_view(codes, window)
    same = np.flatnonzero(~new)
    for k in range(0, len(same), PAIRS):  # equal hashes are no proof
        pairs = same[k : k + PAIRS]
        if not np.array_equal(runs[ordered[pairs]], runs[ordered[pairs - 1]]):
            numbers: dict[bytes, int] = {}
            return np.fromiter((numbers.setdefault(runs[p].tobytes(), len(numbers)) for p in places.tolist()), np.int64, len(places))
    group = np.empty(len(places), np.int64)
    group[order] = np.cumsum(new) - 1
    return group


def _run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` numbers, from those of runs half as long."""
    hashes, length = mixed(codes.astype(np.uint64) + np.uint64(1)), 1
    with np.errstate(over="ignore"):
        while length < size:
            step = min(length, size - length)
            hashes = hashes[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64)) + hashes[step:]
            length += step
    return hashes


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, text (the words that stay, joined by a space).

    `docs` needs an integer id and a text; other columns are ignored, whatever their names. Words are runs
    without ASCII white space, unchanged. A word goes if some window of `window` words that covers it
    also starts in a document of a smaller id. Null texts have no words and give an empty text; texts
    shorter than a window stay whole. Rows with a null id stay whole and count for no other row. Rows that
    repeat an id do not count for each other: their ids are not smaller. An empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).withColumn("row", F.xxhash64("text"))
    ranges = (
        _removed(texts, window)
        .groupBy("doc_id", "row")
        .agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sizes, gone, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                words = text.split() if text is not None else []
                sizes.append(len(words))
                if found:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, [r["start"] for r in found], 1)
                    np.add.at(steps, [r["end"] for r in found], -1)
                    stay = np.cumsum(steps[:-1]) == 0
                    words = [words[k] for k in np.flatnonzero(stay).tolist()]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    return (
        texts.join(ranges, ["doc_id", "row"], "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(keep, "doc_id long, n_words long, n_removed long, text binary")
        .withColumn("text", F.col("text").cast("string"))
    )
