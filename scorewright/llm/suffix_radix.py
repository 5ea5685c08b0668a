"""Suffix-array dedup, cut to the depth that matters: repeated byte windows by most-significant-digit passes.

Only the first `window` bytes of a suffix decide whether it is a repeat, so suffixes are sorted to that depth
and no further, and groups of one suffix leave the sort as soon as they are alone. What is left in one group
after the last pass is a repeated window, exactly.

1. The first digit is taken from the window's own anchor: the leftmost of its substrings of `anchor_bytes`
   bytes with the smallest hash, and where it stands. Equal windows have equal anchors at equal places, and
   neighbouring windows mostly share one, so suffixes travel as runs: the windows of one anchor, packed as
   one string.
2. Texts are written once, in compressed chunks of some megabytes, as a table bucketed by chunk: what comes back
   for a chunk goes to where it lies, and the texts are never shuffled. A chunk sends its distinct anchors, sorted
   and cut by their first bits, to the shards where all chunks' anchors meet, and gets one bit for each back:
   whether it occurs elsewhere too. Runs of other anchors do not travel.
3. Equal runs are told by 128-bit hashes: all but the first are repeats as a whole, within a task at once.
4. The different runs of an anchor meet in its bucket. There their windows are sorted by place, then by eight
   bytes a pass, for many buckets at once in flat arrays. The earliest window of a group stays.

Buckets of very many runs are dealt over shards by the runs' hashes, and what is equal between shards is
settled by an aggregate over 128-bit hashes of their windows, for these buckets only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import bytes_of, chunks_of, mixed, signed, stored

#: Windows whose anchors are looked for at once, so that the arrays stay in the processor's cache.
SEGMENT = 1 << 16
#: Bytes of text of a chunk; a longer text is a chunk of its own.
CHUNK = 4 << 20
#: Occurrences of one anchor in a shard of its bucket.
SHARD = 20_000
#: Chunks of a bucket of the table of chunks, on average.
BUCKET_CHUNKS = 3
#: Buckets that Spark allows a table.
MOST_BUCKETS = 100_000
#: Runs that a map task remembers having sent.
SENT = 200_000
#: Windows that a bucket task sorts at once.
SORTED = 400_000
_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = 0x9E3779B97F4A7C15
_BYTES = mixed(mixed(np.arange(1, 257, dtype=np.uint64)))
#: Anchors of a shard, as expected, in which the chunks' anchors are compared.
ANCHORS = 4 << 20
_CHUNK = "chunk long, doc_ids array<long>, rows array<long>, ends array<long>, data binary"
#: Who a run belongs to, in the order in which documents come: id, hash of the text, place in the input.
_OWNER = ("doc_id", "row", "chunk", "doc")
_KINDS = {
    "anchor": pa.int64(), "shard": pa.int64(), "s1": pa.int64(), "s2": pa.int64(), "doc_id": pa.int64(), "row": pa.int64(), "chunk": pa.int64(),
    "doc": pa.int32(), "start": pa.int32(), "n": pa.int32(), "at": pa.int32(), "packed": pa.binary(),
}
_SENT = "anchor long, shard long, s1 long, s2 long, doc_id long, row long, chunk long, doc int, start int, n int, at int, packed binary"
_RANGES = "doc_id long, row long, chunk long, doc int, start int, stop int, w1 long, w2 long"


def anchor_bytes(window: int) -> int:
    """The largest power of two that is at most a third of the window, and at most 32."""
    return 1 << min(5, max(1, window // 3).bit_length() - 1)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n, step = len(keys) - width + 1, 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return np.minimum(keys[:n], keys[width - step : width - step + n])


def runs_of(flat: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: text, first window's place in `flat`, windows, anchor's place
    after the first window's, and the anchor's hash. No window crosses two texts."""
    k = anchor_bytes(window)
    last = np.maximum(offsets[:-1], offsets[1:] - window + 1)  # from there on no window of the text begins
    border = np.zeros(len(flat) + 1, np.int8)
    np.add.at(border, last, 1)
    np.add.at(border, offsets[1:], -1)
    whole = np.cumsum(border[:-1], dtype=np.int8) == 0
    found = []
    for x in range(0, max(0, len(flat) - window + 1), SEGMENT):
        part = flat[x : x + SEGMENT + window - 1]
        valid = whole[x : x + len(part) - window + 1]
        if not valid.any():
            continue
        h, factor, step = _BYTES[part], _FACTOR, 1
        with np.errstate(over="ignore"):
            while step < k:
                h = h[:-step] * np.uint64(factor) + h[step:]
                factor, step = factor * factor & ((1 << 64) - 1), 2 * step
        place = _least(h & ~_PLACE | np.arange(len(h), dtype=np.uint64), window - k + 1) & _PLACE
        change = np.concatenate(([True], (place[1:] != place[:-1]) | ~valid[:-1]))
        first = np.flatnonzero(change & valid)
        end = np.flatnonzero(np.append(change[1:] | ~valid[1:], True) & valid)
        at = place[first].astype(np.int64)
        found.append((first + x, end - first + 1, at - first, mixed(h[at])))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    first, n, at, anchor = (np.concatenate(x) for x in zip(*found, strict=True))
    return np.searchsorted(offsets, first, "right") - 1, first, n, at, anchor


def _chunks(texts: DataFrame) -> DataFrame:
    """The texts in compressed chunks: (chunk, doc_ids, rows, ends, data); a long text is a chunk of its own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, squeeze = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in _gathered(batches):
            flat, offsets = bytes_of(batch["text"])
            columns = [
                pa.array([number]), pa.array([batch["doc_id"].to_pylist()], pa.list_(pa.int64())), pa.array([batch["row"].to_pylist()], pa.list_(pa.int64())),
                pa.array([offsets[1:].tolist()], pa.list_(pa.int64())), pa.array([squeeze.compress(flat.tobytes())], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "doc_ids", "rows", "ends", "data"])
            number += 1

    return texts.mapInArrow(pack, _CHUNK)


def _bucketed(chunks: DataFrame, buckets: int) -> DataFrame:
    """The same chunks, written to the shared folder in buckets by chunk, so that joins by chunk read them where
    they lie. The catalog has the table only until it is opened."""
    spark = chunks.sparkSession
    name = f"scorewright_chunks_{uuid.uuid4().hex}"
    chunks.write.format("parquet").bucketBy(buckets, "chunk").option("path", f"{shared_folder(spark)}/scorewright/{name}").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved: its files and buckets are known
    spark.sql(f"drop table {name}")
    return table


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about as many bytes of text as `chunks_of` allows, also where Spark's are smaller."""
    held, size = [], 0
    for batch in chunks_of(batches, "text", CHUNK):
        n = len(bytes_of(batch.column("text"))[0])
        if held and size + n > CHUNK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's bytes, offsets, ids (0 for null), which ids are known, and rows."""
    offsets = np.array([0, *row["ends"]], np.int64)
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(offsets[-1])))
    known = np.array([i is not None for i in row["doc_ids"]], bool)
    return np.frombuffer(data, np.uint8), offsets, np.array([i or 0 for i in row["doc_ids"]], np.int64), known, np.array(row["rows"], np.int64)


def _chunk_runs(row: dict, window: int) -> tuple:
    flat, offsets, doc_id, known, rows = _opened(row)
    text, first, n, at, anchor = runs_of(flat, offsets, window)
    own = known[text]
    return flat, offsets, doc_id, rows, *(x[own] for x in (text, first, n, at, anchor))


def _by_shard(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (anchors >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchors), np.int64)


def _shared(chunks: DataFrame, window: int, bits: int) -> DataFrame:
    """(chunk, shard, bits, places, shards): for a chunk's anchors of one shard in order, which occur in other
    chunks too; and the anchors whose buckets are dealt over several shards."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors, times = np.unique(_chunk_runs(row, window)[-1], return_counts=True)
                shard = _by_shard(anchors, bits)
                edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1 if not len(shard) else shard[-1] + 1))
                parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                times = np.minimum(times, 65_535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[i]) for i, _ in parts], pa.int64()), pa.array([row["chunk"]] * len(parts), pa.int64()),
                        pa.array([anchors[i:j].tobytes() for i, j in parts], pa.binary()), pa.array([times[i:j].tobytes() for i, j in parts], pa.binary()),
                    ],
                    ["shard", "chunk", "anchors", "times"],
                )

    def answer(shard: int, asked: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        every = [np.frombuffer(anchors, np.uint64) for _, anchors, _ in asked]
        distinct, where = np.unique(np.concatenate(every), return_inverse=True)
        chunks = np.bincount(where)
        places = np.bincount(where, np.concatenate([np.frombuffer(t, np.uint16) for *_, t in asked]))
        shards = (places // SHARD).astype(np.int64) + 1
        found, at = [], 0
        for (chunk, *_), own in zip(asked, every, strict=True):
            here = where[at : at + len(own)]
            at += len(own)
            hot = np.flatnonzero(shards[here] > 1)
            found.append((chunk, shard, np.packbits(chunks[here] > 1).tobytes(), hot.tolist(), shards[here[hot]].tolist()))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["chunk", "shard", "bits", "places", "shards"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked = None, []
        for batch in batches:
            for shard, *own in zip(*(batch.column(c).to_pylist() for c in ("shard", "chunk", "anchors", "times")), strict=True):
                if shard != key:
                    if asked:
                        yield from answer(key, asked)
                    key, asked = shard, []
                asked.append(own)
        if asked:
            yield from answer(key, asked)

    tasks = max(1 << bits, min(64, chunks.sparkSession.sparkContext.defaultParallelism)) if bits else 1
    return (
        chunks.mapInArrow(ask, "shard long, chunk long, anchors binary, times binary")
        .repartition(tasks, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(meet, "chunk long, shard long, bits binary, places array<long>, shards array<long>")
    )


def _ranges(owners: list, start: list[int], stop: list[int]) -> pa.RecordBatch:
    """Ranges of bytes of one document each, merged where they touch and follow each other."""
    owners = [np.array(x, np.int64) for x in owners]
    order = np.lexsort((start, *reversed(owners)))
    owners = [x[order] for x in owners]
    start, stop = (np.array(x, np.int64)[order] for x in (start, stop))
    if len(start):
        same = np.all([x[1:] == x[:-1] for x in owners], axis=0) & (start[1:] <= stop[:-1])
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        owners, start, stop = [x[first] for x in owners], start[first], np.maximum.reduceat(stop, first)
    none = pa.nulls(len(start), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, _KINDS[c]) for x, c in zip((*owners, start), (*_OWNER, "start"))] + [pa.array(stop, pa.int32()), none, none],
        [*_OWNER, "start", "stop", "w1", "w2"],
    )


def _send(asked: DataFrame, window: int) -> DataFrame:
    """The runs of shared anchors, each distinct one once a task as a string; a run that the task has already
    sent from an earlier place is a repeat, and only its range is sent (without a string)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                yield from sent_runs(row, sent)

    def sent_runs(row: dict, sent: dict[bytes, tuple]) -> Iterator[pa.RecordBatch]:
        flat, offsets, doc_id, rows, text, first, n, at, anchor = _chunk_runs(row, window)
        anchors, back, times = np.unique(anchor, return_inverse=True, return_counts=True)
        shards = np.ones(len(anchors), np.int64)
        wanted = times > 1
        begin = 0
        for part in sorted(row["asked"], key=lambda p: p["shard"]):
            size = int(np.count_nonzero(_by_shard(anchors, row["bits"]) == part["shard"]))
            wanted[begin : begin + size] |= np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=size).astype(bool)
            shards[begin + np.array(part["places"], np.int64)] = part["shards"]
            begin += size
        hit = wanted[back]
        text, first, n, at, anchor, shards = (x[hit] for x in (text, first, n, at, anchor, shards[back]))
        start = first - offsets[text]
        owners = (doc_id[text], rows[text], np.full(len(text), row["chunk"]), text)
        data, digest = memoryview(flat), xxhash.xxh3_128_digest
        hashes, new, old = [], [], []
        places = zip(*(x.tolist() for x in (*owners, start)), strict=True)
        for k, (a, size, key) in enumerate(zip(first.tolist(), n.tolist(), places, strict=True)):
            h = digest(data[a : a + size + window - 1])
            before = sent.get(h)
            if before is not None and before < key:
                old.append(k)
                continue
            if len(sent) >= SENT:
                sent.clear()
            sent[h] = key
            hashes.append(h)
            new.append(k)
        if old:
            made = _ranges([x[old] for x in owners], start[old], start[old] + n[old] + window - 1)
            columns = {c: made[c] for c in (*_OWNER, "start")}
            columns["n"] = pa.array(made["stop"].to_numpy() - made["start"].to_numpy(), pa.int32())
            # to where the document's id leads, as a shard that no bucket has
            yield _sent_batch(made.num_rows, columns | {"anchor": made["doc_id"], "shard": pa.array(np.zeros(made.num_rows, np.int64))})
        if new:
            new = np.array(new)
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            columns = {c: pa.array(x[new], _KINDS[c]) for c, x in zip((*_OWNER, "start", "n", "at"), (*owners, start, n, at))}
            columns |= {
                "anchor": pa.array(signed(anchor[new])), "s1": pa.array(h[:, 0]), "s2": pa.array(h[:, 1]),
                "shard": pa.array(np.mod(h[:, 0], shards[new]) + (shards[new] << 32)),
                "packed": pa.array([bytes(data[a : a + size + window - 1]) for a, size in zip(first[new].tolist(), n[new].tolist(), strict=True)], pa.binary()),
            }
            yield _sent_batch(len(new), columns)

    return asked.mapInArrow(send, _SENT)


def _sent_batch(rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, kind)) for c, kind in _KINDS.items()], list(_KINDS))


def _passes(flat: np.ndarray, at: np.ndarray, group: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit passes over the windows that start at `at`, from their first groups on: the
    places in `at` of those equal to another one, and their groups."""
    eight = np.lib.stride_tricks.sliding_window_view(np.append(flat, np.zeros(8, np.uint8)), 8)
    alive = np.arange(len(at))
    for k in range(0, window, 8):
        k = max(0, min(k, window - 8))
        digit = np.ascontiguousarray(eight[at[alive] + k]).view(">u8").ravel().astype(np.uint64)
        if window < 8:
            digit >>= np.uint64(8 * (8 - window))
        with np.errstate(over="ignore"):
            both = mixed(digit ^ mixed(group.astype(np.uint64)))
        order = np.argsort(both)
        group, digit, both = group[order], digit[order], both[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))) if len(order) else np.empty(0, bool)
        if np.any(new[1:] & (both[1:] == both[:-1])):  # two digits mixed alike may alternate
            again = np.lexsort((digit, group))
            order, group, digit = order[again], group[again], digit[again]
            new = np.concatenate(([True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])))
        alive = alive[order]
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        alive = alive[~alone]
    return alive, group


class Buckets:
    """Runs of several buckets, sorted together."""

    def __init__(self, window: int):
        self.window = window
        self.clear()

    def clear(self) -> None:
        self.size = 0
        self.several: list[tuple[int, list]] = []
        self.repeats: list[tuple] = []

    def add(self, shards: int, bucket: list[tuple]) -> None:
        """bucket: (s1, s2, owner..., start, n, at, packed). The first of equal runs stays."""
        firsts: dict[tuple[int, int], tuple] = {}
        for s1, s2, *run in bucket:
            had = firsts.get((s1, s2))
            if had is None or run[:5] < had[:5]:
                firsts[s1, s2] = run
        for s1, s2, *run in bucket:
            if run[:5] > firsts[s1, s2][:5]:
                self.repeats.append((*run[:5], run[4] + run[5] + self.window - 1))
        if len(firsts) > 1 or shards > 1:
            self.several.append((shards, list(firsts.values())))
            self.size += sum(f[5] for f in firsts.values())

    def result(self) -> Iterator[pa.RecordBatch]:
        window, runs = self.window, [r for _, own in self.several for r in own]
        *owners, start, stop = list(zip(*self.repeats, strict=True)) or [()] * 6
        if not runs:
            yield _ranges(owners, start, stop)
            return
        *of_run, first, n, at = (np.array(x, np.int64) for x in list(zip(*runs, strict=True))[:7])
        bucket = np.repeat(np.arange(len(self.several)), [len(own) for _, own in self.several])
        parted = np.array([shards > 1 for shards, _ in self.several])
        flat = np.frombuffer(b"".join(r[7] for r in runs), np.uint8)
        run = np.repeat(np.arange(len(runs)), n)
        inner = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        begin = (np.cumsum(n + window - 1) - (n + window - 1))[run] + inner
        # the first digit: the anchor's bucket and its place in the window
        group = bucket[run] * window + (at[run] - inner)
        alive, group = _passes(flat, begin, group, window)
        place = first[run] + inner
        order = np.lexsort((place[alive], *(x[run[alive]] for x in reversed(of_run)), group))
        alive, group = alive[order], group[order]
        leads = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.empty(0, bool)
        gone = alive[~leads]
        both = lambda a, b: np.concatenate([np.array(a, np.int64), b])
        yield _ranges([both(a, x[run[gone]]) for a, x in zip(owners, of_run)], both(start, place[gone]), both(stop, place[gone] + window))
        # of buckets in several shards, the windows that are first in their shard
        left = np.zeros(len(run), bool)
        left[parted[bucket[run]]] = True
        left[gone] = False
        for part in np.array_split(np.flatnonzero(left), max(1, int(left.sum()) // 100_000)):
            if len(part):
                data = memoryview(flat)
                h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[a : a + window]) for a in begin[part].tolist()), np.int64).reshape(-1, 2)
                columns = [pa.array(x[run[part]], _KINDS[c]) for c, x in zip(_OWNER, of_run)]
                columns += [pa.array(place[part], pa.int32()), pa.array(place[part] + window, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, [*_OWNER, "start", "stop", "w1", "w2"])


def _sorted(sent: DataFrame, window: int) -> DataFrame:
    """One bucket after the other: ranges that go; with w1 and w2, windows that other shards may have too."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bucket, held = None, [], Buckets(window)
        for batch in batches:
            for anchor, shard, *run in zip(*(batch.column(c).to_pylist() for c in _KINDS), strict=True):
                if (anchor, shard) != key:
                    if bucket:
                        held.add(key[1] >> 32, bucket)
                    if held.size >= SORTED or len(held.repeats) >= SORTED:
                        yield from held.result()
                        held.clear()
                    key, bucket = (anchor, shard), []
                if run[-1] is None:  # a range that its task has settled
                    held.repeats.append((*run[2:7], run[6] + run[7]))
                else:
                    bucket.append(run)
        if bucket:
            held.add(key[1] >> 32, bucket)
        yield from held.result()

    return sent.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(sort, _RANGES)


def _repeated(chunks: DataFrame, window: int, size: int, buckets: int) -> DataFrame:
    """(chunk, doc, start, stop): bytes of windows that start earlier too, in pieces that may overlap."""
    bits = (max(0, size // (anchor_spacing(window) * ANCHORS))).bit_length()
    answers = _shared(chunks, window, bits).repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits", "places", "shards")).alias("asked"))
    asked = chunks.join(answers, "chunk").select("chunk", "doc_ids", "rows", "ends", "data", "asked", F.lit(bits).alias("bits"))
    found = stored(_sorted(_send(asked, window), window), "ranges")
    windows = found.filter("w1 is not null")
    order = [*_OWNER, "start"]
    least = windows.groupBy("w1", "w2").agg(F.min(F.struct(*order)).alias("least"))
    later = windows.join(least, ["w1", "w2"]).filter(F.struct(*order) > F.col("least"))
    columns = ["chunk", "doc", "start", "stop"]
    return found.filter("w1 is null").select(*columns).unionAll(later.select(*columns))


def anchor_spacing(window: int) -> int:
    """Bytes from one anchor to the next, on average."""
    return max(1, (window - anchor_bytes(window) + 2) // 2)


def remove_repeated_bytes(docs: DataFrame, window: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal runs of removed bytes), text (the
    bytes that stay, as binary: a cut may fall within a character).

    `docs` needs an integer id and a text; other columns are ignored, whatever their names. Texts are their
    UTF-8 bytes. A byte goes if some window of `window` bytes that covers it also starts earlier: in a text of
    a smaller id, or further left in the same text; matches do not cross texts and are judged on the input.
    Null texts are empty; texts shorter than a window stay whole. Rows with a null id stay whole and count for
    no other row. Rows that repeat an id come in the order of their texts' 64-bit hashes (`xxhash64`), equal
    ones one after another, so that of rows that repeat both the first counts. An empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")
    ).withColumn("row", F.xxhash64("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = min(MOST_BUCKETS, size // (BUCKET_CHUNKS * CHUNK) + 1)
    chunks = _bucketed(_chunks(texts), buckets)
    ranges = _repeated(chunks, window, size, buckets).repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("doc", "start", "stop")).alias("ranges"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.slice(k, 1)
                inner = own.column("ranges").flatten()
                row = own.select(["doc_ids", "rows", "ends", "data"]).to_pylist()[0]
                flat, offsets, *_ = _opened(row)
                base = offsets[inner.field("doc").to_numpy()]
                steps = np.zeros(len(flat) + 1, np.int32)
                np.add.at(steps, inner.field("start").to_numpy() + base, 1)
                np.add.at(steps, inner.field("stop").to_numpy() + base, -1)
                gone = np.cumsum(steps[:-1]) > 0
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inside = offsets[:-1][offsets[:-1] < len(flat)]
                begins[inside] = gone[inside]  # a run does not go on from the text before
                left = np.append(0, np.cumsum(~gone))[offsets]
                spans = np.diff(np.append(0, np.cumsum(begins))[offsets])
                sizes = np.diff(offsets)
                text = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(flat[~gone])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(sizes), pa.array(sizes - np.diff(left)), pa.array(spans), text],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "text"],
                )

    return (
        chunks.join(ranges, "chunk", "left")
        .select("doc_ids", "rows", "ends", "data", "ranges")
        .mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, text binary")
    )
