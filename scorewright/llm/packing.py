"""Packing of documents into sequences: first-fit decreasing in randomised groups.

Every document is turned into its token ids in the map task and sent, by a hash of its place, to one of
so many groups that a group holds about `group_docs` documents. A group packs alone: full sequences are
cut off its long documents, the rests go to bins in decreasing length, each into the first bin that has
room, found in a tournament tree of the bins' free room. Then the least filled bins are taken apart and
their pieces cut to fill the gaps of the others. What is left, less than one sequence for each group, is
cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_of, rows_of
from .tokens import encoder, load

#: Documents of a group, on average.
GROUP_DOCS = 512
#: Groups that a task packs, one after the other.
TASK_GROUPS = 32


class Tournament:
    """Free room of bins 0..n-1 in a complete binary tree; an inner node holds its children's larger one."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [room] * (2 * self.leaves)

    def first(self, length: int) -> int:
        """The first bin with room for `length`; there is one, as bins are as many as items."""
        at = 1
        while at < self.leaves:
            at *= 2
            if self.tree[at] < length:
                at += 1
        return at - self.leaves

    def take(self, bin_: int, length: int) -> None:
        at = bin_ + self.leaves
        self.tree[at] -= length
        while at > 1:
            at //= 2
            self.tree[at] = max(self.tree[2 * at], self.tree[2 * at + 1])


def pack(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (item, start, length, sequence, offset) of items of these lengths, each token in one piece."""
    placed, sequences = [], 0
    rests = []
    for item, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            placed.append((item, start, size, sequences, 0))
            sequences += 1
        if n % size:
            rests.append((n % size, item, n - n % size))
    rests.sort(key=lambda x: (-x[0], x[1]))
    tree = Tournament(len(rests), size)
    bins: list[list[tuple[int, int, int]]] = []  # pieces (item, start, length)
    for n, item, start in rests:
        k = tree.first(n)
        tree.take(k, n)
        if k == len(bins):
            bins.append([])
        bins[k].append((item, start, n))
    filled = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda k: (-filled[k], k))
    full = sum(filled) // size  # so many stay; the others' pieces fill them up
    loose = [p for k in reversed(order[full:]) for p in bins[k]][::-1]
    for k in order[:full]:
        own, room = bins[k], size - filled[k]
        while room:
            item, start, n = loose.pop()
            cut = min(n, room)
            own.append((item, start, cut))
            room -= cut
            if cut < n:
                loose.append((item, start + cut, n - cut))
        offset = 0
        for item, start, n in own:
            placed.append((item, start, n, sequences, offset))
            offset += n
        sequences += 1
    left = sum(p[2] for p in loose)
    while left:
        target = 1 << (left.bit_length() - 1)
        left -= target
        offset = 0
        while offset < target:
            item, start, n = loose.pop()
            cut = min(n, target - offset)
            placed.append((item, start, cut, sequences, offset))
            offset += cut
            if cut < n:
                loose.append((item, start + cut, n - cut))
        sequences += 1
    return placed


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens,
    sequence_id, offset.

    A document is its ids without special tokens, then `end_id`. `docs` needs an id and a text; other
    columns are ignored, whatever their names. A null or empty text is the end id alone. Null and repeated
    ids keep their rows: each row is packed as a document of its own. Sequences are full but for those of
    a power of two. An empty table gives no rows. Rows are dealt to groups by their place in the input, so
    the input should be a scan or a written table.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    groups = max(1, -(-texts.count() // group_docs))
    # so many groups that a task sorts some 50 MB of ids; more tasks where the machines would else be idle
    tasks = max(-(-groups // TASK_GROUPS), min(groups, docs.sparkSession.sparkContext.defaultParallelism))
    kind = np.dtype("<u2" if load(tokenizer_path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder("packing", tokenizer_path)
        for batch in chunks_of(batches, "text"):
            ids, bounds = own.encode(batch.column("text"), end_id)
            ids = ids.astype(kind, copy=False)
            offsets = pa.py_buffer((bounds * kind.itemsize).astype(np.int32))
            packed = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("doc_id"), packed], ["group", "doc_id", "ids"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One group after the other, sorted by group."""
        key, members = None, []
        for batch in rows_of(batches):
            for group, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("group", "doc_id", "ids")), strict=True):
                if group != key:
                    if members:
                        yield from _pieces(key, members, size, kind)
                    key, members = group, []
                members.append((doc_id, ids))
        if members:
            yield from _pieces(key, members, size, kind)

    place_in_input = F.monotonically_increasing_id()
    return (
        texts.select(F.pmod(F.xxhash64("doc_id", place_in_input), F.lit(groups)).alias("group"), "doc_id", "text")
        .mapInArrow(encode, "group long, doc_id long, ids binary")
        .repartition(tasks, "group")
        .sortWithinPartitions("group")
        .mapInArrow(place, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    )


def _pieces(group: int, members: list[tuple[int, bytes]], size: int, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """The group's pieces; their ids are widened to 32 bits."""
    members = [(doc_id, np.frombuffer(ids, kind)) for doc_id, ids in members]
    placed = pack([len(ids) for _, ids in members], size)
    for k in range(0, len(placed), 1000):
        rows = [
            (members[i][0], start, n, members[i][1][start : start + n].astype("<u4").tobytes(), len(members[i][1]), (group << 32) + s, offset)
            for i, start, n, s, offset in placed[k : k + 1000]
        ]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
