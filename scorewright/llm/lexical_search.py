"""Ranked lexical search without an index of the documents: an Aho-Corasick automaton of all the items'
terms runs over the texts.

Texts are brought to words between single separators (`A-Z` lower-cased, every byte that is no part of a term
made a space), and the automaton holds each item term with a space on both sides: what it finds are whole
terms, never parts of longer ones, and two neighbours share the space between them. A term's number leads
to the items that have it.

1. Each document's tf of the items' terms and its number of terms come out of one scan, into a narrow table.
2. The numbers of documents and terms, and each term's df, are partial sums over that table.
3. Documents are scored in blocks against all items; a task keeps its best for each item, and a window over
   these few ranks them.

Items are taken in blocks of bounded size, each with an automaton of its own, so what is broadcast does not
grow with their number.
"""

from __future__ import annotations

import functools
import itertools
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, chunks_of, lists, stored, worker_cache

#: Bytes of the distinct terms of a block of items, which are broadcast.
BLOCK_BYTES = 1 << 20
#: Scores that a task holds at once (documents times items).
CELLS = 2_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPACE = 32
#: What each byte of a text becomes.
_NORMAL = np.full(256, _SPACE, np.uint8)
for _k in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _NORMAL[_k] = _k
for _k in range(0x41, 0x5B):
    _NORMAL[_k] = _k + 32
#: Key of a null id in comparisons; such a document comes after all others of its score.
_LAST = np.iinfo(np.int64).max


def terms_of(text) -> F.Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_TERM), 0)


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, item_id, terms): the distinct terms of each item over all its rows; and the number of blocks."""
    terms = items.select(F.col(item_col).alias("item_id"), F.explode(terms_of(F.col(text_col).cast("string"))).alias("term"))
    own = stored(terms.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")), "item-terms")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 2)
    total = own.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // block_bytes))
    place = F.pmod(F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit(""))), F.lit(blocks)).cast("int")
    return own.withColumn("block", place), blocks


def _automaton(packed: bytes):
    import ahocorasick

    made = ahocorasick.Automaton()
    for k, term in enumerate(zlib.decompress(packed).split(b"\n")):
        made.add_word(f" {term.decode('latin-1')} ", k)
    made.make_automaton()
    return made


def _occurrences(texts: pa.Array, automaton) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each text: its number of terms, and the numbers and tf of the item terms that it has."""
    flat, offsets = bytes_of(texts)
    spaced = np.append(np.insert(_NORMAL[flat], offsets[:-1], _SPACE), np.uint8(_SPACE))  # one space before each text
    offsets = offsets + np.arange(len(offsets))
    word = spaced != _SPACE
    begins = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    n_terms = np.diff(np.searchsorted(begins, offsets))
    found = np.fromiter(itertools.chain.from_iterable(automaton.iter(spaced.tobytes().decode("latin-1"))), np.int64)
    at = np.searchsorted(offsets, found[::2] - 1, "right") - 1  # a match ends with the space after the term
    pairs, tf = np.unique(at << 32 | found[1::2], return_counts=True)
    cuts = np.searchsorted(pairs >> 32, np.arange(1, len(texts)))
    return n_terms, np.split((pairs & 0xFFFFFFFF).astype(np.int32), cuts), np.split(tf, cuts)


def _scan(texts: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tf) of the documents with at least one term."""
    packed = texts.sparkSession.sparkContext.broadcast(zlib.compress("\n".join(terms).encode()))
    key = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_cache("lexical search", key, lambda: _automaton(packed.value))
        for batch in chunks_of(batches, "text"):
            n, numbers, tf = _occurrences(batch.column("text"), automaton)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), lists(numbers, pa.int32()), lists(tf, pa.int64())],
                ["doc_id", "n", "terms", "tf"],
            ).filter(pa.array(n > 0))

    return texts.mapInArrow(scan, "doc_id long, n long, terms array<int>, tf array<long>")


class Best:
    """The best so many documents of each item among those seen so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.floor = np.ones(items, np.int64)  # a score below this is not among the best
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))

    def see(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """scores[item, document]; `docs` are the documents' ids."""
        floor = self.floor
        if len(docs) > self.top:
            floor = np.maximum(floor, np.partition(scores, len(docs) - self.top, axis=1)[:, len(docs) - self.top])
        item, at = np.nonzero(scores >= floor[:, None])
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, at]), (self.doc, docs[at])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.top
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full = place == self.top - 1
        self.floor[item[full]] = score[full]


def _ranked(found: DataFrame, items: list[tuple[object, list[int]]], weights: np.ndarray, docs: int, total: int, top: int) -> DataFrame:
    """(item, doc_id, score): for each item the best documents of each task."""
    sizes = [len(numbers) for _, numbers in items]
    numbers = np.array([k for _, own in items for k in own], np.int64)
    of_item = np.repeat(np.arange(len(items)), sizes)
    order = np.argsort(numbers, kind="stable")
    # the items of term k are those from starts[k] to starts[k + 1]
    starts = np.searchsorted(numbers[order], np.arange(len(weights) + 1))
    shared = found.sparkSession.sparkContext.broadcast((starts, of_item[order], weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, of_item, weights = shared.value
        best = Best(len(items), top)
        for batch in batches:
            for k in range(0, batch.num_rows, max(1, CELLS // len(items))):
                part = batch.slice(k, max(1, CELLS // len(items)))
                ids = part.column("doc_id")
                doc = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
                n = part.column("n").to_numpy()
                each = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(n)), each)
                term, tf = (part.column(c).flatten().to_numpy() for c in ("terms", "tf"))
                m = 100 - 50 + (50 * n * docs) // total
                worth = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                times = starts[term + 1] - starts[term]
                at = np.repeat(starts[term] - np.cumsum(times) + times, times) + np.arange(times.sum())
                scores = np.zeros(len(items) * len(n), np.int64)
                np.add.at(scores, of_item[at] * len(n) + np.repeat(row, times), np.repeat(worth, times))
                best.see(scores.reshape(len(items), len(n)), doc)
        known = pa.array(best.doc, pa.int64(), mask=best.doc == _LAST)
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), known, pa.array(best.score, pa.int64())], ["item", "doc_id", "score"])

    return found.mapInArrow(score, "item int, doc_id long, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per item and place: item_id, rank (int, from 1), doc_id, score; the `top` documents of each item
    with a score above 0, highest first, equal scores by ascending doc_id.

    Both tables need an id and a text; other columns are ignored, whatever their names. A term is a run of
    ASCII letters and digits and of characters beyond ASCII; only `A-Z` are lower-cased. With N documents
    that have a term, L terms in all, n terms in one document, df documents with a term and tf its
    occurrences there, a term adds w * ((10^9 * tf) div (1000 * tf + 20 * m)), where w is
    floor(1000 * ln((2N + 2) / (2df + 1))) and m is 50 + (50 * n * N) div L; all in 64-bit integers.

    Null texts and texts without terms are no documents of N, and such items have no rows. Rows of one item_id,
    also null, are one item with the terms of all. Each document row counts for itself: rows that repeat an id
    are ranked each, and a null id comes last among equal scores. An empty table on either side gives no rows.
    A block holds one item at least, so an item's own distinct terms should fit in memory.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    blocked, blocks = item_blocks(items, item_col, item_text_col, block_bytes)
    kind = blocked.schema["item_id"].dataType.simpleString()
    parts = []
    for block in range(blocks):
        own = [(r["item_id"], r["terms"]) for r in blocked.filter(F.col("block") == block).select("item_id", "terms").collect()]
        if not own:
            continue
        terms = sorted({t for _, found in own for t in found})
        place = {t: k for k, t in enumerate(terms)}
        found = stored(_scan(texts, terms), "term-counts")
        docs_with, total = found.agg(F.count("*"), F.sum("n")).first()
        if not docs_with:
            break
        df = {r["term"]: r["n"] for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * docs_with + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(terms))], np.int64)
        ranked = _ranked(found, [(i, [place[t] for t in ts]) for i, ts in own], weights, docs_with, total, top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(own)], f"item int, item_id {kind}")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # first within shares of the documents, so that no task reads what all tasks kept for an item
        share = F.pmod(F.xxhash64("doc_id"), F.lit(32))
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item", share).orderBy(*order))).filter(F.col("rank") <= top)
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
        parts.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionAll, parts)
