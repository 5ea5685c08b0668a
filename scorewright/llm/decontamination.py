"""Benchmark decontamination with a positional inverted index of the training texts.

1. Terms of the benchmark are counted over all documents (map-side combine).
2. Each window of an item opens the lists of its rarest terms. The index holds, for the opened terms,
   postings (term, document, position) of every document, written once to the shared folder.
3. A window's lists are intersected from the rarest on: the position of each term less its offset in the
   window must be the same start (phrase) or lie within a slop (proximity).
4. Phrase candidates are compared word by word with their document.

What is sent to all tasks is the benchmark's terms, after a check of their number. Beyond the bound
nothing is broadcast: all words become postings and the shuffle joins of step 3 choose among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_classes, chunks_of, pieces_of, rows_of, stored, word_hashes

#: Terms that may be broadcast: 16 bytes each.
MAX_TERMS = 2_000_000
#: Candidates that may be broadcast to the documents: few bytes each.
MAX_CANDIDATES = 200_000

_KEEP = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() and b < 0x80 else 32 for b in range(256))
#: The same for whole columns.
_CHANGE, _GAPS = np.frombuffer(_KEEP, np.uint8), byte_classes(b" ")


def words(text: bytes | None) -> list[bytes]:
    """Words in lower case: runs of a-z, 0-9 and all that is not ASCII."""
    return text.translate(_KEEP).split() if text is not None else []


def term_ids(found: list[bytes]) -> np.ndarray:
    return word_hashes(found).view(np.int64)


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, item_id, words, terms): each distinct word sequence of `size`, or a whole shorter item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 100):
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words(text)
                n = min(size, len(found))
                sequences = {b" ".join(found[k : k + n]) for k in range(len(found) - n + 1)} if found else ()
                for s in sequences:
                    own = s.split()
                    rows.append((item, np.frombuffer(xxhash.xxh3_128_digest(s), np.int64)[0].item(), s, term_ids(own).tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "window", "words", "terms"])

    return benchmark.mapInArrow(cut, "item_id long, window long, words binary, terms array<long>")


def _broadcast_terms(terms: DataFrame):
    """The terms, sorted, for all tasks; None if there are too many."""
    if terms.count() > MAX_TERMS:
        return None
    values = np.sort(np.array([r[0] for r in terms.collect()], np.int64))
    return terms.sparkSession.sparkContext.broadcast(values)


def _among(ids: np.ndarray, shared) -> np.ndarray:
    """Which ids are among the broadcast terms; all where nothing was broadcast."""
    if shared is None:
        return np.ones(len(ids), bool)
    terms = shared.value
    if not len(terms) or not len(ids):
        return np.zeros(len(ids), bool)
    return terms[np.minimum(np.searchsorted(terms, ids), len(terms) - 1)] == ids


def _terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each word's term, where each text's words start and the last ones end, and the terms' ids:
    words as `words` cuts them, each distinct one hashed once."""
    codes, bounds, values = pieces_of(texts, _GAPS, _CHANGE)
    values = values.to_pylist()
    return codes, bounds, np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values)).view(np.int64)


def _frequencies(texts: DataFrame, shared) -> DataFrame:
    """(term, n): how often the benchmark's terms occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in chunks_of(batches, "text"):
            codes, _, ids = _terms_of(batch.column("text"))
            own = _among(ids, shared)
            held.append((ids[own], np.bincount(codes, minlength=len(ids))[own]))
            rows += len(held[-1][0])
            if rows > 1_000_000:
                yield counted(held)
                held, rows = [], 0
        if held:
            yield counted(held)

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        terms, back = np.unique(np.concatenate([ids for ids, _ in held]), return_inverse=True)
        n = np.zeros(len(terms), np.int64)
        np.add.at(n, back, np.concatenate([n for _, n in held]))
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], ["term", "n"])

    return texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def build_index(texts: DataFrame, shared) -> tuple[DataFrame, DataFrame]:
    """Postings (term, doc_id, row, position) of the shared terms, and (doc_id, row, n_words) of all documents."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text"):
            codes, bounds, ids = _terms_of(batch.column("text"))
            at = np.flatnonzero(_among(ids, shared)[codes])
            ends = np.searchsorted(at, bounds)
            places = at - np.repeat(bounds[:-1], np.diff(ends))
            ends = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(np.diff(bounds).astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(ids[codes[at]])), pa.ListArray.from_arrays(ends, pa.array(places.astype(np.int32))),
                ],
                ["doc_id", "row", "n_words", "terms", "positions"],
            )

    segments = stored(
        texts.select("doc_id", "row", "text").mapInArrow(post, "doc_id long, row long, n_words long, terms array<long>, positions array<int>"),
        "postings",
    )
    postings = segments.select("doc_id", "row", F.explode(F.arrays_zip("terms", "positions")).alias("p")).select(
        F.col("p.terms").alias("term"), "doc_id", "row", F.col("p.positions").alias("position")
    )
    return postings, segments.select("doc_id", "row", "n_words")


def search(windows: DataFrame, postings: DataFrame, frequencies: DataFrame, open_lists: int = 2, slop: int = 0) -> DataFrame:
    """(window, doc_id, row, start, distance): documents where the window's rarest terms stand as in it.

    distance is how far the starts that the terms suggest lie apart; 0 for a phrase candidate, at most
    `slop` for a proximity match.
    """
    anchors = _anchors(windows, frequencies, open_lists)
    found = None
    for rank in range(1, open_lists + 1):
        lists = anchors.filter(F.col("rank") == rank).select("window", "term", "offset", "opened")
        starts = postings.join(lists, "term").select(
            "window", "doc_id", "row", (F.col("position") - F.col("offset")).alias("start"), "opened"
        )
        if found is None:
            found = starts.filter("start >= 0").withColumn("far", F.col("start"))
            continue
        done = found.filter(F.col("opened") < rank)
        if slop:
            other = starts.select("window", F.col("doc_id").alias("other_id"), "row", F.col("start").alias("next"))
            rest = (
                found.filter(F.col("opened") >= rank)
                .join(other, ["window", "row"])
                .filter(F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.abs(F.col("next") - F.col("start")) <= slop))
                .select("window", "doc_id", "row", F.least("start", "next").alias("start"), "opened", F.greatest("far", "next").alias("far"))
                .filter(F.col("far") - F.col("start") <= slop)
                .distinct()
            )
        else:
            keys = ["window", "row", "start"]  # equal texts have equal postings, whatever their ids
            rest = found.filter(F.col("opened") >= rank).join(starts.select(*keys), keys, "left_semi")
        found = done.unionByName(rest)
    return found.select("window", "doc_id", "row", "start", (F.col("far") - F.col("start")).alias("distance"))


def _anchors(windows: DataFrame, frequencies: DataFrame, open_lists: int) -> DataFrame:
    """The rarest terms of each window: (window, rank, term, offset, opened = how many it opens).

    A window with a term that no document holds occurs nowhere and opens no list."""
    places = windows.select("window", "terms").distinct().select("window", F.posexplode("terms").alias("offset", "term"))
    ranked = places.join(frequencies, "term", "left").fillna(0, ["n"])
    each = Window.partitionBy("window")
    return (
        ranked.withColumn("rank", F.row_number().over(each.orderBy("n", "term", "offset")))
        .withColumn("least", F.min("n").over(each))
        .withColumn("opened", F.least(F.count("*").over(each), F.lit(open_lists)))
        .filter((F.col("least") > 0) & (F.col("rank") <= open_lists))
        .select("window", "rank", "term", "offset", "opened")
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    open_lists: int = 2,
    slop: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, row, n_words, n_hit, items) and proximity matches (item_id, doc_id, start, distance).

    Documents: one row per input row; `n_hit` words lie inside an exact occurrence of a window, `items`
    are the sorted ids, as text, of the items whose windows occur; an empty list without any. Both tables
    need an integer id and a text; other columns are ignored, whatever their names. Null texts have no
    words; items without words, or with a null id, match nothing. Null and repeated document ids keep
    their rows; items that repeat an id are one item. Empty tables give no rows, or no hits. With slop 0
    the second table holds the phrase candidates, else the matches whose rarest terms lie up to `slop`
    words out of place.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).withColumn("row", F.xxhash64("text"))
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("binary").alias("text")
    ).filter("item_id is not null and text is not null")
    windows = stored(_windows(items, size), "windows")
    vocabulary = _broadcast_terms(windows.select(F.explode("terms").alias("term")).distinct())
    frequencies = stored(_frequencies(texts.select("text"), vocabulary), "frequencies")
    opened = _anchors(windows, frequencies, open_lists).select("term").distinct()
    postings, sizes = build_index(texts, None if vocabulary is None else _broadcast_terms(opened))
    candidates = stored(search(windows, postings, frequencies, open_lists), "candidates")
    near = candidates if not slop else search(windows, postings, frequencies, open_lists, slop)
    near = near.join(windows.select("window", "item_id"), "window").select("item_id", "doc_id", "start", "distance")

    named = candidates.join(windows.select("window", "item_id", "words"), "window")
    asked = (
        named.groupBy("doc_id", "row", "start", "words")
        .agg(F.collect_set("item_id").alias("items"))
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "words", "items")).alias("asked"))
    )
    asked = stored(asked, "asked")
    asked_docs = F.broadcast(asked) if candidates.count() <= MAX_CANDIDATES else asked
    asked_docs = asked_docs.withColumnRenamed("doc_id", "asked_id").withColumnRenamed("row", "asked_row")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 100):
            hits, found = [], []
            for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                own = words(text)
                hit, items = np.zeros(len(own), bool), set()
                for a in asked:
                    sequence = a["words"].split()
                    end = a["start"] + len(sequence)
                    if own[a["start"] : end] == sequence:
                        hit[a["start"] : end] = True
                        items.update(a["items"])
                hits.append(int(hit.sum()))
                found.append(sorted(map(str, items)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(hits, pa.int64()), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "row", "n_hit", "items"],
            )

    hits = (
        texts.join(asked_docs, (F.col("doc_id").eqNullSafe(F.col("asked_id"))) & (F.col("row") == F.col("asked_row")))
        .select("doc_id", "row", "text", "asked")
        .mapInArrow(compare, "doc_id long, row long, n_hit long, items array<string>")
        .filter("n_hit > 0")
        .dropDuplicates(["doc_id", "row"])
    )
    hits = hits.toDF("hit_id", "hit_row", "n_hit", "items")
    result = sizes.join(hits, (F.col("doc_id").eqNullSafe(F.col("hit_id"))) & (F.col("row") == F.col("hit_row")), "left").select(
        "doc_id", "row", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return result, near
