"""Phrase collocations: exact counts of word n-grams in counting quotient filters, then scores and ranks.

1. Words are counted per language (a task adds up before it sends). Only words that occur often enough can
   be part of a frequent phrase: those get numbers, the others end a run of words as a mark does.
2. Each task cuts its texts into words and marks, looks up the numbers of the distinct words of a chunk at
   once, and packs all runs of 2 to `longest` numbers with their language into permuted numbers. Sorted and
   counted they make quotient filters, one for each shard of the permuted numbers, which travel as bytes.
3. The filters of a shard are merged by their order; shards are even, as a permutation spreads them, and a
   phrase in a third of all texts is one slot of each filter. With very many shards the merge goes in
   several rounds, each by the next bits, so that filters never become small.
4. Phrases that are frequent enough are restored to word numbers; cuts, scores and the containment rule are
   joins among these.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_classes, chunks_of, pieces_of, stored, worker_cache
from .quotient_filter import Layout, counted, read, written

#: The most frequent words whose numbers are broadcast: so many, and so many bytes of them, at most.
TABLE_WORDS, TABLE_BYTES = 400_000, 8 << 20
#: Runs of words that a task holds before it writes filters, and that a shard has at most, as expected.
GRAMS = 1 << 20
#: Bits of a shard's number by which one round of merging parts the filters.
ROUND_BITS = 10
#: Distinct words that a task counts before it sends them on.
HELD_WORDS = 500_000
#: Words of a bucket in which words beyond the broadcast ones are numbered.
NUMBERED = 10_000

_MARKS = b".,;:!?\n\x0b\x0c\r"
_CLASSES = byte_classes(b" \t", bytes(set(range(256)) - set(_MARKS + b" \t")), _MARKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FILTERS = "n int, shard long, filter binary"
_FOUND = "lang int, phrase array<int>, a long"


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("text is not null and text <> ''")


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, own in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(list(own.values()), pa.int64())],
                    ["lang", "word", "n"],
                )
            held.clear()

        for batch in chunks_of(batches, "text"):
            langs = batch.column("lang").dictionary_encode()
            codes, bounds, values = pieces_of(batch.column("text"), _CLASSES, _LOWER)
            of_piece = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
            names = langs.dictionary.to_pylist()
            for k, name in enumerate(names):
                times = np.bincount(codes[of_piece == k] if len(names) > 1 else codes, minlength=len(values))
                some = np.flatnonzero(times)
                words = values.take(pa.array(some)).to_pylist()
                held.setdefault(name, Counter()).update({w: n for w, n in zip(words, times[some].tolist(), strict=True) if w[0] not in _MARKS})
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from sent()
        yield from sent()

    parts = rows.mapInArrow(count, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _numbered(words: DataFrame, first: int) -> DataFrame:
    """(word, id): consecutive numbers from `first` on, given in buckets of words, so no task sees all."""
    buckets = max(1, -(-words.count() // NUMBERED))
    placed = words.select("word", F.pmod(F.xxhash64("word"), F.lit(buckets)).alias("bucket"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over one row a bucket
    starts = placed.groupBy("bucket").agg(F.count("*").alias("size")).select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("word"))
    return placed.withColumn("place", place).join(starts, "bucket").select("word", (F.lit(first - 1) + F.col("start") + F.col("place")).cast("int").alias("id"))


def _vocabulary(words: DataFrame) -> tuple[DataFrame, bytes, int, DataFrame | None]:
    """(word, id) of all words, ids from 1 on; the broadcast table of the most frequent ones; how many words
    there are; and the (word, id) of the others, None if there are none."""
    total, size = words.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    table = min(TABLE_WORDS, total if size <= TABLE_BYTES else max(1, total * TABLE_BYTES // (2 * size)))
    often = [r["word"] for r in words.orderBy(F.desc("n"), "word").limit(table).collect()]
    while sum(len(w.encode()) for w in often) > TABLE_BYTES:  # long ones are among the frequent
        often = often[: len(often) // 2]
    spark = words.sparkSession
    packed = zlib.compress("\n".join(often).encode(), 1)  # a word has no line end
    known = spark.createDataFrame(list(zip(often, range(1, len(often) + 1))), "word string, id int")
    known = stored(known, "words")
    if len(often) == total:
        return known, packed, total, None
    rest = stored(_numbered(words.join(known, "word", "left_anti"), len(often) + 1), "words")
    return known.unionAll(rest), packed, total, rest


def _table(packed: bytes) -> pa.Array:
    text = zlib.decompress(packed)
    return pa.array(text.split(b"\n") if text else [], pa.binary())


def _with_rest(rows: DataFrame, rest: DataFrame | None, packed) -> DataFrame:
    """Adds `rest`, the numbers of those words of a text that are not broadcast: only they are shuffled."""
    kind, name = "map<string,int>", uuid.uuid4().hex
    if rest is None:
        return rows.withColumn("rest", F.lit(None).cast(kind))
    rows = rows.withColumn("key", F.md5(F.col("text").cast("binary")))

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("collocations", name, lambda: _table(packed.value))
        for batch in chunks_of(batches, "text"):
            codes, bounds, values = pieces_of(batch.column("text"), _CLASSES, _LOWER)
            new = pc.is_null(pc.index_in(values, value_set=table)).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            pairs = np.unique(row[new[codes]] << 32 | codes[new[codes]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(pairs >> 32)), values.take(pa.array(pairs & 0xFFFFFFFF)).cast(pa.string())], ["key", "word"]
            )

    asked = rows.select("key", "text").mapInArrow(unknown, "key string, word string").distinct()
    found = asked.join(rest, "word").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("word", "id"))).alias("rest"))
    return rows.join(found, "key", "left").drop("key")


def _cut(layout: Layout, bits: int, n: int, top, low, counts) -> Iterator[tuple[int, int, bytes]]:
    """A sorted list cut at the shards' borders."""
    shard = top >> np.uint64(64 - bits) if bits else np.zeros(len(top), np.uint64)
    edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(top)] if len(top) else []
    for i, j in zip(edges, edges[1:]):
        yield n, int(shard[i]), written(layout, bits, top[i:j], low[i:j], counts[i:j])


def _batch(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    n, shard, data = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(shard, pa.int64()), pa.array(data, pa.binary())], ["n", "shard", "filter"])


def _filters(rows: DataFrame, packed, langs: list[str], layouts: dict[int, Layout], bits: int) -> DataFrame:
    """Quotient filters of all runs of words, each of one task and one shard."""
    of_lang = {lang: k for k, lang in enumerate(langs)}
    longest, name = max(layouts), uuid.uuid4().hex

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("collocations", name, lambda: _table(packed.value))
        held: dict[int, list] = {n: [] for n in layouts}
        size = dict.fromkeys(layouts, 0)

        def sent(n: int) -> Iterator[pa.RecordBatch]:
            if held[n]:
                top, low = (np.concatenate(x) for x in zip(*held[n]))
                yield _batch(list(_cut(layouts[n], bits, n, *counted(top, low))))
            held[n], size[n] = [], 0

        for batch in chunks_of(batches, "text"):
            codes, bounds, values = pieces_of(batch.column("text"), _CLASSES, _LOWER)
            ids = pc.fill_null(pc.add(pc.index_in(values, value_set=table), 1), 0).to_numpy(zero_copy_only=False).astype(np.uint64)
            extra = {w.encode(): k for own in batch.column("rest").to_pylist() if own for w, k in own}
            if extra:
                for k in np.flatnonzero(ids == 0).tolist():
                    ids[k] = extra.get(values[k].as_py(), 0)
            # a zero, which no run of words crosses, stands before each text
            words = np.insert(ids[codes], bounds[:-1], np.uint64(0))
            lang = np.repeat([of_lang.get(x, 0) for x in batch.column("lang").to_pylist()], np.diff(bounds) + 1)  # without words there is none
            place = np.arange(len(words))
            run = place - np.maximum.accumulate(np.where(words == 0, place, -1))
            for n in range(2, longest + 1):
                end = np.flatnonzero(run >= n)
                if not len(end):
                    continue
                held[n].append(layouts[n].pack([words[end - n + 1 + k] for k in range(n)], lang[end]))
                size[n] += len(end)
                if size[n] >= GRAMS:
                    yield from sent(n)
        for n in layouts:
            yield from sent(n)

    return rows.mapInArrow(build, _FILTERS)


def _merged(filters: DataFrame, layouts: dict[int, Layout], had: int, bits: int) -> DataFrame:
    """Filters cut by `had` bits, merged within these and cut by `bits`."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            if held:
                yield _batch(list(_cut(layouts[key[0]], bits, key[0], *counted(*map(np.concatenate, zip(*held))))))

        for batch in batches:
            for n, shard, data in zip(*(batch.column(c) for c in ("n", "shard", "filter")), strict=True):
                if (n.as_py(), shard.as_py()) != key or size >= GRAMS:
                    yield from sent()
                    key, held, size = (n.as_py(), shard.as_py()), [], 0
                held.append(read(layouts[key[0]], key[1], data.as_py()))
                size += len(held[-1][0])
        yield from sent()

    return _by_shard(filters, had, len(layouts)).mapInArrow(merge, _FILTERS)


def _by_shard(filters: DataFrame, bits: int, lengths: int) -> DataFrame:
    tasks = max(lengths * (1 << bits) // 8, filters.sparkSession.sparkContext.defaultParallelism)
    return filters.repartition(tasks, "n", "shard").sortWithinPartitions("n", "shard")


def _frequent(filters: DataFrame, layouts: dict[int, Layout], bits: int, least: int) -> DataFrame:
    """(lang, phrase, a) of all runs that occur `least` times or more: the last merge, one shard after the other."""

    def finish(key: tuple, held: list) -> pa.RecordBatch:
        top, low, counts = counted(*map(np.concatenate, zip(*held)))
        often = counts >= least
        words, lang = layouts[key[0]].unpack(top[often], low[often])
        ends = pa.array(np.arange(len(words) + 1, dtype=np.int32) * key[0], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(words.ravel().astype(np.int32), pa.int32())), pa.array(counts[often], pa.int64())],
            ["lang", "phrase", "a"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            for n, shard, data in zip(*(batch.column(c) for c in ("n", "shard", "filter")), strict=True):
                if (n.as_py(), shard.as_py()) != key:
                    if held:
                        yield finish(key, held)
                    key, held, size = (n.as_py(), shard.as_py()), [], 0
                held.append(read(layouts[key[0]], key[1], data.as_py()))
                size += len(held[-1][0])
                if size >= 2 * GRAMS:  # equal numbers become one
                    held = [counted(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
        if held:
            yield finish(key, held)

    return _by_shard(filters, bits, len(layouts)).mapInArrow(merge, _FOUND)


def count_phrases(rows: DataFrame, words: DataFrame, langs: list[str], total: int, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a), lang as its place in `langs` and the phrase as word numbers, of all phrases of 1 to
    `longest` words that occur `least` times or more; and (word, id). `words` are (lang, word, n) that occur
    as often, `total` is the number of all word occurrences."""
    vocabulary, table, size, rest = _vocabulary(words.groupBy("word").agg(F.sum("n").alias("n")))
    of_lang = rows.sparkSession.createDataFrame([(k, lang) for k, lang in enumerate(langs)], "code int, lang string")
    single = words.join(of_lang, "lang").join(vocabulary, "word").select(F.col("code").alias("lang"), F.array("id").alias("phrase"), F.col("n").alias("a"))
    layouts = {n: Layout(n, max(1, size.bit_length()), max(1, (len(langs) - 1).bit_length())) for n in range(2, longest + 1)}
    final = min((total // GRAMS).bit_length(), *(layout.bits for layout in layouts.values()))
    steps = [*range(ROUND_BITS, final, ROUND_BITS), final]
    packed = rows.sparkSession.sparkContext.broadcast(table)
    filters = _filters(_with_rest(rows, rest, packed), packed, langs, layouts, steps[0])
    for had, bits in zip(steps, steps[1:]):
        filters = _merged(filters, layouts, had, bits)
    often = _frequent(filters, layouts, final, least)
    return stored(often.unionAll(single), "phrases"), vocabulary


def _scored(phrases: DataFrame) -> DataFrame:
    """Candidates with a, l, r and score: the lowest-scoring cut, the smallest k among equals."""
    cut = F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")
    cuts = phrases.filter("size(phrase) > 1").select("lang", "phrase", "a", cut)
    cuts = cuts.withColumns({"left": F.expr("slice(phrase, 1, k)"), "right": F.expr("slice(phrase, k + 1, size(phrase) - k)")})
    of = lambda side, name: phrases.select(F.col("lang"), F.col("phrase").alias(side), F.col("a").alias(name))
    both = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    score = F.expr("cast((cast(2000000 as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    least = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of candidates that stand within a longer one which is almost as frequent."""
    starts = F.explode(F.expr("flatten(transform(sequence(2, size(phrase) - 1), n -> transform(sequence(1, size(phrase) - n + 1), s -> slice(phrase, s, n))))"))
    parts = phrases.filter("size(phrase) > 2").select("lang", F.col("a").alias("longer"), starts.alias("phrase"))
    most = parts.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    exact = "decimal(22,0)"
    return phrases.join(most, ["lang", "phrase"]).filter((F.lit(100).cast(exact) * F.col("longer") >= F.lit(percent).cast(exact) * F.col("a"))).select("lang", "phrase")


def mine(
    docs: DataFrame, longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """One row per language and place: lang, rank (from 1), phrase, a, l, r, n, score; the `top` phrases of each
    language by score and a, both descending, then the phrase in the order of its UTF-8 bytes.

    `docs` needs a language and a text; other columns are ignored, whatever their names. `A-Z` are lower-cased;
    texts are cut at `.,;:!?` and line ends, then at spaces and tabs into words. Phrases are 2 to `longest`
    words in a row that occur a >= `least` times; n counts all words of the language. The cut after k words
    with the lowest floor(2000000 * a / (l + r)) counts. A phrase goes if a longer candidate holds it and
    occurs in `percent` % of its places or more. A null language is `und`; null and empty texts and texts of
    marks alone have no words. Repeated rows count each. An empty table gives no rows. Languages are numbered
    on the driver, one row each. At least two words make a phrase, so `longest` is 2 or more.
    """
    rows = _rows(docs, lang_col, text_col)
    words = stored(_word_counts(rows), "word-counts")
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    spark = docs.sparkSession
    often = words.filter(F.col("n") >= least)
    if often.isEmpty():
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    phrases, vocabulary = count_phrases(rows, often, langs, sum(totals.values()), longest, least)
    candidates = _scored(phrases).join(_covered(phrases.filter("size(phrase) > 1"), percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a")]
    first = candidates.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top)
    first = stored(first.drop("place"), "candidates")
    spelled = (
        first.select("lang", "phrase", F.posexplode("phrase").alias("at", "id"))
        .join(vocabulary, "id")
        .groupBy("lang", "phrase")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("lang", "phrase", F.concat_ws(" ", F.col("words.word")).alias("text"))
    )
    names = spark.createDataFrame([(k, lang, totals[lang]) for k, lang in enumerate(langs)], "lang int, name string, n long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "text"))
    return (
        first.join(spelled, ["lang", "phrase"])
        .withColumn("rank", place.cast("long"))
        .filter(F.col("rank") <= top)
        .join(names, "lang")
        .select(F.col("name").alias("lang"), "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
    )
