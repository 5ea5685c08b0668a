"""Language ID by cross-parsing: how few phrases of a language's own text make up a document.

For each language a suffix automaton holds the text of a bounded sample of labelled documents. A document's
words, with a mark at both ends, are parsed greedily: each phrase is the longest match that the automaton
has from there, or one unknown character. The language that needs the fewest phrases wins; the phrases
over the characters parsed are its cross-parsing entropy. Phrases do not cross words, so an automaton of
the sample's distinct words, marked alike, has the same matches as one of its running text, and a worker
parses each word once. The automaton is kept as flat arrays, and many words are parsed at once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_BYTES, LONGEST_KEY, byte_classes, chunks_of, pieces_of, worker_cache

_LETTERS = re.compile(r"[^\W\d_]+")
#: Letters of a word that are parsed as one; what follows is parsed as a word of its own.
LONGEST_WORD = 64
_GAPS = byte_classes(b" \t\n\x0b\x0c\r")


class SuffixAutomaton:
    """All substrings of a text; transitions only, as parsing starts anew after each phrase.

    `keys` holds state * 2^32 + character of each transition in order, `to` the state it leads to."""

    def __init__(self, text: str):
        follow: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in map(ord, text):
            current = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = current
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                if length[q] == length[p] + 1:
                    link[current] = q
                else:
                    clone = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = clone
                        p = link[p]
                    link[q] = link[current] = clone
            last = current
        n = sum(map(len, follow))
        states = np.repeat(np.arange(len(follow), dtype=np.uint64), [len(f) for f in follow])
        keys = states << np.uint64(32) | np.fromiter((c for f in follow for c in f), np.uint64, n)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.to = np.fromiter((t for f in follow for t in f.values()), np.uint32, n)[order]

    def phrases(self, words: list[str]) -> np.ndarray:
        """Longest matches, one after another, that make up each word; an unknown character is one."""
        counts = np.zeros(len(words), np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.append(0, ends[:-1])[: len(words)]
        state = np.zeros(len(words), np.uint64)
        open_ = np.flatnonzero(at < ends)
        while len(open_):
            key = state[open_] << np.uint64(32) | text[at[open_]]
            place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            found = self.keys[place] == key if len(self.keys) else np.zeros(len(key), bool)
            start = state[open_] == 0
            counts[open_] += ~found  # a phrase ends before this character, or the character is unknown
            at[open_] += found | start
            state[open_] = np.where(found, self.to[place] if len(self.to) else 0, 0)
            open_ = open_[at[open_] < ends[open_]]
        return counts + (state != 0)


def marked_words(text: str) -> list[str]:
    words = [w for w in _LETTERS.findall(text.lower()) if any(map(str.isalpha, w))]
    return [f" {w[k : k + LONGEST_WORD]} " for w in words for k in range(0, len(w), LONGEST_WORD)]


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_docs: int = 150) -> dict[str, str]:
    """Language -> the distinct words of about `sample_docs` whole texts of it, each between marks.

    Which texts are in the sample follows from a hash of their ids, over all rows. Rows without a
    language, text or id are not learned from.
    """
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)).alias("draw"),
        F.col(id_col).isNotNull().alias("known"),
    ).filter("lang is not null and text is not null and known")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, sample_docs / n) * (1 << 30)))])
    words: dict[str, set] = {lang: set() for lang in sizes}
    for row in rows.filter(F.col("draw") <= share[F.col("lang")]).select("lang", "text").collect():
        words[row["lang"]].update(marked_words(row["text"]))
    return {lang: "".join(sorted(own)) for lang, own in words.items() if own}


class Parser:
    """Phrases by language, and the letters, of whole Arrow columns; remembers the pieces it has met."""

    def __init__(self, automata: list[SuffixAutomaton]):
        self.automata = automata
        self.width = len(automata) + 1
        self.limit = CACHE_BYTES // (200 + 4 * self.width)
        self.place: dict[bytes, int] = {}
        self.known = np.empty((0, self.width), np.int32)

    def _parsed(self, pieces: list[bytes]) -> np.ndarray:
        words = [marked_words(p.decode()) for p in pieces]
        flat = [w for own in words for w in own]
        at = np.repeat(np.arange(len(pieces)), [len(own) for own in words])
        out = np.zeros((len(pieces), self.width), np.int64)
        for k, automaton in enumerate(self.automata):
            np.add.at(out[:, k], at, automaton.phrases(flat))
        np.add.at(out[:, -1], at, np.fromiter(map(len, flat), np.int64, len(flat)))
        return out

    def numbers(self, texts: pa.Array) -> np.ndarray:
        """For each text, the phrases by language, then the letters with their marks."""
        codes, bounds, values = pieces_of(texts, _GAPS)
        values = values.to_pylist()
        places = np.fromiter((self.place.get(v, -1) for v in values), np.int64, len(values))
        numbers = np.zeros((len(values), self.width), np.int64)
        old, new = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        numbers[old] = self.known[places[old]]
        if len(new):
            numbers[new] = self._parsed([values[k] for k in new])
            kept = [k for k in new.tolist() if len(values[k]) <= LONGEST_KEY]
            if len(self.place) + len(kept) > self.limit:
                self.place, self.known = {}, self.known[:0]
                kept = kept[: self.limit]
            self.place.update(zip((values[k] for k in kept), range(len(self.known), len(self.known) + len(kept))))
            self.known = np.concatenate([self.known, numbers[kept].astype(np.int32)])
        total = np.zeros(len(codes) + 1, np.int64)
        found = np.empty((len(texts), self.width), np.int64)
        for k in range(self.width):  # one column at a time: there are as many codes as pieces
            np.cumsum(numbers[codes, k], out=total[1:])
            found[:, k] = np.diff(total[bounds])
        return found


def _judge(langs: list[str], numbers: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, np.ndarray]:
    """lang_pred, score, entropy, and which texts have letters."""
    phrases, letters = numbers[:, :-1], numbers[:, -1]
    some = letters > 0
    told = some if langs else np.zeros(len(some), bool)
    if langs:
        least = phrases.min(axis=1)
        best = np.array(langs, object)[phrases.argmin(axis=1)]
        score = 1 / np.exp(np.maximum(least[:, None] - phrases, -700.0)).sum(axis=1)
        entropy = least / np.maximum(letters, 1)
    else:
        best, score, entropy = np.full(len(some), "und", object), np.zeros(len(some)), np.zeros(len(some))
    return (
        pa.array(np.where(told, best, "und"), pa.string()),
        pa.array(np.where(told, score, 0.0), pa.float64()),
        pa.array(entropy, pa.float64(), mask=~told),
        some,
    )


def _judged(docs: DataFrame, model: dict[str, str], text: str, judge, schema: str) -> DataFrame:
    langs = sorted(model)
    shared = docs.sparkSession.sparkContext.broadcast([SuffixAutomaton(model[lang]) for lang in langs])
    key = f"parser {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_cache("language id", key, lambda: Parser(shared.value))
        for batch in chunks_of(batches, text):
            yield judge(batch, *_judge(langs, parser.numbers(batch.column(text))))

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, entropy (phrases a character of the best language).

    `docs` needs an id and a text; other columns are ignored, whatever their names. Whole texts are
    parsed. A null text, one without letters, and every text where no language was learned, gives `und`
    with score 0 and a null entropy. Equal numbers of phrases give the language that sorts first. The
    score is the winner's share when each phrase more costs a factor of e. Null and repeated ids keep
    their rows; an empty table gives no rows. The model is bounded by `fit`'s parameters a language.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def judge(batch: pa.RecordBatch, best, score, entropy, some) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), best, score, entropy], ["doc_id", "lang_pred", "score", "entropy"])

    return _judged(texts, model, "text", judge, "doc_id long, lang_pred string, score double, entropy double")


def keep_told(docs: DataFrame, model: dict[str, str], text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all their columns unchanged, whose language `predict` tells, in one pass over them.

    Where no language was learned nothing can be told, and all texts with letters stay. Rows with a null
    text go. The text is a string column.
    """

    def judge(batch: pa.RecordBatch, best, score, entropy, some) -> pa.RecordBatch:
        told = np.array([b != "und" for b in best.to_pylist()], bool) if model else some
        return batch.filter(pa.array(told, pa.bool_()))

    return _judged(docs, model, text_col, judge, docs.schema)


def held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4):
    """True for ids kept from learning: crc32 of the id as text leaves this remainder. Null ids: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
