"""Phrase collocations and counting quotient filters against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scorewright.llm import collocations, quotient_filter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, percent, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, p), a in often.items():
        longer = [b for (x, q), b in often.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= percent * a for b in longer):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    out = []
    for lang, own in found.items():
        out += [(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(own)[:top])]
    return sorted(out)


def cases(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abéZ\x00'") for _ in range(rng.randint(1, 3))) for _ in range(12)] + ["rare%d" % k for k in range(300)]
    gaps = [" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\x0b", " ; "]
    rows = []
    for _ in range(n):
        some = [rng.choice(words if rng.random() < 0.2 else words[:12]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.4:
            some[3:3] = ["New", "york", "City", "hall"][: rng.choice([2, 3, 4])]
        rows.append((rng.choice(["en", "fr", None, "und"]), "".join(w + rng.choice(gaps) for w in some)))
    rows += [("en", None), (None, ""), ("xx", " .,; "), ("yy", "lonely"), rows[0], rows[0], ("en", "same same " * 400), ("en", "x" * 5000 + " a")]
    return rows


@pytest.fixture
def docs(spark):
    def make(rows):
        full = [(k % 7, t, x, "s", 1, "y") for k, (x, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, word string, n long, phrase string").repartition(3)

    return make


@pytest.mark.parametrize("seed,least,percent,top", [(1, 5, 80, 2000), (2, 3, 50, 7), (3, 30, 80, 2000)])
def test_collocations_are_brute_force(docs, seed, least, percent, top):
    rows = cases(seed)
    found = collocations.mine(docs(rows), least=least, percent=percent, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, least, percent, top)


def test_collocations_in_many_shards_and_rounds(docs, monkeypatch):
    """Filters of a few runs, shards parted by two bits a round, and most words beyond the broadcast table."""
    monkeypatch.setattr(collocations, "GRAMS", 64)
    monkeypatch.setattr(collocations, "ROUND_BITS", 2)
    monkeypatch.setattr(collocations, "TABLE_WORDS", 5)
    monkeypatch.setattr(collocations, "NUMBERED", 4)
    monkeypatch.setattr(collocations, "HELD_WORDS", 10)
    rows = cases(5, 60)
    found = collocations.mine(docs(rows), least=3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 3, 80, 2000)


def test_table_of_long_words_is_cut(docs, monkeypatch):
    monkeypatch.setattr(collocations, "TABLE_BYTES", 20)
    rows = cases(6, 40)
    found = collocations.mine(docs(rows), least=3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 3, 80, 2000)


def test_no_collocations(docs):
    assert collocations.mine(docs([])).count() == 0
    assert collocations.mine(docs([("en", None), (None, "one two")])).count() == 0
    assert collocations.mine(docs([("en", "a. a. a. ")]), least=2).count() == 0


@pytest.mark.parametrize("n,id_bits,lang_bits", [(2, 1, 1), (2, 17, 2), (3, 17, 2), (4, 14, 2), (4, 17, 2), (3, 24, 5), (4, 28, 8)])
def test_quotient_filters_are_a_round_trip(n, id_bits, lang_bits):
    rng = np.random.default_rng(n * id_bits)
    layout = quotient_filter.Layout(n, id_bits, lang_bits)
    words = [rng.integers(0, 1 << id_bits, 3000, dtype=np.uint64) for _ in range(n)]
    lang = rng.integers(0, 1 << lang_bits, 3000)
    top, low = layout.pack(words, lang)
    back, langs = layout.unpack(top, low)
    assert (back == np.stack(words, 1).astype(np.int64)).all() and (langs == lang).all()
    times = rng.integers(1, 1000, 3000)
    distinct = quotient_filter.counted(top, low, times)
    expected = Counter()
    for key, k in zip(zip(*(w.tolist() for w in words), lang.tolist()), times.tolist()):
        expected[key] += k
    for bits in (0, 3):
        found = Counter()
        for _, shard, data in collocations._cut(layout, min(bits, layout.bits), n, *distinct):
            t, lo, counts = quotient_filter.read(layout, shard, data)
            w, x = layout.unpack(t, lo)
            found.update({(*a, b): c for a, b, c in zip(w.tolist(), x.tolist(), counts.tolist())})
        assert found == expected


def test_quotient_filter_is_compact():
    layout = quotient_filter.Layout(3, 17, 2)
    rng = np.random.default_rng(1)
    top, low = layout.pack([rng.integers(0, 1 << 17, 100_000, dtype=np.uint64) for _ in range(3)], np.zeros(100_000))
    own = quotient_filter.counted(top, low)
    assert len(quotient_filter.written(layout, 0, *own)) < 7 * len(own[0])
