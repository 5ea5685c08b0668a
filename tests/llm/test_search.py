"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from scorewright.llm import lexical_search

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_ranks(rows, items, top):
    docs = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    count, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    own = defaultdict(set)
    for i, t in items:
        own[i].update(terms(t))
    out = []
    for item, wanted in own.items():
        scored = []
        for i, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * count) // total
            score = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def cases(seed, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé1") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    gaps = [" ", "  ", ", ", "\n", "-", "\x0b", "\x7f", "_"]
    make = lambda size: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(size))
    rows = [(k, rng.choice([str.upper, str, str.title])(make(rng.randint(0, 40)))) for k in range(n)]
    rows += [(900, None), (901, ""), (902, " ,;-"), (None, rows[3][1]), (None, rows[5][1]), (7, rows[7][1]), (7, rows[7][1]), (903, rows[3][1])]
    rows += [(904, make(5000)), (905, "Ä ä Ç \u00a0x日本 " + words[0]), (906, words[1])]
    items = [(k, make(rng.randint(1, 12))) for k in range(12)] + [(50, None), (51, ""), (52, "zzzz unseen"), (None, words[2]), (53, words[1]), (53, words[4] + " Ä")]
    return rows, items


@pytest.mark.parametrize("top,block", [(50, 1 << 20), (3, 1 << 20), (3, 64)])
def test_ranks_are_brute_force(spark, documents, monkeypatch, top, block):
    monkeypatch.setattr(lexical_search, "CELLS", 300)
    rows, items = cases(top)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, term string, score int")
    found = lexical_search.rank_documents(documents(rows), table, top, block_bytes=block)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_ranks(rows, items, top)


def test_blocks_hold_every_item_once(spark):
    items = spark.createDataFrame([(k, f"word{k} other{k}") for k in range(100)], "item_id long, text string")
    blocked, blocks = lexical_search.item_blocks(items, "item_id", "text", 300)
    rows = blocked.collect()
    assert blocks > 5 and len(rows) == 100 and {r["block"] for r in rows} <= set(range(blocks))


def test_empty_search(spark, documents):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.rank_documents(documents([]), items).count() == 0
    assert lexical_search.rank_documents(documents([(1, "a")]), items.limit(0)).count() == 0
    assert lexical_search.rank_documents(documents([(1, None)]), items).count() == 0
