"""Suffix-array dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import suffix_radix


def brute(rows, window):
    """rows: (doc_id, row hash, text); equal rows come one after another."""
    first = {}
    for place, (doc_id, row, text) in enumerate(rows):
        b = (text or "").encode()
        for k in range(len(b) - window + 1) if doc_id is not None else ():
            t = b[k : k + window]
            first[t] = min(first.get(t, (doc_id, row, place, k)), (doc_id, row, place, k))
    out = []
    for place, (doc_id, row, text) in enumerate(rows):
        b = (text or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - window + 1) if doc_id is not None else ():
            if first[b[k : k + window]] < (doc_id, row, place, k):
                gone[k : k + window] = [True] * window
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def cases(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé日 ") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    passage = "".join(rng.choice(words) for _ in range(40))
    rows = []
    for k in range(n):
        text = "".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        if k % 3 == 0:
            at = rng.randint(0, len(text))
            text = text[:at] + passage[rng.randint(0, 30) :] + text[at:]
        if k % 7 == 0 and rows:
            own = rows[rng.randrange(len(rows))][1] or ""
            text = own[:50] + "~" + own[50:]
        if k % 11 == 0:
            text += text
        rows.append((k, text))
    rows += [(1000, None), (1001, ""), (1002, "ab" * 300), (1003, "a" * 700), (999, "a" * 500 + "b"), (None, rows[5][1]), (None, None)]
    rows += [(3, rows[8][1]), (3, rows[3][1]), (3, rows[3][1]), (-5, rows[9][1] + "x"), (1004, "\x00" * 150)]
    return rows


def found_and_expected(documents, rows, window):
    table = documents(rows)
    keyed = [tuple(r) for r in table.select("doc_id", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")), "text").collect()]
    found = suffix_radix.remove_repeated_bytes(table, window).collect()
    return sorted(((*r[:4], bytes(r[4])) for r in found), key=repr), brute(keyed, window)


@pytest.mark.parametrize("window", [5, 16, 100])
def test_repeated_bytes_are_brute_force(documents, window):
    found, expected = found_and_expected(documents, cases(window), window)
    assert found == expected


def test_hot_buckets_in_shards_and_small_segments(documents, monkeypatch):
    """Buckets dealt over many shards, sorts of few windows, runs cut by segments, a memory of few sent runs."""
    for name, value in (("SHARD", 3), ("SORTED", 50), ("SEGMENT", 37), ("SENT", 4), ("CHUNK", 700), ("ANCHORS", 64)):
        monkeypatch.setattr(suffix_radix, name, value)
    found, expected = found_and_expected(documents, cases(4), 20)
    assert found == expected


def test_runs_cover_every_window_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 99, int(n), dtype=np.uint8) for n in (0, 5, 99, 100, 101, 5000, 3, 700)]
    flat, offsets = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    text, first, n, at, anchor = suffix_radix.runs_of(flat, offsets, 100)
    windows = [(t, p) for t, a, m in zip(text, first, n) for p in range(a, a + m)]
    assert windows == [(t, p) for t in range(len(texts)) for p in range(offsets[t], offsets[t + 1] - 99)]
    # equal windows have equal anchors at equal places
    place = {}
    for a, m, q, h in zip(first, n, at, anchor):
        for j in range(m):
            own = (int(q - j), int(h))
            assert 0 <= own[0] <= 68
            assert place.setdefault(flat[a + j : a + j + 100].tobytes(), own) == own


@pytest.mark.parametrize("window", [3, 8, 13])
def test_passes_leave_equal_windows(window):
    rng = np.random.default_rng(window)
    flat = rng.integers(0, 2, 400, dtype=np.uint8)
    at = np.arange(400 - window + 1)
    alive, group = suffix_radix._passes(flat, at, np.zeros(len(at), np.int64), window)
    found = {}
    for a, g in zip(alive.tolist(), group.tolist()):
        found.setdefault(g, set()).add(a)
    expected = {}
    for a in at.tolist():
        expected.setdefault(flat[a : a + window].tobytes(), set()).add(a)
    assert sorted(map(sorted, found.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1)


def test_nothing_to_remove(documents):
    assert suffix_radix.remove_repeated_bytes(documents([])).count() == 0
    rows = suffix_radix.remove_repeated_bytes(documents([(1, "short"), (2, "short"), (3, None)])).collect()
    assert sorted((r["doc_id"], r["n_removed"], bytes(r["text"])) for r in rows) == [(1, 0, b"short"), (2, 0, b"short"), (3, 0, b"")]


def test_chunks_are_joined_where_they_lie(spark, sf):
    """The texts are written once, by chunk: neither join of the chunks shuffles or sorts them by anything else."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = {t.name for t in spark.catalog.listTables()}
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = suffix_radix.remove_repeated_bytes(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == tables
