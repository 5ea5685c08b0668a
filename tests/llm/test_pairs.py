"""Substring dedup, Jaccard join, decontamination and forest against brute force."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from scorewright.llm import common, decontamination, forest_dedup, jaccard_join, substring_dedup
from scorewright.llm.graph import components


def texts(seed=1, n=120):
    """Invented texts with copies, near copies and shared passages; nulls, empty and blank ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if k % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage
        if k % 7 == 0 and rows:
            words = list((rows[rng.randrange(len(rows))][1] or "").split())
            for _ in range(rng.randint(0, 2)):
                if words:
                    words[rng.randrange(len(words))] = "CHANGED"
        rows.append((k, rng.choice([" ", "\n", "  \t"]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (None, rows[5][1]), (None, None), (3, rows[8][1]), (3, rows[3][1]), (1003, "the same " * 200)]
    return rows


def brute_repeats(rows, window):
    first = {}
    for doc_id, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1) if doc_id is not None else ():
            t = tuple(w[k : k + window])
            first[t] = min(first.get(t, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1) if doc_id is not None else ():
            if first[tuple(w[k : k + window])] < doc_id:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [3, 10, 50])
def test_substring_dedup_is_brute_force(documents, window):
    rows = texts()
    found = substring_dedup.remove_repeats(documents(rows), window).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_repeats(rows, window)


def test_substring_dedup_with_hot_buckets(documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD", 3)
    monkeypatch.setattr(substring_dedup, "SENT", 2)
    rows = texts(2)
    found = substring_dedup.remove_repeats(documents(rows), 10).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_repeats(rows, 10)


def near_copies(n, length=97):
    rng = random.Random(4)
    base = [b"w%05d" % rng.randrange(99_999) for _ in range(length)]
    found = []
    for k in range(n):
        words = list(base)
        words[rng.randrange(length)] = b"x%06d" % k
        found.append(b" ".join(words))
    return found


def test_substring_dedup_compares_a_large_bucket_in_little_memory(documents, monkeypatch):
    """A worker holds a bucket's words as numbers, not an object for each window; these took 74 MB before, 21 since."""
    made = {}
    table = documents(texts()[:20])
    as_it_is = type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda df, f, *a, **k: made.setdefault(f.__name__, f) and as_it_is(df, f, *a, **k))
    substring_dedup.remove_repeats(table)
    strings = near_copies(3000)
    columns = {"minimiser": [7] * 3000, "shard": [1 << 32] * 3000, "packed": strings, "doc_id": list(range(3000))}
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in made["count"](iter([pa.RecordBatch.from_pydict(columns)])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(set(strings))
    assert peak < 40e6


def test_substring_dedup_writes_no_buckets(documents, monkeypatch):
    """Verdicts go straight to their strings: for each file that it writes to a local disk, an executor starts chmod."""
    names = []
    monkeypatch.setattr(substring_dedup, "stored", lambda df, name: names.append(name) or common.stored(df, name))
    rows = texts(5)
    found = substring_dedup.remove_repeats(documents(rows), 10)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_repeats(rows, 10)
    assert "buckets" not in names and len(names) <= 3


@pytest.mark.parametrize("share", [1, 20, 60])
def test_substring_dedup_with_hot_and_other_buckets(documents, monkeypatch, share):
    """Buckets on both sides of the limit, and one hot by a line that few documents repeat very often."""
    monkeypatch.setattr(substring_dedup, "SHARD", share)
    line = " ".join(f"l{k}" for k in range(12))
    rows = texts(6) + [(2000 + k, " ".join(f"{line} {k} {j} y" for j in range(25))) for k in range(3)]
    rows += [(3000 + k, x.decode()) for k, x in enumerate(near_copies(30, 40))]
    found = substring_dedup.remove_repeats(documents(rows), 10).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_repeats(rows, 10)


@pytest.mark.parametrize("collide", [False, True])
def test_equal_windows_are_told_by_their_words(monkeypatch, collide):
    if collide:
        monkeypatch.setattr(substring_dedup, "_run_hashes", lambda codes, size: np.zeros(len(codes) - size + 1, np.uint64))
    rng = random.Random(7)
    for size in (1, 2, 3, 10, 50):
        codes = np.array([rng.randrange(2) for _ in range(80)] * 2, np.int32)
        places = np.array(sorted(rng.sample(range(160 - size + 1), 60)))
        group = substring_dedup._equal_windows(codes, places, size)
        for a, x in zip(places, group):
            for b, y in zip(places, group):
                assert (x == y) == np.array_equal(codes[a : a + size], codes[b : b + size])


def test_super_kmers_cover_every_window_once():
    words = [b"%d" % (k * k % 23) for k in range(200)]
    least, first, end = substring_dedup._super_kmers(words, 10)
    assert first[0] == 0 and end[-1] == 191 and (first[1:] == end[:-1]).all()
    runs = common.window_hashes(common.word_hashes(words), substring_dedup.RUN)
    for m, i, j in zip(least, first, end, strict=True):
        assert all(runs[k : k + 10 - substring_dedup.RUN + 1].min() == m for k in range(i, j))


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common_ >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        ids[root(k)].append(doc_id)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        known = [x for x in ids[root(k)] if x is not None]
        out.append((doc_id, len(sets[k]), min(known) if known else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_join_is_brute_force(documents, size, percent):
    rows = texts(3)
    found = jaccard_join.jaccard_components(documents(rows), size, percent).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(rows, size, percent)


def test_jaccard_join_with_long_lists(documents, monkeypatch):
    """Lists dealt over several tasks, and links that no star finds."""
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 2)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((k, " ".join(words)))
    found = jaccard_join.jaccard_components(documents(rows), 3, 70).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(rows, 3, 70)


def test_sketch_counts_every_document(documents):
    rows = texts(5)
    counts = jaccard_join.shingle_counts(documents(rows).selectExpr("cast(text as binary) as text"), 4)
    assert counts.sum() == sum(len(shingles(t, 4)) for _, t in rows)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_hits(rows, items, size):
    windows = defaultdict(set)
    for item, text in items:
        w = decontamination.words(text.encode()) if text is not None and item is not None else []
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])].add(item)
    out = []
    for doc_id, text in rows:
        w = decontamination.words(text.encode() if text is not None else None)
        hit, found = set(), set()
        for s, of in windows.items():
            for k in range(len(w) - len(s) + 1):
                if tuple(w[k : k + len(s)]) == s:
                    hit.update(range(k, k + len(s)))
                    found |= of
        out.append((doc_id, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=repr)


def test_decontamination_is_brute_force(spark, documents):
    rows = texts(6)
    items = [(k, t) for k, t in rows[:20]] + [(50, "Aa, bb"), (51, None), (52, ""), (None, "a b c"), (53, rows[30][1]), (53, rows[31][1]), (-4, rows[32][1])]
    rows = [*rows, (2000, "x aa bb y AA-BB"), (2001, "aa; bb")]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, window int")
    found, _ = decontamination.find_contamination(documents(rows), benchmark)
    found = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(found, key=repr) == brute_hits(rows, items, 10)


def test_decontamination_without_a_broadcast(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_TERMS", 0)
    monkeypatch.setattr(decontamination, "MAX_CANDIDATES", -1)
    rows = texts(7, 40)
    items = [(k, t) for k, t in rows[:9]]
    found, _ = decontamination.find_contamination(documents(rows), spark.createDataFrame(items, "item_id long, text string"))
    found = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(found, key=repr) == brute_hits(rows, items, 10)


def test_proximity_matches_allow_a_slop(spark, documents):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = documents([(1, "alpha beta gamma"), (2, "alpha so beta gamma"), (3, "alpha beta one two three four gamma")])
    _, near = decontamination.find_contamination(docs, benchmark, slop=2)
    assert sorted((r["doc_id"], r["distance"]) for r in near.collect()) == [(1, 0), (2, 1)]


def vectors(seed, n=400, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, width))
    rows = []
    for k in range(n):
        v = rng.standard_normal(width) if k % 2 else centres[k % 20] + 0.05 * rng.standard_normal(width)
        rows.append((k, v.tolist()))
    same = rows[1][1]
    rows += [(n + k, same) for k in range(30)]
    rows += [(600, None), (601, []), (602, [0.0] * width), (603, [float("nan")] * width), (604, [1.0, None] * (width // 2)), (605, [1.0] * (width - 1)), (606, [float("inf")] * width), (None, same), (3, rows[3][1]), (607, [1e200] * width), (608, [1e-200] * width)]
    return rows


def brute_vectors(rows, width, threshold):
    sound = [v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = np.array([forest_dedup._unit(np.array([v]))[0] if ok else np.zeros(width) for ok, (_, v) in zip(sound, rows, strict=True)])
    link = (unit @ unit.T >= threshold - 1e-12) & ~np.eye(len(rows), dtype=bool)
    return link


def test_forest_links_all_near_vectors(spark):
    rows = vectors(8)
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("leaf", T.StringType()), T.StructField("n", T.IntegerType())])).repartition(3)
    found = forest_dedup.near_vectors(table, leaf=40)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = sorted(map(tuple, found.collect()), key=repr)
    link = brute_vectors(rows, 16, 0.95)
    expected = sorted(int(n) for n in link.sum(axis=1))
    assert len(found) == len(rows)
    got = sum(r[1] for r in found)
    assert 0.98 * sum(expected) <= got <= sum(expected)
    by_id = dict((r[0], r) for r in found if r[0] is not None)
    for k in (600, 601, 602, 603, 604, 605, 606):
        assert by_id[k][1:] == (0, k, True)
    assert by_id[607][2] == by_id[608][2] == 607
    assert by_id[400][2] == 1 and by_id[400][3] is False and by_id[1][3] is True


def test_forest_counts_each_pair_once_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest_dedup, "BLOCK", 7)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(8)
    rows = [(k, (centre + 0.01 * rng.standard_normal(8)).tolist()) for k in range(60)]
    found = forest_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf=10).collect()
    assert [r["component_id"] for r in found] == [0] * 60
    assert max(r["n_links"] for r in found) <= 59 and np.mean([r["n_links"] for r in found]) > 58


def test_forest_sends_a_vector_to_its_nearest_leaves_only():
    rng = np.random.default_rng(4)
    v = forest_dedup._unit(rng.standard_normal((6000, 24)))
    nodes = forest_dedup._fit_tree(v, rng, 12, 0.2, 0.0)
    tree = forest_dedup.Tree(nodes, 24)
    v = forest_dedup._unit(rng.standard_normal((300, 24))).astype(np.float32)

    def all_leaves(at, x, cost):
        direction, middle, margin, left, right = nodes[at]
        if direction is None:
            return [(cost, middle)]
        along = float(x @ direction.astype(np.float32)) - middle
        near, far = (left, right) if along <= 0 else (right, left)
        return all_leaves(near, x, cost) + (all_leaves(far, x, cost + along**2) if abs(along) <= margin else [])

    row, leaf = tree.leaves(v, 4)
    every = [sorted(all_leaves(0, x, 0.0)) for x in v]
    assert np.mean([len(e) for e in every]) > 8  # this grows with the depth, the number of probes does not
    for k, e in enumerate(every):
        own = set(leaf[row == k].tolist())
        assert len(own) == (row == k).sum() == min(4, len(e)) and e[0][1] in own
        assert all(cost <= e[len(own) - 1][0] + 1e-5 for cost, number in e if number in own)


def test_forest_counts_a_pair_of_earlier_leaves_once():
    leaves = pa.array([[1, 5, 70, 90], [5, 90], [2, 90, 95], []], pa.list_(pa.int32()))
    words = forest_dedup._earlier_leaves(leaves.slice(0, 3), 90)
    assert [[bool((words[i] & words[j]).any()) for j in range(3)] for i in range(3)] == [[True, True, False], [True, True, False], [False] * 3]


@pytest.mark.parametrize("operator", ["substring", "jaccard", "contamination", "forest"])
def test_empty_tables(spark, documents, operator):
    empty = documents([])
    bench = spark.createDataFrame([], "item_id long, text string")
    if operator == "substring":
        assert substring_dedup.remove_repeats(empty).count() == 0
    elif operator == "jaccard":
        assert jaccard_join.jaccard_components(empty).count() == 0
    elif operator == "contamination":
        assert decontamination.find_contamination(empty, bench)[0].count() == 0
        some = decontamination.find_contamination(documents([(1, "a b c")]), bench)[0].collect()
        assert [(r["n_words"], r["n_hit"], r["items"]) for r in some] == [(3, 0, [])]
    else:
        assert forest_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_words_of_whole_columns_are_those_of_each_text():
    rng = random.Random(5)
    column = [None, b"", b" a ", b"A-b_c1\x00d", "É日本 x".encode(), b"\t\n"]
    column += [bytes(rng.choice(b"aB1 -_.\n\xc3\xa9") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for texts in (pa.array(column, pa.binary()), pa.array(column, pa.binary()).slice(3, 50)):
        codes, bounds, ids = decontamination._terms_of(texts)
        found = [ids[codes[a:b]].tolist() for a, b in zip(bounds, bounds[1:])]
        assert found == [decontamination.term_ids(decontamination.words(t)).tolist() for t in texts.to_pylist()]
