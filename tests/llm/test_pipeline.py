"""The pipeline against a brute-force version, stage by stage and as a whole."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from scorewright.llm import secret_scan  # noqa: E402
from scorewright.llm.queries import SQL, QUERIES  # noqa: E402

from test_pairs import brute_components, brute_hits, shingles, texts  # noqa: E402
from test_texts import brute_secrets  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def redacted(text):
    out, at = "", 0
    for start, _, end, _ in brute_secrets(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def brute(rows, items):
    """Kept (doc_id, text) rows of all stages but the last."""
    rows = [(i, t) for i, t in rows if t is not None and re.search(r"[^\W\d_]", t)]
    component = {}
    for (i, t), (j, _, c) in zip(sorted(rows, key=repr), brute_components(rows, 5, 80), strict=True):
        component.setdefault(j, set()).add(c)
    rows = [(i, t) for i, t in rows if i is not None and i in component[i]]
    hits = {(i): h for i, _, h, _ in brute_hits(rows, items, 10)}
    return [(i, redacted(t)) for i, t in rows if not hits[i]]


def test_pipeline_is_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in texts(11) if i != 3 and i is not None] + [(5000, "a token = 'abcdef0123456789abcdef' here"), (5001, "123 456")]
    items = [(1, rows[40][1])]
    table = [(i, t, "en" if i % 2 else "fr", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    t = Tokenizer.from_file(PATH)
    found = defaultdict(list)
    for p in pieces:
        found[p["doc_id"]].append((p["start"], tuple(np.frombuffer(p["ids"], "<u4").tolist())))
    expected = {i: (*t.encode(text, add_special_tokens=False).ids, 2) for i, text in brute(rows, items)}
    assert {i: sum((x[1] for x in sorted(own)), ()) for i, own in found.items()} == expected
    assert 5000 in expected and 5001 not in expected


KIND = "doc_id long, text string, lang string, source string, n_chars long"


def brute_first_rows(rows):
    """One (id, text) row of each group: the smallest id, null ids last."""
    sets = [shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for g, (i, t) in zip(group, rows, strict=True):
        own = (i is None, i or 0, t)
        least[g] = min(least.get(g, own), own)
    return [(None if unknown else i, t) for unknown, i, t in least.values()]


def test_near_duplicates_are_decided_by_row(spark):
    a, b, c, d, e, f = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcdef")
    near = {x: f"{x} more" for x in (b, d, e)}
    rows = [(None, a), (5, f), (5, f), (3, b), (5, near[b]), (None, near[b]), (None, d), (None, near[d]), (8, e), (7, near[e]), (None, e), (6, ""), (6, ""), (None, " "), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], KIND).repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    unknown = [x for x in kept if x[1] in (d, near[d])]
    assert len(unknown) == 1 and unknown[0][0] is None
    kept.remove(unknown[0])
    assert Counter(kept) == Counter([(None, a), (5, f), (3, b), (7, near[e]), (6, ""), (None, " "), (None, " ")])


def test_pipeline_with_null_and_repeated_ids(spark, tmp_path, monkeypatch):
    clean = " ".join(f"clean{k}" for k in range(50))
    rows = [*texts(11), (None, clean), (40, clean + " again"), (41, clean + " twice"), (41, "one row"), (41, "one row")]
    items = [(1, texts(11)[40][1])]
    table = [(i, t, "en" if k % 2 else "fr", "s", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(table, KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:-1])
    found = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    lettered = [(i, t) for i, t in rows if t is not None and re.search(r"[^\W\d_]", t)]
    expected = [(i, redacted(t)) for i, t in brute_first_rows(lettered) if not brute_hits([(i, t)], items, 10)[0][2]]
    assert found == Counter(expected)
    assert (40, clean + " again") in found and (41, "one row") in found and (41, clean + " twice") not in found


def test_unlabelled_documents_with_letters_stay(spark):
    rows = [(1, "some words", None), (2, "123 ½", None), (3, None, None), (None, "été", None), (4, "", None)]
    docs = spark.createDataFrame([(i, t, x, "s", 1) for i, t, x in rows], KIND)
    kept = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(1, "some words"), (None, "été")])


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes, name


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, sf)
    assert df.columns == names
    assert Counter(map(tuple, df.collect())) == Counter(result.fetchall())


def test_cut_offs_ignore_tables_without_candidates(documents):
    assert set(secret_scan.cut_offs(documents([(1, "a")]).select("text"), 0.01).values()) == {secret_scan.TOP + 1}


def test_workers_get_their_rows_in_small_batches(spark, tmp_path):
    key = corpus_pipeline.BATCH_BYTES
    before = spark.conf.get(key)
    try:
        docs = spark.createDataFrame([(k, "word " * 100_000, "en", "s", 500_000) for k in range(24)], KIND).coalesce(1)
        corpus_pipeline.pack(spark, docs, str(tmp_path))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes], pa.int64())})

        found = [r["bytes"] for r in docs.mapInArrow(sizes, "bytes long").collect()]
        assert len(found) > 1 and max(found) <= corpus_pipeline.BATCH + 600_000
    finally:
        spark.conf.set(key, before)
