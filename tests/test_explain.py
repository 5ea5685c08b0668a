"""Tree attributions against Shapley values by enumeration."""

import itertools
import math
import random

import numpy as np
import pytest

from scorewright.operators import boosting as B
from scorewright.operators import explain as E


def known_value(tree, x, known, k=0):
    """The tree's value where only some features are known: averages by cover at the others' splits."""
    f = tree.feature[k]
    if f < 0:
        return tree.value[k]
    left, right = 2 * k + 1, 2 * k + 2
    if f in known:
        goes_left = tree.missing_left[k] if math.isnan(x[f]) else x[f] < tree.cut[k]
        return known_value(tree, x, known, left if goes_left else right)
    return sum(tree.cover[c] * known_value(tree, x, known, c) for c in (left, right)) / tree.cover[k]


def brute_values(trees, x):
    n = len(x)
    out = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for some in itertools.combinations(others, size):
                for tree in trees:
                    out[i] += weight * (known_value(tree, x, {*some, i}) - known_value(tree, x, set(some)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        v = [rng.choice([None, round(rng.gauss(0, 1), 1)]) if j < 2 else round(rng.gauss(0, 1), 1) for j in range(4)]
        word = rng.choice(["p", "q", None])
        y = int((v[0] or 0) + 2 * v[2] * v[3] + (word == "p") + rng.gauss(0, 0.5) > 0.5)
        rows.append((k, *v, word, y))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, w string, y int")


def test_tree_values_are_enumerated_shapley_values(spark, table):
    names = ["a", "b", "c", "d", "w"]  # six inputs: the text has two levels
    model = B.boost_many(table, names, {"m": B.Spec()}, "y", trees=4)["m"]
    assert len(model.encoding.inputs) == 6 and any((t.feature >= 0).sum() > 5 for t in model.trees)
    rows = table.limit(12).collect()
    x = np.array([[*(math.nan if r[n] is None else r[n] for n in "abcd"), *(math.nan if r["w"] is None else float(r["w"] == s) for s in "pq")] for r in rows])
    found = E.tree_values(E.tree_paths(model.trees), x)
    assert np.allclose(found, [brute_values(model.trees, row) for row in x], atol=1e-10)
    assert np.allclose(found.sum(axis=1) + E.expected_margin(model), model.margins(x))
    long = E.attribution_tree(table, model, "id", keep=["y"])
    assert long.columns == ["id", "y", "feature", "value"] and long.count() == 300 * 5
    values = {(r["id"], r["feature"]): r["value"] for r in long.collect()}
    for r, own in zip(rows, found):
        assert np.allclose([values[r["id"], n] for n in names], [*own[:4], own[4] + own[5]])
    assert E.attribution_tree(table.limit(0), model, "id").count() == 0


def test_counterfactuals_turn_every_row_that_can_be_turned(spark):
    rng = random.Random(9)
    rows = [(k, rng.gauss(0, 1), float(rng.randint(0, 3)), rng.choice([None, rng.gauss(0, 1)]), rng.choice([-1, 0, 30])) for k in range(90)]
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, fixed int").repartition(4)

    def margin(a, b, c, fixed):
        return 2 * a - b + (c or 0) + 0.2 * fixed

    def scorer(df):
        value = 2 * E.F.col("a") - E.F.col("b") + E.F.coalesce("c", E.F.lit(0.0)) + 0.2 * E.F.col("fixed")
        return df.withColumn("probability", 1 / (1 + E.F.exp(-value)))

    names, spread = ["a", "b", "c"], {"a": 1.0, "b": 1.0, "c": 2.0}
    found = E.counterfactual(table, table, scorer, names, spread, "id", ["fixed"], pool=5, near=4, strongest=6)
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["id"], []).append(r)
    own = {r[0]: r for r in rows}
    for k, (_, a, b, c, fixed) in own.items():
        was = margin(a, b, c, fixed) >= 0
        others = [r for r in rows if (margin(*r[1:]) >= 0) != was]
        turning = [r for r in others if (margin(r[1], r[2], c if r[3] is None else r[3], fixed) >= 0) != was]
        versions = by_id.get(k, [])
        assert len(versions) == (3 if len(turning) >= 3 else len(versions)) and (not turning or versions), (k, len(turning))
        assert [v["place"] for v in sorted(versions, key=lambda v: v["place"])] == list(range(1, len(versions) + 1))
        assert len({(v["a"], v["b"], v["c"]) for v in versions}) == len(versions)
        for v in versions:
            new = (v["a"], v["b"], v["c"])
            assert (margin(*new, fixed) >= 0) != was
            assert math.isclose(v["probability"], 1 / (1 + math.exp(-margin(*new, fixed))))
            assert v["changed_features"] == sum(x != y for x, y in zip(new, (a, b, c)))
            gaps = [abs(x - y) / spread[n] for n, x, y in zip(names, new, (a, b, c)) if x is not None and y is not None]
            assert math.isclose(v["distance"], sum(gaps), abs_tol=1e-9)
    assert sum(len(v) for v in by_id.values()) > 100
    assert E.counterfactual(table.limit(0), table, scorer, names, spread, "id", ["fixed"]).count() == 0
    assert E.counterfactual(table, table.limit(0), scorer, names, spread, "id", ["fixed"]).count() == 0


def plain_copies(x, donor, scale):
    new = np.where(np.isnan(donor), x, donor)
    differs = ~((new == x) | (np.isnan(new) & np.isnan(x)))
    gap = np.nan_to_num(np.abs(new - x)) / scale
    order = [k for k in np.argsort(-gap, kind="stable") if differs[k]]
    for n in sorted({min(n, len(order)) for n in (*E.TAKEN, len(order))} - {0}):
        version = x.copy()
        version[order[:n]] = new[order[:n]]
        yield n, float(gap[order[:n]].sum()), version


def plain_diverse(found, wanted):
    found = sorted(found, key=lambda v: (v[1], v[2], v[0]))
    leading = list({v[0]: v for v in reversed(found)}.values())[::-1]
    leading.sort(key=lambda v: (v[1], v[2], v[0]))
    chosen = []
    for candidates in (leading, found):
        while len(chosen) < wanted:
            apart = [(min((sum(a != b for a, b in zip(v[3], c[3])) for c in chosen), default=1), v) for v in candidates]
            apart = [(n, v) for n, v in apart if n]
            if not apart:
                break
            chosen.append(min(apart, key=lambda t: (-t[0], t[1][1], t[1][2], t[1][0]))[1])
    return chosen


def test_versions_of_many_rows_are_those_of_each_row():
    """All rows of a profile at once give what one row after the other gives."""
    rng = np.random.default_rng(4)
    scale = rng.choice([1.0, 3.0], 15)
    x, pool, ends = (np.where(rng.random((n, 15)) < 0.1, np.nan, np.round(rng.normal(size=(n, 15)))) for n in (30, 9, 3))
    donors = E.Donors({2: pool}, ends)
    assert donors.near(x, 5, scale, 4).shape == (30, 3, 15)
    near = donors.near(x, 2, scale, 4)
    found = [[] for _ in x]
    for i, own in enumerate(x):
        order = np.argsort((np.nan_to_num(np.abs(pool - own)) / scale).sum(axis=1), kind="stable")[:4]
        for d, donor in enumerate(np.vstack([pool[order], ends])):
            assert np.array_equal(near[i, d], donor, equal_nan=True)
            found[i] += [(d, n, distance, tuple(None if v != v else v for v in version)) for n, distance, version in plain_copies(own, donor, scale)]
    row, donor, changed, distance, values = E.partial_copies(x, near, scale)
    made = [(r, d, n, g, tuple(None if v != v else v for v in version)) for r, d, n, g, version in zip(row, donor, changed, distance, values)]
    assert made == [(i, *v) for i, some in enumerate(found) for v in some]
    keep = rng.random(len(row)) < 0.3  # some rows have few versions left, of few donors
    keep &= ~((row % 5 == 0) & (donor > 0))
    chosen = E.diverse(row[keep], donor[keep], changed[keep], distance[keep], values[keep], 3)
    kept = [m for m, k in zip(made, keep) if k]
    assert [kept[c] for c in chosen] == [(i, *v) for i in range(len(x)) for v in plain_diverse([m[1:] for m in kept if m[0] == i], 3)]
    assert len(E.diverse(row[:0], donor[:0], changed[:0], distance[:0], values[:0], 3)) == 0
