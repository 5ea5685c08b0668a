"""Second-order boosting against a brute-force fit, and what a pass of several models shares."""

import math
import random

import numpy as np
import pytest

from scorewright.operators import boosting as B


def table(spark, seed=1, n=120, parts=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a = rng.choice([None, float("nan"), *range(8)])
        b = round(rng.gauss(0, 2), 1)
        c = rng.choice(["x", "y", "z", None])
        p = 1 / (1 + math.exp(-(0.8 * b + (1 if c == "y" else 0) + (1.5 if a is None or a != a else 0.2 * a - 1))))
        rows.append((k, None if a is None else float(a), b, c, int(rng.random() < p), rng.choice([0.5, 1.0, 2.0])))
    rows.append((n, 1.0, 0.0, "x", None, 1.0))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y int, wt double").repartition(parts)


def brute_fit(x, y, w, trees, depth, base):
    """Trees as nested tuples by trying every split of every node on the values themselves."""
    margin = np.full(len(y), base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def score(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + B.PENALTY)

        def grow(rows, left_levels):
            best = None
            if left_levels:
                tries = [(side, f, cut) for side in (False, True) for f in range(x.shape[1]) for cut in [*sorted(set(x[rows, f][~np.isnan(x[rows, f])])), np.inf]]
                found = []
                for side, f, cut in tries:
                    left = rows[np.where(np.isnan(x[rows, f]), side, x[rows, f] < cut)]
                    right = np.setdiff1d(rows, left)
                    if min(h[left].sum(), h[right].sum()) >= B.LEAST_HESSIAN:
                        found.append((score(left) + score(right) - score(rows), left, right))
                most = max((gain for gain, *_ in found), default=0)
                if most > B.LEAST_GAIN:
                    best = next(t for t in found if t[0] >= most * (1 - B.TIE))
            if best is None:
                value = -B.RATE * g[rows].sum() / (h[rows].sum() + B.PENALTY)
                step[rows] = value
                return value
            return best[0], grow(best[1], left_levels - 1), grow(best[2], left_levels - 1)

        step = np.zeros(len(y))
        made.append(grow(np.arange(len(y)), depth))
        margin = margin + step
    return made, margin


def nested(tree, k=0):
    if tree.feature[k] < 0:
        return tree.value[k]
    return tree.gain[k], nested(tree, 2 * k + 1), nested(tree, 2 * k + 2)


def near(a, b):
    return all(map(near, a, b)) if isinstance(a, tuple) and isinstance(b, tuple) else math.isclose(a, b, rel_tol=1e-4, abs_tol=1e-6)


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_are_those_of_a_brute_force_fit(spark, seed, monkeypatch):
    monkeypatch.setattr(B, "REFRESH", 2)
    df = table(spark, seed)
    specs = {"plain": B.Spec(), "heavy": B.Spec(positive_weight=3.0), "own": B.Spec(weight="wt")}
    models = B.boost_many(df, ["a", "b", "c"], specs, "y", trees=5, depth=3, share=1.0)
    rows = [r for r in df.collect() if r["y"] is not None]
    x = np.array([[np.nan if r["a"] is None else r["a"], r["b"], *(np.nan if r["c"] is None else float(r["c"] == s) for s in "xyz")] for r in rows])
    y = np.array([r["y"] for r in rows], float)
    for name, spec in specs.items():
        w = np.where(y == 1, spec.positive_weight, 1.0) * (np.array([r["wt"] for r in rows]) if spec.weight else 1.0)
        mean = (w * y).sum() / w.sum()
        trees, margin = brute_fit(x, y, w, 5, 3, math.log(mean / (1 - mean)))
        assert near(tuple(trees), tuple(map(nested, models[name].trees)))
        assert np.allclose(models[name].margins(x), margin, atol=1e-5)
    scored = {r["id"]: r["probability"] for r in models["plain"](df).collect()}
    m = models["plain"].margins(x)
    assert np.allclose([scored[r["id"]] for r in rows], 1 / (1 + np.exp(-m)))


def test_a_shared_pass_equals_single_fits_and_any_partitions(spark):
    df = table(spark, 3, 400)
    specs = {"one": B.Spec(), "two": B.Spec(positive_weight=2.0)}
    both = B.boost_many(df, ["a", "b"], specs, "y", trees=4, share=1.0)
    for name, spec in specs.items():
        alone = B.boost_many(df.repartition(7), ["a", "b"], {name: spec}, "y", trees=4, share=1.0)[name]
        for s, t in zip(both[name].trees, alone.trees, strict=True):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and np.allclose(s.value, t.value, atol=1e-7)


def test_missing_values_go_to_the_better_side():
    sums = np.zeros((1, 256, 2), np.int64)
    sums[0, 0], sums[0, 1], sums[0, B.MISSING] = (-50, 40), (50, 40), (-30, 20)  # missing values are like bin 0
    gain, feature, cut, missing_left, g, h = B.best_split(sums, np.array([True]), 1.0)
    assert (feature, cut, missing_left, g, h) == (0, 1, True, -80.0, 60.0)
    sums[0, B.MISSING, 0] = 30
    assert B.best_split(sums, np.array([True]), 1.0)[3] is False
    assert B.best_split(sums, np.array([False]), 1.0) is None


def test_odd_tables(spark):
    df = table(spark)
    empty = B.boost_many(df.limit(0), ["a", "b"], {"m": B.Spec()}, "y", trees=2)["m"]
    assert empty(df).where("probability = 0.5").count() == df.count()
    one_class = B.boost_many(df.where("y = 1"), ["a", "c"], {"m": B.Spec()}, "y", trees=2)["m"]
    assert one_class.importances() == {"a": 0.0, "c": 0.0}
    constant = df.selectExpr("id", "1 as a", "cast(null as double) as b", "y")
    model = B.boost_many(constant, ["a", "b"], {"m": B.Spec()}, "y", trees=2)["m"]
    assert all((t.feature < 0).all() for t in model.trees)


def test_importances_are_shares_of_mean_gains(spark):
    model = B.boost_many(table(spark, 5, 300), ["a", "b", "c"], {"m": B.Spec()}, "y", trees=3)["m"]
    shares = model.importances()
    assert set(shares) == {"a", "b", "c"} and math.isclose(sum(shares.values()), 1) and shares["b"] > 0


def test_small_tables_are_fitted_without_a_job_a_level(spark, monkeypatch):
    """One task a model gives the trees of the passes, from drawn rows and features, in a few jobs."""
    monkeypatch.setattr(B, "REFRESH", 3)
    df, made, blocks = table(spark, 7, 500), [], B._blocks
    monkeypatch.setattr(B, "_blocks", lambda *a: made[0] if made else made.append(blocks(*a)) or made[0])  # the same blocks both times
    specs = {"plain": B.Spec(), "heavy": B.Spec(positive_weight=3.0), "own": B.Spec(weight="wt", seed=5)}
    context = spark.sparkContext

    def fitted(group):
        context.setJobGroup(group, group)
        try:
            models = B.boost_many(df, ["a", "b", "c"], specs, "y", trees=8, share=0.7)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return models, len(context.statusTracker().getJobIdsForGroup(group))

    alone, jobs = fitted("alone")
    monkeypatch.setattr(B, "ONE_TASK", 0)
    passes, many = fitted("passes")
    assert jobs < 25 < many
    for name in specs:
        assert alone[name].base == passes[name].base and len(alone[name].trees) == 8
        for s, t in zip(alone[name].trees, passes[name].trees, strict=True):
            assert all(np.array_equal(getattr(s, f), getattr(t, f)) for f in ("feature", "bin", "cut", "missing_left", "value", "gain", "cover"))
