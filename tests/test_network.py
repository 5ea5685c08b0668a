"""The network's gradients and training, permutations and surrogates against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.operators import explain as E
from scorewright.operators import models as M
from scorewright.operators import network as N


def test_gradients_are_finite_differences():
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(12, 5)), rng.integers(0, 2, 12).astype(float), rng.uniform(0.5, 2, 12)
    weights = N.start(5)
    for drawn in (None, 7):
        make = lambda: None if drawn is None else np.random.default_rng(drawn)  # noqa: B023, E731
        _, found, _ = N.gradients(weights, x, y, w, make())
        for name, value in weights.items():
            for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(4)]:
                losses = []
                for step in (1e-6, -1e-6):
                    moved = {**weights, name: value.copy()}
                    moved[name][at] += step
                    losses.append(N.gradients(moved, x, y, w, make())[0])
                assert math.isclose((losses[0] - losses[1]) / 2e-6, found[name][at], rel_tol=1e-4, abs_tol=1e-5), name


def test_area_of_levels_by_hand():
    # falling: 1 positive; 1 negative; 1 positive and 1 negative tied
    assert math.isclose(N.area_of_levels(np.array([[1, 1], [0, 1], [1, 0]])), 0.5 * 1 + 0.5 * 0.5)
    assert N.area_of_levels(np.zeros((3, 2))) == 0.0


def vectors(spark, n, seed, parts):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.3 > 0.4).astype(float)
    rows = [([float(v) for v in a], float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "_x array<double>, _y double").repartition(parts)


def test_training_learns_repeats_and_stops(spark, monkeypatch):
    monkeypatch.setattr(N, "PATIENCE", 2)
    train, held = vectors(spark, 300, 1, 3), vectors(spark, 200, 2, 2)
    table = train.persist()  # the same blocks both times
    table.count()
    first = N.fit_network(table, held, True, epochs=12, batch=64)
    again = N.fit_network(table, held, True, epochs=12, batch=64)
    for a, b in zip(first[:2], again[:2]):
        assert all((a[k] == b[k]).all() for k in a)
    assert first[2] == again[2] and len(first[2]) <= 12
    assert max(first[2]) > 0.55
    x = np.array([r["_x"] for r in held.collect()])
    assert len(set(N.forward(*first[:2], x).round(6))) > 10
    none = N.fit_network(train.limit(0), held, False, epochs=2)
    assert none[2] == []


def applicants(spark, n=60):
    rng = random.Random(3)
    rows = [(k, rng.choice(["train", "train", "test"]), rng.gauss(0, 1), float(rng.randint(0, 3)), rng.choice([None, rng.random()])) for k in range(n)]
    rows = [(*r, int(r[2] + 0.3 * r[3] + rng.gauss(0, 0.5) > 0.5)) for r in rows]
    return spark.createDataFrame(rows, "id long, split string, a double, b double, c double, Default_Flag int").repartition(3)


def test_permuted_values_are_permutations(spark):
    table = applicants(spark).where("split = 'test'")
    rows, n = M.numbered(table, "id")
    assert sorted(r["_at"] for r in rows.collect()) == list(range(n)) and n == table.count()
    given = M.permuted_values(rows, n, ["a", "b", "c"], 2).collect()
    assert len(given) == n
    taken = defaultdict(list)
    for r in given:
        for g in r["_given"]:
            taken[g["feature"], g["repeat"]].append(g["value"])
    for (feature, _), values in taken.items():
        assert Counter(values) == Counter(r[feature] for r in table.collect())
    assert len(taken) == 6


def test_permutation_importance_is_plain(spark):
    table = applicants(spark)
    model = M.train_logistic(table.where("split = 'train'"), ["a", "b"], iterations=30)
    found = {r["feature"]: r for r in M.permutation_importance(table, model, "id", repeats=2).collect()}
    assert set(found) == {"a", "b"}
    rows, n = M.numbered(table.where("split = 'test'"), "id")
    base = {r["_at"]: r for r in rows.collect()}
    given = {r["_at"]: r["_given"] for r in M.permuted_values(rows, n, ["a", "b"], 2).collect()}
    score = M.matrix_scorer(model)

    def area(values):
        ranked = sorted(((s, base[k]["Default_Flag"]) for k, s in values.items()), reverse=True)
        ones = sum(y for _, y in ranked)
        total = 0.0
        for cut in sorted({s for s, _ in ranked}, reverse=True):
            hit = sum(y for s, y in ranked if s == cut)
            total += hit / ones * sum(y for s, y in ranked if s >= cut) / sum(s >= cut for s, _ in ranked)
        return total

    plain = area({k: float(score(np.array([[r["a"], r["b"]]]))[0]) for k, r in base.items()})
    for feature in ("a", "b"):
        drops = []
        for repeat in range(2):
            values = {}
            for k, r in base.items():
                swap = next(g["value"] for g in given[k] if g["feature"] == feature and g["repeat"] == repeat)
                row = [swap if f == feature else r[f] for f in ("a", "b")]
                values[k] = float(score(np.array([row]))[0])
            drops.append(plain - area(values))
        assert math.isclose(found[feature]["permutation_pr_auc_drop"], np.mean(drops), abs_tol=1e-9)


def test_surrogates_are_plain(spark):
    table = applicants(spark)
    names = ["a", "b", "c"]
    train = table.where("split = 'train'")
    score = lambda x: 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))
    found = defaultdict(list)
    asked = table.where("split = 'test'")
    for r in E.local_surrogate(asked, train, score, names, "id", samples=60, terms=2).collect():
        found[r["id"]].append(r)
    rows = asked.collect()
    assert set(found) == {r["id"] for r in rows}  # every row
    quantiles = E.quantile_table(train, names)
    own = [sorted(r[n] for r in train.collect() if r[n] is not None) for n in names]
    assert np.allclose(quantiles, [np.quantile(v, np.arange(65) / 64) for v in own])
    for r in rows[:6]:
        x = np.array([quantiles[k, 32] if r[n] is None else r[n] for k, n in enumerate(names)])
        draws = E.drawn_rows(r["id"], x, quantiles, 60, 42)
        assert (draws[0] == x).all() and (draws[1:] >= quantiles[:, 0]).all() and (draws[1:] <= quantiles[:, -1]).all()
        code = [[sum(v > quantiles[k, q] for q in (16, 32, 48)) for k, v in enumerate(d)] for d in draws]
        same = np.array([[float(c == f) for c, f in zip(own_code, code[0])] for own_code in code])
        weight = np.exp(-(1 - same).sum(axis=1) / (0.75 * math.sqrt(3)) ** 2)
        weight /= weight.sum()
        y = score(draws)

        def explained(some):
            design = np.column_stack([np.ones(60), same[:, some]])
            penalty = np.diag([0.0] + [1 / 60] * len(some))
            beta = np.linalg.solve(design.T @ (design * weight[:, None]) + penalty, design.T @ (weight * y))
            mean = weight @ y
            return weight @ (y - mean) ** 2 - weight @ (y - design @ beta) ** 2, beta[1:]

        first = max(range(3), key=lambda k: (round(explained([k])[0], 12), -k))
        second = max((k for k in range(3) if k != first), key=lambda k: (round(explained([first, k])[0], 12), -k))
        got = sorted(found[r["id"]], key=lambda g: g["place"])
        assert [g["feature"] for g in got] == [names[first], names[second]]
        assert np.allclose([g["weight"] for g in got], explained([first, second])[1])
        for g in got:
            k = names.index(g["feature"])
            assert (g["low"] is None or x[k] > g["low"]) and (g["high"] is None or x[k] <= g["high"])


def test_a_small_table_is_trained_by_one_task(spark, monkeypatch):
    """In the same numbers as by a job a step, in a few jobs."""
    train, held = vectors(spark, 300, 1, 3).persist(), vectors(spark, 200, 2, 2).persist()
    assert train.count() == 300 and held.count() == 200  # the same blocks both times
    context = spark.sparkContext

    def fitted(group, **more):
        context.setJobGroup(group, group)
        try:
            found = N.fit_network(train, held, True, batch=64, **more)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return found, len(context.statusTracker().getJobIdsForGroup(group))

    (weights, running, history), jobs = fitted("one-task", epochs=5)
    assert len(history) == 5 and jobs < 12
    monkeypatch.setattr(N, "ONE_TASK", 0)
    (others, resting, areas), many = fitted("by-steps", epochs=5)
    assert many > jobs and history == areas
    assert all((weights[k] == others[k]).all() for k in weights) and all((running[k] == resting[k]).all() for k in running)
    none = vectors(spark, 10, 1, 1).limit(0)
    monkeypatch.setattr(N, "ONE_TASK", 1 << 20)
    assert N.fit_network(none, none, False, epochs=2)[2] == [] and N.fit_network(train, none, False, epochs=2)[2] == [0.0, 0.0]
