"""Which learner the registered queries fit, and the methods that the trade-off table compares."""

import itertools
import math
import random

import numpy as np
import pytest

from scorewright.operators import boosting as B
from scorewright.operators import models as M
from scorewright.operators import mitigation as W
from scorewright.operators.neighbours import oversample_minority
from scorewright.plans import catalogue
from scorewright.plans.jobs import split_table
from scorewright.plans.tables import KEY

BASE = ["LIMIT_BAL", "AGE", "PAY_0", "BILL_AMT1"]
BOOSTED = [
    "train_boosted", "reweigh_train", "tradeoff_table", "target_shuffle_auc", "importance", "attribution_tree", "ablation",
    "standard_compare", "external_benchmark", "recall_optimise",
]


class Fitted(Exception):
    pass


@pytest.mark.parametrize("name", BOOSTED)
def test_queries_fit_the_whole_boosted_model(name, spark, sf, monkeypatch):
    seen = []

    def noted(df, features, specs, target="Default_Flag", trees=B.TREES, **more):
        seen.append((trees, len(specs)))
        raise Fitted

    monkeypatch.setattr(M, "boost_many", noted)
    with pytest.raises(Fitted):
        catalogue.QUERIES[name](spark, sf)
    assert seen and {t for t, _ in seen} == {150}
    assert name != "recall_optimise" or {n for _, n in seen} == {8}  # all class weights in the same passes


def test_thresholds_by_group_are_a_third_method(spark, sf):
    table = split_table(spark, sf)
    scored = M.reweigh_compare(table, BASE, KEY, trainer=M.train_logistic, thresholds=True)
    rows = scored.collect()
    base = {r[KEY]: r for r in rows if r["model_name"] == "baseline"}
    cut = {r[KEY]: r for r in rows if r["model_name"] == "group_thresholds"}
    model = M.train_logistic(table.where("split <> 'test'"), BASE)
    train = model.predictions(table.where("split <> 'test'"), KEY, "m").join(table.select(KEY, "SEX"), KEY)
    plan = {r["SEX"]: r for r in W.equalised_odds(train).collect()}
    assert base.keys() == cut.keys() and len(plan) > 1
    for k, r in cut.items():
        own = plan.get(r["SEX"])
        if own is None:
            continue
        reaches = [own[n] is not None and base[k]["y_proba"] >= own[n] for n in ("high_threshold", "low_threshold")]
        if own["ignored"] == 0 and reaches[0] == reaches[1]:
            assert r["y_proba"] == float(reaches[0])
        assert r["y_proba"] in (0.0, 1.0)
    table = M.tradeoff_table(scored).collect()
    assert sorted(r["method"] for r in table) == ["baseline", "group_thresholds", "reweighing"]


def scored_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        group = rng.choice(["a", "b", "c", None])
        truth = int(rng.random() < (0.3 if group == "a" else 0.5))
        score = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.25 * truth, 0.2))), 2)
        rows.append((k, group, score if rng.random() < 0.98 else None, truth if rng.random() < 0.98 else None))
    rows += [(n + k, "one class", 0.1 * k, 1) for k in range(5)]
    return rows


@pytest.mark.parametrize("part", [100_000, 7])
def test_equalised_odds_by_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(W, "CURVE_PART", part)
    rows = scored_rows(3)
    scored = spark.createDataFrame(rows, "id long, g string, y_proba double, y_true int")
    plan = {r["g"]: r for r in W.equalised_odds(scored, "g").collect()}
    assert sorted(plan) == ["a", "b", "c"]

    def curve(group):
        own = [(s, t) for _, g, s, t in rows if g == group and s is not None and t is not None]
        p, n = sum(t for _, t in own), sum(1 - t for _, t in own)
        cuts = [math.inf, *sorted({s for s, _ in own}, reverse=True)]
        return [(sum(s >= c and not t for s, t in own) / n, sum(s >= c and t for s, t in own) / p) for c in cuts], p, n

    def height(points, x):
        return max(b + (d - b) * ((x - a) / (c - a) if c > a else 1) for a, b in points for c, d in points if a <= x <= c)

    curves = {g: curve(g) for g in plan}
    right = []
    for i in range(1001):
        y = min(height(points, i / 1000) for points, _, _ in curves.values())
        p, n = sum(c[1] for c in curves.values()), sum(c[2] for c in curves.values())
        right.append((round((p * y + n * (1 - i / 1000)) / (p + n), 9), -i, y))
    accuracy, step, tpr = max(right)
    for g, r in plan.items():
        assert math.isclose(r["fpr"], -step / 1000) and math.isclose(r["tpr"], tpr, abs_tol=1e-9) and math.isclose(r["accuracy"], accuracy, abs_tol=1e-8)
    # the expected rates of the decisions on the same rows are equal
    decided = W.mixed_decision(scored, W.equalised_odds(scored, "g"), "g", "id").collect()
    for truth, rate in ((1, "tpr"), (0, "fpr")):
        for g in plan:
            own = [r["flag_probability"] for r in decided if r["g"] == g and r["y_true"] == truth and r["y_proba"] is not None]
            assert abs(sum(own) / len(own) - plan[g][rate]) < 1e-6
    for r in decided:
        if r["g"] == "one class":
            assert r["flagged"] == (r["y_proba"] >= 0.5)
        assert r["y_proba"] is not None or not r["flagged"]


def test_hull_is_that_of_all_segments():
    rng = random.Random(1)
    for _ in range(100):
        points = [(rng.randint(0, 9), rng.randint(0, 9), 0.0) for _ in range(rng.randint(1, 12))]
        found = {(a, b) for a, b, _ in W._hull(points)}
        under = lambda q: any(
            a[0] < q[0] < c[0] and (q[1] - a[1]) * (c[0] - a[0]) < (c[1] - a[1]) * (q[0] - a[0]) for a, c in itertools.permutations(points, 2)
        ) or any(a[0] == q[0] and a[1] > q[1] for a in points)
        assert found == {(q[0], q[1]) for q in points if not under(q)}


def test_new_minority_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(a), float(b), int(k < 9)) for k, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    made = oversample_minority(df, ["a", "b"], "y", "id", k=3).collect()
    assert len(made) == 31 - 9 and all(r["y"] == 1 for r in made)
    minority = {k: np.array([a, b]) for k, a, b, y in rows if y}
    times = {k: sum(r["made_from"] == k for r in made) for k in minority}
    assert max(times.values()) - min(times.values()) <= 1
    for r in made:
        own, new = minority[r["made_from"]], np.array([r["a"], r["b"]])
        near = sorted((np.linalg.norm(v - own), k) for k, v in minority.items() if k != r["made_from"])[:3]
        gaps = [np.linalg.norm(np.cross(np.append(minority[k] - own, 0), np.append(new - own, 0))) for _, k in near]
        inside = [0 <= (new - own) @ (minority[k] - own) <= (minority[k] - own) @ (minority[k] - own) for _, k in near]
        assert any(g < 1e-9 and i for g, i in zip(gaps, inside))
    even = df.where("id < 18")
    assert oversample_minority(even, ["a", "b"], "y", "id").count() == 0


def test_recall_candidates_are_those_of_single_fits(spark, sf):
    """Eight weights in shared passes choose what single fits choose; the resampled ones are reported only."""
    table = split_table(spark, sf)
    weights = [1.0, 3.0]
    out = M.recall_optimise(table, BASE, weights, KEY, trees=3)
    test = {r["model_name"]: r for r in out["test"].collect()}
    assert set(test) == {"weight_1_0", "weight_3_0", "resampled", "resampled_weighted"}
    assert out["chosen"].collect()[0]["model_name"] in ("weight_1_0", "weight_3_0")
    scores = {(r["model_name"], r[KEY], r["split"]): r["y_proba"] for r in out["scores"].collect()}
    for name, weight in (("weight_1_0", 1.0), ("weight_3_0", 3.0)):
        for train, held in (("split = 'train'", "validation"), ("split <> 'test'", "test")):
            model = M.train_boosted(table.where(train), BASE, positive_weight=weight, trees=3)
            for r in model.predictions(table.where(f"split = '{held}'"), KEY, name).collect():
                assert math.isclose(scores[name, r[KEY], held], r["y_proba"], abs_tol=1e-9)
