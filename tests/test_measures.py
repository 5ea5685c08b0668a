"""Hand-computed and published values of the score measures."""

import pytest
from pyspark.sql import functions as F

from scorewright.operators import confusion as C
from scorewright.operators import curves as R
from scorewright.operators import fairness as G
from scorewright.operators import selection as S
from scorewright.operators.confusion import Policy


@pytest.fixture(scope="module")
def four(spark):
    rows = [(1, 0, 0.10), (1, 1, 0.60), (2, 0, 0.70), (2, 1, 0.20)]
    table = spark.createDataFrame(rows, "SEX int, y_true int, y_proba double")
    return G.with_sex_group(table.withColumn("model_name", F.lit("m")))


def test_confusion_by_hand(spark):
    rows = [(0, 0.1), (0, 0.6), (1, 0.4), (1, 0.9)]
    row = C.confusion(spark.createDataFrame(rows, "y_true int, y_proba double"), 0.5).first()
    assert (row.true_positives, row.false_positives) == (1, 1)
    assert (row.true_negatives, row.false_negatives) == (1, 1)
    assert row.recall == row.specificity == row.f2 == 0.5
    assert row.expected_cost == 6


def test_grid_has_thirteen_thresholds_and_equals_direct_counts(four):
    assert len(C.GRID) == 13 and C.GRID[0] == 0.10 and C.GRID[-1] == 0.70
    grid = {r.threshold: r for r in C.threshold_grid(four).collect()}
    assert len(grid) == 13
    for threshold in C.GRID:
        assert grid[threshold].asDict() == pytest.approx(C.confusion(four, threshold).first().asDict())


def test_published_group_counts_give_published_gaps(spark):
    rows = [("p", "Male", 205, 96, 1676, 374), ("p", "Female", 248, 139, 2764, 500)]
    counts = spark.createDataFrame(rows, "policy string, `group` string, tp int, fp int, tn int, fn int")
    gaps = G.fairness_gaps(counts, ["policy"]).first()
    assert gaps.demographic_parity_difference == pytest.approx(0.022032268651218212, abs=1e-12)
    assert gaps.disparate_impact_ratio == pytest.approx(0.9753554494958341, abs=1e-12)
    assert gaps.equal_opportunity_difference == pytest.approx(0.006294570340171113, abs=1e-12)
    assert gaps.equalized_odds_difference == pytest.approx(0.022507919795332176, abs=1e-12)


def test_published_validation_row(spark):
    counts = spark.createDataFrame([(1217, 2951, 1722, 110)], "tp int, fp int, tn int, fn int")
    row = C._with_measures(counts, []).first()
    assert row.precision == pytest.approx(0.2919865642994242, abs=1e-12)
    assert row.f2 == pytest.approx(0.6421485859012241, abs=1e-12)
    assert row.expected_cost == 3501


def test_group_table_and_gaps_on_four_rows(four):
    table = {r.sex_code: r for r in G.group_confusion(four, [Policy("p", "m", 0.5)]).collect()}
    assert table[1].accuracy == 1 and table[1].group == "Male (SEX=1)"
    assert table[2].false_positive_rate == 1 and table[2].false_negative_rate == 1
    gaps = G.policy_gaps(four, [Policy("p", "m", 0.5)]).first()
    assert gaps.demographic_parity_difference == 0 and gaps.disparate_impact_ratio == 1
    assert gaps.false_positive_rate_difference == gaps.false_negative_rate_difference == 1


def test_calibration_keeps_empty_bins(spark):
    rows = [(1, 0, 0.05), (1, 1, 0.15), (2, 1, 0.95)]
    table = G.with_sex_group(spark.createDataFrame(rows, "SEX int, y_true int, y_proba double"))
    bins = {(r.sex_code, r.bin): r for r in G.calibration_bins(table, edges=[0.0, 0.1, 0.2, 1.0]).collect()}
    assert len(bins) == 6
    first = bins[1, "0.00-0.10"]
    assert first.n == 1 and first.calibration_gap == pytest.approx(-0.05)
    assert bins[2, "0.00-0.10"].n == 0 and bins[2, "0.00-0.10"].calibration_gap is None


def test_one_class_has_no_area(spark):
    table = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y_true int, y_proba double")
    row = R.ranking_metrics(table).first()
    assert row.roc_auc is None and row.pr_auc is None


def test_area_by_brute_force_with_many_ranges(spark):
    rows = [((i * 7919) % 3 == 0, ((i * 104729) % 997) / 997) for i in range(2000)]
    table = spark.createDataFrame([(int(y), p) for y, p in rows], "y_true int, y_proba double")
    positives = [p for y, p in rows if y]
    negatives = [p for y, p in rows if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert R.roc_auc(table).first().roc_auc == pytest.approx(won / len(positives) / len(negatives))


def _grid(spark, rows):
    table = spark.createDataFrame(rows, "threshold double, precision double, recall double, f2 double")
    return table.withColumns({"model_name": F.lit("m"), "f1": F.col("f2"), "expected_cost": F.lit(1)})


def test_rules(spark):
    first = _grid(spark, [(0.1, 0.40, 0.95, 0.80), (0.2, 0.51, 0.70, 0.65), (0.3, 0.60, 0.60, 0.60)])
    assert S.select_rule(first, S.RULE_A, ["model_name"]).first().threshold == 0.2
    second = _grid(spark, [(0.1, 0.40, 0.95, 0.82), (0.2, 0.44, 0.75, 0.76)])
    chosen = S.select_preferred(second, ["model_name"]).first()
    assert chosen.threshold == 0.1 and chosen.fallback_used
    summary = {r.selection_rule: r for r in S.selection_summary(second, ["model_name"]).collect()}
    assert len(summary) == 5 and not summary[S.RULE_A].available
    assert summary[S.RULE_A].threshold is None
    with pytest.raises(ValueError):
        S.select_rule(first, "no_such_rule", ["model_name"])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 137, 142, 300])
def test_exact_quantiles_of_any_number_of_rows(spark, n):
    from scorewright.operators.ordering import exact_quantiles

    rows = [("big", float(v % 7)) for v in range(1000)] + [("small", float(v)) for v in range(n)] + [("none", None)]
    probabilities = [k / 10 for k in range(11)]
    found = exact_quantiles(spark.createDataFrame(rows, "g string, x double"), ["x"], probabilities, ["g"])
    got = {r["g"]: r["quantiles"] for r in found.collect()}
    import numpy as np

    assert set(got) == {"big", "small"}
    assert np.allclose(got["small"], np.quantile(np.arange(n), probabilities))
    assert np.allclose(got["big"], np.quantile([v % 7 for v in range(1000)], probabilities))


def test_unlabelled_rows_and_other_labels_count_nowhere(spark):
    from scorewright.operators import fairness
    from scorewright.operators.confusion import Policy, confusion, threshold_grid

    rows = [(1, 0.9, "m", 1), (0, 0.1, "m", 1), (None, 0.8, "m", 1), (2, 0.7, "m", 1)]
    scored = spark.createDataFrame(rows, "y_true int, y_proba double, model_name string, SEX int")
    out = fairness.group_outcome(fairness.with_sex_group(scored), [Policy("p", "m", 0.5)]).collect()
    assert [(r["n"], r["mean_predicted_default_probability"]) for r in out] == [(2, 0.5)]


def test_lookups_beyond_the_map_are_joined(spark, monkeypatch):
    from scorewright.operators import ordering

    monkeypatch.setattr(ordering, "LOOKUP_LIMIT", 3)
    table = spark.range(10).selectExpr("id", "cast(id as string) as k")
    lookup = ordering.small_lookup(table.where("id < 8"), ["k"], "id")
    got = ordering.looked_up(table, "v", lookup, ["k"]).collect()
    assert {r["id"]: r["v"] for r in got} == {k: k if k < 8 else None for k in range(10)}
