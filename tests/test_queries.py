"""Registered queries against their SQL twins on the smallest tables."""

import functools

import pytest

import __spark_entry__ as entry
from scorewright.operators import models as M
from scorewright.plans import catalogue
from tools.compare import compare, connect

# Every family is covered; the full list is run by tools/compare.py.
CHECKED = [
    "headline", "adapt_schema", "prepare_table", "legacy_group_parse", "scan_predictions",
    "classification_report", "pr_curve", "threshold_grid", "group_outcome", "fairness_ext",
    "threshold_frontier", "calibration_bins", "coverage_audit", "profile", "reweigh",
    "mutual_info_target", "feature_group_assoc", "threshold_optimizer", "selection_summary",
    "policy_record", "split_group_stratified", "split_validation", "overlap_check",
    "target_shuffle", "join_nearest", "topk_drivers", "guidance_top3", "explanation_text",
    "scenario_exposure", "sensitivity_flip", "shortcomings",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(name, spark, con, sf):
    good, note = compare(name, spark, con, sf)
    assert good, note


def test_catalogue_is_whole(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert len(queries) >= 130 and set(sql) <= set(queries)
    assert len(sql) >= 110


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def few_trees(fit, df, features, specs, target="Default_Flag", trees=150, **more):
    return fit(df, features, specs, target, trees=2, **more)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_runs(name, spark, sf, monkeypatch):
    """With fewer trees and epochs than the query fits: here it counts that it runs."""
    fit = M.fit_network
    monkeypatch.setattr(M, "boost_many", functools.partial(few_trees, M.boost_many))
    monkeypatch.setattr(M, "fit_network", lambda train, held, balanced, epochs: fit(train, held, balanced, 2))
    df = catalogue.QUERIES[name](spark, sf)
    assert df.columns and df.count() > 0
