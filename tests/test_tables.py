"""Header, typing, features, labels, splits and quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright import schema as H
from scorewright.functions import labels as L
from scorewright.operators import audit as A
from scorewright.operators import neighbours as N
from scorewright.operators import prepare as P
from scorewright.operators import splits as X
from scorewright.operators.ordering import exact_quantiles


def coded(spark, n=40):
    """The synthetic raw table with coded headers."""
    rows = []
    for i in range(n):
        row = [20000 + 1000 * i, 1 + i % 2, 1 + i % 4, 1 + i % 3, 22 + i % 45]
        row += [(i + k) % 5 - 2 for k in range(6)]
        row += [1000 + 25 * i + 10 * k for k in range(6)]
        row += [100 + 5 * i + k for k in range(6)]
        rows.append([*row, i % 2])
    return spark.createDataFrame(rows, [*(f"X{i}" for i in range(1, 24)), "Y"])


def test_adapt_names_types_and_twice_is_once(spark):
    once = P.adapt_schema(coded(spark))
    assert set(H.BASE) <= set(once.columns) and H.TARGET in once.columns
    assert len(H.feature_columns(once, "application_public")) == 36
    assert "SEX" not in H.feature_columns(once, "application_public")
    assert len(H.feature_columns(once)) == 37
    again = P.adapt_schema(once)
    assert again.columns == once.columns and again.exceptAll(once).count() == 0


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        P.adapt_schema(coded(spark).drop("X5"))
    with pytest.raises(ValueError):
        H.feature_columns(coded(spark), "no_such_set")


def test_repeated_headers_are_numbered(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a.b", "c"])
    assert P.norm_columns(df).columns == ["A_B", "A_B_1", "C"]


def test_zero_limit_and_missing_months(spark):
    base = {n: 0.0 for n in H.BASE} | {"BILL_AMT1": 50.0, "PAY_0": 2.0}
    base["PAY_6"] = base["BILL_AMT6"] = base["PAY_AMT6"] = None
    schema = ", ".join(f"{n} double" for n in H.BASE)
    row = P.add_features(spark.createDataFrame([tuple(base[n] for n in H.BASE)], schema)).first()
    assert row.BillToLimitRatio_1 == 0 and row.AvgBillAmount == 10
    assert row.MaxPaymentDelay == 2 and row.NumDelayedMonths == 1


def test_bands_and_labels(spark):
    df = spark.createDataFrame([(0.29,), (0.30,), (0.60,), (0.61,)], "p double")
    bands = [r[0] for r in df.select(L.risk_band("p")).collect()]
    assert bands == ["Low Risk", "Medium Risk", "Medium Risk", "High Risk"]
    codes = spark.createDataFrame([("1",), ("2",)], "c string")
    assert [r[0] for r in codes.select(L.group_label("c")).collect()] == [
        "Male (SEX=1)", "Female (SEX=2)"]


def hot_table(spark):
    """A third of the rows are copies of one row."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("a"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 500 % 7 == 0).cast("int")).alias("y"),
    )


def test_group_split_keeps_copies_together(spark):
    split = X.split_group_stratified(hot_table(spark), ["a"], target="y")
    assert split.count() == 3000
    sides = split.groupBy("a", "y").agg(F.countDistinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0
    units = split.select("a", "y", "split").distinct()
    held, total = units.where("split = 'test'").count(), units.count()
    assert held == -(-total // 5)


def test_validation_split_is_disjoint_and_sized(spark):
    split = X.split_validation(X.split_simple(hot_table(spark), "id", "y"), "id", "y")
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"test": 600, "validation": 600, "train": 1800}


def test_shuffle_keeps_the_number_of_ones(spark):
    table = hot_table(spark)
    shuffled = X.target_shuffle(table, "id", "y")
    assert shuffled.agg(F.sum("y")).first()[0] == table.agg(F.sum("y")).first()[0]
    moved = shuffled.join(table.select("id", F.col("y").alias("was")), "id")
    assert moved.where("y <> was").count() > 300


def test_temporal_split_errors(spark):
    one = spark.createDataFrame([(1, "2020-01-01")], "id int, d string")
    with pytest.raises(Exception, match="empty test side"):
        X.split_temporal(one, "d", "id").collect()
    with pytest.raises(ValueError):
        X.split_temporal(one, "no_date", "id")


def test_quantiles_with_a_hot_value_and_gaps(spark):
    rng = np.random.default_rng(5)
    values = np.where(rng.random(4000) < 0.4, 3.0, rng.normal(size=4000))
    rows = [(float(v) if i % 50 else None, i % 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, g int")
    found = {r.g: r for r in exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0], ["g"]).collect()}
    for g in (0, 1):
        wanted = np.quantile([v for v, h in rows if h == g and v is not None], [0.0, 0.1, 0.5, 0.99, 1.0])
        assert found[g].quantiles == pytest.approx(list(wanted))


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1)], "x double, y int")
    assert A.feature_target_corr(df, ["x"], "y").first().correlation_with_target is None


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    # One crowded corner holds a third of the points, and some points are equal.
    points = np.round(np.vstack([rng.normal(size=(400, 3)), 0.01 * rng.normal(size=(200, 3)) + 4]), 2)
    points[10] = points[11]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    found = N.nearest(df, df, [], k=3, exclude_self=True, block=64).collect()
    near = {}
    for r in found:
        near.setdefault(r.id, {})[r["rank"]] = (r.neighbour_id, r.distance)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    assert len(near) == 600
    for i in range(600):
        order = sorted(range(600), key=lambda j: (gaps[i, j], j))[:3]
        assert [near[i][k][1] for k in (1, 2, 3)] == pytest.approx([gaps[i, j] for j in order])
        assert near[i][1][0] == min(j for j in range(600) if gaps[i, j] == gaps[i].min()) or (
            near[i][1][1] == pytest.approx(gaps[i].min()))


def test_both_directions_equal_brute_force_in_any_parts(spark, monkeypatch):
    """Rows travel once for each part of the other side; missing and infinite vectors have no neighbours and hide none."""
    monkeypatch.setattr(N, "PAIRS", 1)
    monkeypatch.setattr(N, "PARTS", 3)
    rng = np.random.default_rng(5)
    sides = [np.round(rng.normal(size=(n, 4)) * [1, 1, 100, 0.01], 1) for n in (500, 300)]
    sides[1][7], sides[0][3], sides[1][8, 2], sides[0][9, 1] = sides[0][4], sides[0][4], np.nan, np.inf
    tables = [
        spark.createDataFrame([(i, [float(v) for v in p], float(i)) for i, p in enumerate(x)] + [(n, None, 0.0)], "id long, vector array<double>, p double")
        for x, n in zip(sides, (500, 300))
    ]
    found = {(r.side, r.id): r for r in N.nearest_both(*tables, ["p"], block=32).collect()}
    assert len(found) == 499 + 299
    for side, (own, other) in enumerate((sides, sides[::-1])):
        good = np.flatnonzero(np.isfinite(other).all(axis=1))
        for i in np.flatnonzero(np.isfinite(own).all(axis=1)):
            gaps = np.sqrt(((other[good] - own[i]) ** 2).sum(axis=1))
            r = found[side, i]
            assert r.distance == pytest.approx(gaps.min()) and gaps[list(good).index(r.neighbour_id)] == pytest.approx(gaps.min())
            assert r.distance > 0 or r.neighbour_id == good[gaps == 0].min()
            assert (r.p, r.neighbour_p) == (i, r.neighbour_id)
    assert N.nearest(tables[0], tables[1].limit(0), []).count() == 0
    alone = {r.id: r for r in N.nearest(tables[0], tables[1], ["p"]).collect()}
    assert {i: (r.neighbour_id, r.distance) for i, r in alone.items()} == {i: (r.neighbour_id, r.distance) for (s, i), r in found.items() if not s}
