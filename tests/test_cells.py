"""Trees from sums over cells against the fits of ``pyspark.ml``; what a fit scans; the split by written hashes."""

import random

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from chronoframe.operators import cells
from chronoframe.operators import models as md
from chronoframe.operators import split as sp
from chronoframe.operators import trees as tr


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(3)
    rows = [(float(r.randint(0, 6)), float(r.randint(0, 4)), r.gauss(0, 30)) for _ in range(3000)]
    df = spark.createDataFrame([(*x, 50 + 2 * x[0] + x[1] * x[1] + x[2] / 10 + r.random()) for x in rows], "a double, b double, c double, y double")
    return df.repartition(4).cache()


def nodes(model):
    return {(r["tree"], r["node"]): r for r in tr.node_table(model).collect()}


@pytest.mark.parametrize("boosted", [False, True])
def test_trees_of_few_values_are_those_of_the_library(points, boosted):
    est = GBTRegressor(labelCol="y", maxIter=5, maxDepth=3, stepSize=0.3, seed=1) if boosted else DecisionTreeRegressor(labelCol="y", maxDepth=4, seed=1)
    want, got = nodes(est.fit(md.assemble(points, ["a", "b"]))), nodes(md.fit_regressor(est, points, "y", ["a", "b"]))
    assert set(got) == set(want)
    for k, w in want.items():
        assert all((got[k][c] is None) == (w[c] is None) for c in ("feature", "threshold", "gain"))
        assert (got[k]["feature"], got[k]["rows"]) == (w["feature"], w["rows"])
        assert all(got[k][c] == pytest.approx(w[c], rel=1e-7, abs=1e-7) for c in ("threshold", "value", "gain", "weight", "tree_weight") if w[c] is not None)


def test_fits_of_many_values_are_as_good_as_those_of_the_library(points):
    data, xs = md.assemble(points, ["a", "b", "c"]), ["a", "b", "c"]
    for est in (DecisionTreeRegressor(labelCol="y", maxDepth=5, seed=1), GBTRegressor(labelCol="y", maxIter=8, maxDepth=3, stepSize=0.3, seed=1), RandomForestRegressor(labelCol="y", numTrees=15, maxDepth=5, seed=1)):
        model = md.fit_regressor(est, points, "y", xs)
        own, library = md.rmse(model.transform(data), "y"), md.rmse(est.fit(data).transform(data), "y")
        assert own < (1.4 if isinstance(est, RandomForestRegressor) else 1.1) * library and type(model) is type(est.fit(data.limit(50))), type(est)


def test_a_heavy_value_takes_one_bin_and_the_others_share_the_rest(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3600, 0.0).otherwise(F.col("id").cast("double")).alias("x"))
    (last, thresholds), = cells.cut_points(df, ["x"], 16)
    assert last[0] == 0 and 12 <= len(last) <= 15 and list(last) == sorted(set(last)) and list(thresholds) == list(last)
    (last, thresholds), = cells.cut_points(spark.createDataFrame([(v,) for v in (5.0, 1.0, 2.0, 5.0)], "x double"), ["x"], 3)
    assert (list(last), list(thresholds)) == ([1.0, 2.0], [1.5, 3.5])


def test_fits_scan_their_written_rows_a_few_times(spark, points, monkeypatch):
    """Twelve rounds of depth 4 made one scan for each level of each tree."""
    keep, seen = md.materialize, spark.sparkContext.accumulator(0)

    def counted(df, name):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return keep(df, name).mapInArrow(run, df.schema)

    monkeypatch.setattr(md, "materialize", counted)
    model = md.fit_gbt(points, "y", ["a", "b"], rounds=12, depth=4, eta=0.1)
    assert len(model.treeWeights) == 12 and seen.value <= 4 * 3000
    before = seen.value
    md.run_models(points, points, "y", ["a", "b"], ["tree"])       # the three fits share the mean, the cuts and the sums
    assert seen.value - before <= 4 * 3000


def test_a_null_or_infinite_value_is_an_error(spark):
    for bad in ((None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf"))):
        df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), bad], "a double, y double")
        with pytest.raises(Exception):
            md.fit_tree(df, "y", ["a"])
    with pytest.raises(Exception):
        md.fit_tree(spark.createDataFrame([], "a double, y double"), "y", ["a"])
    flat = md.fit_gbt(spark.createDataFrame([(1.0, 4.0), (2.0, 4.0)], "a double, y double"), "y", ["a"], rounds=3)
    assert {(r["node"], r["value"]) for r in tr.node_table(flat).collect()} == {(1, 4.0), (1, 0.0)}


def test_wide_tables_are_fitted_by_the_library(spark):
    assert cells.fits_cells(GBTRegressor(maxBins=32), 4) and not cells.fits_cells(GBTRegressor(maxBins=32), 5)
    assert not cells.fits_cells(RandomForestRegressor(numTrees=50), 4)


def test_a_split_by_written_hashes_is_the_same(spark):
    r = random.Random(8)
    ids = [f"k{r.randint(0, 900)}" for _ in range(700)] + ["k1"] * 90 + [None] * 9             # ids may repeat or be null
    whole = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "k string, v int").repartition(5)
    for df, ratio, up in ((whole, 0.2, False), (whole, 0.003, True), (whole, 0.0, False), (whole, 0.555, False), (whole, 1.0, False), (whole.where("false"), 0.2, False),
                          (whole.where("k = 'k1'"), 0.5, False)):
        want = sp.random_split_exact(df, "k", ratio, 3, up).groupBy("k", "split").count()
        got = sp.random_split_exact(df.withColumn("key", sp.hash_bytes(3, "k")), "key", ratio, 3, up, hashed=True).groupBy("k", "split").count()
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), (ratio, up)
