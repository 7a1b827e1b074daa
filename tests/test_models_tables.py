"""Node tables of trees, sparse encodings, narrowing quantiles, averages, first rows, batches and stages, against plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from chronoframe.operators import frame as fr
from chronoframe.operators import models as md
from chronoframe.operators import prepare as pr
from chronoframe.operators import timeseries as ts
from chronoframe.operators import trees as tr
from chronoframe.operators.order import quantiles
from chronoframe.operators.stages import RatioFeatures, TopFeatures, WideEncoder
from chronoframe.sources import io


def test_quantiles_by_narrowing(spark):
    r = random.Random(6)
    cols = {"even": [r.random() for _ in range(900)], "heavy": [math.exp(r.uniform(-300, 300)) for _ in range(900)], "few": [float(r.randint(0, 3)) for _ in range(900)],
            "ends": [r.choice([float("-inf"), float("inf"), 1.0, -2.5]) for _ in range(900)], "gaps": [None if r.random() < 0.5 else r.gauss(1e9, 1e-3) for _ in range(900)],
            "wide": [r.choice([-1.7e308, 1.7e308, 5e-324, 0.0, -0.0]) for _ in range(900)], "nan": [float("nan")] * 900}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(5)
    probs = [0.0, 0.1, 0.5, 0.731, 1.0]
    for limit in (20, 1 << 20):
        got = {(q["column"], q["prob"]): q["value"] for q in quantiles(df, list(cols), probs, limit=limit).collect()}
        assert len(got) == 6 * len(probs)
        for c in list(cols)[:-1]:
            v = sorted(x for x in cols[c] if x is not None)
            for p in probs:
                h = p * (len(v) - 1)
                a, z = v[math.floor(h)], v[math.ceil(h)]
                want = a if a == z else a + (z - a) * (h - math.floor(h))
                assert got[c, p] == want or math.isnan(want) and math.isnan(got[c, p]), (c, p, limit)


@pytest.mark.parametrize("alpha", [0.0, 0.995, 1.0])
def test_averages_do_not_depend_on_the_block(spark, alpha):
    r = random.Random(2)
    rows = [(s, i, None if r.random() < 0.1 else r.gauss(0, 1) * 10 ** r.randint(-3, 3)) for s in "ab" for i in range(700 if s == "a" else 3)]
    df = spark.createDataFrame(rows, "s string, i long, v double").withColumn("i", F.timestamp_seconds("i")).repartition(3)
    want = {}
    for s in "ab":
        e, t = None, 0
        for _, i, v in sorted(x for x in rows if x[0] == s):
            if v is not None:
                a = min(1 - 1 / (t + 1), alpha)
                e, t = v if e is None else a * e + (1 - a) * v, t + 1
            want[s, i] = e
    for block in (2, 1 << 16):
        got = {(q["s"], q["i"]): q["ema"] for q in ts.ema(df, "s", "i", "v", alpha, block_rows=block).select("s", F.unix_seconds("i").alias("i"), "ema").collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert v is None and got[k] is None or got[k] == pytest.approx(v, rel=1e-9, abs=1e-12), (k, block)
    plan = ts.ema(df, "s", "i", "v", alpha)._jdf.queryExecution().optimizedPlan().toString()
    assert "InPandas" not in plan and "InArrow" not in plan and "Python" not in plan


def test_first_rows(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, None), ("a", 1, "y"), (None, 2, "z"), ("b", None, "n"), ("b", 0, "m")], "k string, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in fr.unique_by(df, ["k"], ["o", F.col("v")]).collect()}
    assert got == {"a": (1, None), None: (2, "z"), "b": (None, "n")}
    assert fr.unique_by(df.select("k"), ["k"], ["k"]).count() == 3 and fr.unique_by(df.where("false"), ["k"], ["o"]).count() == 0


def test_a_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "samples")
    rows = lambda n, split="train": spark.range(n).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("x"), F.lit(split).alias("split"))
    io.write_samples(rows(5).union(rows(2, "val")), path, "x", 2, batch="b-1")
    io.write_samples(rows(7), path, "x", 2, batch="b-2")
    with pytest.raises(Exception, match="sample width"):
        io.write_samples(rows(9), path, "x", 3, batch="b-2")          # a write that fails
    io.write_samples(rows(7), path, "x", 2, batch="b-2")
    io.write_samples(rows(4), path, "x", 2, batch="b-1")
    assert {(r["batch"], r["split"]): r["count"] for r in io.load_samples(spark, path).groupBy("batch", "split").count().collect()} == {("b-1", "train"): 4, ("b-2", "train"): 7}
    with pytest.raises(ValueError):
        io.write_samples(rows(1), path, "x", 2, batch="../x")


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(9)
    rows = [(i, r.random(), float(r.randint(0, 5)), r.gauss(0, 1)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    return df.withColumn("y", F.col("a") * 3 + F.col("b") * F.col("a") + F.sin("c")).withColumn("cls", (F.col("y") > 2).cast("double") + (F.col("y") > 4).cast("double")).cache()


def test_node_tables_are_the_models(spark, points):
    xs = ["a", "b", "c"]
    rows = points.unionByName(points.limit(1).withColumns({"id": F.lit(9999).cast("long"), "a": F.lit(None).cast("double")}))
    for m, boosted in ((md.fit_tree(points, "y", xs, depth=4), False), (md.fit_forest(points, "y", xs, trees=7, depth=4), False), (md.fit_gbt(points, "y", xs, rounds=5, depth=3, eta=0.3), True)):
        nodes = tr.node_table(m)
        mine = {r["id"]: r["prediction"] for r in tr.score_by_nodes(rows, nodes, xs, ["id"], boosted).collect()}
        theirs = {r["id"]: r["p"] for r in md.score_rows(m, rows, xs, F.col("prediction"), "p").collect()}
        assert mine.keys() == theirs.keys() and mine[9999] is None is theirs[9999]
        assert all(mine[i] == pytest.approx(p, rel=1e-12) for i, p in theirs.items() if p is not None)
        if not boosted:
            imp = {r["feature"]: r["importance"] for r in tr.importances_by_nodes(nodes, xs).collect()}
            assert imp == pytest.approx(dict(md.importances(m, xs)), rel=1e-9)
        boosted_imp = {r["feature"]: r["importance"] for r in tr.importances_by_nodes(nodes, xs, boosted=True).collect()}
        if boosted:
            assert boosted_imp == pytest.approx(dict(md.importances(m, xs)), rel=1e-9)
        by = defaultdict(dict)
        for n in nodes.collect():
            by[n["tree"]][n["node"]] = n
        for tree in by.values():         # children hold the rows of their parent
            for i, n in tree.items():
                assert (2 * i in tree) == (2 * i + 1 in tree) == (n["feature"] is not None)
                if n["feature"] is not None:
                    assert tree[2 * i]["rows"] + tree[2 * i + 1]["rows"] == n["rows"]


def test_a_single_leaf_and_a_classifier(spark, points):
    flat = md.fit_tree(points.withColumn("y", F.lit(2.5)), "y", ["a"], depth=3)
    nodes = tr.node_table(flat)
    assert nodes.count() == 1 and tr.score_by_nodes(points.limit(3), nodes, ["a"], ["id"], False).select("prediction").distinct().first()[0] == 2.5
    assert [r["importance"] for r in tr.importances_by_nodes(nodes, ["a"]).collect()] == [0.0]
    m = RandomForestClassifier(featuresCol="features", labelCol="cls", numTrees=1, maxDepth=3, seed=1).fit(md.assemble(points, ["a", "b"]))
    at = tr.leaves_of(points, tr.node_table(m), ["a", "b"], ["id"]).select("id", "value")
    both = at.join(m.transform(md.assemble(points, ["a", "b"])).select("id", "prediction"), "id")
    assert both.where("value <> prediction").count() == 0 and both.count() == 500


def test_sparse_encoding(spark, tmp_path):
    rows = [(1, "x", 5), (2, "y", 7), (3, None, 5), (4, "x", None), (5, None, None)]
    df = spark.createDataFrame(rows, "id long, a string, _size int")
    path = str(tmp_path / "p")
    Pipeline(stages=[WideEncoder(columns=["a", "_size"], folder=str(tmp_path / "tables"))]).fit(df).write().save(path)
    new = df.unionByName(spark.createDataFrame([(6, "unknown", 7)], df.schema))
    got = {r["id"]: (r["hot"]["size"], list(r["hot"]["indices"]), list(r["hot"]["values"])) for r in PipelineModel.load(path).transform(new).collect()}
    assert got == {1: (4, [0, 2], [1.0, 1.0]), 2: (4, [1, 3], [1.0, 1.0]), 3: (4, [2], [1.0]), 4: (4, [0], [1.0]), 5: (4, [], []), 6: (4, [3], [1.0])}
    hot = pr.one_hot_sparse(df, pr.wide_dictionary(df, ["a", "_size"]), ["a", "_size"])
    v = {r["id"]: r["v"].toArray().tolist() for r in hot.select("id", pr.as_ml_vector("hot").alias("v")).collect()}
    assert v[2] == [0, 1, 0, 1] and v[5] == [0, 0, 0, 0]
    with pytest.raises(ValueError, match="WideEncoder"):
        pr.categories(df, "a", limit=1)
    assert pr.categories(df, "a", limit=2) == ["x", "y"]
    empty = df.where("false")
    assert pr.one_hot_sparse(df, pr.wide_dictionary(empty, ["a"]), ["a"]).select("hot.size").distinct().first()[0] == 0


def test_ten_thousand_categories_train_a_model(spark):
    df = spark.range(10_000).select("id", F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") % 2).cast("double").alias("y"))
    x = pr.one_hot_sparse(df, pr.wide_dictionary(df, ["k"]), ["k"]).withColumn("features", pr.as_ml_vector("hot"))
    m = LinearRegression(labelCol="y", regParam=1.0, solver="l-bfgs", maxIter=2).fit(x)
    assert m.numFeatures == 10_000


def test_stages_are_saved(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i % 3), float(i * i)) for i in range(30)], "a double, b double, y double")
    stages = [RatioFeatures(ratios=[("r", "a", "b")]), TopFeatures(features=["a", "b", "r"], target="y", k=1)]
    Pipeline(stages=stages).fit(df).write().save(str(tmp_path / "s"))
    x = PipelineModel.load(str(tmp_path / "s")).transform(df)
    assert x.columns == ["a", "y"] and x.count() == 30


def test_ridge_over_fold_matrices(spark, points):
    got = md.ridge_search(points, "id", "y", ["a", "b"], [0.0, 0.5], k=4, seed=3)
    from chronoframe.operators.split import kfold
    rows = kfold(points, "id", 4, 3).collect()
    for penalty, fold, rmse in got:
        a, b = [[r for r in rows if (r["fold"] == fold) == own] for own in (False, True)]
        x, y = np.array([(r["a"], r["b"]) for r in a]), np.array([r["y"] for r in a])
        xc, yc = x - x.mean(axis=0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc / len(a) + penalty * np.eye(2), xc.T @ yc / len(a))
        e = np.array([r["y"] - y.mean() - (np.array([r["a"], r["b"]]) - x.mean(axis=0)) @ w for r in b])
        assert rmse == pytest.approx(math.sqrt((e**2).mean()), rel=1e-9)
    assert len(got) == 8 and md.ridge_search(points.where("false"), "id", "y", ["a"], [1.0]) == []


def test_a_search_stops_and_goes_on(spark, points, tmp_path):
    space = {"regParam": ("loguniform", 1e-4, 1.0)}
    log = str(tmp_path / "log")
    est = LinearRegression(featuresCol="features", labelCol="y", solver="normal")
    a = md.random_search(points, "id", "y", ["a"], est, space, trials=6, k=2, batch=2, max_seconds=0.0, log=log)
    assert len(a) == 2
    b = md.random_search(points, "id", "y", ["a"], est, space, trials=6, k=2, batch=2, log=log)
    assert len(b) == 6 and b[:2] == a and spark.read.parquet(log).count() == 6
    assert b == md.random_search(points, "id", "y", ["a"], est, space, trials=6, k=2)
