"""Nulls, NaN, single classes, constant columns, ragged vectors, long lags, and results that must not depend on
how rows are cut into blocks."""

import random

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from chronoframe.functions import text as tx
from chronoframe.operators import frame as fr
from chronoframe.operators import metrics as mt
from chronoframe.operators import models as md
from chronoframe.operators import prepare as pr
from chronoframe.operators import split as sp
from chronoframe.operators import timeseries as ts
from chronoframe.operators import vectors as vx
from chronoframe.operators.ensemble import ensemble_rank
from chronoframe.operators.order import average_rank, modes, quantiles
from chronoframe.session import drop_stages, materialize
from chronoframe.sources import io
from chronoframe.sources.generators import sample_dist


def series(spark, n=200, gaps=()):
    r = random.Random(1)
    rows = [("s", 60 * i, None if i in gaps else r.random()) for i in range(n)] + [("t", 60 * i, float(i)) for i in range(7)]
    return spark.createDataFrame(rows, "seg string, sec long, v double").select("seg", F.timestamp_seconds("sec").cast("timestamp_ntz").alias("ts"), "v")


def test_lag_samples_for_any_lag_and_block(spark):
    df = series(spark)
    for lag in (5, 64, 100, 130):
        found = {b: sorted(map(tuple, ts.lag_features(df, "seg", "ts", "v", lag, 1, block_steps=b).collect())) for b in (7, 64, 1 << 14)}
        assert found[7] == found[64] == found[1 << 14]
        assert len(found[64]) == 200 - lag + max(0, 7 - lag)


def test_blocks_do_not_change_windows(spark):
    df = series(spark, 90, gaps=set(range(0, 4)) | set(range(20, 45)) | {89})
    for fn in (lambda b: ts.fill_null(df, "seg", "ts", "v", "forward", fine_seconds=b), lambda b: ts.fill_null(df, "seg", "ts", "v", "backward", fine_seconds=b),
               lambda b: ts.rolling_mean(df, "seg", "ts", "v", 6, name="m", block_rows=b), lambda b: ts.sliding_samples(df, "seg", "ts", ["v"], "v", 4, 2, 3, block_rows=b),
               lambda b: ts.ema(df, "seg", "ts", "v", 0.9, block_rows=b), lambda b: ts.chrono_split(df, "seg", "ts", block_rows=b)):
        got = [sorted((tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in fn(b).collect()), key=repr) for b in (3, 10, 1 << 17)]
        assert got[0] == got[1] == got[2] and got[0]


def test_ema_takes_a_null_as_no_observation(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([None, 1.0, None, 3.0, 5.0])], "seg string, i long, v double").select("seg", F.timestamp_seconds("i").alias("ts"), "v")
    got = [r.ema for r in ts.ema(df, "seg", "ts", "v", 0.9).orderBy("ts").collect()]
    assert got == [None, 1.0, 1.0, 2.0, pytest.approx(3.0)]


def test_guards_run(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 2.0], "train"), ("b", [1.0], "train")], "seg string, x array<double>, split string")
    with pytest.raises(Exception, match="sample width"):
        io.write_samples(df, str(tmp_path / "x"), "x", 2)
    dup = series(spark, 5).unionAll(series(spark, 1))
    with pytest.raises(Exception, match="duplicate timestamp"):
        ts.check_unique_ts(dup, "seg", "ts").collect()
    assert ts.check_unique_ts(series(spark, 5), "seg", "ts").count() == 12
    assert len(ts.check_unique_ts(dup, "seg", "ts", "mean").collect()) == len(ts.check_unique_ts(dup, "seg", "ts", "first").collect()) == 12
    day = spark.createDataFrame([("2024-01-01", 30)], "d string, t int").select(F.col("d").cast("timestamp_ntz").alias("d"), "t")
    with pytest.raises(Exception, match="midnight"):
        ts.time_id_to_datetime(day, "d", "t", 60).collect()
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        io.read_csvs(spark, str(tmp_path / "none"), schema="a int")


def test_nulls_and_single_classes_in_metrics(spark):
    df = spark.createDataFrame([(None,), (None,), (1.0,), (2.0,), (2.0,)], "x double")
    assert sorted((r.x, r.x_rank) for r in average_rank(df, "x").collect() if r.x) == [(1.0, 1.0), (2.0, 2.5), (2.0, 2.5)]
    one = spark.createDataFrame([(1, 0.2), (1, 0.4), (None, 0.1), (1, None)], "y int, s double")
    assert mt.roc_auc(one, "y", "s").first()["auc"] is None
    const = spark.createDataFrame([(1.0, 1.5, 2.0), (1.0, 0.5, 3.0)], "y double, p double, q double")
    assert mt.regression_metrics(const, "y", "p").first()["r2"] is None
    assert mt.kendall_tau_b(const, "y", "q").first()["kendall"] is None
    assert ensemble_rank(spark.createDataFrame([("a", 1, 0.5)], "method string, id long, prediction double")).first()["prediction"] is None
    cm = mt.confusion_matrix(spark.createDataFrame([(0, 0), (1, 5)], "y int, p int"), "y", "p", [0, 1, 2]).orderBy("actual").collect()
    assert [tuple(r) for r in cm] == [(0, 1, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0)]
    big = spark.createDataFrame([(1e9 + i, 1e9 + i + 0.1) for i in range(100)], "y double, p double")
    assert mt.regression_metrics(big, "y", "p").first()["r2"] == pytest.approx(1 - 0.01 / 833.25, abs=1e-7)


def test_quantiles_and_modes(spark):
    r = random.Random(4)
    x = [r.choice([1.0, 2.0, 5.0, r.random()]) for _ in range(501)]
    df = spark.createDataFrame([(v, float(i % 3) if i % 7 else None, "b" if i % 2 else "a") for i, v in enumerate(x)], "x double, y double, s string")
    got = {(q.column, q.prob): q.value for q in quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    xs = sorted(x)
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        h = p * 500
        assert got["x", p] == pytest.approx(xs[int(h)] + (h - int(h)) * (xs[min(500, int(h) + 1)] - xs[int(h)]))
    assert got["y", 0.5] == 1.0 and modes(df, "s").first()["s"] == "a"
    d = fr.describe_exact(df, ["x"]).first()
    assert (d["count"], d["min"], d["max"]) == (501, xs[0], xs[-1]) and d["mean"] == pytest.approx(sum(x) / 501)
    none = df.where("false")
    assert quantiles(none, ["x"], [0.5]).count() == 0 and modes(none, "s").first()["s"] is None


def test_imputer_fills_nan_and_one_hot_takes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None), (3.0, "b"), (None, "z")], "x double, c string")
    assert sorted(r.x for r in pr.impute(df, ["x"], "median").collect()) == [1.0, 2.0, 2.0, 3.0]
    got = sorted(((r.c, r.c_a, r.c_b) for r in pr.one_hot(df.select("c"), "c", ["a", "b"]).collect()), key=repr)
    assert got == [("a", 1.0, 0.0), ("b", 0.0, 1.0), ("z", 0.0, 0.0), (None, 0.0, 0.0)]


def test_text_expressions(spark):
    row = spark.createDataFrame([("xbxb", "90", "1h2m3s", "soon", "[bold]a[/] [#ff0000]b[link=x]c[/link] [1] [OK]")], "a string, b string, c string, d string, e string")
    got = row.select(tx.replace_first("a", "a|b", "Z"), tx.parse_duration("b"), tx.parse_duration("c"), tx.parse_duration("d"), tx.strip_markup("e")).first()
    assert tuple(got) == ("xZxb", 90.0, 3723.0, None, "a bc [1] [OK]")


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [[1.0], [2.0, 3.0]], 7)], "i long, a array<double>, b array<array<double>>, c int")
    assert df.select(vx.flatten_values(df, ["a", "b", "c"])).first()[0] == [1, 2, 1, 2, 3, 7]
    ragged = spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 1)], "i long, v array<double>, l int")
    with pytest.raises(ValueError, match="widths"):
        vx.knn_class_share(ragged, ragged, "i", "v", "l")


@pytest.mark.parametrize("cell", [4096, 6])
def test_neighbours_against_brute_force(spark, cell):
    r = random.Random(6)
    rows = [(i, [r.gauss(i % 4, 0.5), r.gauss(i % 3, 0.5), r.random()], i % 4) for i in range(120)] + [(500 + i, [0.5, 0.5, 0.5], i) for i in range(4)]
    train, query = rows[20:], rows[:20] + [(900, [0.5, 0.5, 0.5], 0)]
    make = lambda x: spark.createDataFrame(x, "i long, v array<double>, l int")
    got = {(x.i, x.l): x.share for x in vx.knn_class_share(make(train), make(query), "i", "v", "l", k=5, cell_rows=cell, block_rows=16).collect()}
    want = {}
    for i, v, _ in query:
        near = sorted(train, key=lambda t: (sum((a - b) ** 2 for a, b in zip(v, t[1])), t[0]))[:5]
        for _, _, lab in near:
            want[i, lab] = want.get((i, lab), 0) + 0.2
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def table(spark, n=60):
    r = random.Random(8)
    return spark.createDataFrame([(i, r.random(), r.random(), 0.0) for i in range(n)], "i long, a double, b double, y double").withColumn("y", 3 * F.col("a") - F.col("b"))


@pytest.mark.parametrize("k", [2, 3, 5])
def test_searches_for_any_number_of_folds(spark, k):
    est = LinearRegression(featuresCol="features", labelCol="y")
    res = md.grid_search(table(spark), "i", "y", ["a", "b"], est, [{"regParam": [0.0, 1.0]}, {"maxIter": [5]}], k=k)
    assert [p for p, _ in res] == [{"regParam": 0.0}, {"regParam": 1.0}, {"maxIter": 5}] and res[0][1] < 1e-6 < res[1][1]


def test_null_features_never_drop_rows(spark):
    df = table(spark).withColumn("y", (F.col("a") > 0.5).cast("double"))
    test = df.withColumn("a", F.when(F.col("i") % 3 != 0, F.col("a")))
    out = md.blend(df, df, test, "y", {"m": ["a"], "n": ["b"]}).collect()
    assert len(out) == 60 and sum(r.blend is None for r in out) == 20
    with pytest.raises(Exception):
        md.fit_linear(test, "y", ["a", "b"])
    holes = table(spark).withColumns({"y": F.when(F.col("i") % 4 != 0, F.col("y")), "a": F.when(F.col("i") != 8, F.col("a"))})
    full = md.impute_by_model(holes, "y", ["a", "b"])
    mean = holes.agg(F.avg("y")).first()[0]
    rows = {r.i: r for r in full.collect()}
    assert len(rows) == 60 and rows[8].y == pytest.approx(mean) and rows[4].y == pytest.approx(3 * rows[4].a - rows[4].b)


def test_row_ids_are_unique_and_stable(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a long, b string")
    ids = sorted(r.rid for r in sp.with_row_id(df).collect())
    assert len(set(ids)) == 4 and ids == sorted(r.rid for r in sp.with_row_id(df.repartition(3)).collect())


def test_narrow_types_keeps_an_empty_column(spark):
    df = spark.createDataFrame([(1, None, 1.5), (126, None, 2.5)], "a long, b long, c double")
    assert dict(fr.narrow_types(df).dtypes) == {"a": "tinyint", "b": "bigint", "c": "float"}
    assert {r.col_name: r.dtype for r in fr.narrow_plan(df).collect()} == {"a": "tinyint", "b": "bigint", "c": "float"}


def test_beta_quantiles(spark):
    u = spark.createDataFrame([(0.0625,), (0.5,), (0.9,)], "u double")
    assert [round(r[0], 9) for r in u.select(sample_dist(F.col("u"), "beta", a=2, b=1)).collect()] == [0.25, round(0.5**0.5, 9), round(0.9**0.5, 9)]
    half = u.select(sample_dist(F.col("u"), "beta", a=0.5, b=0.5)).collect()
    assert half[1][0] == pytest.approx(0.5)


def test_stages_can_be_dropped(spark):
    df = materialize(spark.range(5), "probe")
    path = df.inputFiles()[0]
    assert drop_stages(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
