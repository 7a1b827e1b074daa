"""Property and partition-invariance checks."""

import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoframe.operators import metrics as mt
from chronoframe.operators import order as od
from chronoframe.operators import split as sp
from conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_kfold_sizes_and_invariance(spark):
    o = _orders(spark).select("o_orderkey")
    n = o.count()
    results = []
    for parts in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        f = sp.kfold(o, "o_orderkey", 7, 42)
        results.append(sorted((r[0], r[1]) for r in f.select("o_orderkey", "fold").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    sizes = {}
    for _, fold in results[0]:
        sizes[fold] = sizes.get(fold, 0) + 1
    assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes.values()) <= 1
    assert [sizes[k] for k in sorted(sizes)] == sorted(sizes.values(), reverse=True)


def test_exact_split_is_disjoint_and_complete(spark):
    o = _orders(spark).select("o_orderkey")
    s = sp.random_split_exact(o, "o_orderkey", 0.25, 1)
    n = o.count()
    c = {r[0]: r[1] for r in s.groupBy("split").count().collect()}
    assert c["test"] == int(n * 0.25) and c["test"] + c["train"] == n
    assert s.select("o_orderkey").distinct().count() == n


def test_global_position_matches_row_number(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    got = od.global_position(li.dropDuplicates(keys), keys, partitions=5)
    ref = li.dropDuplicates(keys).withColumn("rn", F.row_number().over(Window.orderBy(*keys)) - 1)
    diff = got.join(ref, keys).where(F.col("pos") != F.col("rn")).count()
    assert diff == 0


def test_kendall_and_auc_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 6) / 6, rnd.randint(0, 4) / 4, rnd.randint(0, 1)) for _ in range(120)]
    df = spark.createDataFrame(rows, "x double, y double, lab int")
    conc = disc = 0
    for (x1, y1, _), (x2, y2, _) in itertools.combinations(rows, 2):
        s = (x1 - x2) * (y1 - y2)
        conc += s > 0
        disc += s < 0
    n = len(rows)
    n0 = n * (n - 1) / 2
    tx = sum(v * (v - 1) / 2 for v in _counts([r[0] for r in rows]).values())
    ty = sum(v * (v - 1) / 2 for v in _counts([r[1] for r in rows]).values())
    tau = (conc - disc) / ((n0 - tx) * (n0 - ty)) ** 0.5
    assert mt.kendall_tau_b(df, "x", "y").first()[0] == pytest.approx(tau)
    pos = [r[0] for r in rows if r[2] == 1]
    neg = [r[0] for r in rows if r[2] == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert mt.roc_auc(df, "lab", "x").first()[0] == pytest.approx(auc)


def _counts(vals):
    out = {}
    for v in vals:
        out[v] = out.get(v, 0) + 1
    return out


def test_bias_variance_decomposition(spark):
    rows = [(r, i, float(i) + (r - 2) * 0.5 + (i % 3) * 0.1, float(i)) for r in range(5) for i in range(20)]
    df = spark.createDataFrame(rows, "round int, id int, p double, y double")
    b = mt.bias_variance(df, "round", "id", "p", "y").first()
    assert b["mse"] == pytest.approx(b["bias"] + b["var"])


def test_scale_inverse_identity(spark):
    from chronoframe.operators import prepare as pr
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_extendedprice")
    st = pr.fit_minmax(li, ["l_quantity", "l_extendedprice"])
    back = pr.apply_minmax(pr.apply_minmax(li, st, ["l_quantity", "l_extendedprice"]), st,
                           ["l_quantity", "l_extendedprice"], inverse=True)
    m = back.agg(F.min("l_quantity"), F.max("l_extendedprice")).first()
    ref = li.agg(F.min("l_quantity"), F.max("l_extendedprice")).first()
    assert m[0] == pytest.approx(ref[0]) and m[1] == pytest.approx(ref[1])


def test_rank_ensemble_invariant_to_monotone_transform(spark):
    from chronoframe.operators import ensemble as en
    rows = [(m, i, float((i * 7 + k) % 11)) for k, m in enumerate("abc") for i in range(30)]
    df = spark.createDataFrame(rows, "method string, id long, prediction double")
    a = {r[0]: r[1] for r in en.ensemble_rank(df).collect()}
    b = {r[0]: r[1] for r in en.ensemble_rank(df.withColumn("prediction", F.exp("prediction"))).collect()}
    assert a == b


def test_lag_samples_equal_time_shift_join(spark):
    from chronoframe.operators import timeseries as ts
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    b = ts.resample_mean(ev, "event_type", "ts", "value", 360)
    lags = ts.lag_features(b, "event_type", "ts", "value", 2, 360)
    j = ts.lag_by_time(b, "event_type", "ts", "value", 1, 360, name="prev")
    bad = lags.join(j, ["event_type", "ts"]).where(~F.col("lag_1").eqNullSafe(F.col("prev"))).count()
    assert lags.count() > 0 and bad == 0
