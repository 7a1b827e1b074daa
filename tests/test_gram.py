"""Blocked Gram matrices and what stands on them: wide correlations, gradient descents, bootstrap weights, refits."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.operators import gram, models, split
from chronoframe.operators import metrics as mt


def frame(spark, rows, cols, parts=3):
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(parts)


@pytest.fixture(scope="module")
def table():
    r = np.random.default_rng(1)
    x = r.standard_normal((400, 17)) @ r.standard_normal((17, 17)) + 1e6 * np.arange(17)
    rows = [[None if r.random() < 0.1 else float(v) for v in row] for row in x]
    for row in rows:
        row[3] = 0.1                    # constant
        row[5] = None if rows.index(row) % 2 else row[5]
    for k, row in enumerate(rows):
        row[6] = None if k % 2 == 0 else row[6]      # never together with column 5
    rows[7][9] = float("nan")
    return rows


def pearson(rows, i, j):
    both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
    if any(not math.isfinite(v) for p in both for v in p):
        return "nan"
    if not both:
        return None
    a, b = np.array(both).T
    if np.ptp(a) == 0 or np.ptp(b) == 0:
        return None
    return float(np.corrcoef(a, b)[0, 1])


@pytest.mark.parametrize("block", [4, 128])
def test_correlations_pair_by_pair(spark, table, block):
    cols = [f"c{i}" for i in range(17)]
    got = {(r["a"], r["b"]): r["corr"] for r in gram.corr_pairs(frame(spark, table, cols), cols, block).collect()}
    assert len(got) == 17 * 17
    for i in range(17):
        for j in range(17):
            want, have = pearson(table, i, j), got[f"c{i}", f"c{j}"]
            if want is None or want == "nan":
                assert have is None if want is None else math.isnan(have), (i, j)
            else:
                assert abs(have - want) < 1e-9, (i, j)


def test_many_scans_give_the_same_and_the_plan_does_not_grow(spark, table):
    cols = [f"c{i}" for i in range(17)]
    df = frame(spark, table, cols).select(gram.vector(cols).alias("v"))
    one = {(r["i"], r["j0"]): r["part"] for r in gram.comoments(df, "v", 17, block=4).collect()}
    many = {(r["i"], r["j0"]): r["part"] for r in gram.comoments(df, "v", 17, block=4, budget=4000).collect()}
    assert one.keys() == many.keys()
    for k in one:
        assert np.allclose(np.frombuffer(one[k]), np.frombuffer(many[k]), rtol=1e-9, equal_nan=True)
    wide = mt.corr_matrix(spark.range(5).select(*[(F.col("id") * k % 7).cast("double").alias(f"c{k}") for k in range(200)]), [f"c{k}" for k in range(200)])
    assert len(wide._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert wide.count() == 200 * 200


def test_covariance_of_no_rows_and_of_far_means(spark):
    r = np.random.default_rng(2)
    x = r.standard_normal((1000, 5)) + 1e8
    df = spark.createDataFrame([(row.tolist(),) for row in x] + [(None,)], "v array<double>").repartition(7)
    n, mean, c = gram.covariance(df, "v", 5)
    assert n == 1000 and np.allclose(mean, x.mean(axis=0), rtol=1e-14) and np.allclose(c, np.cov(x.T, bias=True), atol=1e-6)
    n, mean, c = gram.covariance(df.where("v is null"), "v", 5)
    assert n == 0 and not mean.any() and not c.any()
    with pytest.raises(Exception, match="another width"):
        gram.covariance(df, "v", 4)


def rows_of(n, seed=4):
    r = random.Random(seed)
    return [(i, r.uniform(-2, 2), r.uniform(0, 5)) for i in range(n)]


def descent(rows, lr, iters, link):
    x = np.array([(1.0, a, b) for _, a, b, _ in rows])
    y = np.array([t for *_, t in rows])
    w = np.zeros(3)
    for _ in range(iters):
        w = w - lr * ((link(x @ w) - y) @ x) / len(y)
    return w


def test_gradient_descents(spark):
    rows = [(i, a, b, 3 + 2 * a - b + math.sin(i)) for i, a, b in rows_of(500)]
    df = spark.createDataFrame(rows + [(900, None, 1.0, 1.0), (901, 1.0, 1.0, None)], "id long, a double, b double, y double").repartition(4)
    assert np.allclose(models.linreg_gd(df, "y", ["a", "b"], 0.05, 40), descent(rows, 0.05, 40, lambda z: z), atol=1e-12)
    binary = df.withColumn("y", (F.col("y") > 1).cast("int"))
    marks = [(i, a, b, float(y > 1)) for i, a, b, y in rows]
    assert np.allclose(models.logreg_gd(binary, "y", ["a", "b"], 0.2, 15), descent(marks, 0.2, 15, lambda z: 1 / (1 + np.exp(-z))), atol=1e-12)
    none = df.where("id < 0")
    assert models.linreg_gd(none, "y", ["a", "b"]) == [0, 0, 0] and models.logreg_gd(none, "y", ["a", "b"], iters=2) == [0, 0, 0]


def test_bootstrap_weights_against_a_plain_restatement(spark):
    """The tree drawn again in plain Python from the rows' hashes."""
    from hashlib import md5
    n, rounds, size, seed = 700, 6, 16, 11
    df = spark.createDataFrame(rows_of(n), "id long, a double, b double")
    got = {r["id"]: list(r["weights"]) for r in split.bootstrap_weights(df.repartition(3), "id", rounds, seed, bucket_rows=size).collect()}
    again = {r["id"]: list(r["weights"]) for r in split.bootstrap_weights(df.repartition(9), "id", rounds, seed, bucket_rows=size).collect()}
    assert got == again and len(got) == n
    content = {r["id"]: r["x"] for r in df.select("id", F.xxhash64(F.struct("id", "a", "b")).alias("x")).collect()}
    h = {i: int(md5(f"{seed}-{i}-{x}".encode()).hexdigest()[:15], 16) for i, x in content.items()}
    depth = 0
    while n > size * 16**depth:
        depth += 1

    def deal(level, node, ids, total):
        if level == depth:
            ids = sorted(ids, key=h.get)
            w = np.random.default_rng([seed, depth, node]).multinomial(total, np.full(len(ids), 1 / len(ids)))
            return {i: w[:, k].tolist() for k, i in enumerate(ids)}
        parts = [[i for i in ids if (h[i] >> 60 - 4 * (level + 1)) % 16 == c] for c in range(16)]
        counts = np.array([len(p) for p in parts], dtype=float)
        t = np.random.default_rng([seed, level, node]).multinomial(total, counts / counts.sum())
        out = {}
        for c, p in enumerate(parts):
            if p:
                out |= deal(level + 1, node * 16 + c, p, t[:, c])
        return out

    assert got == deal(0, 0, list(h), np.full(rounds, n))
    assert all(sum(w[r] for w in got.values()) == n for r in range(rounds))


def test_bootstrap_weights_are_like_draws_with_replacement(spark):
    n, rounds = 3000, 40
    w = np.array([r[0] for r in split.bootstrap_weights(spark.range(n), "id", rounds, 5, bucket_rows=64).select("weights").collect()])
    assert (w.sum(axis=0) == n).all()
    share = [(w == k).mean() for k in range(4)]
    assert np.allclose(share, [math.exp(-1) / math.factorial(k) for k in range(4)], atol=0.006)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.08


def test_bootstrap_weights_of_repeats_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (3, 2.0), (3, 2.5), (3, 2.5)] * 20, "id long, _c double")
    rows = split.bootstrap_weights(df, "id", 5, 1, bucket_rows=4).collect()
    assert len(rows) == 100 and all(sum(r["weights"][k] for r in rows) == 100 for k in range(5))
    assert split.bootstrap_weights(df.where("id = 9"), "id", 5, 1).collect() == []


def test_bias_variance_of_refitted_models(spark):
    r = random.Random(3)
    rows = [(i, a, b, 1e4 + 5 * a - b + r.gauss(0, 3)) for i, a, b in rows_of(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    rounds = 25
    drawn = split.bootstrap_weights(train, "id", rounds, 7, name="w")
    got = mt.bias_variance_refit(drawn, test, "y", ["a", "b"], "w", rounds).first()
    t = drawn.collect()
    x, y, w = np.array([(1, q["a"], q["b"]) for q in t]), np.array([q["y"] for q in t]), np.array([q["w"] for q in t])
    xt, yt = np.array([(1, a, b) for i, a, b, _ in rows if i % 3 == 0]), np.array([v for i, *_, v in rows if i % 3 == 0])
    p = []
    for k in range(rounds):
        again = np.repeat(np.arange(len(y)), w[:, k])              # the sample itself
        p.append(xt @ np.linalg.lstsq(x[again], y[again], rcond=None)[0])
    p = np.array(p)
    assert got["rounds"] == rounds
    assert np.allclose([got["mse"], got["bias"], got["var"]], [((p - yt) ** 2).mean(), ((p.mean(axis=0) - yt) ** 2).mean(), p.var(axis=0).mean()], rtol=1e-8)
    assert abs(got["mse"] - got["bias"] - got["var"]) < 1e-9
    none = mt.bias_variance_refit(drawn, test.where("id < 0"), "y", ["a", "b"], "w", rounds).first()
    assert none["mse"] is None and none["rounds"] == 0


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 16])
def test_grid_does_not_depend_on_the_piece(spark, block):
    from datetime import datetime, timedelta

    from chronoframe.operators import timeseries as ts
    at = datetime(2024, 2, 28, 23, 7)
    rows = [("a", at), ("a", at + timedelta(minutes=95)), ("b", at), (None, at), (None, at + timedelta(minutes=30)), ("c", None)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz")
    got = sorted(((r["s"] or "", r["t"]) for r in ts.grid(df, "s", "t", 10, True, block).collect()))
    first = datetime(2024, 2, 28, 23, 0)
    want = [("", first + timedelta(minutes=10 * k)) for k in range(4)] + [("a", first + timedelta(minutes=10 * k)) for k in range(11)] + [("b", first)]
    assert got == sorted(want)
    assert ts.grid(df.where("t is null"), "s", "t", 10, True, block).collect() == []


def test_a_long_segment_is_many_rows_over_many_tasks(spark):
    from chronoframe.operators import timeseries as ts
    df = spark.sql("SELECT 'a' AS s, timestamp_ntz'2000-01-01' AS t UNION ALL SELECT 'a', timestamp_ntz'2003-10-21'")
    g = ts.grid(df, "s", "t", 1, block=1 << 14).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in g) == 2_000_161 and len(g) > 4
