"""Operator 12: eigenvectors against numpy, the query's columns against plain numpy and whole numbers, edge rows."""

from math import floor

import numpy as np
import pytest

from chronoframe.llm import whiten as w


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), 2.0 ** -np.arange(40), np.repeat([5.0, 3.0, 0.0], [3, 10, 7]), np.zeros(6), np.ones(5), np.array([1.0, 1 + 1e-9, 2.0, 1e6]),
    np.array([3.0]), np.r_[np.ones(20), 1e-12 * np.arange(20)]])
def test_components_against_numpy(values):
    r = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(r.standard_normal((len(values),) * 2))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, basis = w.components_of(v)
    top = max(np.linalg.norm(v), 1e-300)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1], atol=1e-13 * top)
    assert np.linalg.norm(basis.T @ basis - np.eye(len(values))) < 1e-12
    assert np.linalg.norm(v @ basis - basis * e) < 1e-12 * top


def test_polar_factor_is_the_matrix_sign():
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.standard_normal((30, 30)))
    d = np.r_[np.geomspace(1e-13, 10, 15), -np.geomspace(1e-10, 1e4, 15)]
    u = w.polar_factor((q * d) @ q.T)
    assert np.linalg.norm(u @ u - np.eye(30)) < 1e-12
    assert np.linalg.norm(w.polar_factor((q * np.sign(d) * np.linspace(1, 9, 30)) @ q.T) - (q * np.sign(d)) @ q.T) < 1e-12


def plain(rows, k=16):
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    xs = [(i, tuple(floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in ok]
    fit = sorted(set(x for _, x in xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, dtype=float) - np.array(sums) / n
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    return xs, n, sums, cov, e, q[:, :k]


def frame(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.select("*", *[F.lit(1).alias(c) for c in ("x", "v", "w", "n", "i", "part", "component", "label")])


@pytest.mark.parametrize("dims", [5, 24])
def test_query_against_plain_numbers(spark, dims):
    r = np.random.default_rng(dims)
    mix = r.standard_normal((dims, dims)) * np.linspace(0.05, 2, dims)
    rows = [(i, [float(np.float32(c)) for c in r.standard_normal(dims) @ mix]) for i in range(300)]
    rows += rows[:40] + [(7, rows[3][1]), (None, rows[5][1]), (900, None), (901, [None] * dims), (902, [float("nan")] * dims),
                         (903, [float("inf")] + [0.0] * (dims - 1)), (904, []), (905, [1.0] * (dims + 1))]
    got = w.whiten(frame(spark, rows)).collect()
    xs, n, sums, cov, e, q = plain([x for x in rows if x[0] not in (904, 905)])
    assert len(got) == len(xs) * min(16, dims)
    assert {g["n"] for g in got} == {n}
    want = sorted((str(i), c + 1, sum((n * a - s) ** 2 for a, s in zip(x, sums)), (np.array(x) - np.array(sums) / n) @ q[:, c] / np.sqrt(e[c])) for i, x in xs for c in range(q.shape[1]))
    have = sorted((str(g["vec_id"]), g["component"], g["deviation"], g["whitened"]) for g in got)
    sign = {}
    for a, b in zip(sorted(have, key=lambda t: (t[0], t[1], t[2], abs(t[3]))), sorted(want, key=lambda t: (t[0], t[1], t[2], abs(t[3])))):
        assert a[:3] == b[:3] and abs(abs(a[3]) - abs(b[3])) < 1e-8
        if abs(b[3]) > 1e-3:
            sign.setdefault(a[1], set()).add(np.sign(a[3] * b[3]))
    assert all(len(s) == 1 for s in sign.values())
    for g in got[:64]:
        assert abs(g["explained"] - e[g["component"] - 1] / np.trace(cov)) < 1e-10
    assert max(g["identity_error"] for g in got) < 1e-9


def test_far_entries_and_no_variance(spark):
    got = w.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [1.0, 0.0])])).collect()
    assert {(g["vec_id"], g["deviation"]) for g in got} == {(1, None), (2, None), (3, 128**2)} and all((g["whitened"] is None) == (g["component"] == 2) for g in got)
    one = w.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert len(one) == 4 and all(g["whitened"] is None and g["n"] == 1 and g["deviation"] == 0 and g["explained"] == 0 for g in one)


def test_empty_tables(spark):
    assert w.whiten(frame(spark, [])).collect() == []
    assert w.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
