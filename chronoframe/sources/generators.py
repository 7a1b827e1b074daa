"""Generated columns and frames (S10–S13) from hash uniforms, so that every draw is reproducible on any
partitioning and identical in SQL engines that have ``md5``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def hash_uniform(seed, *parts) -> Column:
    """Uniform in ``(0, 1)`` from the first 13 hex digits of ``md5(seed || '|' || part …)``."""
    pieces = [F.lit(str(seed))]
    for p in parts:
        pieces += [F.lit("|"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    h = F.conv(F.substring(F.md5(F.concat(*pieces)), 1, 13), 16, 10).cast("long")
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(16 ** 13))


def hash_normal(seed, *parts) -> Column:
    """Standard normal by Box–Muller from two hash uniforms."""
    u1 = hash_uniform(seed, *parts, F.lit("a"))
    u2 = hash_uniform(seed, *parts, F.lit("b"))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def range_frame(spark: SparkSession, n: int, seed) -> DataFrame:
    """Integer column ``id`` 0…n−1 and a uniform column ``u`` (``spark.range`` is split over tasks)."""
    return spark.range(n).withColumn("u", hash_uniform(seed, "id"))


def make_blobs(df: DataFrame, id_col: str, centers: int, dims: int, seed, spread: float = 1.0,
               box: tuple[float, float] = (-10.0, 10.0)) -> DataFrame:
    """One sample per input row – a centre chosen by hash, centre coordinates uniform in ``box``,
    plus ``spread`` × standard normal noise per dimension.  Columns ``blob`` and ``x0 … x{dims−1}``."""
    c = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}c"), F.col(id_col).cast("string"))), 1, 8), 16, 10)
               .cast("long"), F.lit(centers)).cast("int")
    lo, hi = box
    out = df.select(id_col, c.alias("blob"))
    coords = {}
    for d in range(dims):
        centre = F.lit(lo) + F.lit(hi - lo) * hash_uniform(seed, F.lit("centre"), F.col("blob"), F.lit(d))
        coords[f"x{d}"] = centre + F.lit(spread) * hash_normal(seed, F.col(id_col), F.lit(d))
    return out.withColumns(coords)


def sample_dist(u: Column, dist: str, **p) -> Column:
    """Inverse-transform draws from a uniform column ``u``.

    ``loguniform(low, high)`` (reciprocal), ``exponential(scale)``, ``geometric(p)`` (trials to the first
    success, ≥ 1), ``randint(low, high)`` (``high`` exclusive), ``uniform(low, high)``, ``beta(a, b)`` (the
    inverse of its distribution function by bisection, in Arrow batches; a = b = 1 is the uniform itself).
    """
    if dist == "loguniform":
        la, lb = math.log(p["low"]), math.log(p["high"])
        return F.exp(F.lit(la) + u * F.lit(lb - la))
    if dist == "exponential":
        return F.lit(-float(p.get("scale", 1.0))) * F.log(F.lit(1.0) - u)
    if dist == "geometric":
        return F.ceil(F.log(F.lit(1.0) - u) / F.lit(math.log(1 - p["p"]))).cast("long")
    if dist == "randint":
        return (F.lit(p["low"]) + F.floor(u * F.lit(p["high"] - p["low"]))).cast("long")
    if dist == "uniform":
        return F.lit(float(p.get("low", 0.0))) + u * F.lit(float(p.get("high", 1.0)) - float(p.get("low", 0.0)))
    if dist == "beta":
        a, b = float(p.get("a", 1.0)), float(p.get("b", 1.0))
        return u if a == b == 1.0 else beta_quantile(a, b)(u)
    raise ValueError(f"distribution {dist} {p} is not supported")


def beta_quantile(a: float, b: float):
    """Column function: quantile of the beta(a, b) distribution, by bisection on the regularised incomplete beta
    function (a vectorised pandas function: there is no closed inverse and no built-in)."""
    if a <= 0 or b <= 0:
        raise ValueError("beta needs positive a and b")
    log_beta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)

    def fraction(a, b, x):
        tiny = 1e-300                        # modified Lentz evaluation of the continued fraction, all rows at once
        c, d = np.ones_like(x), 1.0 / np.maximum(1.0 - (a + b) * x / (a + 1.0), tiny)
        h = d
        for m in range(1, 300):
            for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 + t * d
                d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1.0 + t / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * c * d
            if np.all(np.abs(c * d - 1.0) < 1e-15):
                break
        return h

    def cdf(x):
        x = np.clip(x, 1e-300, 1 - 1e-16)
        front = np.exp(log_beta + a * np.log(x) + b * np.log1p(-x))
        low = x < (a + 1) / (a + b + 2)
        return np.where(low, front * fraction(a, b, np.where(low, x, 0.5)) / a, 1 - front * fraction(b, a, np.where(low, 0.5, 1 - x)) / b)

    @F.pandas_udf("double")
    def quantile(u: pd.Series) -> pd.Series:
        want = u.to_numpy(dtype="float64")
        lo, hi = np.zeros_like(want), np.ones_like(want)
        for _ in range(60):
            mid = (lo + hi) / 2
            less = cdf(mid) < want
            lo, hi = np.where(less, mid, lo), np.where(less, hi, mid)
        return pd.Series(np.where(np.isnan(want), np.nan, (lo + hi) / 2))

    return quantile
