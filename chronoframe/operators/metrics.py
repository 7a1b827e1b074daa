"""Metrics and statistics (M01–M17, A12, A13) as aggregates over prediction tables.

Every metric is one aggregate (map-side partial, one small shuffle) or a composition of aggregates and
equi-joins.  Where an exact answer needs a global order (AUC, ranks, Kendall's τ) the order is taken on
the table of *distinct* values with counts, and prefix sums come from :mod:`.order`'s range-bucketed
running sums, so no task ever holds the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_or_raw
from .gram import corr_pairs, covariance, vector, weighted_moments
from .order import average_rank, global_cumsum, global_position


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------------------------------
# regression
# ---------------------------------------------------------------------------------------------------

def regression_aggs(y, p) -> dict[str, Column]:
    """MAE, MSE, RMSE, R² (null for a constant ``y``), MAPE, SMAPE as aggregate expressions (usable inside any
    ``groupBy``)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    err = y - p
    mse = F.avg(err * err)
    ss_tot = F.var_pop(y) * F.count(y)
    return {
        "mae": F.avg(F.abs(err)),
        "mse": mse,
        "rmse": F.sqrt(mse),
        "r2": F.lit(1.0) - F.try_divide(F.sum(err * err), ss_tot),
        "mape": F.avg(F.abs(F.try_divide(err, y))),
        "smape": F.avg(F.try_divide(2.0 * F.abs(err), F.abs(y) + F.abs(p))),
    }


def regression_metrics(df: DataFrame, y: str, p: str, group: Sequence[str] = ()) -> DataFrame:
    """One row (per group) with ``mae, mse, rmse, r2, mape, smape``."""
    aggs = regression_aggs(y, p)
    return df.groupBy(*group).agg(*[e.alias(k) for k, e in aggs.items()])


def score_table(df: DataFrame, model: str, y: str, p: str, digits: int = 4,
                metrics: Sequence[str] = ("mae", "mse", "rmse", "mape", "smape", "r2")) -> DataFrame:
    """One row per model with its metrics rounded half-to-even to ``digits`` as text."""
    m = regression_metrics(df, y, p, [model])
    return m.select(model, *[round_or_raw(k, digits).alias(k.upper()) for k in metrics])


# ---------------------------------------------------------------------------------------------------
# classification
# ---------------------------------------------------------------------------------------------------

def accuracy(df: DataFrame, y: str, p: str, percent: bool = False) -> DataFrame:
    """Share of rows with ``y = p`` (×100 with ``percent``)."""
    a = F.avg((F.col(y) == F.col(p)).cast("double"))
    return df.agg((a * 100 if percent else a).alias("accuracy"))


def zero_one_cost(df: DataFrame, y: str, p: str) -> DataFrame:
    """Number of mismatches."""
    return df.agg(F.count_if(~F.col(y).eqNullSafe(F.col(p))).cast("long").alias("cost"))


def confusion_long(df: DataFrame, y: str, p: str) -> DataFrame:
    """M07 in long form: ``(y, p, count)`` for every pair that occurs."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, y: str, p: str, classes: Sequence) -> DataFrame:
    """N×N matrix over ``classes`` – one row per actual class (also without rows), one column per predicted
    class; other predictions have no column.  The unbounded form is :func:`confusion_long`."""
    kind = dict(df.dtypes)[y]
    rows = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("actual"))
    counts = df.groupBy(F.col(y).alias("actual")).pivot(p, list(classes)).agg(F.count(F.lit(1)))
    return rows.join(counts, "actual", "left").na.fill(0)


def roc_auc(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC with ties (Mann–Whitney), per ``group``.

    ``AUC = Σ_pos (#neg with a lower score + ½ #neg with the same score) / (P·N)``, evaluated on the
    table of distinct scores with (count, positives); the negatives below each score are a range-bucketed
    running sum.  ``BinaryClassificationEvaluator`` bins the scores, so it is not used.  Rows with a null score
    or label do not count; a group of one class has no AUC (null).
    """
    g = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(*group, score).agg(F.sum(F.col(y).cast("long")).alias("_pos"),
                                      F.count(F.lit(1)).alias("_n"))
    g = g.withColumn("_neg", F.col("_n") - F.col("_pos"))
    g = global_cumsum(g, [score], "_neg", "_neg_below", partition_by=list(group) or None)
    num = F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0))
    return g.groupBy(*group).agg(F.try_divide(num, F.sum("_pos") * F.sum("_neg")).alias("auc"))


def roc_auc_many(df: DataFrame, y: str, scores: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """M08 for several scores at once: ``(score, auc)`` (and ``group``), one long table and one range stage."""
    cells = F.array(*[F.struct(F.lit(s).alias("score"), F.col(s).cast("double").alias("_v")) for s in scores])
    long = df.select(*group, y, F.inline(cells))
    return roc_auc(long, y, "_v", ["score", *group])


def log_loss(df: DataFrame, y: str, p: str, eps: float = 1e-15) -> DataFrame:
    """Binary cross-entropy with the probability clipped to ``[eps, 1−eps]``."""
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg((-F.avg(yy * F.log(q) + (1 - yy) * F.log(1 - q))).alias("log_loss"))


def log_softmax_at(logits: Column, idx: Column) -> Column:
    """``log softmax(logits)[idx]`` (0-based index) with the max subtracted for stability."""
    m = F.array_max(logits)
    lse = m + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))
    return F.element_at(logits, idx.cast("int") + 1) - lse


def mixed_loss(df: DataFrame, logits: str, a: str, b: str, lam: float) -> DataFrame:
    """``λ·CE(p, a) + (1−λ)·CE(p, b)`` averaged, with ``p = softmax(logits)``."""
    lg = F.col(logits).cast("array<double>")
    ce = lam * -log_softmax_at(lg, F.col(a)) + (1 - lam) * -log_softmax_at(lg, F.col(b))
    return df.agg(F.avg(ce).alias("mixed_loss"))


def softmax(logits: Column) -> Column:
    """Softmax of an array column."""
    lg = logits.cast("array<double>")
    m = F.array_max(lg)
    e = F.transform(lg, lambda v: F.exp(v - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / s)


def sq_diff_sum(a: Column, b: Column) -> Column:
    """Σ (aᵢ − bᵢ)² of two equal-length arrays."""
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda acc, v: acc + v)


def consistency_loss(df: DataFrame, logits: str, logits2: str, label: str, weight: float = 0.1) -> DataFrame:
    """Mean of ``CE(softmax(logits), label) + weight · Σ (softmax(logits) − softmax(logits2))²``."""
    lg, lg2 = F.col(logits).cast("array<double>"), F.col(logits2).cast("array<double>")
    row = -log_softmax_at(lg, F.col(label)) + weight * sq_diff_sum(softmax(lg), softmax(lg2))
    return df.agg(F.avg(row).alias("consistency_loss"))


# ---------------------------------------------------------------------------------------------------
# boxes (M09)
# ---------------------------------------------------------------------------------------------------

def iou(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Intersection over union of two boxes with the inclusive (+1 pixel) convention."""
    ax0, ay0, ax1, ay1, bx0, by0, bx1, by1 = map(_c, (ax0, ay0, ax1, ay1, bx0, by0, bx1, by1))
    iw = F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0) + 1, F.lit(0))
    ih = F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0) + 1, F.lit(0))
    inter = (iw * ih).cast("double")
    area_a = (ax1 - ax0 + 1) * (ay1 - ay0 + 1)
    area_b = (bx1 - bx0 + 1) * (by1 - by0 + 1)
    return inter / (area_a + area_b - inter)


# ---------------------------------------------------------------------------------------------------
# intervals and decompositions
# ---------------------------------------------------------------------------------------------------

def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularized incomplete beta function (modified Lentz)."""
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def _inc_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1 - x) / b


def t_cdf(t: float, dof: float) -> float:
    """Student t distribution function."""
    x = dof / (dof + t * t)
    tail = 0.5 * _inc_beta(dof / 2.0, 0.5, x)
    return 1.0 - tail if t > 0 else tail


def t_ppf(q: float, dof: float) -> float:
    """Inverse of :func:`t_cdf` by bisection (driver-side scalar; no SciPy needed)."""
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_cdf(mid, dof) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def z_critical(confidence: float) -> float:
    return NormalDist().inv_cdf((1 + confidence) / 2)


def rmse_ci(df: DataFrame, y: str, p: str, confidence: float = 0.95, method: str = "t") -> DataFrame:
    """Confidence interval of the RMSE, ``sqrt(mean(e²) ± c · s / √m)`` over squared errors ``e²``.

    ``c`` is the normal (``method='z'``) or Student-t (``m−1`` degrees) critical value; the t value needs
    ``m`` on the driver, so the one-row aggregate is computed there once and not again.
    """
    e2 = (F.col(y).cast("double") - F.col(p).cast("double")) ** 2
    stats = df.agg(F.avg(e2).alias("_mean"), F.stddev_samp(e2).alias("_s"), F.count(e2).alias("_m"))
    if method == "z":
        crit = F.lit(z_critical(confidence))
    else:
        row = stats.first()
        stats = df.sparkSession.createDataFrame([tuple(row)], "_mean double, _s double, _m long")
        crit = F.lit(t_ppf((1 + confidence) / 2, row["_m"] - 1) if row["_m"] > 1 else None).cast("double")
    half = crit * F.col("_s") / F.sqrt(F.col("_m"))
    return stats.select(F.sqrt(F.col("_mean")).alias("rmse"),
                        F.sqrt(F.col("_mean") - half).alias("lower"), F.sqrt(F.col("_mean") + half).alias("upper"))


def bias_variance(df: DataFrame, round_col: str, id_col: str, p: str, y: str) -> DataFrame:
    """Over bootstrap rounds, ``mse = mean (p−y)²``, ``bias = mean_id (p̄−y)²``,
    ``var = mean (p−p̄)²`` with ``p̄`` the mean prediction per id (``mse = bias + var`` when ``y`` is fixed
    per id).  Two aggregation levels: per id, then global."""
    per_id = df.groupBy(id_col).agg(F.avg(p).alias("_pbar"), F.first(y).alias("_y"),
                                    F.avg((F.col(p) - F.col(y)) ** 2).alias("_mse"),
                                    F.var_pop(p).alias("_var"))
    return per_id.agg(F.avg("_mse").alias("mse"), F.avg((F.col("_pbar") - F.col("_y")) ** 2).alias("bias"),
                      F.avg("_var").alias("var"))


def bias_variance_refit(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], weights: str, rounds: int) -> DataFrame:
    """M11 with a least-squares model fitted again in every bootstrap round: ``mse``, ``bias``, ``var`` over the test
    rows and rounds (``mse = bias + var``), and the number of ``rounds``.

    ``weights`` holds in every training row its number of draws in each round (:func:`split.bootstrap_weights`).  One scan
    of the training rows gives the weighted Gram matrices of all rounds; the fits are solved on the driver, ``rounds`` systems of
    ``len(xs) + 1`` unknowns (of the least norm where a round does not determine them).  Squared errors are
    quadratic forms in the test rows' Gram matrix, so the test rows are scanned once as well.  Nulls are an error; rounds without
    draws, or no test rows, give nulls."""
    width = len(xs) + 1
    n, mean, c = covariance(test.select(vector([*xs, y]).alias("v")), "v", width)
    rows = train.select(vector([*xs, y]).alias("v"), F.col(weights).alias("w"))
    fits = []
    for g in weighted_moments(rows, "v", width, "w", rounds, shift=mean)["gram"] if n else []:
        if g[0, 0] > 0:
            m = g[0, 1:] / g[0, 0]
            s = g[1:, 1:] / g[0, 0] - np.outer(m, m)
            slope = np.linalg.lstsq(s[:-1, :-1], s[:-1, -1], rcond=1e-12)[0]
            m = m + mean
            fits.append([m[-1] - slope @ m[:-1], *slope, -1.0])
    schema = "mse double, bias double, var double, rounds int"
    if not fits:
        return train.sparkSession.createDataFrame([(None, None, None, 0)], schema)
    f = np.array(fits)         # error of a row in a round: f · (1, x, y)
    centre = f.mean(axis=0)

    def mean_square(a: np.ndarray) -> float:
        return float((np.einsum("ri,ij,rj->r", a[:, 1:], c, a[:, 1:]) + (a[:, 0] + a[:, 1:] @ mean) ** 2).mean())

    return train.sparkSession.createDataFrame([(mean_square(f), mean_square(centre[None]), mean_square(f - centre), len(fits))], schema)


def all_close(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str], tol: float = 1e-8) -> DataFrame:
    """Join two feature tables on ``key`` and test ``max |a−b| ≤ tol`` over ``cols``; also reports
    rows present on one side only."""
    a2 = a.select(*key, *[F.col(c).alias(f"_a_{c}") for c in cols])
    b2 = b.select(*key, *[F.col(c).alias(f"_b_{c}") for c in cols])
    j = a2.join(b2, on=list(key), how="full")
    diff = F.greatest(*[F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")) for c in cols]) if len(cols) > 1 else \
        F.abs(F.col(f"_a_{cols[0]}") - F.col(f"_b_{cols[0]}"))
    miss = F.count_if(F.col(f"_a_{cols[0]}").isNull() != F.col(f"_b_{cols[0]}").isNull())
    return j.agg(F.max(diff).alias("max_abs_diff"), miss.alias("unmatched")) \
            .withColumn("all_close", (F.col("max_abs_diff") <= tol) & (F.col("unmatched") == 0))


# ---------------------------------------------------------------------------------------------------
# correlations
# ---------------------------------------------------------------------------------------------------

#: Above so many columns :func:`corr_matrix` is a blocked Gram matrix.
FEW_COLUMNS = 12


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair, long form ``(a, b, corr)``, one scan.

    Up to :data:`FEW_COLUMNS` columns every pair is an expression of one aggregate; more of them are one vector column,
    whose blocked Gram matrices are summed over the tasks, so the plan does not grow with the pairs."""
    if len(cols) > FEW_COLUMNS:
        return corr_pairs(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    st = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(z).alias("b"), F.col(f"{i}").alias("corr"))
                   for i, (a, b) in enumerate(pairs) for x, z in dict.fromkeys([(a, b), (b, a)])])
    return row.select(F.inline(st))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, descending."""
    m = corr_matrix(df, [*cols, target]).where((F.col("b") == target) & (F.col("a") != target))
    return m.select(F.col("a").alias("column"), "corr").orderBy(F.desc("corr"), "column")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman's ρ = Pearson correlation of average ranks."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    r = average_rank(average_rank(d, x, "_rx"), y, "_ry")
    return r.agg(F.corr("_rx", "_ry").alias("spearman"))


def kendall_tau_b(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's τ-b in O(n log n) distributed work.

    The pairs are compressed to distinct ``(x, y)`` with counts.  Concordant pairs ``C`` (``x'<x`` and
    ``y'<y``) are a 2-D dominance count: with ``r`` the dense rank of ``y``, the ranks below ``r`` are the
    union of the dyadic blocks ``(r >> L) − 1`` at the levels ``L`` where bit ``L`` of ``r`` is set.  Each
    point is inserted into its block on every level and queries its prefix blocks; inside a
    (level, block) group a range-bucketed running sum in ``x`` order counts the inserted points with a
    smaller ``x``.  No pair is ever formed.  Discordant pairs follow from the tie counts:
    ``D = n0 − n1 − n2 + n3 − C``.
    """
    d = (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
           .groupBy(F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_c")))
    yr = global_position(d.select("_y").distinct(), ["_y"], name="_r")
    n_levels = max(1, int(yr.agg(F.max("_r")).first()[0] or 0).bit_length())
    pts = d.join(yr, "_y")
    lv = pts.select("_x", "_r", "_c", F.explode(F.sequence(F.lit(0), F.lit(n_levels - 1))).alias("_l"))
    blk = F.expr("shiftright(_r, _l)")
    ins = lv.select("_l", blk.alias("_b"), "_x", F.lit(1).alias("_k"), F.col("_c").alias("_wt"),
                    F.lit(0).cast("long").alias("_q"))
    qry = lv.where((blk % 2) == 1).select("_l", (blk - 1).alias("_b"), "_x", F.lit(0).alias("_k"),
                                          F.lit(0).cast("long").alias("_wt"), F.col("_c").alias("_q"))
    u = ins.unionByName(qry)
    cs = global_cumsum(u, ["_x", "_k"], "_wt", "_below", partition_by=["_l", "_b"])
    conc = cs.where(F.col("_k") == 0).agg(F.sum(F.col("_q") * F.col("_below")).alias("C"))
    pair = lambda c: c * (c - 1) / 2.0
    ties = d.agg(F.sum("_c").alias("n"), F.sum(pair(F.col("_c"))).alias("n3"))
    tx = d.groupBy("_x").agg(F.sum("_c").alias("t")).agg(F.sum(pair(F.col("t"))).alias("n1"))
    ty = d.groupBy("_y").agg(F.sum("_c").alias("t")).agg(F.sum(pair(F.col("t"))).alias("n2"))
    s = conc.crossJoin(ties).crossJoin(tx).crossJoin(ty)   # four one-row aggregates
    n0 = pair(F.col("n"))
    disc = n0 - F.col("n1") - F.col("n2") + F.col("n3") - F.col("C")
    tau = F.try_divide(F.col("C") - disc, F.sqrt((n0 - F.col("n1")) * (n0 - F.col("n2"))))      # null for a constant column
    return s.select(tau.alias("kendall"))


def align(a: DataFrame, b: DataFrame, key: str, value: str, names=("x", "y")) -> DataFrame:
    """Two prediction tables on their common ids: ``key`` and one value column for each."""
    return (a.select(key, F.col(value).alias(names[0])).join(b.select(key, F.col(value).alias(names[1])), key))


def correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson, Spearman and Kendall τ-b of two aligned prediction columns, one row."""
    p = df.agg(F.corr(x, y).alias("pearson"))
    return p.crossJoin(spearman(df, x, y)).crossJoin(kendall_tau_b(df, x, y))
