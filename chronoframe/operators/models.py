"""Models and model selection (F11–F20, V01–V07, E07) on ``pyspark.ml``.

Training data never passes the driver: estimators are fitted by Spark ML's distributed optimisers;
the driver holds only parameters, coefficients and metric scalars.  Folds come from the reproducible
k-fold assignment (R05), so cross-validation is the same on any cluster.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import time
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .cells import fit_cells, fits_cells
from .gram import batch_matrix, covariance, vector, weighted_moments
from .order import global_position
from .split import kfold


def assemble(df: DataFrame, xs: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; a null or NaN feature is an error (impute first), never a dropped row."""
    return VectorAssembler(inputCols=list(xs), outputCol=out, handleInvalid="error").transform(df)


def written_rows(df: DataFrame, cols: Sequence[str], name: str = "rows", part_rows: int = 1 << 19) -> DataFrame:
    """The columns of ``df`` written once and dealt over parts of at most about ``part_rows`` rows.  Fits scan their input several times and keep
    a copy of each part in memory: they read this and not the plan that the rows came from, and a task's share stays
    the same for any number of rows."""
    kept = materialize(df.select(*dict.fromkeys(cols)), name)
    n = kept.count()
    parts = max(1, -(-n // part_rows), min(df.sparkSession.sparkContext.defaultParallelism, n >> 12))
    return kept.repartition(parts)


@contextmanager
def training_rows(df: DataFrame, y: str, xs: Sequence[str]):
    """Label and feature vector of :func:`written_rows`, kept by the executors while a fit runs."""
    rows = written_rows(df, [y, *xs], "training").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield assemble(rows, xs)
    finally:
        rows.unpersist()


def score_rows(model, df: DataFrame, xs: Sequence[str], result: Column, name: str) -> DataFrame:
    """``df`` with ``name``: ``result`` of the model's prediction; a row with a null or NaN feature is kept and gets
    null."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in xs])
    safe = df.withColumns({f"_x{i}": F.when(whole, F.col(c)).otherwise(F.lit(0)) for i, c in enumerate(xs)})
    out = model.transform(assemble(safe, [f"_x{i}" for i in range(len(xs))]))
    return out.select(*df.columns, F.when(whole, result).alias(name))


def fit_linear(df: DataFrame, y: str, xs: Sequence[str], intercept: bool = True):
    """ordinary least squares (no penalty), with or without intercept."""
    lr = LinearRegression(featuresCol="features", labelCol=y, regParam=0.0, fitIntercept=intercept,
                          solver="normal", standardization=False)
    return lr.fit(assemble(df, xs))


def linreg_gd(df: DataFrame, y: str, xs: Sequence[str], lr: float = 0.1, iters: int = 50) -> list[float]:
    """full-batch gradient descent for linear regression by the mean gradient ``(1/m) Σ (w·x − y)·x_j``.

    The gradient is linear in the rows' means and covariances, so one scan gives these and every step runs on the
    driver (weights, bias first).  Rows with a null are left out; without rows the weights stay 0."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*xs, y)])
    n, mean, cov = covariance(df.where(whole).select(vector([*xs, y]).alias("v")), "v", len(xs) + 1)
    w = np.zeros(len(xs) + 1)
    for _ in range(iters if n else 0):
        error = w[0] + w[1:] @ mean[:-1] - mean[-1]
        w = w - lr * np.array([error, *(cov[:-1, :-1] @ w[1:] - cov[:-1, -1] + mean[:-1] * error)])
    return w.tolist()


def fit_logistic(df: DataFrame, y: str, xs: Sequence[str], reg: float = 0.0, max_iter: int = 100):
    """logistic regression."""
    return LogisticRegression(featuresCol="features", labelCol=y, regParam=reg, maxIter=max_iter).fit(assemble(df, xs))


def design_blocks(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """``(rows, block)``: the columns ``(1, x…, y)`` of complete rows as binary matrices of doubles, one for each batch of rows, written once.
    Iterations read these and not the plan that the rows came from."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*xs, y)])
    width = len(xs) + 1

    def pack(batches):
        for b in batches:
            x, _ = batch_matrix(b.column(0), width)
            if len(x):
                m = np.column_stack([np.ones(len(x)), x])
                yield pa.RecordBatch.from_arrays([pa.array([len(m)], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["rows", "block"])

    return materialize(df.where(whole).select(vector([*xs, y]).alias("v")).mapInArrow(pack, "rows int, block binary"), "design")


def logreg_gd(df: DataFrame, y: str, xs: Sequence[str], lr: float = 0.1, iters: int = 50) -> list[float]:
    """logistic regression by full-batch gradient descent, mean gradient ``(1/m) Σ (σ(w·x) − y)·x_j``.

    The rows are written once as blocks of a design matrix; a step is one product for each block, summed by task and then by
    Spark.  The weights (bias first) stay on the driver.  Rows with a null are left out; without rows the weights stay 0."""
    blocks, width = design_blocks(df, y, xs), len(xs) + 2
    w = np.zeros(width - 1)

    def gradient_of(at: np.ndarray):
        def run(batches):
            g = np.zeros(width)
            for b in batches:
                for raw in b.column(0):
                    m = np.frombuffer(raw.as_buffer(), dtype=np.float64).reshape(-1, width)
                    z = m[:, :-1] @ at
                    error = 0.5 * (1.0 + np.tanh(0.5 * z)) - m[:, -1]
                    g += np.append(error @ m[:, :-1], len(m))
            yield pa.RecordBatch.from_arrays([pa.array([g.tolist()], pa.list_(pa.float64()))], ["g"])
        return run

    for _ in range(iters):
        parts = blocks.select("block").mapInArrow(gradient_of(w), "g array<double>")
        total = {r[0]: r[1] for r in parts.select(F.posexplode("g")).groupBy("pos").agg(F.sum("col")).collect()}
        if not total.get(width - 1):
            break
        w = w - lr * np.array([total[j] for j in range(width - 1)]) / total[width - 1]
    return w.tolist()


def fit_regressor(est, df: DataFrame, y: str, xs: Sequence[str], known: dict | None = None):
    """A tree, a forest or boosted trees: from sums over cells (:func:`cells.fit_cells`) where these are bounded, which scans the written rows a few
    times, whatever the number of trees and levels; else by ``pyspark.ml``, which scans them for every level.  With ``known`` (a dictionary for all
    fits on ``df``) the rows are written already."""
    if fits_cells(est, len(xs)):
        return fit_cells(est, materialize(df.select(*dict.fromkeys([y, *xs])), "training") if known is None else df, y, xs, known)
    with training_rows(df, y, xs) as rows:
        return est.fit(rows)


def fit_tree(df: DataFrame, y: str, xs: Sequence[str], depth: int = 5, seed: int = 42, bins: int = 32):
    """decision-tree regressor; a feature of at most ``bins`` values is split between any two of them."""
    return fit_regressor(DecisionTreeRegressor(featuresCol="features", labelCol=y, maxDepth=depth, seed=seed, maxBins=bins), df, y, xs)


def fit_forest(df: DataFrame, y: str, xs: Sequence[str], trees: int = 20, depth: int = 5, seed: int = 42,
               classifier: bool = False):
    """random-forest regressor or classifier."""
    est = (RandomForestClassifier if classifier else RandomForestRegressor)(
        featuresCol="features", labelCol=y, numTrees=trees, maxDepth=depth, seed=seed)
    return fit_regressor(est, df, y, xs)


def fit_gbt(df: DataFrame, y: str, xs: Sequence[str], rounds: int = 1000, depth: int = 10, eta: float = 0.01,
            seed: int = 42, bins: int = 32):
    """F16: gradient-boosted trees; the defaults are the settings of the forecasting pipeline."""
    est = GBTRegressor(featuresCol="features", labelCol=y, maxIter=rounds, maxDepth=depth, stepSize=eta, seed=seed, maxBins=bins)
    return fit_regressor(est, df, y, xs)


def fit_linear_svc(df: DataFrame, y: str, xs: Sequence[str], reg: float = 0.0, max_iter: int = 50):
    """linear-kernel support-vector classifier."""
    return LinearSVC(featuresCol="features", labelCol=y, regParam=reg, maxIter=max_iter).fit(assemble(df, xs))


def importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """feature importances with names, descending."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))


def rmse(pred: DataFrame, y: str, p: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=y, predictionCol=p, metricName="rmse").evaluate(pred)


def cross_val_scores(df: DataFrame, id_col: str, y: str, xs: Sequence[str], make_estimator, k: int = 5,
                     seed: int = 42, score=rmse) -> list[tuple[int, float]]:
    """``score(predictions, y)`` (RMSE) of each fold when trained on the other folds (folds from R05)."""
    f = kfold(df, id_col, k, seed).drop("pos")
    data = assemble(f, xs).cache()
    out = []
    for i in range(k):
        m = make_estimator().fit(data.where(F.col("fold") != i))
        out.append((i, score(m.transform(data.where(F.col("fold") == i)), y)))
    data.unpersist()
    return out


def score_candidates(df: DataFrame, id_col: str, y: str, xs: Sequence[str], estimator, candidates: Sequence[dict], k: int = 3,
                     seed: int = 42, parallelism: int = 3, evaluator=None) -> list[float]:
    """Mean score (RMSE, or that of ``evaluator``) over ``k`` folds of every parameter set: the folds are computed
    once and one ``CrossValidator`` runs all sets, ``parallelism`` at a time."""
    maps = [{getattr(estimator, p): v for p, v in c.items()} for c in candidates]
    folds = assemble(kfold(df, id_col, k, seed).drop("pos"), xs).cache()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, foldCol="fold", numFolds=k, parallelism=parallelism,
                        evaluator=evaluator or RegressionEvaluator(labelCol=y, metricName="rmse"))
    scores = [float(s) for s in cv.fit(folds).avgMetrics]
    folds.unpersist()
    return scores


def expand_grids(grids: dict | Sequence[dict]) -> list[dict]:
    """All parameter sets of a grid or of a list of grids."""
    grids = [grids] if isinstance(grids, dict) else list(grids)
    return [dict(zip(g, values)) for g in grids for values in itertools.product(*g.values())]


def grid_search(df: DataFrame, id_col: str, y: str, xs: Sequence[str], estimator, grid: dict | Sequence[dict], k: int = 3,
                seed: int = 42, parallelism: int = 3) -> list[tuple[dict, float]]:
    """Every parameter set of one grid or of a list of grids, scored by k-fold RMSE over the reproducible
    folds."""
    sets = expand_grids(grid)
    return list(zip(sets, score_candidates(df, id_col, y, xs, estimator, sets, k, seed, parallelism)))


def preparation_search(df: DataFrame, id_col: str, y: str, numeric: Sequence[str], make_estimator, strategies: Sequence[str],
                       top_ks: Sequence[int], importances_of, k: int = 3, seed: int = 42) -> list[tuple[dict, float]]:
    """Search over preparation options – imputer strategy and number of features.  For each strategy the
    imputed table ranks its features with ``importances_of(table)`` (names, best first); each ``top_k`` of them is
    scored by k-fold RMSE."""
    from .prepare import impute
    out, df = [], materialize(df, "search")       # medians and modes scan it several times
    for strategy in strategies:
        x = impute(df, list(numeric), strategy).cache()
        ranked = importances_of(x)
        for top in top_ks:
            s = score_candidates(x, id_col, y, ranked[:top], make_estimator(), [{}], k, seed)[0]
            out.append(({"strategy": strategy, "top_k": top}, s))
        x.unpersist()
    return out


def _u(seed, *parts) -> float:
    """Driver-side hash uniform (same md5 rule as the column generators), for parameter draws."""
    h = hashlib.md5("|".join([str(seed), *map(str, parts)]).encode()).hexdigest()[:13]
    return (int(h, 16) + 0.5) / 16 ** 13


def draw_params(space: dict, trial: int, seed: int) -> dict:
    """The parameter set of one trial: ``('int', lo, hi)``, ``('loguniform', lo, hi)`` or ``('uniform', lo, hi)`` for each name, by a
    hash of seed and trial."""
    params = {}
    for j, (p, (kind, lo, hi)) in enumerate(sorted(space.items())):
        u = _u(seed, trial, j)
        params[p] = (int(lo + math.floor(u * (hi - lo + 1))) if kind == "int" else
                     math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))) if kind == "loguniform" else
                     lo + u * (hi - lo))
    return params


def random_search(df: DataFrame, id_col: str, y: str, xs: Sequence[str], estimator, space: dict, trials: int = 60,
                  k: int = 5, seed: int = 42, parallelism: int = 3, batch: int | None = None, min_gain: float | None = None,
                  max_seconds: float | None = None, log: str | None = None) -> list[tuple[dict, float]]:
    """``trials`` parameter sets drawn from distributions (:func:`draw_params`), each scored by k-fold RMSE.

    Trials run in batches (all at once by default), one ``CrossValidator`` each over folds written once.  After a batch the search
    ends if it has taken ``max_seconds``, or if the batch has lowered the best score by less than ``min_gain``.  With
    ``log``, a folder, every batch's scores are appended there, and trials that stand in it are not run again: a search that lost its driver
    goes on where it stopped."""
    spark, began = df.sparkSession, time.monotonic()
    folds = materialize(assemble(kfold(df, id_col, k, seed).drop("pos"), xs), "folds")
    done = _read_trials(spark, log) if log else {}
    size = batch or trials
    for at in range(0, trials, size):
        todo = [t for t in range(at, min(at + size, trials)) if t not in done]
        before = min((done[t] for t in range(at) if t in done), default=math.inf)
        if todo:
            sets = [draw_params(space, t, seed) for t in todo]
            cv = CrossValidator(estimator=estimator, estimatorParamMaps=[{getattr(estimator, p): v for p, v in c.items()} for c in sets], foldCol="fold", numFolds=k,
                                parallelism=parallelism, evaluator=RegressionEvaluator(labelCol=y, metricName="rmse"))
            new = {t: float(s) for t, s in zip(todo, cv.fit(folds).avgMetrics)}
            done |= new
            if log:
                spark.createDataFrame(list(new.items()), "trial int, score double").coalesce(1).write.mode("append").parquet(log)
        here = min(done[t] for t in range(at, min(at + size, trials)))
        if max_seconds is not None and time.monotonic() - began >= max_seconds or min_gain is not None and at and before - here < min_gain:
            break
    return [(draw_params(space, t, seed), done[t]) for t in sorted(done) if t < trials]


def _read_trials(spark, log: str) -> dict[int, float]:
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return {}
    return {r["trial"]: r["score"] for r in spark.read.schema("trial int, score double").parquet(log).collect()}


def ridge_search(df: DataFrame, id_col: str, y: str, xs: Sequence[str], penalties: Sequence[float], k: int = 5, seed: int = 42) -> list[tuple[float, int, float]]:
    """K-fold RMSE ``(penalty, fold, rmse)`` of ridge regressions with an unpenalised intercept, minimising mean squared
    error + penalty · |w|².

    One scan gives the Gram matrix of each fold; the training matrix of a fold is the sum of the others, and the error on the fold a
    quadratic form in its own matrix.  So any number of penalties costs one scan and small solves on the driver.  Rows with a null are left
    out; a fold or its rest without rows has no score."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*xs, y)])
    width = len(xs) + 1
    shift = covariance(df.where(whole).select(vector([*xs, y]).alias("v")), "v", width)[1]
    f = kfold(df, id_col, k, seed).where(whole)
    marks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.col("fold") == i).cast("double"))
    grams = list(weighted_moments(f.select(vector([*xs, y]).alias("v"), marks.alias("w")), "v", width, "w", k, shift=shift)["gram"])
    out = []
    for penalty in penalties:
        for i, own in enumerate(grams):
            rest = sum(g for j, g in enumerate(grams) if j != i)
            if k < 2 or not own[0, 0] or not rest[0, 0]:
                continue
            mean = rest[0, 1:] / rest[0, 0]
            c = rest[1:, 1:] / rest[0, 0] - np.outer(mean, mean)
            w = np.linalg.lstsq(c[:-1, :-1] + penalty * np.eye(width - 1), c[:-1, -1], rcond=None)[0]
            e = np.array([mean[-1] - w @ mean[:-1], *w, -1.0])
            out.append((float(penalty), i, float(np.sqrt(max(0.0, e @ own @ e / own[0, 0])))))
    return out


def halving_search(df: DataFrame, id_col: str, y: str, xs: Sequence[str], estimator, candidates: list[dict],
                   eta: int = 3, min_fraction: float = 0.1, k: int = 3, seed: int = 42) -> list[tuple[int, dict, float]]:
    """Successive halving – score all candidates on a hash sample, keep the best ``1/eta``, grow the
    sample ``eta`` times, until one candidate (or the whole table) remains.  A round is one ``CrossValidator``."""
    alive = list(candidates)
    frac, rnd, log = min_fraction, 0, []
    h = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("long")
    while True:
        sample = df.where(h < F.lit(int(min(frac, 1.0) * 16 ** 8)))
        scores = score_candidates(sample, id_col, y, xs, estimator, alive, k, seed)
        log += [(rnd, c, s) for c, s in zip(alive, scores)]
        if len(alive) == 1 or frac >= 1.0:
            return log
        order = sorted(range(len(alive)), key=lambda i: scores[i])
        alive = [alive[i] for i in order[: max(1, len(alive) // eta)]]
        frac, rnd = frac * eta, rnd + 1


def trial_table(scores: DataFrame, trial: str, score: str, higher_is_better: bool = False) -> DataFrame:
    """Mean and (population) std of the score per trial, with ``rank`` 1 = best, by distributed positions."""
    t = scores.groupBy(trial).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"),
                                  F.count(F.lit(1)).alias("folds"))
    best = -F.col("mean_score") if higher_is_better else F.col("mean_score")
    placed = global_position(t.withColumn("_best", best), ["_best", trial], name="_pos")
    return placed.withColumn("rank", (F.col("_pos") + 1).cast("int")).drop("_best", "_pos")


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist a fitted pipeline and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def linear_pipeline(xs: Sequence[str], y: str) -> Pipeline:
    """assembler + linear regression as one pipeline."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(xs), outputCol="features", handleInvalid="error"),
                            LinearRegression(featuresCol="features", labelCol=y, regParam=0.0)])


def blend(train: DataFrame, hold: DataFrame, test: DataFrame, y: str, base_features: dict[str, Sequence[str]]) -> DataFrame:
    """Base logistic models fitted on ``train`` score ``hold`` and ``test``; the hold-out scores,
    min-max scaled with hold-out statistics (applied to both sides), train a logistic meta-model that
    scores ``test``.  Returns every row of ``test`` with ``blend`` (probability of class 1; null where a
    feature is null).  Null features in ``train`` or ``hold`` are an error: impute first."""
    names = list(base_features)
    prob = vector_to_array("probability")[1]
    for name, xs in base_features.items():
        m = fit_logistic(train, y, xs)
        hold = m.transform(assemble(hold, xs)).select(*hold.columns, prob.alias(name))
        test = score_rows(m, test, xs, prob, name)
    st = hold.agg(*[e for n in names for e in (F.min(n).alias(f"_lo_{n}"), F.max(n).alias(f"_hi_{n}"))])
    scale = lambda d: d.crossJoin(F.broadcast(st)).withColumns({  # noqa: E731  (one-row statistics)
        n: (F.col(n) - F.col(f"_lo_{n}")) / F.greatest(F.col(f"_hi_{n}") - F.col(f"_lo_{n}"), F.lit(1e-12)) for n in names})
    meta = fit_logistic(scale(hold), y, names)
    out = score_rows(meta, scale(test), names, prob, "blend")
    return out.select(*test.columns, "blend")


def impute_by_model(df: DataFrame, target: str, features: Sequence[str], estimator=None) -> DataFrame:
    """fill the nulls of ``target`` with a model trained on the rows where the target and all features are
    present; rows are predicted in place (no join back, so rows are never multiplied).  A row with a null
    feature cannot be predicted and takes the mean of the target."""
    est = estimator or LinearRegression(featuresCol="_feat", labelCol=target, regParam=0.0)
    known = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [target, *features]]))
    model = est.fit(assemble(known, features, "_feat"))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    safe = df.withColumns({f"_x{i}": F.when(whole, F.col(c)).otherwise(F.lit(0)) for i, c in enumerate(features)})
    out = model.transform(assemble(safe, [f"_x{i}" for i in range(len(features))], "_feat"))
    out = out.crossJoin(F.broadcast(df.agg(F.avg(target).alias("_mean"))))      # one row
    fill = F.when(whole, F.col(est.getPredictionCol())).otherwise(F.col("_mean"))
    missing = F.col(target).isNull() | F.isnan(F.col(target).cast("double"))
    return out.select(*[F.when(missing, fill).otherwise(F.col(c)).alias(c) if c == target else F.col(c) for c in df.columns])


# The model registry – a flag or group name selects estimators; every selected one is fitted and
# scored into one table (M15).  Fixed values: the model groups of the forecasting pipeline.
MODEL_GROUPS = {"linear": ["LR"], "tree": ["DT", "RF", "GBT"], "all": ["LR", "DT", "RF", "GBT"]}


def make_regressor(name: str, label: str, seed: int = 42):
    return {"LR": lambda: LinearRegression(featuresCol="features", labelCol=label, regParam=0.0),
            "DT": lambda: DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=5, seed=seed),
            "RF": lambda: RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=10, maxDepth=5, seed=seed),
            "GBT": lambda: GBTRegressor(featuresCol="features", labelCol=label, maxIter=10, maxDepth=4, seed=seed),
            }[name]()


def run_models(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], selection: Sequence[str],
               digits: int = 4) -> DataFrame:
    """Fit every selected model (names or group names) on ``train`` and return the score table of
    its ``test`` predictions: ``model, MAE, MSE, RMSE, MAPE, SMAPE, R2`` as text (M15)."""
    from .metrics import score_table
    names = list(dict.fromkeys(n for s in selection for n in MODEL_GROUPS.get(s, [s])))
    te = assemble(materialize(test.select(*dict.fromkeys([y, *xs])), "test"), xs)       # scored by every model
    tr = materialize(train.select(*dict.fromkeys([y, *xs])), "training")
    preds, known = None, {}
    for n in names:
        est = make_regressor(n, y)
        m = est.fit(assemble(tr, xs)) if isinstance(est, LinearRegression) else fit_regressor(est, tr, y, xs, known)
        p = m.transform(te).select(F.lit(n).alias("model"), y, "prediction")
        preds = p if preds is None else preds.unionByName(p)
    return score_table(preds, "model", y, "prediction", digits)
