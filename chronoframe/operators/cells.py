"""Regression trees, forests and boosted trees grown from sums over cells.

A tree reads a row only through the bins of its features, and a squared loss reads the rows of one combination of bins, a *cell*, only through
their number and the sums of label and label².  So where the cells are bounded (``bins ** features`` of at most :data:`CELLS`), the rows are
scanned for the cuts and once for the sums, whatever the number of trees and levels, and the trees grow from the sums on the driver.  Every row counts in
every tree.  The result is a model of ``pyspark.ml``, loaded from its saved form.  Wider tables are fitted by ``pyspark.ml`` itself.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import scratch_path

CELLS = 1 << 20
_MODELS = {DecisionTreeRegressor: DecisionTreeRegressionModel, GBTRegressor: GBTRegressionModel, RandomForestRegressor: RandomForestRegressionModel}


def fits_cells(est, features: int) -> bool:
    """Whether ``est`` is a regressor whose cells are bounded."""
    trees = est.getNumTrees() if isinstance(est, RandomForestRegressor) else 1
    return type(est) in _MODELS and features > 0 and trees * est.getMaxBins() ** features <= CELLS


def cut_points(rows: DataFrame, xs: Sequence[str], bins: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(last, thresholds)`` of each feature: the last value of every bin but the highest, and where a split after it lies.  A feature of at most
    ``bins`` values is cut between any two of them, in the middle; one of more values at quantiles of all rows, where a value of more
    than a bin's rows takes one bin and the others share the rest."""
    d = len(xs)

    def seen(batches):
        held = [np.empty(0)] * d
        for b in batches:
            for f in range(d):
                if held[f] is not None:
                    v, h = b.column(f).to_numpy(zero_copy_only=False), held[f]
                    new = v[h[np.minimum(np.searchsorted(h, v), len(h) - 1)] != v] if len(h) else v
                    h = np.unique(np.concatenate([h, new])) if len(new) else h
                    held[f] = h if len(h) <= bins else None
        f = [i for i, v in enumerate(held) for _ in range(1 if v is None else len(v))]
        v = [x for v in held for x in ([None] if v is None else v.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(v, pa.float64())], ["f", "v"])

    few = (rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(xs)]).mapInArrow(seen, "f int, v double").groupBy("f")
           .agg(F.collect_set("v").alias("v"), F.max(F.col("v").isNull()).alias("wide"))
           .where(~F.col("wide") & (F.size("v") <= bins)).select("f", F.array_sort("v").alias("v")).collect())
    out = {r["f"]: np.array(r["v"]) for r in few}
    wide = [i for i in range(d) if i not in out]
    cuts = [(out[i][:-1], out[i][:-1] / 2 + out[i][1:] / 2) if i in out else None for i in range(d)]
    if wide:
        m = 16 * bins
        found = rows.select(*[F.col(xs[i]).cast("double").alias(f"x{i}") for i in wide]).approxQuantile([f"x{i}" for i in wide], [k / m for k in range(1, m + 1)], 1 / (2 * m))
        for i, q in zip(wide, found):
            values, counts = np.unique(q, return_counts=True)
            last, held, left, free = [], 0, m, bins
            for v, c in zip(values[:-1], counts[:-1]):
                held += c
                if free > 1 and held * free >= left:
                    last.append(v)
                    left, free, held = left - held, free - 1, 0
            cuts[i] = (np.array(last), np.array(last))
    return cuts


def cell_sums(rows: DataFrame, y: str, xs: Sequence[str], last: Sequence[np.ndarray], shift: float, trees: int = 0, seed: int = 0) -> DataFrame:
    """``tree, cell, n, s, q``: the number of rows of each cell and the sums of ``y - shift`` and of its square; with ``trees``, for as many
    bootstrap samples, in which a row stands a Poisson number of times.  A null or infinite value is an error, as in ``pyspark.ml``."""
    d, shape = len(xs), [len(c) + 1 for c in last]
    size = math.prod(shape)
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in (y, *xs)])
    whole = F.when(bad, F.raise_error(F.lit("Labels and features of a fit MUST NOT be Null, NaN or infinite"))).otherwise(F.col(y).cast("double"))

    def run(batches):
        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        sums, held, n = np.zeros((max(1, trees), 3, size)), [], 0

        def add():
            cell, dev = (np.concatenate(c) for c in zip(*held))
            for t in range(max(1, trees)):
                w = draw.poisson(1.0, len(cell)).astype(np.float64) if trees else np.ones(len(cell))
                for k, v in enumerate((w, w * dev, w * dev * dev)):
                    sums[t, k] += np.bincount(cell, v, size)

        for b in batches:
            cell = np.zeros(b.num_rows, dtype=np.int64)
            for f in range(d):
                cell = cell * shape[f] + np.searchsorted(last[f], b.column(f + 1).to_numpy(zero_copy_only=False), side="left")
            held.append((cell, b.column(0).to_numpy(zero_copy_only=False) - shift))
            n += b.num_rows
            if n >= max(size, 1 << 17):
                add()
                held, n = [], 0
        if n:
            add()
        t, cell = np.nonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(cell, pa.int64()), *[pa.array(sums[t, k, cell], pa.float64()) for k in range(3)]], ["tree", "cell", "n", "s", "q"])

    parts = rows.select(whole.alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(xs)]).mapInArrow(run, "tree int, cell long, n double, s double, q double")
    return parts.groupBy("tree", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])


def grow(place: Sequence[np.ndarray], thresholds: Sequence[np.ndarray], n: np.ndarray, s: np.ndarray, q: np.ndarray, depth: int, base: float = 0.0,
         some: int | None = None, rng=None) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """One regression tree by the variance on cells in the bins ``place`` (one array for each feature), level by level, and the mean of every
    cell's leaf.  Labels are ``base`` above the sums.  ``some``: so many features, drawn anew, are tried at each node."""
    total = np.array([[n.sum(), s.sum(), q.sum()]])
    feature, threshold, gain, child = np.array([-1]), np.array([0.0]), np.array([-1.0]), np.array([-1])
    where, active = np.zeros(len(n), dtype=np.int64), np.array([0])
    for _ in range(depth):
        slot = np.full(len(total), -1)
        slot[active] = np.arange(len(active))
        cells = np.flatnonzero(slot[where] >= 0)
        a = slot[where[cells]]
        nt, st, qt = total[active].T[:, :, None]
        best, f_at, k_at = np.full(len(active), -1.0), np.zeros(len(active), dtype=np.int64), np.zeros(len(active), dtype=np.int64)
        tried = None if some is None or some >= len(place) else rng.random((len(active), len(place))).argsort(1) < some
        for f, t in enumerate(thresholds):
            if not len(t):
                continue
            width = len(t) + 1
            nl, sl = (np.bincount(a * width + place[f][cells], v[cells], len(active) * width).reshape(-1, width).cumsum(1)[:, :-1] for v in (n, s))
            nr, sr = nt - nl, st - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where((nl > 0) & (nr > 0), nl * nr / (nt * nt) * (sl / nl - sr / nr) ** 2, -1.0)
            k = g.argmax(1)
            g = g[np.arange(len(active)), k]
            better = g > best if tried is None else (g > best) & tried[:, f]
            best[better], f_at[better], k_at[better] = g[better], f, k[better]
        mean, spread = st[:, 0] / nt[:, 0], qt[:, 0] / nt[:, 0]
        parted = best > np.finfo(float).eps * (np.abs(spread) + (mean + base) ** 2)       # less is rounding
        up = active[parted]
        if not len(up):
            break
        first = len(total) + 2 * np.arange(len(up))
        feature[up], gain[up], child[up] = f_at[parted], best[parted], first
        threshold[up] = [thresholds[f][k] for f, k in zip(f_at[parted], k_at[parted])]
        to = np.full(len(active), -1)
        to[parted] = first
        for f in range(len(place)):
            mine = cells[(to[a] >= 0) & (f_at[a] == f)]
            at = slot[where[mine]]
            where[mine] = to[at] + (place[f][mine] > k_at[at])
        made = len(total) + 2 * len(up)
        below = [np.bincount(where, v, made)[len(total):] for v in (n, s, q)]
        new = np.arange(len(total), made)
        total = np.vstack([total, np.column_stack(below)])
        feature, threshold, gain, child = (np.concatenate([x, np.full(len(new), v, dtype=x.dtype)]) for x, v in ((feature, -1), (threshold, 0.0), (gain, -1.0), (child, -1)))
        nn, ss, qq = total[new].T
        active = new[np.abs((qq - ss * ss / nn) / nn) >= np.finfo(float).eps]
    nn, ss, qq = total.T
    order, todo = [], [0]           # the saved form counts nodes from the root, the left side first
    while todo:
        i = todo.pop()
        order.append(i)
        if child[i] >= 0:
            todo += [child[i] + 1, child[i]]
    order = np.array(order)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    value = ss / nn
    tree = {"prediction": value + base, "impurity": np.maximum(qq / nn - value * value, 0.0), "n": nn, "s": ss + nn * base, "q": qq + 2 * base * ss + nn * base * base,
            "gain": gain, "left": np.where(child >= 0, number[child], -1), "right": np.where(child >= 0, number[np.minimum(child + 1, len(order) - 1)], -1), "feature": feature, "threshold": threshold}
    return {k: v[order] for k, v in tree.items()}, value[where]


def _load(est, trees: list[dict[str, np.ndarray]], weights: Sequence[float], features: int, spark):
    """The model of ``est`` that consists of these trees, by way of the saved form."""
    kind = _MODELS[type(est)]
    path = scratch_path(spark, "grown")
    est.write().overwrite().save(f"{path}/estimator")
    meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    single = kind is DecisionTreeRegressionModel
    said = meta | {"class": f"org.apache.spark.ml.regression.{kind.__name__}", "numFeatures": features} | ({} if single else {"numTrees": len(trees)})
    col = lambda k, t: pa.array(np.concatenate([x[k] for x in trees]), t)
    size = [len(x["n"]) for x in trees]
    stats = np.concatenate([np.column_stack([x["n"], x["s"], x["q"]]) for x in trees])
    f = np.concatenate([x["feature"] for x in trees])
    lists = lambda v, lens: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(v, pa.float64()))
    split = pa.StructArray.from_arrays([pa.array(f, pa.int32()), lists(np.concatenate([x["threshold"] for x in trees])[f >= 0], f >= 0), pa.array(np.full(len(f), -1), pa.int32())],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = {"id": pa.array(np.concatenate([np.arange(n) for n in size]), pa.int32()), "prediction": col("prediction", pa.float64()), "impurity": col("impurity", pa.float64()),
            "impurityStats": lists(stats.ravel(), np.full(len(f), 3)), "rawCount": pa.array(np.rint(stats[:, 0]).astype(np.int64)), "gain": col("gain", pa.float64()),
            "leftChild": col("left", pa.int32()), "rightChild": col("right", pa.int32()), "split": split}
    table = pa.table(node) if single else pa.table({"treeID": pa.array(np.repeat(np.arange(len(trees)), size), pa.int32()), "nodeData": pa.StructArray.from_arrays(list(node.values()), list(node))})
    spark.createDataFrame(table).write.parquet(f"{path}/model/data")
    spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    if not single:
        one = DecisionTreeRegressor(featuresCol=est.getFeaturesCol(), labelCol=est.getLabelCol(), maxDepth=est.getMaxDepth(), maxBins=est.getMaxBins(), seed=est.getSeed())
        one.write().overwrite().save(f"{path}/tree")
        text = json.loads(spark.read.text(f"{path}/tree/metadata").first()[0]) | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"}
        each = [(i, json.dumps(text | {"uid": f"dtr_{meta['uid'][-12:]}_{i}"}), float(w)) for i, w in enumerate(weights)]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    return kind.load(f"{path}/model")


def fit_cells(est, rows: DataFrame, y: str, xs: Sequence[str], known: dict | None = None):
    """The model of ``est`` (:func:`fits_cells`) on ``rows``, which should be written: they are scanned for the mean, the cuts and the sums.  Fits on the same
    rows, label and features that are given one ``known`` share these."""
    known = {} if known is None else known
    spark, depth, forest = rows.sparkSession, est.getMaxDepth(), isinstance(est, RandomForestRegressor)
    seed = est.getSeed() & 0x7FFFFFFF
    bins, every = est.getMaxBins(), est.getNumTrees() if forest else 0
    if "shift" not in known:
        known["shift"] = rows.agg(F.avg(F.col(y).cast("double"))).first()[0] or 0.0
    shift = known["shift"] if math.isfinite(known["shift"]) else 0.0
    if bins not in known:
        known[bins] = cut_points(rows, xs, bins)
    last, thresholds = [c[0] for c in known[bins]], [c[1] for c in known[bins]]
    if (bins, every, every and seed) not in known:
        found = cell_sums(rows, y, xs, last, shift, every, seed).toArrow().to_pandas()
        known[bins, every, every and seed] = found.sort_values(["tree", "cell"])
    sums = known[bins, every, every and seed]
    if sums.empty:
        raise ValueError("a fit needs rows")
    places = lambda of: [p.astype(np.int64) for p in np.unravel_index(of["cell"].to_numpy(), [len(c) + 1 for c in last])]
    trees, weights = [], []
    if forest:
        some = None if every == 1 else math.ceil(len(xs) / 3)
        for t in range(every):
            of = sums[sums["tree"] == t]
            trees.append(grow(places(of), thresholds, *(of[c].to_numpy() for c in "nsq"), depth, shift, some, np.random.default_rng([seed, t]))[0])
            weights.append(1.0)
        return _load(est, trees, weights, len(xs), spark)
    place, n, s, q = places(sums), *(sums[c].to_numpy() for c in "nsq")
    tree, value = grow(place, thresholds, n, s, q, depth, shift)
    trees.append(tree)
    weights.append(1.0)
    if isinstance(est, GBTRegressor):
        mean, at = s / n, value
        own = np.maximum(q - n * mean * mean, 0.0)          # inside a cell: the same in every round
        for _ in range(est.getMaxIter() - 1):
            far = 2 * (mean - at)                           # the negative gradient of the squared error
            tree, value = grow(place, thresholds, n, n * far, 4 * own + n * far * far, depth)
            trees.append(tree)
            weights.append(est.getStepSize())
            at = at + est.getStepSize() * value
    return _load(est, trees, weights, len(xs), spark)
