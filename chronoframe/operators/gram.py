"""Sums of products of many columns in one scan: blocked Gram matrices.

Rows come as one vector column, so the plan has the same size for 3 columns and for 3000.  Columns are cut into blocks;
every task keeps one small matrix for each pair of blocks, and adds a batch of rows to it by a matrix product.  What a task
sends on are matrix rows, which streams of a shuffle by their number add up, so no task holds more than its share of
the matrix and the driver sees none of it unless :func:`covariance` is asked for.

Sums are kept as counts, means and centred products and joined by the parallel update of moments, so columns with a
mean far from zero lose no digits and no scan for the means goes first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Planes of a pair of columns: rows where both are there, their means there, centred products, rows with a value that is not finite.
PLANES = ("n", "mx", "my", "cxy", "cxx", "cyy", "bad")
_SALT = 32


def vector(cols: Sequence[str | Column]) -> Column:
    """The columns as one array of doubles; a null stays a null."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def batch_matrix(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 where null) and presence of a batch of vectors of one width; a null vector is a row of nulls."""
    if lists.null_count:
        lists = pc.drop_null(lists)
    flat = pc.list_flatten(lists)
    if len(flat) != len(lists) * width:
        raise ValueError(f"vectors of another width than {width}")
    there = ~np.asarray(pc.is_null(flat)) if flat.null_count else np.ones(len(flat), dtype=bool)
    x = np.array(pc.fill_null(flat, 0.0), dtype=np.float64)
    return x.reshape(-1, width), there.reshape(-1, width)


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together; planes first."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    weight = a[0] * share
    dx, dy = b[1] - a[1], b[2] - a[2]
    out = np.empty_like(a)
    out[0], out[1], out[2] = n, a[1] + dx * share, a[2] + dy * share
    out[3] = a[3] + b[3] + dx * dy * weight
    if len(a) > 4:
        out[4], out[5] = a[4] + b[4] + dx * dx * weight, a[5] + b[5] + dy * dy * weight
        out[6] = a[6] + b[6]
    return out


def _products(x: np.ndarray, there: np.ndarray, i: slice, j: slice, complete: bool) -> np.ndarray:
    """Planes of the column blocks ``i`` and ``j`` over the rows of ``x``."""
    if complete:
        mean = x[0] + (x - x[0]).mean(axis=0)       # exact for a constant column
        xi, xj = x[:, i] - mean[i], x[:, j] - mean[j]
        shape = (xi.shape[1], xj.shape[1])
        return np.stack([np.full(shape, float(len(x))), np.broadcast_to(mean[i][:, None], shape), np.broadcast_to(mean[j], shape), xi.T @ xj])
    finite = there & np.isfinite(x)
    x = np.where(finite, x, 0.0)
    count = finite.sum(axis=0)
    first = x[finite.argmax(axis=0), np.arange(x.shape[1])]
    mean = first + np.where(finite, x - first, 0.0).sum(axis=0) / np.maximum(count, 1)     # exact for a constant column
    x = np.where(finite, x - mean, 0.0)
    mi, mj, xi, xj = finite[:, i].astype(float), finite[:, j].astype(float), x[:, i], x[:, j]
    n = mi.T @ mj
    some = np.maximum(n, 1.0)
    sx, sy = xi.T @ mj, mi.T @ xj
    both = there[:, i].astype(float).T @ there[:, j].astype(float)
    return np.stack([n, np.where(n > 0, mean[i][:, None] + sx / some, 0.0), np.where(n > 0, mean[j] + sy / some, 0.0),
                     xi.T @ xj - sx * sy / some, (xi * xi).T @ mj - sx * sx / some, mi.T @ (xj * xj) - sy * sy / some, both - n])


def sum_streams(parts: DataFrame, keys: Sequence[str], merge=None) -> DataFrame:
    """Adds the arrays of doubles in the binary column ``part`` of equal whole-number ``keys`` (or joins them by
    ``merge``): first among rows that share a salt, so no stream is longer than a part of the tasks, then over the salts.  A task
    holds one array for each of its keys."""
    merge = merge or (lambda a, b: a + b)
    names = [*keys, "part"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            part = b.column(b.schema.get_field_index("part"))
            for key, raw in zip(zip(*[b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]), part):
                v = np.frombuffer(raw.as_buffer(), dtype=np.float64)
                held[key] = merge(held[key], v) if key in held else v.copy()
        todo = list(held)
        for a in range(0, len(todo), 512):
            some = todo[a: a + 512]
            yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in some]) for i in range(len(keys))], pa.array([held[k].tobytes() for k in some], pa.binary())], names)

    schema = ", ".join(f"{k} long" for k in keys) + ", part binary"
    first = parts.repartition(*keys, "salt").select(*names).mapInArrow(add, schema)
    return first.repartition(*keys).mapInArrow(add, schema)


def comoments(df: DataFrame, vec: str, width: int, complete: bool = False, block: int = 128, budget: int = 1 << 28) -> DataFrame:
    """Rows ``(i, j0, part)``: planes (see :data:`PLANES`) of column ``i`` with the columns from ``j0`` of its block on, as doubles one plane
    after another, for the blocks on and above the diagonal.  Nulls are left out pair by pair; ``complete`` says that there are none
    (rows of a null vector are left out) and gives the first four planes.  A task keeps at most about ``budget`` bytes of
    matrices; wider tables are scanned once for each such part."""
    cuts = [slice(a, min(width, a + block)) for a in range(0, width, block)]
    pairs = [(a, b) for ia, a in enumerate(cuts) for b in cuts[ia:]]
    planes = 4 if complete else len(PLANES)
    size = max(1, budget // (8 * planes * block * block))
    rows = df.select(F.col(vec).cast("array<double>").alias("v"))
    parts = None
    for at in range(0, len(pairs), size):
        part = rows.mapInArrow(_scan(pairs[at: at + size], width, complete), "i long, j0 long, salt int, part binary")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return df.sparkSession.createDataFrame([], "i long, j0 long, part binary")

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _merge(a.reshape(planes, -1), b.reshape(planes, -1)).ravel()

    return sum_streams(parts, ["i", "j0"], merge)


def _scan(pairs: list[tuple[slice, slice]], width: int, complete: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            x, there = batch_matrix(b.column(0), width)
            if not len(x):
                continue
            for k, (i, j) in enumerate(pairs):
                new = _products(x, there, i, j, complete)
                held[k] = _merge(held[k], new) if k in held else new
        salt = TaskContext.get().partitionId() % _SALT
        for k, m in held.items():
            i, j = pairs[k]
            rows = range(i.start, i.stop)
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([j.start] * len(rows), pa.int64()), pa.array([salt] * len(rows), pa.int32()),
                                              pa.array([np.ascontiguousarray(m[:, r]).tobytes() for r in range(len(rows))], pa.binary())], ["i", "j0", "salt", "part"])
    return run


def corr_pairs(df: DataFrame, cols: Sequence[str], block: int = 128, vec: str | None = None) -> DataFrame:
    """Pearson correlation ``(a, b, corr)`` of every ordered pair of columns over the rows where both are there, null
    where there is none or a column is constant there, NaN where a value is not finite.  ``vec`` names a vector column that
    holds the columns already."""
    names, width = list(cols), len(cols)
    sums = comoments(df.select((F.col(vec) if vec else vector(names)).alias("v")), "v", width, block=block)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j0, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                n, _, _, cxy, cxx, cyy, bad = np.frombuffer(raw.as_buffer(), dtype=np.float64).reshape(len(PLANES), -1)
                scale = np.sqrt(cxx) * np.sqrt(cyy)
                r = np.divide(cxy, scale, out=np.zeros(len(cxy)), where=scale > 0)
                known = (n > 0) & (scale > 0) | (bad > 0)
                r = np.where(bad > 0, np.nan, np.clip(r, -1.0, 1.0))
                js = np.arange(j0, j0 + len(r))
                up = js >= i
                r, known, js = r[up], known[up], js[up]
                off = js > i
                a, z = np.append(np.full(len(js), i), js[off]), np.append(js, np.full(int(off.sum()), i))
                corr = pa.array(np.append(r, r[off]), mask=np.append(~known, ~known[off]))
                yield pa.RecordBatch.from_arrays([pa.array(names).take(pa.array(a)), pa.array(names).take(pa.array(z)), corr], ["a", "b", "corr"])

    return sums.mapInArrow(pairs, "a string, b string, corr double")


def covariance(df: DataFrame, vec: str, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and the covariance matrix (divisor n) of complete vectors, on the driver: ``width`` squared doubles, whatever
    the number of rows.  No rows give zeros."""
    n, mean, out = 0, np.zeros(width), np.zeros((width, width))
    for r in comoments(df, vec, width, complete=True).toLocalIterator():
        count, mx, my, c = np.frombuffer(r["part"], dtype=np.float64).reshape(4, -1)
        i, j = r["i"], slice(r["j0"], r["j0"] + len(c))
        n, mean[i], mean[j] = int(count[0]), mx[0], my
        out[i, j] = c / count[0]
        out[j, i] = out[i, j]
    return n, mean, out


def weighted_moments(df: DataFrame, vec: str, width: int, weights: str, rounds: int, shift: Sequence[float] | None = None) -> pd.DataFrame:
    """Per round the weighted sums of products of every two of ``(1, v…)`` over one scan: a table of ``rounds`` rows with the
    matrices (``width + 1`` squared) in ``gram``.  ``weights`` holds one weight for each round in every row, so all rounds together
    are one product of the weights with the rows' products.  ``shift`` is taken from every vector first (means near the
    data's keep the digits)."""
    at, base = np.triu_indices(width + 1), np.zeros(width) if shift is None else np.asarray(shift, dtype=float)
    rows = df.select(F.col(vec).cast("array<double>").alias("v"), F.col(weights).cast("array<double>").alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rounds, len(at[0])))
        for b in batches:
            x, there = batch_matrix(b.column(0), width)
            if not there.all() or len(x) != len(b):
                raise ValueError("null in a vector: impute first")
            w, _ = batch_matrix(b.column(1), rounds)
            for a in range(0, len(x), 4096):
                one = np.column_stack([np.ones(len(x[a: a + 4096])), x[a: a + 4096] - base])
                total += w[a: a + 4096].T @ (one[:, at[0]] * one[:, at[1]])
        salt = TaskContext.get().partitionId() % _SALT
        yield pa.RecordBatch.from_arrays([pa.array(range(rounds), pa.int64()), pa.array([salt] * rounds, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], ["round", "salt", "part"])

    got = sum_streams(rows.mapInArrow(run, "round long, salt int, part binary"), ["round"]).toPandas().sort_values("round", ignore_index=True)
    grams = []
    for raw in got["part"]:
        g = np.zeros((width + 1, width + 1))
        g[at] = np.frombuffer(raw, dtype=np.float64)
        grams.append(g + np.triu(g, 1).T)
    return pd.DataFrame({"round": got["round"], "gram": grams})
