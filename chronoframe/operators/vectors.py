"""Vector-table operators (O06, X20, X21, G01–G03, J09, F17): arrays stay in Spark's higher-order
functions (``transform``, ``zip_with``, ``aggregate``); only the tiles of the neighbour search run in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, shuffle_partitions
from .order import hash_position
from .split import hash_int


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def random_partner(df: DataFrame, id_col: str, seed, cols=None, prefix: str = "partner_") -> DataFrame:
    """A partner row for every row, never itself.

    Rows are numbered in the ``md5(seed || id)`` order; the partner of position ``i`` is position
    ``(i + k) mod n`` with a shift ``1 ≤ k < n`` drawn from the seed – a permutation without fixed points,
    found by one equi-join on the position (no pairs are formed).  ``cols`` are copied from the partner
    with ``prefix``.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns]
    p = hash_position(df, id_col, seed, with_count="_n")
    k = F.lit(1) + F.pmod(hash_int(seed, F.lit("shift")), F.greatest(F.col("_n") - 1, F.lit(1)))
    left = p.withColumn("_ppos", F.pmod(F.col("pos") + k, F.col("_n")))
    right = p.select(F.col("pos").alias("_ppos"), *[F.col(c).alias(prefix + c) for c in cols])
    return left.join(right, "_ppos").drop("_ppos", "_n")


def array_top_k(arr, k: int) -> Column:
    """0-based positions of the ``k`` largest cells (ties: lower position first)."""
    a = _c(arr).cast("array<double>")
    tagged = F.transform(a, lambda v, i: F.struct((-v).alias("nv"), i.alias("i")))
    return F.transform(F.slice(F.array_sort(tagged), 1, k), lambda s: s["i"])


def poly_bounds(arr) -> Column:
    """Axis-aligned bounds ``struct(xmin, ymin, xmax, ymax)`` of a polygon ``[x0, y0, x1, y1, …]``."""
    a = _c(arr)
    xs = F.filter(a, lambda v, i: i % 2 == 0)
    ys = F.filter(a, lambda v, i: i % 2 == 1)
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def flatten_values(df: DataFrame, cols, element: str = "double") -> Column:
    """One flat array from the arrays, nested arrays and scalars in ``cols`` (a scalar becomes a one-element
    list); cells are cast to ``element``."""
    parts = []
    for c in map(_c, cols):
        kind = df.select(c.alias("c")).schema[0].dataType
        depth = 0
        while isinstance(kind, T.ArrayType):
            kind, depth = kind.elementType, depth + 1
        for _ in range(depth - 1):
            c = F.flatten(c)
        parts.append((F.array(c) if not depth else c).cast(f"array<{element}>"))
    return F.flatten(F.array(*parts))


def vector_width(df: DataFrame, vec: str) -> int:
    """Width of the vectors of a column; an error if they differ (one aggregate over the whole table)."""
    lo, hi = df.agg(F.min(F.size(vec)), F.max(F.size(vec))).first()
    if lo != hi:
        raise ValueError(f"vectors of {vec} have widths from {lo} to {hi}")
    return lo or 0


def _unit_hash(seed, id_col: str, i: Column) -> Column:
    """Uniform [0, 1) from ``md5(seed || id || '-' || i)`` (reproducible per row and cell)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string"), F.lit("-"),
                                           i.cast("string"))), 1, 8), 16, 10).cast("long")
    return h / F.lit(float(16 ** 8))


def mixup(df: DataFrame, id_col: str, vec: str, label: str, lam: float, seed) -> DataFrame:
    """``λ·x + (1−λ)·x_partner`` with a fixed-point-free random partner (J09); both labels and λ kept."""
    p = random_partner(df, id_col, seed, cols=[id_col, vec, label])
    mixed = F.zip_with(F.col(vec).cast("array<double>"), F.col("partner_" + vec).cast("array<double>"),
                       lambda a, b: F.lit(lam) * a + F.lit(1 - lam) * b)
    return p.select(id_col, F.col("partner_" + id_col).alias("partner_id"), label, F.col("partner_" + label).alias("partner_label"),
                    F.lit(lam).alias("lam"), mixed.alias(vec))


def cutmix(df: DataFrame, id_col: str, vec: str, label: str, lam: float, seed) -> DataFrame:
    """CutMix on a vector – a contiguous slice of length ``⌊d·(1−λ)⌋`` at a hash-chosen start is taken
    from the partner; ``lam`` is corrected to the share of own cells kept."""
    p = random_partner(df, id_col, seed, cols=[id_col, vec, label])
    x = F.col(vec).cast("array<double>")
    xp = F.col("partner_" + vec).cast("array<double>")
    d = F.size(x)
    cut = F.floor(d * F.lit(1 - lam)).cast("int")
    start = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string"))), 1, 8), 16, 10)
                   .cast("long"), (d - cut + 1).cast("long")).cast("int")
    mixed = F.concat(F.slice(x, 1, start), F.slice(xp, start + 1, cut), F.slice(x, start + cut + 1, d))
    return p.select(id_col, F.col("partner_" + id_col).alias("partner_id"), label,
                    F.col("partner_" + label).alias("partner_label"), start.alias("cut_start"), cut.alias("cut_len"),
                    (F.lit(1.0) - cut / d).alias("lam"), mixed.alias(vec))


def add_noise(df: DataFrame, id_col: str, vec: str, a: float, b: float, seed) -> DataFrame:
    """``x + U(0,1)·a + b`` per cell, with ``U`` from a per-row, per-cell hash (reproducible)."""
    noisy = F.transform(F.col(vec).cast("array<double>"),
                        lambda v, i: v + _unit_hash(seed, id_col, i) * F.lit(float(a)) + F.lit(float(b)))
    return df.withColumn(vec, noisy)


def _distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows, by differences (equal rows get equal distances)."""
    out = np.empty((len(q), len(t)))
    step = max(1, (1 << 22) // max(1, t.size))
    for a in range(0, len(q), step):
        gap = q[a: a + step, None, :] - t[None, :, :]
        out[a: a + step] = np.einsum("ijk,ijk->ij", gap, gap)
    return out


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors of a column as rows of doubles."""
    return lists.flatten().to_numpy().reshape(-1, width).astype(np.float64, copy=False)


def _tile_top(tiles: DataFrame, k: int, width: int) -> DataFrame:
    """``qid, tid, lab, d2`` of the ``k`` nearest train rows of every query row inside its tile ``(cell, i, j)``:
    distances stay in the task, only ``k`` rows for each query and tile leave it."""
    n = 2 * shuffle_partitions(tiles.sparkSession)
    dealt = tiles.repartition(n, "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "side", "id")

    def run(batches):
        key, held = None, []

        def top():
            t = pa.Table.from_batches(held)
            side, ids, lab = t.column("side").to_numpy(), t.column("id").to_numpy(), t.column("lab").to_numpy()
            x = _matrix(t.column("x").combine_chunks(), width)
            q, b = side == 0, side == 1
            xq, xb, qid, tid, tl = x[q], x[b], ids[q], ids[b], lab[b]
            step = max(1, (1 << 22) // max(1, len(xb)))         # distances of a part of the queries at a time
            for a in range(0, len(xq) if len(xb) else 0, step):
                d = _distances(xq[a: a + step], xb)
                row, at = np.nonzero(~(d > np.partition(d, min(k, len(xb)) - 1, axis=1)[:, min(k, len(xb)) - 1:][:, :1]))     # the k-th and all as near
                d = d[row, at]
                order = np.lexsort((tid[at], d, row))
                row, at, d = row[order], at[order], d[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, at, d = row[best], at[best], d[best]
                yield pa.RecordBatch.from_arrays([pa.array(qid[a + row]), pa.array(tid[at]), pa.array(tl[at]), pa.array(d)], names=["qid", "tid", "lab", "d2"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "i", "j"))))
            start = 0
            for r in range(1, len(keys) + 1):
                if r < len(keys) and keys[r] == keys[start]:
                    continue
                if keys[start] != key:
                    if held:
                        yield from top()
                    key, held = keys[start], []
                held.append(batch.slice(start, r - start))
                start = r
        if held:
            yield from top()

    return dealt.mapInArrow(run, "qid long, tid long, lab long, d2 double")


def knn_class_share(train: DataFrame, query: DataFrame, id_col: str, vec: str, label: str, k: int = 5, cell_rows: int = 1 << 14,
                    max_pivots: int = 4096, block_rows: int | None = None) -> DataFrame:
    """exact k-nearest-neighbour class shares ``(query id, label, share)`` (``predict_proba``).

    Pivots (train rows whose id hash falls on a rate of one in ``cell_rows``, raised with the table so that
    about ``max_pivots`` are the most) cut the train rows into cells of the nearest pivot; a cell's radius is
    the largest distance to its pivot.  First every query searches the nearest cells that hold ``k`` rows,
    which bounds its k-th distance by r; then, by the triangle inequality, only the cells with
    ``d(q, pivot) − radius ≤ r``.  A cell's train rows and its queries are cut into blocks; a pair of
    blocks is one tile whose distances are computed by numpy and never leave the task.  A row is sent once to each tile, so
    blocks (``block_rows``) grow with the table, a sixteenth of the train rows from 1 024 to 16 384, and vectors of floats stay floats until
    their distances are taken.  Ids and labels are whole numbers; ties go to the least train id.
    """
    spark = train.sparkSession
    cells_of = "float" if all(dict(d.dtypes)[vec] == "array<float>" for d in (train, query)) else "double"
    x = F.col(vec).cast(f"array<{cells_of}>")
    tr = train.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("lab"), x.alias("x"), F.lit(True).alias("train"))
    qu = query.select(F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("lab"), x.alias("x"), F.lit(False).alias("train"))
    both = materialize(tr.unionByName(qu), "knn_rows")     # both sides feed several steps
    lo, hi, total = both.agg(F.min(F.size("x")), F.max(F.size("x")), F.count_if("train")).first()
    if lo != hi:
        raise ValueError(f"vectors of {vec} have widths from {lo} to {hi}")
    width = lo or 0
    block_rows = block_rows or min(1 << 14, max(1024, total >> 4))
    tr, qu = both.where("train").drop("train"), both.where("NOT train").drop("train")
    rate = max(cell_rows, -(-total // max_pivots))
    chosen = tr.where(F.pmod(F.xxhash64("id"), F.lit(rate)) == 0).orderBy("id").select("x").collect() if total > cell_rows else []
    pivots = np.array([r.x for r in chosen], dtype=np.float64).reshape(-1, width) if len(chosen) > 1 else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(pivots)

    def near(batches):
        for b in batches:
            d = np.sqrt(_distances(_matrix(b.column(2), width), shared.value))
            own = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(d)), own])], names=["id", "lab", "x", "cell", "d"])

    if len(pivots) > 1:
        tr = materialize(tr.mapInArrow(near, f"id long, lab long, x array<{cells_of}>, cell int, d double"), "knn_train")
        cells = {r.cell: (r.n, r.r) for r in tr.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()}   # one row per pivot
    else:
        tr, cells = tr.withColumn("cell", F.lit(0)), {0: (total, float("inf"))}
    count = np.array([cells.get(c, (0, 0.0))[0] for c in range(len(pivots))])
    radius = np.array([cells.get(c, (0, -np.inf))[1] for c in range(len(pivots))])
    blocks = np.maximum(1, -(-count // block_rows))

    def visits(first: bool):
        def run(batches):
            for b in batches:
                d = np.sqrt(_distances(_matrix(b.column(2), width), shared.value))
                order = d.argsort(axis=1, kind="stable")
                held = np.cumsum(count[order], axis=1)
                need = np.concatenate([np.ones((len(d), 1), dtype=bool), held[:, :-1] < k], axis=1)   # cells until k rows are there
                home = np.zeros(d.shape, dtype=bool)
                np.put_along_axis(home, order, need, axis=1)
                if not first:
                    home = ~home & (d - radius <= b.column(3).to_numpy(zero_copy_only=False)[:, None] + 1e-9)
                row, cell = np.nonzero(home & (count > 0))
                part = b.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(cell.astype(np.int32)), pa.array(blocks[cell].astype(np.int32))], names=["id", "lab", "x", "cell", "m"])
        return run

    def search(q: DataFrame, first: bool) -> DataFrame:
        if len(pivots) > 1:
            go = materialize(q.mapInArrow(visits(first), f"id long, lab long, x array<{cells_of}>, cell int, m int"), "knn_visits")
        else:
            go = q.select("id", "lab", "x", F.lit(0).alias("cell"), F.lit(int(blocks[0])).alias("m"))
        block = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
        qb = F.greatest(F.ceil(F.col("c") / F.lit(block_rows)), F.lit(1))
        sizes = go.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).select("cell", qb.alias("h"))
        left = go.join(sizes, "cell").select("cell", block(F.col("h")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"), F.lit(0).alias("side"), "id", "lab", "x")
        many = F.array(*[F.lit(int(v)) for v in blocks])
        right = tr.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), (F.col("h") - 1).cast("int"))).alias("i"),
                                              block(F.get(many, F.col("cell"))).alias("j"), F.lit(1).alias("side"), "id", "lab", "x")
        return _tile_top(left.unionByName(right), k, width)

    w = Window.partitionBy("qid").orderBy("d2", "tid")
    best = lambda d: d.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    found = best(search(qu, True)).drop("_rk")
    if len(pivots) > 1:
        found = materialize(found, "knn_first")
        bound = found.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.sqrt(F.max("d2"))).otherwise(F.lit(float("inf"))).alias("r"))
        q2 = qu.join(bound, qu["id"] == bound["qid"], "left").select("id", "lab", "x", F.coalesce("r", F.lit(float("inf"))).alias("r"))
        found = best(found.unionByName(search(q2, False))).drop("_rk")
    kind = dict(train.dtypes)
    return (found.groupBy(F.col("qid").cast(kind[id_col]).alias(id_col), F.col("lab").cast(kind[label]).alias(label))
                 .agg((F.count(F.lit(1)) / F.lit(float(k))).alias("share")))
