"""Near-duplicate vectors: exact metric range join over pivots.

Vectors are compared inside groups of equal label and width.  On unit vectors a cosine of at least c is a
Euclidean distance of at most r = sqrt(2 - 2c), a metric.  Pivots (rows whose id hash falls on a rate of one in
``cell_rows``, raised with the table so that all pivots together stay near ``max_pivots``, which bounds their
broadcast) partition a group: a vector's home is the cell of its nearest pivot.  If x and y lie within r and y
lives in cell j, the triangle inequality gives d(x, p_j) <= d(x, p_home) + 2r, and in Euclidean space x lies
at most r beyond the plane between p_home and p_j; x visits the cells that meet both bounds.  So every
vector finds all its partners in its home cell, and cells join independently.

A cell's home rows and its home and visiting rows are cut into blocks of at most ``block_rows``; every pair of
blocks is one tile, a product of two matrices in double precision.  A tile returns for each row the number of its links
and the least id that it reaches there, never the pairs.  Equal vectors are one row with a multiplicity from the start; links are counted
by distinct ids.

Rows: vectors that are null, empty, zero, or hold null or non-finite numbers, rows of null label and rows of null
id link with nothing (a null id is kept); rows that repeat an id are one vector, the least (label, vector); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .components import components

SLACK = 1e-9
MATRIX = 1 << 21          # doubles of one matrix of rows by pivots


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest number is taken out first, so squares neither vanish nor overflow."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def tile(home: np.ndarray, home_id: np.ndarray, other: np.ndarray, other_id: np.ndarray, other_n: np.ndarray, cosine: float):
    """Links of the home rows (by multiplicity of the others), and for the linked ids the least id reached."""
    near = home @ other.T >= cosine
    near &= home_id[:, None] != other_id[None, :]
    count = near @ other_n
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(rows, cols)]
    nodes = np.unique(np.concatenate([home_id[rows], other_id[cols]]))
    at_row, at_col = np.searchsorted(nodes, home_id[rows]), np.searchsorted(nodes, other_id[cols])
    low = np.arange(len(nodes))
    while len(nodes):
        old = low.copy()
        np.minimum.at(low, at_row, np.where(near, low[at_col][None, :], len(nodes)).min(axis=1))
        np.minimum.at(low, at_col, np.where(near, low[at_row][:, None], len(nodes)).min(axis=0))
        low = low[low]
        if (low == old).all():
            break
    return count, nodes, nodes[low] if len(nodes) else nodes


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = 0.98,
                 cell_rows: int = 2048, max_pivots: int = 16384, block_rows: int = 2048) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = rows.where(F.col("_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    good = good.groupBy("_id").agg(F.min(F.struct("label", "v")).alias("s")).select("_id", "s.label", "s.v")
    good = good.withColumn("key", F.sha2(F.concat_ws(",", "label", F.col("v").cast("array<string>")), 256))
    good = materialize(good, "vectors")
    reps = good.groupBy("key").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    reps = materialize(reps.join(good.select(F.col("_id").alias("rep"), "key", "label", "v"), ["rep", "key"]).withColumn("width", F.size("v")), "distinct-vectors")
    total = reps.count()
    rate = max(cell_rows, math.ceil(total / max_pivots))
    picked = reps.where(F.pmod(F.xxhash64("rep"), F.lit(rate)) == 0).select("label", "width", "rep", "v").collect()
    groups: dict = {}
    for p in sorted(picked, key=lambda p: (p.label, p.width, p.rep)):
        groups.setdefault((p.label, p.width), []).append(p.v)
    shared = spark.sparkContext.broadcast({k: unit(np.array(v, dtype=np.float64)) for k, v in groups.items()})
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for b in batches:
            label, width = np.array(b.column(0).to_pylist(), dtype=object), b.column(1).to_numpy()
            keys = list(zip(label.tolist(), width.tolist()))
            for g in dict.fromkeys(keys):
                pick = np.array([k == g for k in keys])
                part = b.filter(pa.array(pick))
                p = pivots.get(g, ())
                step = max(1, MATRIX // max(1, len(p)))         # bounds the matrices of rows by pivots
                for at in range(0, part.num_rows, step):
                    yield cells(part.slice(at, step), p, g[1])

    def cells(part: pa.RecordBatch, p: np.ndarray, width: int) -> pa.RecordBatch:
        n = part.num_rows
        take, cell, home = [np.arange(n)], [np.zeros(n, dtype=np.int32)], [np.ones(n, dtype=bool)]
        if len(p) > 1:
            d2 = np.maximum(0.0, 2 - 2 * (unit(matrix(part.column(4), width)) @ p.T))
            d = np.sqrt(d2)
            own = d.argmin(axis=1)
            gap = np.sqrt(np.maximum(0.0, 2 - 2 * (p[own] @ p.T)))
            near = d[np.arange(n), own]
            visit = (d <= near[:, None] + 2 * radius + SLACK) & (d2 - (near**2)[:, None] <= 2 * gap * (radius + SLACK) + SLACK)
            visit[np.arange(n), own] = False
            row, to = np.nonzero(visit)
            take, cell, home = [np.arange(n), row], [own.astype(np.int32), to.astype(np.int32)], [np.ones(n, dtype=bool), np.zeros(len(row), dtype=bool)]
        out = part.take(pa.array(np.concatenate(take)))
        return pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(home))], names=["label", "width", "rep", "n", "v", "cell", "home"])

    schema = "label string, width int, rep long, n long, v array<double>, cell int, home boolean"
    placed = materialize(reps.select("label", "width", "rep", "n", "v").mapInArrow(assign, schema), "cells")
    sizes = placed.groupBy("label", "width", "cell").agg(F.ceil(F.sum(F.col("home").cast("long")) / block_rows).cast("int").alias("h"), F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("m"))
    sizes = sizes.where("h > 0")
    at = placed.join(sizes, ["label", "width", "cell"])
    slot = F.xxhash64("rep")
    as_home = at.where("home").select("label", "width", "cell", F.pmod(slot, "h").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"), F.lit(0).alias("side"), "rep", "n", "v")
    as_other = at.select("label", "width", "cell", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("i"), F.pmod(slot, "m").cast("int").alias("j"), F.lit(1).alias("side"), "rep", "n", "v")
    parts = 2 * shuffle_partitions(spark)
    tiles = as_home.unionByName(as_other).repartition(parts, "label", "width", "cell", "i", "j").sortWithinPartitions("label", "width", "cell", "i", "j", "side", "rep")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def run() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            side, rep, n = (t.column(c).to_numpy() for c in ("side", "rep", "n"))
            x = unit(matrix(t.column("v").combine_chunks(), key[1]))
            a, b = side == 0, side == 1
            count, nodes, low = tile(x[a], rep[a], x[b], rep[b], n[b], cosine)
            link = nodes != low
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([rep[a], nodes[link]]), pa.int64()), pa.array(np.concatenate([count, np.zeros(int(link.sum()), dtype=np.int64)]), pa.int64()),
                                              pa.array(np.concatenate([rep[a], low[link]]), pa.int64())], names=["rep", "n_links", "parent"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "width", "cell", "i", "j"))))
            start = 0
            for r in range(1, len(keys) + 1):
                if r < len(keys) and keys[r] == keys[start]:
                    continue
                if keys[start] != key:
                    if held:
                        yield from run()
                    key, held = keys[start], []
                held.append(batch.slice(start, r - start))
                start = r
        if held:
            yield from run()

    found = materialize(tiles.mapInArrow(join, "rep long, n_links long, parent long"), "vector-links")
    linked = components(found.where("rep <> parent").select(F.col("rep").alias("a"), F.col("parent").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    classes = reps.select("key", "rep", "n").join(counts, "rep", "left").join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
    classes = classes.select("key", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    by_id = good.select("_id", "key").join(classes, "key").select("_id", "n_links", "component_id")
    return rows.select("_id").join(by_id, "_id", "left").select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "_id").alias("component_id"),
                                                               F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))
