"""Reproducible splits and samples.

Every random choice is a function of ``md5(seed || id)``, so a split is the same at any partitioning, on
any cluster size and after an executor is lost (``randomSplit`` and ``rand`` are neither).  Positions in
the hash order come from :mod:`.order`, which never moves a whole table or a whole stratum to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .md5 import hasher
from .order import global_position, hash_key, hash_position


def hash_int(seed, *parts, digits: int = 12) -> Column:
    """Integer from the first ``digits`` hex digits of ``md5(seed || part1 || '-' || part2 …)``."""
    pieces = [F.lit(str(seed))]
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.conv(F.substring(F.md5(F.concat(*pieces)), 1, digits), 16, 10).cast("long")


def with_row_id(df: DataFrame, name: str = "rid", cols: Sequence[str] | None = None) -> DataFrame:
    """A unique, reproducible row id for a table without a key: md5 of the columns and the number of the row
    among those that are equal in all of them (equal rows are interchangeable)."""
    joined = F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (cols or df.columns)])
    # rows meet by four bytes of a hash; the md5, which does not compress, is taken after they have been dealt
    kinds = dict(df.dtypes)
    plain = all(isinstance(c, str) and kinds.get(c) in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") for c in (cols or df.columns))
    deal = F.hash(*[F.col(c) for c in (cols or df.columns)]) if plain else F.hash(joined)     # numbers of one text have one hash
    x = df.withColumn("_deal", deal).repartition("_deal").withColumn("_md", F.md5(joined))
    w = Window.partitionBy("_deal", "_md").orderBy(F.lit(0))
    return x.withColumn(name, F.concat("_md", F.lit("-"), F.row_number().over(w).cast("string"))).drop("_md", "_deal")


def _label_by_position(df: DataFrame, n_test: Column, test: str = "test", train: str = "train") -> DataFrame:
    return df.withColumn("split", F.when(F.col("pos") < n_test, F.lit(test)).otherwise(F.lit(train)))


def random_split_exact(df: DataFrame, id_col: str, ratio: float, seed, round_up: bool = False, with_pos: bool = True, hashed: bool = False) -> DataFrame:
    """Exactly ``int(n·ratio)`` (R02: ``ceil``) rows go to ``test`` – the first ones in the
    order of ``md5(seed || id)``; the rest are ``train``.  Adds ``pos`` (hash order) and ``split``; without ``pos`` the
    split is the same and no row is moved or sorted for it, but for those of one bucket of hashes.  ``hashed``, for written rows: ``id_col`` holds the
    hash already (:func:`hash_bytes`); the hash that cuts the rows is looked up at once, and a row is labelled by one comparison."""
    size = F.ceil if round_up else F.floor
    n_test = lambda n: size(n.cast("double") * F.lit(float(ratio)))
    if hashed:
        return _label_by_hash(df, id_col, n_test)
    if not with_pos:
        return _label_by_cut(df, id_col, seed, n_test)
    p = hash_position(df, id_col, seed, with_count="_n")
    return _label_by_position(p, n_test(F.col("_n"))).drop("_n")


def _label_by_cut(df: DataFrame, id_col: str, seed, n_test, digits: int = 3, test: str = "test", train: str = "train") -> DataFrame:
    """The labels of :func:`_label_by_position` for ``n_test`` of the number of rows.  Rows are counted by a prefix of their hash; the bucket in
    which position ``n_test`` lies cuts the others, and only its own rows are numbered.  A null id has no place, as in
    :func:`.order.hash_position`."""
    h = hash_key(seed, id_col)
    x = df.withColumn("_h", h).withColumn("_bk", F.coalesce(F.substring("_h", 1, digits), F.lit("")))
    before = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)           # over at most 16^digits counts
    counts = x.groupBy("_bk").agg(F.count(F.lit(1)).alias("_bn")).select(
        "_bk", "_bn", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"), F.sum("_bn").over(Window.partitionBy()).alias("_n"))
    rest = F.greatest(n_test(F.col("_n")), F.lit(0)) - F.col("_off")
    cut = counts.agg(F.max(F.when((rest >= 0) & (rest < F.col("_bn")), F.struct("_bk", rest.alias("rest")))).alias("_c"))      # one row
    cut = cut.select(F.coalesce("_c._bk", F.lit("g")).alias("_cut"), F.col("_c.rest").alias("_rest"))     # "g" is above all hashes
    marked = x.crossJoin(F.broadcast(cut))
    place = F.row_number().over(Window.partitionBy("_bk").orderBy("_h", F.col(id_col)))
    label = lambda first: F.when(first, F.lit(test)).otherwise(F.lit(train))
    apart = marked.where(F.col("_bk") != F.col("_cut")).withColumn("split", label(F.col("_bk") < F.col("_cut")))
    inside = marked.where(F.col("_bk") == F.col("_cut")).withColumn("split", label(place <= F.col("_rest")))
    return apart.unionByName(inside).where(F.col("_bk") != "").select(*df.columns, "split")


def hash_bytes(seed, id_col) -> Column:
    """The 16 bytes of :func:`.order.hash_key`; they have the order of its text."""
    return F.unhex(hash_key(seed, id_col))


def _label_by_hash(df: DataFrame, key: str, n_test, test: str = "test", train: str = "train") -> DataFrame:
    """The labels of :func:`_label_by_cut` for rows that hold their hash as bytes.  Two scans of the hashes find the one at position ``n_test``:
    counts by the first two bytes, then the hashes of one bucket.  Rows are numbered only if the cut goes through rows of one hash."""
    rows = df.where(F.col(key).isNotNull())
    x = df.select(key, F.coalesce(F.substring(key, 1, 2), F.lit(bytearray())).alias("_bk"))       # rows without a hash count, ahead of the others
    before = lambda by: Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)  # noqa: E731  (over at most 2^16 counts, or one bucket)
    counts = x.groupBy("_bk").agg(F.count(F.lit(1)).alias("_bn")).select(
        "_bk", "_bn", F.coalesce(F.sum("_bn").over(before("_bk")), F.lit(0)).alias("_off"), F.sum("_bn").over(Window.partitionBy()).alias("_n"))
    rest = F.greatest(n_test(F.col("_n")), F.lit(0)) - F.col("_off")
    cut = counts.where((rest >= 0) & (rest < F.col("_bn"))).select("_bk", rest.alias("rest")).first()
    label = lambda first: F.when(first, F.lit(test)).otherwise(F.lit(train))
    if cut is None:
        return rows.withColumn("split", F.lit(test)).select(*df.columns, "split")
    if not cut["rest"] or not cut["_bk"]:
        return rows.withColumn("split", label(F.col(key) < F.lit(cut["_bk"]))).select(*df.columns, "split")
    own = x.where(F.col("_bk") == F.lit(cut["_bk"])).groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    own = own.withColumn("_off", F.coalesce(F.sum("_c").over(before(key)), F.lit(0)))
    at = own.where((F.col("_off") < cut["rest"]) & (F.col("_off") + F.col("_c") >= cut["rest"])).first()
    last, room = F.lit(at[key]), cut["rest"] - at["_off"]
    if room == at["_c"]:
        return rows.withColumn("split", label(F.col(key) <= last)).select(*df.columns, "split")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
    apart = rows.where(F.col(key) != last).withColumn("split", label(F.col(key) < last))
    inside = rows.where(F.col(key) == last).withColumn("split", label(place <= room))
    return apart.unionByName(inside).select(*df.columns, "split")


def stratified_split(df: DataFrame, id_col: str, strata: str | Sequence[str], ratio: float, seed) -> DataFrame:
    """Stratified split with proportional allocation.

    ``n_test = ceil(n·ratio)``.  Stratum ``s`` with ``n_s`` rows gets ``floor(n_test·n_s/n)`` test rows; the
    remaining test rows go one each to the strata with the largest fractional parts (ties: stratum key
    ascending).  Inside a stratum the first rows in hash order are the test rows.  The allocation runs on
    the small per-stratum count table; rows are numbered per stratum by hash buckets (a hot stratum is
    spread over many tasks).
    """
    keys = [strata] if isinstance(strata, str) else list(strata)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ns"))
    total = counts.agg(F.sum("_ns").alias("_n"))          # one row
    alloc = (counts.crossJoin(F.broadcast(total))
             .withColumn("_nt", F.ceil(F.col("_n").cast("double") * F.lit(float(ratio))))
             .withColumn("_exact", F.col("_nt") * F.col("_ns") / F.col("_n"))
             .withColumn("_q", F.floor("_exact"))
             .withColumn("_less", F.col("_q") - F.col("_exact")))      # minus the fractional part
    rest = alloc.agg((F.max("_nt") - F.sum("_q")).alias("_left"))      # one row
    alloc = (global_position(alloc, ["_less", *keys], name="_rk").crossJoin(F.broadcast(rest))
             .select(*keys, (F.col("_q") + F.when(F.col("_rk") < F.col("_left"), 1).otherwise(0)).alias("_quota")))
    p = hash_position(df, id_col, seed, partition_by=keys)
    # one row per stratum: AQE turns this into a broadcast join when it is small
    return _label_by_position(p.join(alloc, keys), F.col("_quota")).drop("_quota")


def kfold(df: DataFrame, id_col: str, k: int, seed, name: str = "fold") -> DataFrame:
    """Shuffled k-fold assignment ``0 … k−1``; the first ``n mod k`` folds get one more row (the
    folds are consecutive runs of the hash order, like ``ntile(k)``)."""
    p = hash_position(df, id_col, seed, with_count="_n")
    q = F.floor(F.col("_n") / k)
    r = F.col("_n") % k
    big = r * (q + 1)
    fold = F.when(F.col("pos") < big, F.floor(F.col("pos") / (q + 1))).otherwise(r + F.floor((F.col("pos") - big) / q))
    return p.withColumn(name, fold.cast("int")).drop("_n")


def positional_split(df: DataFrame, cls: str, order: Sequence, n: int) -> DataFrame:
    """Per class the first ``n`` rows in ``order`` are ``train``, the rest ``val``."""
    p = global_position(df, order, partition_by=[cls])
    return p.withColumn("split", F.when(F.col("pos") < n, F.lit("train")).otherwise(F.lit("val")))


def shuffle(df: DataFrame, id_col: str, seed) -> DataFrame:
    """Whole rows in a reproducible random order (``pos`` = place in the shuffled order).

    Unlike the reference, features and labels stay paired."""
    return hash_position(df, id_col, seed)


def sample_n(df: DataFrame, id_col: str, n: int, seed) -> DataFrame:
    """``n`` rows without replacement – the ``n`` smallest hashes (a per-task top-n, then a merge)."""
    h = hash_key(seed, id_col)
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


def bootstrap_counts(df: DataFrame, id_col: str, rounds: int, seed, name: str = "weights", block_draws: int = 1 << 21) -> DataFrame:
    """Every row gets ``name``, its number of draws in each of ``rounds`` bootstrap samples of ``n`` draws with replacement.

    Draw ``j`` of round ``r`` takes the row at hash position ``md5(seed, r, j) mod n``.  Tasks hash their share of the draws, many at once
    (:mod:`.md5`), sort them and send them on as blocks of two-byte numbers, one block for each round and run of positions; a run takes about ``block_draws``
    draws, and its task counts them beside its rows.  So a draw costs one hash and two bytes of shuffle, and a task holds one run, whatever the
    number of rows and rounds.  An empty table gives no rows.
    """
    import numpy as np
    import pyarrow as pa

    spark, hash_ints = df.sparkSession, hasher()
    p = materialize(hash_position(df, id_col, seed, with_count="_n"), "positions")      # feeds the number of draws and the runs
    first, n = p.agg(F.coalesce(F.min("pos"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    width = min(1 << 16, max(1, block_draws // max(1, rounds)))
    span = min(1 << 20, max(1, n - first))                                              # a task's draws of one round
    pieces = -(-(n - first) // span)
    each = max(1, min((1 << 23) // span, -(-rounds * pieces // spark.sparkContext.defaultParallelism)))        # rounds of a task
    tasks = pieces * -(-rounds // each)

    def draw(batches):
        for b in batches:
            for task in b.column(0).to_pylist():
                lo, turn = first + task % pieces * span, task // pieces * each
                mine = range(turn, min(turn + each, rounds))
                for r, h in zip(mine, hash_ints([f"{seed}{r}-" for r in mine], lo, min(lo + span, n))):
                    at = h % np.uint64(n)
                    at = np.sort(at.astype(np.uint32) if n <= 1 << 32 else at)
                    run = at // at.dtype.type(width)
                    cuts = np.flatnonzero(np.diff(run)) + 1
                    cuts = np.concatenate([[0], cuts, [len(at)]])
                    cells = (at - run * at.dtype.type(width)).astype(np.uint16)
                    blocks = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 2).astype(np.int32).tobytes()), pa.py_buffer(cells.tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(run[cuts[:-1]].astype(np.int64)), pa.array(np.full(len(cuts) - 1, r, np.int32)), blocks], ["_run", "round", "cells"])

    schema = df.select("*").withColumn(name, F.array().cast("array<int>")).schema
    kept = df.columns

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        here = left.column("pos").to_numpy() % width
        total = np.zeros((rounds, width), dtype=np.int32)
        if right.num_rows:
            turn = right.column("round").to_numpy()
            order = np.argsort(turn, kind="stable")
            blocks = pa.concat_arrays(right.column("cells").chunks).take(pa.array(order))
            ends = np.frombuffer(blocks.buffers()[1], dtype=np.int32)[blocks.offset:blocks.offset + len(blocks) + 1] // 2
            drawn = np.frombuffer(blocks.buffers()[2], dtype=np.uint16)
            of, begin = np.unique(turn[order], return_index=True)
            for r, a, z in zip(of, begin, [*begin[1:], len(order)]):
                total[r] = np.bincount(drawn[ends[a]:ends[z]], minlength=width)
        flat = pa.array(np.ascontiguousarray(total.T[here]).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(left.num_rows + 1, dtype=np.int32) * rounds), flat)
        return left.select(kept).append_column(name, lists)

    rows = p.withColumn("_run", F.floor(F.col("pos") / width).cast("long"))
    packed = spark.range(0, tasks, 1, max(1, min(tasks, 1 << 16))).mapInArrow(draw, "_run long, round int, cells binary")
    return rows.groupBy("_run").cogroup(packed.groupBy("_run")).applyInArrow(count, schema)


def bootstrap(df: DataFrame, id_col: str, rounds: int, seed) -> DataFrame:
    """``rounds`` bootstrap samples of ``n`` draws with replacement (:func:`bootstrap_counts`), one row per (round, drawn
    row) with its multiplicity ``weight``; a row drawn many times is not repeated."""
    counted = bootstrap_counts(df, id_col, rounds, seed, "_weights")
    each = counted.select(*df.columns, F.posexplode("_weights").alias("round", "weight")).where("weight > 0")
    return each.select(F.col("round").cast("long").alias("round"), F.col("weight").cast("long").alias("weight"), *df.columns)


_FAN = 16


def bootstrap_weights(df: DataFrame, id_col: str, rounds: int, seed: int, name: str = "weights", bucket_rows: int = 1 << 13) -> DataFrame:
    """R09 without a row for each draw: every row gets ``name``, its number of draws in each of ``rounds`` bootstrap samples of
    ``n`` draws; in each round they add up to the number of rows exactly.

    The counts of a sample are multinomial.  They are drawn down a tree of hash buckets: a bucket's draws are dealt to its 16
    children by their row counts, at the end to the rows of a leaf of about ``bucket_rows`` rows.  A node's generator is seeded by
    the seed and the node, so each leaf's task repeats the draws on its path and no task knows more than 16 counts of a
    level.  Only the rows are shuffled, once, by leaf.  Rows of one id are told apart by their content; rows equal in all columns
    are interchangeable.  Null ids are an id; an empty table gives no rows."""
    import numpy as np
    import pyarrow as pa

    key = F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")), F.xxhash64(F.struct(*df.columns)).cast("string"))
    rows = df.withColumn("_h", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"))
    n, depth = df.count(), 0
    while n > bucket_rows * _FAN**depth:
        depth += 1
    leaf = lambda level: F.shiftright("_h", 60 - 4 * level)
    rows = rows.withColumn("_leaf", leaf(depth))
    leaves = rows.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_c"))
    path = leaves.select(F.col("_leaf").alias("_at"))
    for level in range(depth):      # the counts of the 16 children of the ancestor at this level
        up = 4 * (depth - level - 1)
        child = leaves.groupBy(F.shiftright("_leaf", up).alias("_k")).agg(F.sum("_c").alias("_c"))
        node = (child.groupBy(F.shiftright("_k", 4).alias("_n")).agg(F.collect_list(F.struct((F.col("_k") % _FAN).cast("int").alias("k"), "_c")).alias(f"_a{level}")))
        path = path.withColumn("_n", F.shiftright("_at", up + 4)).join(node, "_n").drop("_n")
    schema = df.select("*").withColumn(name, F.array().cast("array<int>")).schema

    def draw(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema_arrow(left, np.zeros((rounds, 0), dtype=np.int64))
        order = np.argsort(left.column("_h").to_numpy(), kind="stable")
        left = left.take(pa.array(order))
        here = int(left.column("_leaf")[0].as_py())
        total = np.full(rounds, n, dtype=np.int64)
        for level in range(depth):
            counts = np.zeros(_FAN)
            for cell in right.column(f"_a{level}")[0].as_py():
                counts[cell["k"]] = cell["_c"]
            node, child = here >> 4 * (depth - level), (here >> 4 * (depth - level - 1)) % _FAN
            total = np.random.default_rng([seed, level, node]).multinomial(total, counts / counts.sum())[:, child]
        m = left.num_rows
        return schema_arrow(left, np.random.default_rng([seed, depth, here]).multinomial(total, np.full(m, 1.0 / m)))

    def schema_arrow(left: pa.Table, weights: np.ndarray) -> pa.Table:
        m = weights.shape[1]
        flat = pa.array(np.ascontiguousarray(weights.T, dtype=np.int32).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * rounds), flat)
        return left.drop_columns(["_h", "_leaf"]).append_column(name, lists)

    return rows.groupBy("_leaf").cogroup(path.groupBy("_at")).applyInArrow(draw, schema)
