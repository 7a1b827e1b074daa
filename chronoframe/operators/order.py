"""Row positions in a total order without moving all rows to one task.

An unpartitioned ``row_number()`` window sends the whole table to one task.  Every position here is
computed in three distributed steps instead:

1. every row gets a *bucket* that is monotone in the order (a hash prefix, a time block, or the
   partition of a range-partitioned, checkpointed copy);
2. rows are counted per (group, bucket) – a small aggregate with map-side combine – and running
   offsets are taken over that small table;
3. the offsets are joined back and a window *partitioned by (group, bucket)* numbers the rows
   inside each bucket.

Each window task then holds one bucket, never a whole group, so a hot group is split as well.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, shuffle_partitions


def _cols(cols) -> list[Column]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def hash_key(seed, id_col) -> Column:
    """``md5(seed || id)`` as lowercase hex – the same text in Spark, DuckDB and hashlib."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string") if isinstance(id_col, str)
                          else id_col.cast("string")))


def bucketed_position(df: DataFrame, bucket: Column, order: Sequence, partition_by=None,
                      name: str = "pos", with_count: str | None = None) -> DataFrame:
    """0-based position of each row inside ``partition_by`` ordered by ``(bucket, *order)``.

    ``bucket`` must be monotone in the order (rows of a lower bucket come first).  ``order`` should make
    rows unique inside a bucket, otherwise ties are numbered in an arbitrary order.  ``with_count`` adds
    the group size.
    """
    part = _cols(partition_by)
    order_c = _cols(order)
    keys = [f"_pk{i}" for i in range(len(part))]
    base = df.select("*", *[c.alias(k) for c, k in zip(part, keys)], bucket.alias("_bk"))
    counts = base.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    w_off = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_boff", F.coalesce(F.sum("_bn").over(w_off), F.lit(0)))
    if with_count:
        offsets = offsets.withColumn("_gn", F.sum("_bn").over(Window.partitionBy(*keys)))
    offsets = offsets.drop("_bn")
    w_in = Window.partitionBy(*keys, "_bk").orderBy(*order_c)
    # never a broadcast of the rows, however small they look; the window reuses the join's partitions
    out = (base.join(offsets.hint("merge"), on=[*keys, "_bk"], how="inner")
               .withColumn(name, (F.col("_boff") + F.row_number().over(w_in) - 1).cast("long")))
    if with_count:
        out = out.withColumnRenamed("_gn", with_count)
    return out.drop(*keys, "_bk", "_boff")


def hash_buckets(spark) -> int:
    """Hex digits of the hash prefix used as bucket: about 4 buckets per shuffle partition."""
    return max(2, min(6, math.ceil(math.log(max(2, shuffle_partitions(spark)) * 4, 16))))


def hash_position(df: DataFrame, id_col: str, seed, partition_by=None, name: str = "pos",
                  with_count: str | None = None, digits: int | None = None) -> DataFrame:
    """Position in the order of ``md5(seed || id)`` (ties by id) – a reproducible shuffle.

    The hash prefix is the bucket, so buckets are equally full whatever the id distribution and the
    result is the same at any partitioning (no sampling).
    """
    digits = digits or hash_buckets(df.sparkSession)
    h = hash_key(seed, id_col)
    tmp = df.withColumn("_h", h)
    bucket = F.substring(F.col("_h"), 1, digits)
    out = bucketed_position(tmp, bucket, [F.col("_h"), F.col(id_col)], partition_by, name, with_count)
    return out.drop("_h")


def global_position(df: DataFrame, order: Sequence, name: str = "pos", partitions: int | None = None,
                    partition_by=None, with_count: str | None = None) -> DataFrame:
    """Position in an arbitrary total order ``order`` (make it unique with a tie key).

    Range partitioning samples the data, so the copy with its partition numbers is written once to the
    session's checkpoint folder before they are used as buckets; a lost executor then re-reads the same
    rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or shuffle_partitions(spark)
    order_c = _cols(order)
    part = _cols(partition_by)
    ranged = materialize(df.repartitionByRange(n, *part, *order_c).withColumn("_rp", F.spark_partition_id()),
                         "ranged")
    return bucketed_position(ranged, F.col("_rp"), order_c, part or None, name, with_count).drop("_rp")


def time_block(ts_col, block_seconds: int) -> Column:
    """Block number of a timestamp – the bucket for per-segment time order."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(block_seconds * 1_000_000)).cast("long")


def bucketed_cumsum(df: DataFrame, bucket: Column, order: Sequence, weight, partition_by=None,
                    name: str = "cum_before") -> DataFrame:
    """Sum of ``weight`` over the rows before each row inside ``partition_by`` in the order
    ``(bucket, *order)`` – the weighted form of :func:`bucketed_position`.  Bucket totals and their running
    offsets live in a small aggregate; the per-row window runs per (group, bucket)."""
    part = _cols(partition_by)
    order_c = _cols(order)
    w = F.col(weight) if isinstance(weight, str) else weight
    keys = [f"_pk{i}" for i in range(len(part))]
    base = df.select("*", *[c.alias(k) for c, k in zip(part, keys)], bucket.alias("_bk"), w.alias("_w"))
    totals = base.groupBy(*keys, "_bk").agg(F.sum("_w").alias("_bs"))
    w_off = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bk", F.coalesce(F.sum("_bs").over(w_off), F.lit(0)).alias("_boff"))
    w_in = Window.partitionBy(*keys, "_bk").orderBy(*order_c).rowsBetween(Window.unboundedPreceding, -1)
    out = (base.join(offsets.hint("merge"), on=[*keys, "_bk"], how="inner")
               .withColumn(name, F.col("_boff") + F.coalesce(F.sum("_w").over(w_in), F.lit(0))))
    return out.drop(*keys, "_bk", "_boff", "_w")


def global_cumsum(df: DataFrame, order: Sequence, weight, name: str = "cum_before",
                  partitions: int | None = None, partition_by=None) -> DataFrame:
    """Sum of ``weight`` over all rows before each row in the total order ``order`` (unique keys), on a
    range-partitioned, checkpointed copy (see :func:`global_position`)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or shuffle_partitions(spark)
    order_c = _cols(order)
    part = _cols(partition_by)
    ranged = materialize(df.repartitionByRange(n, *part, *order_c).withColumn("_rp", F.spark_partition_id()),
                         "ranged")
    return bucketed_cumsum(ranged, F.col("_rp"), order_c, weight, part or None, name).drop("_rp")


def average_rank(df: DataFrame, col: str, name: str | None = None, partition_by=None) -> DataFrame:
    """1-based average rank of ``col`` (ties share the mean of their ranks), per ``partition_by``.

    Ranks are computed on the table of distinct values with counts – ``rank = (#smaller) + (count+1)/2``
    – and joined back on the value, so equal values never need to meet in one window task.  A null has no rank and does not
    count for the others.
    """
    name = name or f"{col}_rank"
    part = [c for c in ([partition_by] if isinstance(partition_by, str) else (partition_by or []))]
    g = df.where(F.col(col).isNotNull()).groupBy(*part, col).agg(F.count(F.lit(1)).alias("_c"))
    g = global_cumsum(g, [col], "_c", "_below", partition_by=part or None)
    g = g.select(*part, col, (F.col("_below") + (F.col("_c") + 1) / 2.0).alias(name))
    return df.join(g, on=[*part, col], how="left")


def cells_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value)`` of the non-null, non-NaN values (as double) of several columns in one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))


_BINS = 4096


def _bin_of(wide: bool) -> Column:
    """Bin of ``value`` in the range ``[_a, _z]``, monotone in the value: of equal widths, or, where those put most rows into one
    bin, of widths that grow by a factor (18 decades at once)."""
    u = F.try_divide(F.col("value") * 0.5 - F.col("_a") * 0.5, F.col("_z") * 0.5 - F.col("_a") * 0.5)
    u = F.coalesce(u, (F.col("value") > F.col("_a")).cast("double"))        # a range of the least doubles only
    u = F.log1p(u * 2.0**60) / math.log1p(2.0**60) if wide else u
    return F.least(F.floor(u * _BINS).cast("int"), F.lit(_BINS - 1))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], limit: int = 1 << 20) -> DataFrame:
    """Exact quantiles ``(column, prob, value)`` of several columns, linear between neighbours; no rows for a column
    without values.

    The values at the positions ``floor`` and ``ceil`` of ``prob * (n - 1)`` are found by narrowing: a histogram of
    4096 bins of the ranges that still hold a wanted position, whose bins with such a position are the next ranges.
    Only histograms are shuffled, whatever the number of distinct values; when at most ``limit`` rows are left in all ranges, their
    distinct values are counted.  The driver holds one range for each wanted position.
    """
    spark, cells = df.sparkSession, cells_long(df, cols)
    low, high = F.col("value") == float("-inf"), F.col("value") == float("inf")
    finite = F.when(~low & ~high, F.col("value"))
    stats = cells.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if(low).alias("low"), F.count(finite).alias("mid"),
                                        F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()
    cells = cells.where(~low & ~high)
    at: dict[tuple[str, int], float] = {}                # (column, position) -> value
    todo: dict[tuple[str, float, float], list] = {}       # (column, from, to) -> [rows before, rows inside, positions]
    for s in stats:
        places = {k for p in probs for k in (math.floor(p * (s["n"] - 1)), math.ceil(p * (s["n"] - 1)))}
        for k in places:
            if k < s["low"] or k >= s["low"] + s["mid"]:
                at[s["column"], k] = float("-inf") if k < s["low"] else float("inf")
        inside = [k for k in places if (s["column"], k) not in at]
        if inside:
            todo[s["column"], s["lo"], s["hi"]] = [s["low"], s["mid"], inside]
    wide = False
    while True:
        for (c, a, z), (_, _, ks) in list(todo.items()):
            if a == z:
                at.update({(c, k): a for k in ks})
                del todo[c, a, z]
        rows = sum(v[1] for v in todo.values())
        if not todo:
            break
        ranges = spark.createDataFrame([(c, a, z, i) for i, (c, a, z) in enumerate(todo)], "column string, _a double, _z double, _r int")
        keys = list(todo)
        inside = cells.join(F.broadcast(ranges), "column").where(F.col("value").between(F.col("_a"), F.col("_z")))     # one row for each range
        last = rows <= limit
        by = F.col("value") if last else _bin_of(wide)
        bins = inside.groupBy("_r", by.alias("_b")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        run = Window.partitionBy("_r").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
        wanted = spark.createDataFrame([(i, k - todo[c][0]) for i, c in enumerate(keys) for k in todo[c][2]], "_r int, _k long")
        hit = bins.join(F.broadcast(wanted), "_r").where((F.col("_k") >= F.col("before")) & (F.col("_k") < F.col("before") + F.col("n")))
        new: dict = {}
        for h in hit.collect():
            c, base = keys[h["_r"]][0], todo[keys[h["_r"]]][0]
            new.setdefault((c, h["lo"], h["hi"]), [base + h["before"], h["n"], []])[2].append(base + h["_k"])
        wide = not wide and sum(v[1] for v in new.values()) > rows // 16
        todo = new
    out = []
    for s in stats:
        for p in probs:
            h = p * (s["n"] - 1)
            a, z = at[s["column"], math.floor(h)], at[s["column"], math.ceil(h)]
            out.append((s["column"], float(p), a if a == z else a + (z - a) * (h - math.floor(h))))
    return spark.createDataFrame(out, "column string, prob double, value double")


def modes(df: DataFrame, col: str) -> DataFrame:
    """One row with the most frequent non-null value of ``col`` (the least one on ties), by two aggregates over
    the distinct values."""
    v = F.col(col)
    ok = v.isNotNull() & ~F.isnan(v) if dict(df.dtypes)[col] in ("double", "float") else v.isNotNull()
    g = df.where(ok).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    top = g.agg(F.max("_n").alias("_n"))
    return g.join(F.broadcast(top), "_n").agg(F.min(col).alias(col))     # one-row side


def count_blocks(df: DataFrame, segment, ts: str, block_rows: int = 1 << 17, fine_seconds: int = 60, name: str = "_blk") -> DataFrame:
    """Block number per segment, monotone in ``ts``, of about ``block_rows`` rows each.

    Rows are counted per (segment, ``fine_seconds`` of time); running counts over that small table are cut
    every ``block_rows``, so blocks follow the rows and not the calendar.
    """
    seg = [segment] if isinstance(segment, str) else list(segment or [])
    fine = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(fine_seconds * 1_000_000)).cast("long")
    base = df.withColumn("_fine", fine)
    counts = base.groupBy(*seg, "_fine").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*seg).orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(name, F.floor(F.coalesce(F.sum("_c").over(before), F.lit(0)) / F.lit(block_rows)).cast("long")).drop("_c")
    return base.join(counts, [*seg, "_fine"]).drop("_fine")
