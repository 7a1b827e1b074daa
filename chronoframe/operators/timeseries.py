"""Segmented time-series operators: resampling, grids, gap fills, lags, samples, smoothing.

A series is a long table ``(segment, ts, values…)``.  Every operator shuffles once by segment (or by
segment and time block) instead of looping over segments.  Windows over a whole segment are cut into
*time blocks* where the operator allows it, so one very long segment is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.datetime import epoch_micros, floor_ts, from_epoch_micros
from ..session import shuffle_partitions
from .order import bucketed_cumsum, bucketed_position, count_blocks

_MIN_US = 60_000_000


def _seg(segment) -> list[str]:
    if segment is None:
        return []
    return [segment] if isinstance(segment, str) else list(segment)


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------------------------------------------
# resampling
# ---------------------------------------------------------------------------------------------------

def resample_mean(df: DataFrame, segment, ts: str, values, minutes: int, out_ts: str | None = None) -> DataFrame:
    """Mean of ``values`` per segment and left-closed, epoch-aligned bucket of ``minutes``.

    The bucket label is its start.  Partial aggregation runs map-side before the shuffle.
    """
    seg = _seg(segment)
    vals = _list(values)
    out_ts = out_ts or ts
    return (df.groupBy(*seg, floor_ts(ts, minutes).alias(out_ts))
              .agg(*[F.avg(v).alias(v) for v in vals]))


def grid(df: DataFrame, segment, ts: str, minutes: int, floor_first: bool = True, block: int = 1 << 16) -> DataFrame:
    """Regular grid per segment from (floored) first to last timestamp, both ends included.

    A segment's grid is generated in pieces of ``block`` points: each piece is a row of its own, dealt by (segment, piece) before
    its points are formed, so a long segment is spread over tasks and is never one array."""
    seg = _seg(segment)
    lo = floor_ts(F.min(ts), minutes) if floor_first else F.min(ts)
    bounds = df.groupBy(*seg).agg(epoch_micros(lo).alias("_lo"), epoch_micros(F.max(ts)).alias("_hi")).where(F.col("_lo").isNotNull())
    step = int(minutes) * _MIN_US
    last = F.expr(f"(_hi - _lo) div {step}")      # of the points from 0
    pieces = bounds.select(*seg, "_lo", last.alias("_n")).withColumn("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"_n div {block}"))))
    pieces = pieces.repartition(shuffle_partitions(df.sparkSession), *seg, "_g")
    ends = F.sequence(F.col("_g") * block, F.least(F.col("_n"), (F.col("_g") + 1) * block - 1))
    at = from_epoch_micros(F.col("_lo") + F.col("_i") * F.lit(step).cast("long")).cast(dict(df.dtypes)[ts])
    return pieces.select(*seg, "_lo", F.explode(ends).alias("_i")).select(*seg, at.alias(ts))


def resample_dense(df: DataFrame, segment, ts: str, values, minutes: int) -> DataFrame:
    """Dense resample – a value exactly on a grid point wins, else the bucket mean, else null.

    Grid = floor(first ts) … last ts per segment.  Off-grid rows do not survive (they went into bucket
    means).  Duplicate timestamps are averaged on the exact branch.
    """
    seg = _seg(segment)
    vals = _list(values)
    g = grid(df, seg, ts, minutes)
    exact = (df.where(F.col(ts) == floor_ts(ts, minutes))
               .groupBy(*seg, ts).agg(*[F.avg(v).alias(f"_x_{v}") for v in vals]))
    means = resample_mean(df, seg, ts, vals, minutes)
    out = (g.join(exact, on=[*seg, ts], how="left")
            .join(means, on=[*seg, ts], how="left"))
    return out.select(*seg, ts, *[F.coalesce(f"_x_{v}", v).alias(v) for v in vals])


def resample_grid(df: DataFrame, segment, ts: str, values, minutes: int) -> DataFrame:
    """W11 without the empty grid points: one row per bucket that has rows; the mean of the values exactly on
    the grid point where there are any, else the bucket mean.  One aggregate, no join."""
    seg = _seg(segment)
    on = F.col(ts) == floor_ts(ts, minutes)
    return (df.groupBy(*seg, floor_ts(ts, minutes).alias("_g"))
              .agg(*[F.coalesce(F.avg(F.when(on, F.col(v))), F.avg(v)).alias(v) for v in _list(values)])
              .withColumnRenamed("_g", ts))


def check_unique_ts(df: DataFrame, segment, ts: str, policy: str = "error") -> DataFrame:
    """Duplicate timestamps per segment: ``error`` (fail at run time), ``first`` or ``mean``."""
    seg = _seg(segment)
    if policy == "mean":
        others = [c for c in df.columns if c not in (*seg, ts)]
        num = [c for c in others if dict(df.dtypes)[c] in ("double", "float", "int", "bigint", "smallint", "tinyint")]
        return df.groupBy(*seg, ts).agg(*[F.avg(c).alias(c) for c in num])
    if policy == "first":
        return df.dropDuplicates([*seg, ts])
    w = Window.partitionBy(*seg, ts)
    # the check is part of a column that stays: an extra column would be pruned with its check
    ok = F.when(F.count(F.lit(1)).over(w) == 1, F.col(ts)).otherwise(F.raise_error(F.lit("duplicate timestamp in segment")).cast(dict(df.dtypes)[ts]))
    return df.withColumn("_ts", ok).select(*[F.col("_ts").alias(ts) if c == ts else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------------------------------
# Grid joins, time shift, combine-first, keyed update
# ---------------------------------------------------------------------------------------------------

def fill_date(df: DataFrame, segment, ts: str, minutes: int, strip=None) -> DataFrame:
    """Full outer join of each segment with its grid ``[min, max]`` at ``minutes``.

    Off-grid rows survive; grid points without a row get nulls; ``strip`` (a calendar-filter callable)
    is applied again afterwards, as the reference does.
    """
    seg = _seg(segment)
    g = grid(df, seg, ts, minutes, floor_first=False)
    out = df.join(g, on=[*seg, ts], how="full")
    return strip(out) if strip else out


def lag_by_time(df: DataFrame, segment, ts: str, value: str, i: int, minutes: int, name: str | None = None) -> DataFrame:
    """Value at ``ts − i·minutes`` by an equi self-join (left join, null when absent)."""
    seg = _seg(segment)
    name = name or f"{value}_lag_{i}"
    shifted = df.select(*seg, F.timestamp_add("MINUTE", F.lit(i * minutes), F.col(ts)).alias(ts),
                        F.col(value).alias(name))
    return df.join(shifted, on=[*seg, ts], how="left")


def combine_first(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Union of keys; a's value wins where not null, b fills the gaps."""
    keys = list(keys)
    x = a.select(*keys, *[F.col(v).alias(f"_a_{v}") for v in values])
    y = b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values])
    return x.join(y, on=keys, how="full").select(*keys, *[F.coalesce(f"_a_{v}", f"_b_{v}").alias(v) for v in values])


def left_update(df: DataFrame, upd: DataFrame, on: Sequence[str], column: str, upd_column: str | None = None) -> DataFrame:
    """Left join on ``on``; where the update side has a value it replaces ``column``.

    The update side is reduced to one row per key first (mean of its values) so the join never
    multiplies rows.
    """
    on = list(on)
    upd_column = upd_column or column
    u = upd.groupBy(*on).agg(F.avg(upd_column).alias("_upd"))
    return (df.join(u, on=on, how="left")
              .withColumn(column, F.coalesce(F.col("_upd"), F.col(column)))
              .drop("_upd"))


# ---------------------------------------------------------------------------------------------------
# Rolling mean and fills
# ---------------------------------------------------------------------------------------------------

def _positions(df: DataFrame, segment, order: str, ties: Sequence[str] = (), block_rows: int = 1 << 17, with_count: str | None = None) -> DataFrame:
    """``_pos``: place of each row in its segment, by blocks that follow the row counts."""
    seg = _seg(segment)
    return bucketed_position(count_blocks(df, seg, order, block_rows), F.col("_blk"), [order, *ties], seg or None, name="_pos", with_count=with_count).drop("_blk")


def _overlapping(df: DataFrame, before: int, after: int, block_rows: int) -> DataFrame:
    """Rows with a ``_pos`` dealt to blocks of ``block_rows`` (``_own``); each row also goes to every block
    ``_blk`` where a window of ``before`` rows before and ``after`` rows after can reach it."""
    own = F.floor(F.col("_pos") / F.lit(block_rows)).cast("long")
    first = F.greatest(F.floor((F.col("_pos") - after) / F.lit(block_rows)).cast("long"), F.lit(0))
    last = F.floor((F.col("_pos") + before) / F.lit(block_rows)).cast("long")
    return df.withColumn("_own", own).withColumn("_blk", F.explode(F.sequence(first, last)))


def rolling_mean(df: DataFrame, segment, order: str, value: str, n: int = 5, name: str | None = None,
                 drop_null: bool = True, block_rows: int = 1 << 17) -> DataFrame:
    """Mean of the last ``n`` rows of the segment; null until ``n`` values exist.  A segment is cut into
    blocks of ``block_rows`` rows; each block gets the ``n − 1`` rows before it."""
    name = name or value
    x = _overlapping(_positions(df, segment, order, block_rows=block_rows), n - 1, 0, block_rows)
    w = Window.partitionBy(*_seg(segment), "_blk").orderBy("_pos").rowsBetween(-(n - 1), 0)
    out = x.withColumn(name, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))
    out = out.where(F.col("_own") == F.col("_blk")).drop("_own", "_blk", "_pos")
    return out.where(F.col(name).isNotNull()) if drop_null else out


def _carried(df: DataFrame, seg: list[str], order: str, cols: list[str], forward: bool, fine_seconds: int) -> DataFrame:
    """Fills by short spans of time: inside a span by a window; what a span cannot fill comes from the nearest span
    with a value (one row per span).  The rows are shuffled once, by (segment, span), for the join and the window."""
    fine = F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(fine_seconds * 1_000_000)).cast("long")
    x = df.withColumn("_k", F.struct(*[F.col(c) for c in seg], fine.alias("_fine")))        # nulls are equal inside a struct
    pick = F.max_by if forward else F.min_by
    ends = x.groupBy("_k").agg(*[pick(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_e_{c}") for c in cols])
    at = F.col("_k")["_fine"]
    far = Window.partitionBy(*[F.col("_k")[c] for c in seg]).orderBy(at if forward else at.desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_k", *[F.last(f"_e_{c}", ignorenulls=True).over(far).alias(f"_c_{c}") for c in cols])
    near = Window.partitionBy("_k").orderBy(order if forward else F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    x = x.join(ends, "_k").withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(near) for c in cols})
    return x.select(*[F.coalesce(f"_f_{c}", f"_c_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_null(df: DataFrame, segment, order: str, columns, strategy: str, fine_seconds: int = 60) -> DataFrame:
    """Forward / backward fill inside the segment, or the segment's min / max / mean.

    Also ``zero`` and ``one`` (constant fills offered by the same option).  A long segment is filled in spans of
    ``fine_seconds``; null segments are one segment.
    """
    seg = _seg(segment)
    cols = _list(columns)
    if strategy in ("forward", "backward"):
        return _carried(df, seg, order, cols, strategy == "forward", fine_seconds)
    if strategy in ("min", "max", "mean"):
        fn = {"min": F.min, "max": F.max, "mean": F.avg}[strategy]
        stats = df.groupBy(*seg).agg(*[fn(c).alias(f"_s_{c}") for c in cols])
        joined = df.join(stats, on=seg, how="left") if seg else df.crossJoin(F.broadcast(stats))
        return joined.select(*[F.coalesce(c, f"_s_{c}").alias(c) if c in cols else F.col(c)
                               for c in df.columns])
    if strategy in ("zero", "one"):
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(0 if strategy == "zero" else 1)) for c in cols})
    raise ValueError(f"unknown fill strategy {strategy!r}")


# ---------------------------------------------------------------------------------------------------
# Lag features and sliding samples
# ---------------------------------------------------------------------------------------------------

def lag_features(df: DataFrame, segment, ts: str, value: str, lag: int, minutes: int,
                 block_steps: int = 1 << 14, target: str = "y", prefix: str = "lag_") -> DataFrame:
    """One row per complete sample of a bucketed series (one row per segment and bucket).

    Output columns ``lag_<lag> … lag_1`` (oldest first) and ``target`` = the value at ``ts``.  A sample
    exists only if all ``lag`` previous buckets and the current one hold a non-null value.  Missing
    buckets are simply absent rows, so no dense grid is materialised.

    The series is cut into blocks of ``block_steps`` buckets; a bucket is copied into every later block whose
    rows reach back to it (one for ``lag`` up to ``block_steps``, more beyond), so each window task holds
    one block of one segment and its ``lag`` buckets before.
    """
    seg = _seg(segment)
    step = int(minutes) * _MIN_US
    blk = step * int(block_steps)
    base = (df.where(F.col(value).isNotNull() & ~F.isnan(value))
              .select(*seg, ts, F.col(value).alias("_v"), epoch_micros(ts).alias("_e")))
    base = base.withColumn("_own", F.floor(F.col("_e") / F.lit(blk)))
    reach = F.floor((F.col("_e") + F.lit(lag * step)) / F.lit(blk))
    base = base.withColumn("_blk", F.explode(F.sequence("_own", reach)))
    w = Window.partitionBy(*seg, "_blk").orderBy("_e")
    lags = {f"{prefix}{i}": F.lag("_v", i).over(w) for i in range(lag, 0, -1)}
    complete = F.lag("_e", lag).over(w) == F.col("_e") - F.lit(lag * step)
    out = (base.withColumns(lags).withColumn("_ok", complete)
               .where((F.col("_blk") == F.col("_own")) & F.col("_ok")))
    return out.select(*seg, ts, *lags.keys(), F.col("_v").alias(target))


def sliding_samples(df: DataFrame, segment, order: str, features: Sequence[str], target: str,
                    lag: int, ahead: int = 1, offset: int = 1, block_rows: int = 1 << 17) -> DataFrame:
    """Rows ``[i, i+lag)`` as features, target rows ``[i+lag+offset−ahead, i+lag+offset)`` as label.
    A segment is cut into blocks of ``block_rows`` rows; each block gets the rows after it that its samples reach.

    ``offset = max(offset, ahead)``; a sample is kept only if none of its cells is null.  Output: the
    segment, the order value of the first feature row (``start``), ``x`` = array of feature structs
    (oldest first) and ``y`` = array of labels.
    """
    seg = _seg(segment)
    offset = max(offset, ahead)
    feats = list(features)
    w = Window.partitionBy(*seg, "_blk").orderBy("_pos")
    cell = F.struct(*[F.col(c) for c in feats])
    ok_row = F.lit(True)
    for c in feats:
        ok_row = ok_row & F.col(c).isNotNull()
    base = _overlapping(_positions(df, segment, order, block_rows=block_rows), 0, lag + offset - 1, block_rows)
    base = base.withColumn("_cell", cell).withColumn("_ok", ok_row)
    xw = w.rowsBetween(0, lag - 1)
    yw = w.rowsBetween(lag + offset - ahead, lag + offset - 1)
    out = base.select(
        *seg, F.col(order).alias("start"), "_own", "_blk",
        F.collect_list("_cell").over(xw).alias("x"),
        F.count(F.lit(1)).over(xw).alias("_nx"),
        F.min(F.col("_ok").cast("int")).over(xw).alias("_okx"),
        F.collect_list(target).over(yw).alias("y"),
        F.count(F.lit(1)).over(yw).alias("_ny"),
    )
    out = out.where(F.col("_own") == F.col("_blk")).drop("_own", "_blk")
    return (out.where((F.col("_nx") == lag) & (F.col("_okx") == 1) & (F.size("y") == ahead) & (F.col("_ny") == ahead))
               .drop("_nx", "_okx", "_ny"))


# ---------------------------------------------------------------------------------------------------
# Chronological splits
# ---------------------------------------------------------------------------------------------------

def chrono_split(df: DataFrame, segment, ts: str, ratios=(0.7, 0.1, 0.2), name: str = "split",
                 drop_empty: bool = True, ties: Sequence[str] = (), block_rows: int = 1 << 17) -> DataFrame:
    """Per segment, ``a = ⌊n·r0⌋``, ``b = ⌊n·(r0+r1)⌋``: train ``[0,a)``, val ``[a,b)``, test ``[b,n)``.

    Positions come from blocks of about ``block_rows`` rows, so no task holds a whole segment; ``ties`` order
    rows of one time.  A segment with an empty part is dropped (``drop_empty``).  Ratios are combined in
    double arithmetic.
    """
    r0, r1 = float(ratios[0]), float(ratios[1])
    pos = _positions(df, segment, ts, ties, block_rows, with_count="_n")
    a = F.floor(F.col("_n") * F.lit(r0))
    b = F.floor(F.col("_n") * F.lit(r0 + r1))
    out = pos.withColumn(name, F.when(F.col("_pos") < a, "train").when(F.col("_pos") < b, "val").otherwise("test"))
    if drop_empty:
        out = out.where((a > 0) & (b > a) & (F.col("_n") > b))
    return out.drop("_pos", "_n")


def invalid_segments(df: DataFrame, segment: str, ratios=(0.7, 0.1, 0.2), known: DataFrame | None = None) -> DataFrame:
    """Segments that :func:`chrono_split` drops because a part is empty, with their rows; ``known`` lists
    segments that may have no row at all."""
    r0, r1 = float(ratios[0]), float(ratios[1])
    n = df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"))
    if known is not None:
        n = known.select(segment).distinct().join(n, segment, "left").select(segment, F.coalesce("n", F.lit(0)).alias("n"))
    a, b = F.floor(F.col("n") * F.lit(r0)), F.floor(F.col("n") * F.lit(r0 + r1))
    return n.where(~((a > 0) & (b > a) & (F.col("n") > b)))


def chrono_split_flex(df: DataFrame, segment, ts: str, ratios=(0.7, 0.1, 0.2), name: str = "split",
                      ties: Sequence[str] = (), block_rows: int = 1 << 17) -> DataFrame:
    """Older variant – val = test = 0 → all train; test = 0 → val takes the rest; else as W07
    (empty parts allowed)."""
    r0, r1, r2 = (float(r) for r in ratios)
    pos = _positions(df, segment, ts, ties, block_rows, with_count="_n")
    n = F.col("_n")
    if r1 == 0 and r2 == 0:
        a, b = n, n
    elif r2 == 0:
        a, b = F.floor(n * F.lit(r0)), n
    else:
        a, b = F.floor(n * F.lit(r0)), F.floor(n * F.lit(r0 + r1))
    out = pos.withColumn(name, F.when(F.col("_pos") < a, "train").when(F.col("_pos") < b, "val").otherwise("test"))
    return out.drop("_pos", "_n")


# ---------------------------------------------------------------------------------------------------
# W12 / W13
# ---------------------------------------------------------------------------------------------------

def batch_rows(df: DataFrame, order: Sequence, k: int, drop_last: bool = False, name: str = "batch",
               partition_by=None) -> DataFrame:
    """Batch index ``⌊position / k⌋`` in ``order``; ``drop_last`` removes the final partial batch."""
    from .order import global_position
    pos = global_position(df, order, name="_pos", partition_by=partition_by, with_count="_n")
    out = pos.withColumn(name, F.floor(F.col("_pos") / F.lit(k)).cast("long"))
    if drop_last:
        out = out.where(F.col(name) < F.floor(F.col("_n") / F.lit(k)))
    return out.drop("_pos", "_n")


def ema(df: DataFrame, segment, order: str, value: str, alpha: float, name: str = "ema",
        block_rows: int = 1 << 16) -> DataFrame:
    """Exponential moving average with warm-up ``α_t = min(1 − 1/(t+1), α)``, t = 0-based step.

    ``e_t = α_t·e_{t−1} + (1−α_t)·x_t`` (so ``e_0 = x_0``).  The recurrence is affine.  A segment is cut into blocks of
    at most ``block_rows`` rows, in which ``e_t = P_t·e_in + L_t`` has closed forms over running sums: during the warm-up the
    average is the mean so far (``P_t = s/(t+1)`` from a block's start ``s``), after it ``P_t = α^(t−s+1)`` and
    ``L_t = (1−α)·α^(t−s)·Σ x_k·α^(s−k)``; blocks are short enough for the powers to stay in range.  The maps of the
    block ends are composed as prefixes, in groups of blocks and then over the groups, which gives each block its ``e_in``.  A null
    (or NaN) is no observation: ``t`` counts the others only, and the row takes the average before it (null before
    the first observation).
    """
    seg = _seg(segment)
    alpha = float(alpha)
    seen = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    pos = bucketed_cumsum(count_blocks(df, seg, order, block_rows), F.col("_blk"), [order], seen.cast("long"), seg or None, name="_t").drop("_blk")
    pos = pos.withColumn("_t", F.col("_t") - F.when(seen, 0).otherwise(1))       # a gap stands behind the observation before it
    warm = _warm_rows(alpha)
    size = block_rows if alpha >= 1 else 1 if alpha <= 0 else max(1, min(block_rows, int(200 * math.log(10) / -math.log(alpha))))
    t, w = F.col("_t"), -(-warm // size) if warm is not None else 0
    early = F.lit(True) if warm is None else t < warm
    blk = F.when(early, F.expr(f"_t div {size}")).otherwise(F.lit(w) + F.expr(f"(_t - {warm or 0}) div {size}"))
    pos = pos.withColumn("_b", blk.cast("long"))
    start = F.when(early, F.col("_b") * size).otherwise((F.col("_b") - w) * size + (warm or 0))
    x, since, known = F.when(seen, F.col(value).cast("double")).otherwise(0.0), (t - start).cast("double"), t >= 0
    in_block = Window.partitionBy(*seg, "_b").orderBy("_t", seen.desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.when(early, x).otherwise(x * F.pow(F.lit(alpha), -since))).over(in_block)
    rows = pos.withColumn("_run", run).withColumns({
        "_p": F.when(known & early, start / (t + 1)).when(known, F.pow(F.lit(alpha), since + 1)),
        "_l": F.when(known & early, F.col("_run") / (t + 1)).when(known, (1 - alpha) * F.pow(F.lit(alpha), since) * F.col("_run"))})
    ends = rows.groupBy(*seg, "_b").agg(F.max_by(F.struct(F.col("_p").alias("p"), F.col("_l").alias("l")), "_t").alias("_m"))
    out = rows.join(_entering(ends, seg), on=[*seg, "_b"], how="inner")
    return out.select(*df.columns, (F.col("_p") * F.col("_in") + F.col("_l")).alias(name))


def _warm_rows(alpha: float) -> int | None:
    """The first step whose warm-up rate is not below ``alpha``; None if there is none."""
    if alpha >= 1:
        return None
    t = max(0, int(1 / (1 - alpha)) - 3)
    while 1 - 1 / (t + 1) < alpha:
        t += 1
    return t


def _entering(ends: DataFrame, seg: list[str], group: int = 256) -> DataFrame:
    """``(segment, _b, _in)``: the value that enters each block, 0 for the first, from the affine maps ``_m`` (p, l) of the blocks.

    Maps are composed as prefixes inside groups of ``group`` blocks, the groups' maps again so, and the maps of those
    over the segment: the longest array of a segment of 10^9 blocks has some 15 000 entries."""
    one = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("l"))

    def after(a: Column, b: Column) -> Column:
        return F.struct((a["p"] * b["p"]).alias("p"), (b["p"] * a["l"] + b["l"]).alias("l"))

    def prefixes(df: DataFrame, by: list[str], at: str) -> DataFrame:
        """Per group the composed map ``_m`` and, in ``_each``, for each ``at`` the map of what comes before it."""
        items = df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(at).alias("k"), F.col("_m").alias("m")))).alias("_i"))
        state = F.struct(one.alias("m"), F.slice(F.transform("_i", lambda i: F.struct(i["k"].alias("k"), one.alias("m"))), 1, 0).alias("each"))
        done = F.aggregate("_i", state, lambda s, i: F.struct(after(s["m"], i["m"]).alias("m"), F.concat(s["each"], F.array(F.struct(i["k"].alias("k"), s["m"].alias("m")))).alias("each")))
        return items.withColumn("_d", done).select(*by, F.col("_d.m").alias("_m"), F.col("_d.each").alias("_each"))

    if not seg:
        return _entering(ends.withColumn("_s", F.lit(0)), ["_s"], group).drop("_s")
    g0 = prefixes(ends.withColumn("_g", F.expr(f"_b div {group}")), [*seg, "_g"], "_b")
    g1 = prefixes(g0.withColumn("_h", F.expr(f"_g div {group}")), [*seg, "_h"], "_g")
    g2 = prefixes(g1, seg, "_h")
    top = g2.select(*seg, F.inline("_each").alias("_h", "_m2"))
    mid = g1.select(*seg, "_h", F.inline("_each").alias("_g", "_m1")).join(top, [*seg, "_h"])
    mid = mid.select(*seg, "_g", after(F.col("_m2"), F.col("_m1")).alias("_m1"))
    low = g0.select(*seg, "_g", F.inline("_each").alias("_b", "_m0")).join(mid, [*seg, "_g"])
    return low.select(*seg, "_b", after(F.col("_m1"), F.col("_m0"))["l"].alias("_in"))


# ---------------------------------------------------------------------------------------------------
# Time id → timestamp, conditional time encoding
# ---------------------------------------------------------------------------------------------------

def time_id_to_datetime(df: DataFrame, date: str, time_id: str, granularity_min: int, start_min: int = 0,
                        name: str | None = None) -> DataFrame:
    """``date + (time_id − 1)·granularity + start`` minutes.

    Guard: an id must stay inside the day (``id·g + start − 1440 ≤ 0``); a row that does not fails the query
    when its time is computed, without a pass of its own over the data.
    """
    from ..functions.datetime import time_id_to_ts
    t = time_id_to_ts(date, time_id, granularity_min, start_min)
    inside = F.col(time_id).isNull() | (F.col(time_id) * granularity_min + start_min - 24 * 60 <= 0)
    msg = F.concat(F.lit("time id passes midnight: "), F.col(time_id).cast("string"))
    kind = df.select(t.alias("t")).dtypes[0][1]
    return df.withColumn(name or date, F.when(inside, t).otherwise(F.raise_error(msg).cast(kind)))


def time_encoder(df: DataFrame, ts: str, pairs: Sequence[str] | None = None) -> DataFrame:
    """sin/cos of unix seconds, period one day (``day_*``) and one year (``month_*``).

    A pair is added only if more than one distinct day (month) occurs – one aggregate decides; ``pairs`` names
    the pairs (``day``, ``month``) to add whatever the data's span.
    """
    from ..functions.datetime import time_encoding
    enc = time_encoding(ts)
    every = {"day": {"day_cos": enc["day_cos"], "day_sin": enc["day_sin"]}, "month": {"month_cos": enc["year_cos"], "month_sin": enc["year_sin"]}}
    if pairs is not None:
        return df.withColumns({k: c for p in pairs for k, c in every[p].items()})
    n = df.agg(F.count_distinct(F.dayofmonth(ts)).alias("d"), F.count_distinct(F.month(ts)).alias("m")).first()
    cols = {k: c for p, many in (("day", n["d"]), ("month", n["m"])) if many > 1 for k, c in every[p].items()}
    return df.withColumns(cols) if cols else df
