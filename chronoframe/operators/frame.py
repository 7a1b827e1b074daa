"""Frame operators: projections, predicates, sorts, set operations, profiles and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .order import global_position, quantiles, cells_long

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------------------------------------------
# projections and predicates
# ---------------------------------------------------------------------------------------------------

def select_except(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every column but ``cols``."""
    return df.drop(*cols)


def used_columns(df: DataFrame, date: str | None, features, target, exclude_date: bool = False) -> DataFrame:
    """Keep date → features → target in that order; list-valued entries are flattened."""
    def flat(item):
        if isinstance(item, (list, tuple)):
            for x in item:
                yield from flat(x)
        elif item:
            yield item

    parts = [] if exclude_date or not date else [date]
    parts.extend(flat([features, target]))
    return df.select(*dict.fromkeys(parts))


def with_total(df: DataFrame, col: str, name: str | None = None, fn=F.sum) -> DataFrame:
    """A global aggregate attached to every row (one-row broadcast, not an unpartitioned window)."""
    agg = df.agg(fn(col).alias(name or f"{col}_total"))
    return df.crossJoin(F.broadcast(agg))


_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute}


def calendar_filter(df: DataFrame, ts: str, bounds: dict) -> DataFrame:
    """``start ≤ part < end`` for each of year, month, day, hour, minute; unset or 0 skipped.

    ``bounds`` maps a part to ``(start, end)``.  A bounded year is also written as a plain range on
    ``ts`` so that the Parquet reader can skip row groups.
    """
    conds: list[Column] = []
    for part, (lo, hi) in bounds.items():
        fn = _PARTS[part]
        if lo:
            conds.append(fn(ts) >= lo)
        if hi:
            conds.append(fn(ts) < hi)
    yl, yh = bounds.get("year", (None, None))
    if yl:
        conds.append(F.col(ts) >= F.lit(f"{int(yl):04d}-01-01 00:00:00").cast("timestamp_ntz"))
    if yh:
        conds.append(F.col(ts) < F.lit(f"{int(yh):04d}-01-01 00:00:00").cast("timestamp_ntz"))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def map_values(df: DataFrame, col: str, mapping: dict, name: str | None = None, drop_unknown: bool = True) -> DataFrame:
    """Look up each value in a literal dictionary; unknown → null (and dropped)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    name = name or col
    out = df.withColumn(name, m[F.col(col)])
    return out.where(F.col(name).isNotNull()) if drop_unknown else out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns (schema inspection, no data read)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with a null in any (of the given) columns."""
    return df.where(any_null(list(cols or df.columns)))


def like_glob(col, pattern: str) -> Column:
    """P20: shell wildcard (``*``, ``?``) as a SQL ``LIKE`` (``%``, ``_``), other characters literal."""
    esc = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    c = F.col(col) if isinstance(col, str) else col
    return c.like(esc.replace("*", "%").replace("?", "_"))


def ratio_features(df: DataFrame, a: str, b: str, c: str, d: str, add_third: bool = True,
                   names=("a_per_b", "c_per_a", "d_per_b")) -> DataFrame:
    """``a/b``, ``c/a`` and optionally ``d/b``; division by zero gives null (``try_divide``)."""
    exprs = {names[0]: F.try_divide(F.col(a), F.col(b)), names[1]: F.try_divide(F.col(c), F.col(a))}
    if add_third:
        exprs[names[2]] = F.try_divide(F.col(d), F.col(b))
    return df.withColumns(exprs)


# ---------------------------------------------------------------------------------------------------
# sorts, limits, slices, set operations
# ---------------------------------------------------------------------------------------------------

def head(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First ``n`` rows in ``order`` (TakeOrderedAndProject: a per-task top-n, then a merge)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last ``n`` rows in ``order``, returned in ascending order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def top_k(df: DataFrame, score: str, k: int, tie: str | None = None) -> DataFrame:
    """The ``k`` rows with the highest score (ties by ``tie`` ascending)."""
    keys = [F.col(score).desc()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*keys).limit(k)


def slice_rows(df: DataFrame, order: Sequence, start: int, stop: int, name: str = "pos") -> DataFrame:
    """Rows at positions ``[start, stop)`` of a total order, by the distributed position."""
    return global_position(df, order, name=name).where((F.col(name) >= start) & (F.col(name) < stop))


def concat(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Vertical concatenation by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key – the first in ``order`` (nulls first, as a sort has them; make it unique).  A least-row aggregate, so
    each task sends at most one row of a key whatever the key's size."""
    by = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)])
    rest = [c for c in df.columns if c not in set(keys)]
    if not rest:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_row"))
    return first.select(*[F.col(c) if c in set(keys) else F.col("_row")[c].alias(c) for c in df.columns])


# ---------------------------------------------------------------------------------------------------
# aggregates and profiles
# ---------------------------------------------------------------------------------------------------

def global_agg(df: DataFrame, col: str) -> DataFrame:
    """Min, max, sum and mean of a column."""
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"), F.sum(col).alias("sum"),
                  F.avg(col).alias("mean"))


def group_count_ordered(df: DataFrame, key: str, order: str) -> DataFrame:
    """Count per group, groups in order of first appearance (``min(order)``)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.min(order).alias("first_seen"))
              .orderBy("first_seen"))


def group_all(df: DataFrame, key: str, fns=("count", "sum")) -> DataFrame:
    """Every function applied to every non-key column: ``<col>_<fn>``."""
    table = {"count": F.count, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[table[f](c).alias(f"{c}_{f}") for c in others for f in fns])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, descending (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(col))


def proportions(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Share of each category in the table."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(col, (F.col("_n") / F.col("_t")).alias(name))


def compare_proportions(overall: DataFrame, strat: DataFrame, rand: DataFrame, col: str) -> DataFrame:
    """Overall / stratified / random shares side by side with percentage errors."""
    o = proportions(overall, col, "overall")
    s = proportions(strat, col, "stratified")
    r = proportions(rand, col, "random")
    j = o.join(s, col, "left").join(r, col, "left")
    return j.withColumns({
        "strat_error_pct": F.lit(100.0) * F.col("stratified") / F.col("overall") - 100.0,
        "rand_error_pct": F.lit(100.0) * F.col("random") / F.col("overall") - 100.0,
    })


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact, linear interpolation), max – long form: one aggregate by
    column, and quantiles by narrowing histograms."""
    base = cells_long(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                                      F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return base.join(q, "column").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def profile(df: DataFrame) -> DataFrame:
    """Per column its type, non-null count, null count and whether it has nulls (one scan)."""
    aggs = []
    for c in df.columns:
        aggs += [F.count(c).alias(f"n_{c}"), F.count_if(F.col(c).isNull()).alias(f"z_{c}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{t}', n_{c}, z_{c}" for c, t in df.dtypes)
    return one.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, dtype, non_null, nulls)") \
              .withColumn("has_null", F.col("nulls") > 0)


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """A10: number of distinct values (exact by default; HyperLogLog++ as an opt-in)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(fn(col).alias("n_distinct"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """``bins`` equal-width bins over ``[min, max]``; the max falls into the last bin.

    Bounds default to the column's min and max (one-row aggregate, broadcast).
    """
    if lo is None or hi is None:
        st = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    else:
        st = df.sparkSession.range(1).select(F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
    x = df.crossJoin(F.broadcast(st))
    b = F.when(F.col(col) == F.col("_hi"), F.lit(bins)).otherwise(
        F.width_bucket(F.col(col), F.col("_lo"), F.col("_hi"), F.lit(bins)))
    return (x.where(F.col(col).isNotNull()).withColumn("bin", b.cast("long"))
             .groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.min("_lo").alias("_lo"), F.min("_hi").alias("_hi"))
             .select("bin", (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("lower"),
                     (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("upper"), "count"))


def grid_summary(df: DataFrame, x: str, y: str, c: str, nx: int, ny: int) -> DataFrame:
    """2-D equal-width bins of (x, y) with row count and mean of ``c``."""
    st = df.agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))
    j = df.crossJoin(F.broadcast(st))

    def bucket(v, lo, hi, n):
        return F.when(F.col(v) == F.col(hi), F.lit(n)).otherwise(F.width_bucket(F.col(v), F.col(lo), F.col(hi), F.lit(n)))

    return (j.withColumn("bx", bucket(x, "_x0", "_x1", nx).cast("long"))
             .withColumn("by", bucket(y, "_y0", "_y1", ny).cast("long"))
             .groupBy("bx", "by").agg(F.count(F.lit(1)).alias("count"), F.avg(c).alias(f"mean_{c}")))


def score_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, population std (cross-validation report) and sample std (describe) of scores."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std_pop"),
                  F.stddev_samp(col).alias("std_samp"), F.count(col).alias("n"))


def mean_of_batch_means(df: DataFrame, batch: str, col: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean over batches of the per-batch mean (differs from the row mean for uneven batches)."""
    per = df.groupBy(*group, batch).agg(F.avg(col).alias("_m"))
    return per.groupBy(*group).agg(F.avg("_m").alias("mean_of_batch_means"), F.count(F.lit(1)).alias("batches"))


def narrow_plan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(col_name, dtype)`` – the smallest type per numeric column, from one aggregate of all minima and
    maxima.

    Integers: the smallest signed type whose *open* range holds min and max (strict inequalities).  Doubles:
    float if min and max lie strictly inside the float range.  A column without values keeps its type.
    Strings stay strings (Parquet dictionary pages already compress them).
    """
    cols = list(cols or numeric_columns(df))
    types = dict(df.dtypes)
    bounds = df.agg(*[e for c in cols for e in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))])
    fmax = 3.4028234663852886e38
    rows = []
    for c in cols:
        lo, hi, t = F.col(f"lo_{c}"), F.col(f"hi_{c}"), F.lit(types[c])
        if types[c] in ("tinyint", "smallint", "int", "bigint"):
            t = F.when(lo.isNull(), types[c])
            for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
                t = t.when((lo > -2 ** bits) & (hi < 2 ** bits - 1), name)
            t = t.otherwise("bigint")
        elif types[c] in ("double", "float"):
            t = F.when(lo.isNull(), types[c]).when((lo > -fmax) & (hi < fmax), "float").otherwise("double")
        rows.append(F.struct(F.lit(c).alias("col_name"), t.alias("dtype")))
    return bounds.select(F.inline(F.array(*rows)))


def narrow_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast every numeric column to the type of :func:`narrow_plan` (one row for each column reaches the
    driver)."""
    plan = {r["col_name"]: r["dtype"] for r in narrow_plan(df, cols).collect()} if list(cols or numeric_columns(df)) else {}
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])
