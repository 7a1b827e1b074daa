"""Feature preparation (F01, F03–F10): fit = one aggregate into a small statistics table, apply = a
join with that table.  Statistics are exact (``avg``, exact ``median``, ``stddev_pop``), unlike the
approximate medians of ``ml.feature.Imputer`` or the sample std of ``ml.feature.StandardScaler``.

Dictionaries (ordinal codes, label indices, shared encodings) are tables of distinct values numbered by
the distributed positions of :mod:`.order`; they are joined back, so their size is never assumed small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frame import ratio_features
from .order import global_position, modes, quantiles

# ---------------------------------------------------------------------------------------------------
# F01 imputation
# ---------------------------------------------------------------------------------------------------


def fit_imputer(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """one-row table of fill values: ``mean``, exact ``median`` or ``most_frequent`` (smallest value
    on ties).  Medians and modes come from the distinct values with counts, so no task holds a column."""
    if strategy == "mean":
        clean = {c: F.when(~F.isnan(c), F.col(c)) if t in ("double", "float") else F.col(c) for c, t in df.dtypes}
        return df.agg(*[F.avg(clean[c]).alias(f"_fill_{c}") for c in cols])
    if strategy == "median":
        q = quantiles(df, cols, [0.5])
        return q.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_fill_{c}") for c in cols])
    if strategy != "most_frequent":
        raise ValueError(f"unknown strategy {strategy!r}")
    out = None
    for c in cols:
        one = modes(df, c).withColumnRenamed(c, f"_fill_{c}")
        out = one if out is None else out.crossJoin(one)      # one-row tables
    return out


def apply_imputer(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls (and NaN) of ``cols`` from the fitted one-row table (a broadcast of one row)."""
    j = df.crossJoin(F.broadcast(stats))
    fill = {c: F.coalesce(F.nanvl(F.col(c), F.lit(None)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c),
                          F.col(f"_fill_{c}")).cast(dict(df.dtypes)[c]) for c in cols}
    return j.withColumns(fill).drop(*[f"_fill_{c}" for c in cols])


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean", fit_on: DataFrame | None = None) -> DataFrame:
    """fit on ``fit_on`` (e.g. the train split; default ``df``) and apply to ``df``."""
    return apply_imputer(df, fit_imputer(fit_on if fit_on is not None else df, cols, strategy), cols)


# ---------------------------------------------------------------------------------------------------
# F03, F04, F07, F08 encodings
# ---------------------------------------------------------------------------------------------------


def ordinal_dictionary(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Sorted distinct values of ``col`` with 0-based codes."""
    return global_position(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name=name)


def ordinal_encode(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """code = position of the value among the sorted distinct values (a dictionary join)."""
    name = name or f"{col}_code"
    return df.join(ordinal_dictionary(df, col, name), col, "left")


MAX_CATEGORIES = 10_000


def categories(df: DataFrame, col: str, limit: int = MAX_CATEGORIES) -> list:
    """Sorted distinct values of a column that is to become columns.  More than ``limit`` are an error: such a column belongs into a
    sparse vector (:func:`one_hot_sparse`)."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} categories: use one_hot_sparse or WideEncoder")
    return sorted(found)


def one_hot(df: DataFrame, col: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    """one 0/1 column per category in ``values``, all kept (no dropped last level); a null or unknown
    category is 0 in all of them."""
    prefix = prefix if prefix is not None else f"{col}_"
    return df.withColumns({f"{prefix}{v}": F.coalesce((F.col(col) == F.lit(v)).cast("double"), F.lit(0.0)) for v in values})


def wide_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F04 for wide columns: ``column, value, index`` – the distinct values of the columns as text, numbered in the order (place of the
    column, value) over the cluster."""
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
    found = df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()
    return global_position(found, ["at", "value"], name="index").select("column", "value", "index")


def one_hot_sparse(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], name: str = "hot") -> DataFrame:
    """F04 without a column for each value: ``name`` holds ``size``, the sorted ``indices`` of the row's categories in the dictionary
    and their ``values`` (1.0); nulls and values that are not in the dictionary have no index.  One join for each of ``cols``, which
    Spark broadcasts only where the dictionary's size allows."""
    keep = df.columns
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"))          # clashing names stay inside
    for i, c in enumerate(cols):
        d = dictionary.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("index").cast("int").alias(f"_i{i}"))
        out = out.join(d, F.col("_row")[c].cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    size = dictionary.agg(F.count(F.lit(1)).cast("int").alias("_size"))
    indices = F.array_sort(F.array_compact(F.array(*[F.col(f"_i{i}") for i in range(len(cols))])))
    cell = F.struct(F.col("_size").alias("size"), indices.alias("indices"), F.transform(indices, lambda _: F.lit(1.0)).alias("values"))
    return out.crossJoin(F.broadcast(size)).select("_row.*", cell.alias(name))      # one row


def as_ml_vector(col: str):
    """The struct of :func:`one_hot_sparse` as a sparse vector for ``pyspark.ml``, without Python."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    text = F.to_json(F.struct(F.struct(F.lit(0).cast("tinyint").alias("type"), F.col(col)["size"].alias("size"), F.col(col)["indices"].alias("indices"),
                                       F.col(col)["values"].alias("values")).alias("v")))
    return F.from_json(text, StructType([StructField("v", VectorUDT())]))["v"]


def label_index(df: DataFrame, col: str, order: Sequence[str], name: str | None = None) -> DataFrame:
    """index of each label in the order of its first appearance (``min(order)`` per label)."""
    name = name or f"{col}_index"
    first = df.groupBy(col).agg(F.min(F.struct(*order)).alias("_first"))
    d = global_position(first, ["_first", col], name=name).drop("_first")
    return df.join(d, col, "left")


def shared_dictionary(dfs: Sequence[DataFrame], cols: Sequence[str], name: str = "code") -> DataFrame:
    """one dictionary over the values of several columns in several tables, sorted, 0-based."""
    vals = None
    for df in dfs:
        for c in cols:
            v = df.select(F.col(c).cast("string").alias("value"))
            vals = v if vals is None else vals.unionAll(v)
    return global_position(vals.where(F.col("value").isNotNull()).distinct(), ["value"], name=name)


def shared_encode(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], name: str = "code") -> DataFrame:
    """replace each column by its code in the shared dictionary (one join per column)."""
    out = df
    for c in cols:
        d = dictionary.select(F.col("value").alias(f"_v_{c}"), F.col(name).alias(f"{c}_{name}"))
        out = out.join(d, out[c].cast("string") == d[f"_v_{c}"], "left").drop(f"_v_{c}")
    return out


# ---------------------------------------------------------------------------------------------------
# F05, F06 scaling
# ---------------------------------------------------------------------------------------------------


def fit_standard(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """one-row table of means and **population** standard deviations."""
    return df.agg(*[e for c in cols for e in (F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}"))])


def apply_standard(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(x − mean) / std``; a constant column (std 0) is only centred."""
    j = df.crossJoin(F.broadcast(stats))
    sd = lambda c: F.when(F.col(f"_sd_{c}") > 0, F.col(f"_sd_{c}")).otherwise(F.lit(1.0))
    return j.withColumns({c: (F.col(c) - F.col(f"_mu_{c}")) / sd(c) for c in cols}) \
            .drop(*[f"_{k}_{c}" for c in cols for k in ("mu", "sd")])


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_standard(df, fit_standard(fit_on if fit_on is not None else df, cols), cols)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """one-row table of minima and maxima."""
    return df.agg(*[e for c in cols for e in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))])


def apply_minmax(df: DataFrame, stats: DataFrame, cols: Sequence[str], inverse: bool = False) -> DataFrame:
    """``(x − min) / (max − min)`` (X16); a constant column maps to 0.  ``inverse`` undoes it."""
    j = df.crossJoin(F.broadcast(stats))
    rng = lambda c: F.when(F.col(f"_hi_{c}") > F.col(f"_lo_{c}"),
                           F.col(f"_hi_{c}") - F.col(f"_lo_{c}")).otherwise(F.lit(1.0))
    if inverse:
        new = {c: F.col(c) * rng(c) + F.col(f"_lo_{c}") for c in cols}
    else:
        new = {c: (F.col(c) - F.col(f"_lo_{c}")) / rng(c) for c in cols}
    return j.withColumns(new).drop(*[f"_{k}_{c}" for c in cols for k in ("lo", "hi")])


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_minmax(df, fit_minmax(fit_on if fit_on is not None else df, cols), cols)


# ---------------------------------------------------------------------------------------------------
# F09 column-wise preparation, F10 top features
# ---------------------------------------------------------------------------------------------------


def prepare(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], ratios: dict | None = None,
            strategy: str = "median", fit_on: DataFrame | None = None, known: dict | None = None,
            assemble: str | None = "features") -> DataFrame:
    """numeric branch (impute → ratio features → standard scale) and categorical branch (one-hot),
    concatenated; with ``assemble`` the prepared columns are also packed into one ML vector column.
    All statistics are fitted on ``fit_on`` (default ``df``)."""
    fit = fit_on if fit_on is not None else df
    x = impute(df, numeric, strategy, fit)
    fx = impute(fit, numeric, strategy, fit)
    num = list(numeric)
    if ratios:
        x = ratio_features(x, **ratios)
        fx = ratio_features(fx, **ratios)
        num += [n for n in ratios.get("names", ("a_per_b", "c_per_a", "d_per_b"))[: 3 if ratios.get("add_third", True) else 2]]
    x = apply_standard(x, fit_standard(fx, num), num)
    cat_cols: list[str] = []
    for c in categorical:
        before = set(x.columns)
        x = one_hot(x, c, (known or {}).get(c) or categories(fit, c))
        cat_cols += [k for k in x.columns if k not in before]
    if assemble:
        x = VectorAssembler(inputCols=[*num, *cat_cols], outputCol=assemble, handleInvalid="keep").transform(x)
    return x


def top_features(importances: DataFrame, k: int, name: str = "feature", score: str = "importance") -> list[str]:
    """names of the ``k`` most important features (a top-k of a small table; ``k`` names reach the
    driver to drive the projection)."""
    return [r[0] for r in importances.orderBy(F.desc(score), name).limit(k).collect()]


def select_top_features(df: DataFrame, importances: DataFrame, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """keep ``keep`` plus the ``k`` most important feature columns."""
    return df.select(*keep, *top_features(importances, k))
