"""Queries: feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as pr
from ..operators.metrics import corr_matrix, corr_with_target
from .catalog import r6, register, table
from .q_frame import NULLABLE_SQL, nullable

# The five market segments of the customer table, in sorted order.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _impute_sql(fill_qty: str, fill_disc: str) -> str:
    return f"""
WITH n AS {NULLABLE_SQL}
SELECT o_orderkey, round(coalesce(qty, ({fill_qty})), 6) AS qty, round(coalesce(disc, ({fill_disc})), 6) AS disc FROM n"""


def _impute(spark, sf_dir, strategy):
    x = pr.impute(nullable(spark, sf_dir), ["qty", "disc"], strategy)
    return x.select("o_orderkey", r6("qty").alias("qty"), r6("disc").alias("disc"))


@register("impute_mean", _impute_sql(f"SELECT avg(qty) FROM {NULLABLE_SQL} a", f"SELECT avg(disc) FROM {NULLABLE_SQL} a"),
          ids="F01")
def q_impute_mean(spark, sf_dir):
    return _impute(spark, sf_dir, "mean")


@register("impute_median", _impute_sql(f"SELECT median(qty) FROM {NULLABLE_SQL} a",
                                       f"SELECT median(disc) FROM {NULLABLE_SQL} a"), ids="F01 A08")
def q_impute_median(spark, sf_dir):
    return _impute(spark, sf_dir, "median")


@register("impute_mode", _impute_sql(
    f"SELECT qty FROM {NULLABLE_SQL} a WHERE qty IS NOT NULL GROUP BY qty ORDER BY count(*) DESC, qty LIMIT 1",
    f"SELECT disc FROM {NULLABLE_SQL} a WHERE disc IS NOT NULL GROUP BY disc ORDER BY count(*) DESC, disc LIMIT 1"),
    ids="F01 A11")
def q_impute_mode(spark, sf_dir):
    return _impute(spark, sf_dir, "most_frequent")


@register("ordinal_encode", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS c_mktsegment_code
FROM customer""", ids="F03")
def q_ordinal_encode(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return pr.ordinal_encode(c, "c_mktsegment")


@register("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS seg_{s}" for s in SEGMENTS) + " FROM customer", ids="F04")
def q_one_hot(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return pr.one_hot(c, "c_mktsegment", SEGMENTS, prefix="seg_").drop("c_mktsegment")


@register("one_hot_discovered", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer",
          ids="F04")
def q_one_hot_discovered(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return pr.one_hot(c, "c_mktsegment", pr.categories(c, "c_mktsegment")).drop("c_mktsegment")


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("standard_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round((({c}) - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _SCALE_COLS) + " FROM lineitem",
          ids="F05")
def q_standard_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    s = pr.standard_scale(li, _SCALE_COLS)
    return s.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in _SCALE_COLS])


@register("minmax_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in _SCALE_COLS)
    + " FROM lineitem", ids="F06 X16")
def q_minmax_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    s = pr.minmax_scale(li, _SCALE_COLS)
    return s.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in _SCALE_COLS])


@register("minmax_inverse", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in _SCALE_COLS) + " FROM lineitem", ids="X16 F06")
def q_minmax_inverse(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    st = pr.fit_minmax(li, _SCALE_COLS)
    back = pr.apply_minmax(pr.apply_minmax(li, st, _SCALE_COLS), st, _SCALE_COLS, inverse=True)
    return back.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in _SCALE_COLS])


@register("label_index", """
WITH f AS (SELECT o_orderpriority, min((o_orderdate, o_orderkey)) AS first FROM orders GROUP BY 1),
d AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY first, o_orderpriority) - 1 AS BIGINT) AS o_orderpriority_index FROM f)
SELECT o_orderkey, o_orderpriority, o_orderpriority_index FROM orders JOIN d USING (o_orderpriority)""", ids="F07")
def q_label_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return pr.label_index(o, "o_orderpriority", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("shared_encode", """
WITH v AS (SELECT DISTINCT value FROM (SELECT o_orderstatus AS value FROM orders UNION ALL SELECT o_orderpriority FROM orders
                                       UNION ALL SELECT l_returnflag FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem)),
d AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM v)
SELECT o_orderkey, a.code AS o_orderstatus_code, b.code AS o_orderpriority_code
FROM orders JOIN d a ON a.value = o_orderstatus JOIN d b ON b.value = o_orderpriority""", ids="F08")
def q_shared_encode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("o_orderstatus"),
                                                 F.col("l_linestatus").alias("o_orderpriority"))
    d = pr.shared_dictionary([o, li], ["o_orderstatus", "o_orderpriority"])
    e = pr.shared_encode(o, d, ["o_orderstatus", "o_orderpriority"])
    return e.select("o_orderkey", "o_orderstatus_code", "o_orderpriority_code")


# housing-like table: customer with its order aggregates (FIXTURES.md part 3)
HOUSING_SQL = """(SELECT c_custkey, c_acctbal, c_mktsegment, count(o_orderkey) AS n_orders, sum(o_totalprice) AS order_sum,
  avg(o_totalprice) AS target FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_acctbal, c_mktsegment)"""


def housing(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n_orders"), F.sum("o_totalprice").alias("order_sum"),
        F.avg("o_totalprice").alias("target"))
    return c.join(o, "c_custkey", "left").select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "order_sum", "target")


@register("prepare_pipeline", f"""
WITH h AS {HOUSING_SQL},
i AS (SELECT c_custkey, c_mktsegment, c_acctbal, CAST(n_orders AS DOUBLE) AS n_orders,
             coalesce(order_sum, (SELECT median(order_sum) FROM h)) AS order_sum FROM h),
r AS (SELECT *, order_sum / NULLIF(n_orders, 0) AS sum_per_order, c_acctbal / NULLIF(order_sum, 0) AS bal_per_sum FROM i)
SELECT c_custkey,
  round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
  round((order_sum - avg(order_sum) OVER ()) / stddev_pop(order_sum) OVER (), 6) AS order_sum,
  round((sum_per_order - avg(sum_per_order) OVER ()) / stddev_pop(sum_per_order) OVER (), 6) AS sum_per_order,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c_mktsegment_BUILDING
FROM r""", ids="F09 F01 F05 F04 P17")
def q_prepare_pipeline(spark, sf_dir):
    h = housing(spark, sf_dir).withColumn("n_orders", F.col("n_orders").cast("double"))
    x = pr.prepare(h, ["c_acctbal", "n_orders", "order_sum"], ["c_mktsegment"],
                   ratios={"a": "order_sum", "b": "n_orders", "c": "c_acctbal", "d": "c_acctbal", "add_third": False,
                           "names": ("sum_per_order", "bal_per_sum", "unused")},
                   strategy="median", known={"c_mktsegment": SEGMENTS})
    return x.select("c_custkey", *[r6(c).alias(c) for c in ("c_acctbal", "order_sum", "sum_per_order")],
                    "c_mktsegment_BUILDING")


@register("top_features", """
WITH c AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature,
                  unnest([abs(corr(l_quantity, l_extendedprice)), abs(corr(l_discount, l_extendedprice)),
                          abs(corr(l_tax, l_extendedprice))]) AS importance FROM lineitem)
SELECT feature, round(importance, 6) AS importance FROM c ORDER BY importance DESC, feature LIMIT 2""", ids="F10 O05 A12")
def q_top_features(spark, sf_dir):
    """The k most important features (importance = |corr| with the target)."""
    li = table(spark, sf_dir, "lineitem")
    imp = (corr_matrix(li, ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
           .where((F.col("b") == "l_extendedprice") & (F.col("a") != "l_extendedprice"))
           .select(F.col("a").alias("feature"), F.abs("corr").alias("importance")))
    names = pr.top_features(imp, 2)
    return imp.where(F.col("feature").isin(names)).select("feature", r6("importance").alias("importance"))


@register("select_top_features", """
WITH c AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature,
                  unnest([abs(corr(l_quantity, l_extendedprice)), abs(corr(l_discount, l_extendedprice)), abs(corr(l_tax, l_extendedprice))]) AS importance FROM lineitem),
k AS (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) AS rk FROM c),
v AS (SELECT (SELECT feature FROM k WHERE rk = 1) AS f1, (SELECT feature FROM k WHERE rk = 2) AS f2)
SELECT l_orderkey, l_linenumber,
  CASE f1 WHEN 'l_quantity' THEN l_quantity WHEN 'l_discount' THEN l_discount ELSE l_tax END AS first_feature,
  CASE f2 WHEN 'l_quantity' THEN l_quantity WHEN 'l_discount' THEN l_discount ELSE l_tax END AS second_feature FROM lineitem, v""", ids="F10 A12")
def q_select_top_features(spark, sf_dir):
    """The table projected on its key and its two most important features."""
    li = table(spark, sf_dir, "lineitem")
    imp = corr_with_target(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice").select(F.col("column").alias("feature"), F.abs("corr").alias("importance"))
    x = pr.select_top_features(li, imp, 2, keep=["l_orderkey", "l_linenumber"])
    return x.toDF("l_orderkey", "l_linenumber", "first_feature", "second_feature")


@register("prepare_saved", f"""
WITH h AS {HOUSING_SQL},
i AS (SELECT c_custkey, c_mktsegment, c_acctbal, coalesce(order_sum, (SELECT median(order_sum) FROM h)) AS order_sum FROM h)
SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
  round((order_sum - avg(order_sum) OVER ()) / stddev_pop(order_sum) OVER (), 6) AS order_sum,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c_mktsegment_BUILDING FROM i""", ids="F09 K07 F01 F04 F05")
def q_prepare_saved(spark, sf_dir):
    """The preparation as an ML pipeline of fitted stages, saved, read back and applied."""
    from pyspark.ml import Pipeline, PipelineModel

    from ..operators.stages import ColumnPreparer
    from ..sources.io import scratch_path
    h = housing(spark, sf_dir)
    path = scratch_path(spark, "preparation")
    Pipeline(stages=[ColumnPreparer(numeric=["c_acctbal", "order_sum"], categorical=["c_mktsegment"], strategy="median")]).fit(h).write().overwrite().save(path)
    x = PipelineModel.load(path).transform(h)
    return x.select("c_custkey", r6("c_acctbal").alias("c_acctbal"), r6("order_sum").alias("order_sum"), "c_mktsegment_BUILDING")


@register("one_hot_wide", """
WITH d AS (SELECT k, v, row_number() OVER (ORDER BY k, v) - 1 AS i FROM (
  SELECT DISTINCT 0 AS k, CAST(l_partkey AS VARCHAR) AS v FROM lineitem UNION SELECT DISTINCT 1, CAST(l_shipdate AS VARCHAR) FROM lineitem)),
l AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS a, CAST(l_shipdate AS VARCHAR) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST((SELECT count(*) FROM d) AS INTEGER) AS size, CAST(x.i AS VARCHAR) || ',' || CAST(y.i AS VARCHAR) AS indices, 2.0::DOUBLE AS ones
FROM l JOIN d x ON x.k = 0 AND x.v = l.a JOIN d y ON y.k = 1 AND y.v = l.b""", ids="F04 F09 K07")
def q_one_hot_wide(spark, sf_dir):
    """All parts and ship dates as one sparse vector, by a saved pipeline whose dictionary is a table."""
    from pyspark.ml import Pipeline, PipelineModel

    from ..operators.stages import WideEncoder
    from ..sources.io import scratch_path
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("a"), F.col("l_shipdate").cast("string").alias("b"))
    path = scratch_path(spark, "wide")
    Pipeline(stages=[WideEncoder(columns=["a", "b"], folder=f"{path}-tables")]).fit(li).write().overwrite().save(path)
    x = PipelineModel.load(path).transform(li)
    return x.select("l_orderkey", "l_linenumber", "hot.size", F.array_join(F.transform("hot.indices", lambda i: i.cast("string")), ",").alias("indices"),
                    F.aggregate("hot.values", F.lit(0.0), lambda a, v: a + v).alias("ones"))


@register("stages_saved", f"""
WITH h AS (SELECT *, order_sum / n_orders AS per_order, c_acctbal / order_sum AS bal_share FROM {HOUSING_SQL} h),
c AS (SELECT abs(corr(per_order, c_acctbal)) AS a, abs(corr(bal_share, c_acctbal)) AS b, abs(corr(n_orders, c_acctbal)) AS n FROM h)
SELECT c_custkey, round(CASE WHEN a >= b AND a >= n THEN per_order WHEN b >= n THEN bal_share ELSE n_orders END, 6) AS kept,
       CASE WHEN a >= b AND a >= n THEN 'per_order' WHEN b >= n THEN 'bal_share' ELSE 'n_orders' END AS name FROM h, c""", ids="F10 P17 K07")
def q_stages_saved(spark, sf_dir):
    """Ratio features and the choice of the best of three features as a saved pipeline."""
    from pyspark.ml import Pipeline, PipelineModel

    from ..operators.stages import RatioFeatures, TopFeatures
    from ..sources.io import scratch_path
    h = housing(spark, sf_dir).select("c_custkey", "c_acctbal", "order_sum", F.col("n_orders").cast("double").alias("n_orders"))
    three = ["per_order", "bal_share", "n_orders"]
    stages = [RatioFeatures(ratios=[("per_order", "order_sum", "n_orders"), ("bal_share", "c_acctbal", "order_sum")]), TopFeatures(features=three, target="c_acctbal", k=1)]
    path = scratch_path(spark, "stages")
    Pipeline(stages=stages).fit(h).write().overwrite().save(path)
    x = PipelineModel.load(path).transform(h)
    name = next(c for c in x.columns if c in three)
    return x.select("c_custkey", r6(name).alias("kept"), F.lit(name).alias("name"))
