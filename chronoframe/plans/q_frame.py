"""Queries: projections, predicates, joins, aggregates, sorts, set operations, scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as num
from ..functions import text as tx
from ..operators import frame as fr
from ..operators.order import quantiles
from ..operators.split import random_split_exact, stratified_split
from .catalog import r6, register, table

# ---------------------------------------------------------------------------------------------------
# fixtures derived from the driver tables (FIXTURES.md part 3)
# ---------------------------------------------------------------------------------------------------

NULLABLE_SQL = """(SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, qty, disc
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty, avg(l_discount) AS disc FROM lineitem
                         WHERE l_returnflag = 'R' GROUP BY l_orderkey) r ON o_orderkey = r.l_orderkey)"""


def nullable(spark, sf_dir):
    """orders left join an aggregate of returned lines: ``qty`` and ``disc`` are null without a match."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    r = (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
         .groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg(F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc")))
    return o.join(r, "o_orderkey", "left")


NAN_EVENTS_SQL = """(SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value
  FROM events)"""


def nan_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type",
                     F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))


# ---------------------------------------------------------------------------------------------------
# projections and predicates
# ---------------------------------------------------------------------------------------------------

@register("select_all", "SELECT * FROM region", ids="P01")
def q_select_all(spark, sf_dir):
    return table(spark, sf_dir, "region").select("*")


@register("select_cols", "SELECT c_custkey, c_name, c_acctbal FROM customer", ids="P02")
def q_select_cols(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


@register("select_except", "SELECT * EXCLUDE (c_name, c_mktsegment) FROM customer", ids="P03")
def q_select_except(spark, sf_dir):
    return fr.select_except(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


@register("used_columns", "SELECT l_shipdate, l_quantity, l_discount, l_extendedprice FROM lineitem", ids="P04")
def q_used_columns(spark, sf_dir):
    return fr.used_columns(table(spark, sf_dir, "lineitem"), "l_shipdate", [["l_quantity"], "l_discount"],
                           "l_extendedprice")


@register("derive_cols", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS disc_price,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge, l_quantity AS qty
FROM lineitem""", ids="P05 P24")
def q_derive_cols(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    d = li.withColumns({"disc_price": F.col("l_extendedprice") * (1 - F.col("l_discount"))})
    d = d.withColumn("charge", F.col("disc_price") * (1 + F.col("l_tax"))).withColumnRenamed("l_quantity", "qty")
    return d.select("l_orderkey", "l_linenumber", r6("disc_price").alias("disc_price"), r6("charge").alias("charge"), "qty")


@register("broadcast_agg", """
SELECT s_suppkey, s_nationkey, CAST(sum(s_nationkey) OVER () AS BIGINT) AS s_nationkey_total FROM supplier""", ids="P06")
def q_broadcast_agg(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return fr.with_total(s, "s_nationkey")


@register("filter_between", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20""", ids="P07")
def q_filter_between(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_not_nan", f"""
SELECT event_id, round(value, 6) AS value FROM {NAN_EVENTS_SQL} e WHERE event_id > 3 AND NOT isnan(value)""", ids="P08")
def q_filter_not_nan(spark, sf_dir):
    e = nan_events(spark, sf_dir)
    return e.where((F.col("event_id") > 3) & ~F.isnan("value")).select("event_id", r6("value").alias("value"))


@register("filter_not_contains", "SELECT p_partkey, p_type FROM part WHERE NOT contains(p_type, 'BRASS')", ids="P10")
def q_filter_not_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").where(~F.col("p_type").contains("BRASS")).select("p_partkey", "p_type")


@register("lit_col", "SELECT n_nationkey, n_name, 'case_1' AS case_name, CAST(24 AS INTEGER) AS lag FROM nation", ids="P11")
def q_lit_col(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.withColumns({"case_name": F.lit("case_1"), "lag": F.lit(24)})


@register("casts", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
       CAST(o_orderdate AS DATE) AS order_day, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_text,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_num
FROM orders""", ids="P12")
def q_casts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
                    F.col("o_totalprice").cast("long").alias("price_int"),
                    F.col("o_orderdate").cast("date").alias("order_day"),
                    F.col("o_orderdate").cast("date").cast("string").alias("day_text"),
                    F.col("o_orderpriority").try_cast("int").alias("priority_num"))


@register("drop_cols", "SELECT * EXCLUDE (o_orderstatus, o_orderpriority) FROM orders", ids="P13")
def q_drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_orderstatus", "o_orderpriority")


@register("null_split", f"""
SELECT o_orderkey, qty IS NULL AS is_null FROM {NULLABLE_SQL} n""", ids="P14")
def q_null_split(spark, sf_dir):
    n = nullable(spark, sf_dir)
    with_null = n.where(F.col("qty").isNull()).select("o_orderkey", F.lit(True).alias("is_null"))
    without = n.where(F.col("qty").isNotNull()).select("o_orderkey", F.lit(False).alias("is_null"))
    return with_null.unionByName(without)


@register("when_coalesce", f"""
SELECT o_orderkey, round(coalesce(qty, o_totalprice / 1000.0), 6) AS qty_filled,
       CASE WHEN disc IS NOT NULL THEN 'matched' ELSE 'none' END AS state FROM {NULLABLE_SQL} n""", ids="P15")
def q_when_coalesce(spark, sf_dir):
    n = nullable(spark, sf_dir)
    return n.select("o_orderkey", r6(F.coalesce(F.col("qty"), F.col("o_totalprice") / 1000.0)).alias("qty_filled"),
                    F.when(F.col("disc").isNotNull(), "matched").otherwise("none").alias("state"))


@register("column_project", "SELECT o_orderkey, o_totalprice FROM orders", ids="P16")
def q_column_project(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


@register("ratio_features", """
SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_quantity, 0) AS price_per_qty,
       l_tax / NULLIF(l_extendedprice, 0) AS tax_per_price, l_discount / NULLIF(l_quantity, 0) AS disc_per_qty
FROM lineitem""", ids="P17")
def q_ratio_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = fr.ratio_features(li, "l_extendedprice", "l_quantity", "l_tax", "l_discount",
                            names=("price_per_qty", "tax_per_price", "disc_per_qty"))
    return out.select("l_orderkey", "l_linenumber", "price_per_qty", "tax_per_price", "disc_per_qty")


# Fixed values of the map_lookup query: a three-entry dictionary like the reference's symbol → id map.
PRIORITY_IDS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}


@register("map_lookup", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS priority_id
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""", ids="P18 P23")
def q_map_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return fr.map_values(o, "o_orderpriority", PRIORITY_IDS, name="priority_id").select("o_orderkey", "priority_id")


@register("min_size_filter", "SELECT p_partkey FROM part WHERE p_size > 20 AND p_retailprice > 20", ids="P19")
def q_min_size_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where((F.col("p_size") > 20) & (F.col("p_retailprice") > 20)).select("p_partkey")


@register("wildcard_match", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%green%' ORDER BY p_partkey LIMIT 25""", ids="P20")
def q_wildcard_match(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return fr.head(p.where(fr.like_glob("p_name", "*green*")).select("p_partkey", "p_name"), 25, ["p_partkey"])


@register("any_null_rows", f"SELECT o_orderkey FROM {NULLABLE_SQL} n WHERE qty IS NULL OR disc IS NULL", ids="P22")
def q_any_null_rows(spark, sf_dir):
    return fr.rows_with_null(nullable(spark, sf_dir), ["qty", "disc"]).select("o_orderkey")


@register("drop_nulls", f"SELECT o_orderkey, round(qty, 6) AS qty FROM {NULLABLE_SQL} n WHERE qty IS NOT NULL AND disc IS NOT NULL",
          ids="P23")
def q_drop_nulls(spark, sf_dir):
    return nullable(spark, sf_dir).na.drop(subset=["qty", "disc"]).select("o_orderkey", r6("qty").alias("qty"))


_LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("numeric_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST(count({c}) AS BIGINT) AS filled, round(CAST(max({c}) AS DOUBLE), 6) AS top FROM lineitem" for c in _LI_NUMERIC), ids="P21")
def q_numeric_columns(spark, sf_dir):
    """The numeric columns (found in the schema) with their filled cells and largest values."""
    li = table(spark, sf_dir, "lineitem")
    cols = fr.numeric_columns(li)
    one = li.select(*cols).agg(*[e for c in cols for e in (F.count(c).alias(f"n_{c}"), F.max(c).cast("double").alias(f"t_{c}"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"n_{c}").alias("filled"), r6(f"t_{c}").alias("top")) for c in cols])))


# ---------------------------------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------------------------------

@register("inner_join", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""", ids="J01")
def q_inner_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")


@register("anti_split", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
          ids="J08")
def q_anti_split(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    test_ids = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return c.join(test_ids, "c_custkey", "left_anti")


# ---------------------------------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------------------------------

@register("global_agg", """
SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(sum(l_extendedprice), 4) AS sum,
       round(avg(l_extendedprice), 6) AS mean FROM lineitem""", ids="A01")
def q_global_agg(spark, sf_dir):
    g = fr.global_agg(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return g.select("min", "max", r6("sum", 4).alias("sum"), r6("mean").alias("mean"))


@register("group_count", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS count, min(o_orderkey) AS first_seen FROM orders GROUP BY 1""", ids="A02")
def q_group_count(spark, sf_dir):
    return fr.group_count_ordered(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


@register("group_all", """
SELECT l_returnflag, CAST(count(l_quantity) AS BIGINT) AS l_quantity_count, round(sum(l_quantity), 4) AS l_quantity_sum,
       CAST(count(l_discount) AS BIGINT) AS l_discount_count, round(sum(l_discount), 4) AS l_discount_sum,
       CAST(count(l_linenumber) AS BIGINT) AS l_linenumber_count, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber_sum
FROM lineitem GROUP BY 1""", ids="A03")
def q_group_all(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_linenumber")
    g = fr.group_all(li, "l_returnflag", ("count", "sum"))
    return g.select("l_returnflag", "l_quantity_count", r6("l_quantity_sum", 4).alias("l_quantity_sum"),
                    "l_discount_count", r6("l_discount_sum", 4).alias("l_discount_sum"),
                    "l_linenumber_count", "l_linenumber_sum")


@register("value_counts", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS count FROM orders GROUP BY 1", ids="A04")
def q_value_counts(spark, sf_dir):
    return fr.value_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@register("proportions", """
SELECT c_mktsegment, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM customer GROUP BY 1""", ids="A05")
def q_proportions(spark, sf_dir):
    p = fr.proportions(table(spark, sf_dir, "customer"), "c_mktsegment")
    return p.select("c_mktsegment", r6("share").alias("share"))


_HASH = "md5('42' || CAST(c_custkey AS VARCHAR))"


@register("compare_proportions", f"""
WITH p AS (SELECT c_custkey, c_mktsegment AS s, row_number() OVER (ORDER BY {_HASH}, c_custkey) - 1 AS pos, count(*) OVER () AS n,
             row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_HASH}, c_custkey) - 1 AS spos FROM customer),
c AS (SELECT s, count(*) AS ns, any_value(n) AS n, ceil(any_value(n) * 0.2::DOUBLE) AS nt FROM p GROUP BY s),
q AS (SELECT *, floor(nt * ns / n) AS base, nt * ns / n - floor(nt * ns / n) AS frac FROM c),
a AS (SELECT s, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, s) <= nt - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q),
st AS (SELECT p.s FROM p JOIN a USING (s) WHERE spos < quota), rn AS (SELECT s FROM p WHERE pos < floor(n * 0.2::DOUBLE)),
o AS (SELECT s, count(*) / (SELECT count(*) FROM p) AS overall FROM p GROUP BY s),
x AS (SELECT s, count(*) / (SELECT count(*) FROM st) AS stratified FROM st GROUP BY s),
y AS (SELECT s, count(*) / (SELECT count(*) FROM rn) AS random FROM rn GROUP BY s)
SELECT s AS c_mktsegment, round(overall, 6) AS overall, round(stratified, 6) AS stratified, round(random, 6) AS random,
  round(100 * stratified / overall - 100, 6) AS strat_error_pct, round(100 * random / overall - 100, 6) AS rand_error_pct
FROM o LEFT JOIN x USING (s) LEFT JOIN y USING (s)""", ids="A05 R01 R04")
def q_compare_proportions(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    strat = stratified_split(c, "c_custkey", "c_mktsegment", 0.2, 42).where(F.col("split") == "test")
    rand = random_split_exact(c, "c_custkey", 0.2, 42).where(F.col("split") == "test")
    t = fr.compare_proportions(c, strat, rand, "c_mktsegment")
    return t.select("c_mktsegment", *[r6(x).alias(x) for x in t.columns[1:]])


@register("describe", """
SELECT 'l_quantity' AS column, CAST(count(l_quantity) AS BIGINT) AS count, round(avg(l_quantity), 6) AS mean,
  round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min, round(quantile_cont(l_quantity, 0.25), 6) AS p25,
  round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.75), 6) AS p75, max(l_quantity) AS max
FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev_samp(l_extendedprice), 6),
  min(l_extendedprice), round(quantile_cont(l_extendedprice, 0.25), 6), round(quantile_cont(l_extendedprice, 0.5), 6),
  round(quantile_cont(l_extendedprice, 0.75), 6), max(l_extendedprice) FROM lineitem""", ids="A06")
def q_describe(spark, sf_dir):
    d = fr.describe_exact(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std")], "min",
                    *[r6(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("profile", f"""
SELECT * FROM (VALUES
  ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_totalprice', 'double'), ('o_orderpriority', 'string'),
  ('qty', 'double'), ('disc', 'double')) t(col_name, dtype)
JOIN (
  SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderpriority', 'qty', 'disc']) AS col_name,
         unnest([count(o_orderkey), count(o_custkey), count(o_totalprice), count(o_orderpriority), count(qty), count(disc)]) AS non_null,
         unnest([count(*) - count(o_orderkey), count(*) - count(o_custkey), count(*) - count(o_totalprice),
                 count(*) - count(o_orderpriority), count(*) - count(qty), count(*) - count(disc)]) AS nulls
  FROM {NULLABLE_SQL} n) c USING (col_name)
""", ids="A07")
def q_profile(spark, sf_dir):
    p = fr.profile(nullable(spark, sf_dir))
    return p.select(F.col("column").alias("col_name"), "dtype", F.col("non_null").cast("long").alias("non_null"),
                    F.col("nulls").cast("long").alias("nulls"))


@register("median", """
SELECT round(median(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6) AS l_extendedprice,
       round(median(l_discount), 6) AS l_discount FROM lineitem""", ids="A08")
def q_median(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    q = quantiles(table(spark, sf_dir, "lineitem"), cols, [0.5])
    return q.agg(*[r6(F.max(F.when(F.col("column") == c, F.col("value")))).alias(c) for c in cols])


@register("distinct_values", """
SELECT DISTINCT event_type FROM events""", ids="A10")
def q_distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type").distinct()


@register("distinct_count", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_distinct FROM events", ids="A10")
def q_distinct_count(spark, sf_dir):
    return fr.distinct_count(table(spark, sf_dir, "events"), "user_id")


@register("histogram", """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CASE WHEN l_extendedprice = hi THEN 20 ELSE CAST(floor(20 * (l_extendedprice - lo) / (hi - lo)) AS BIGINT) + 1 END AS bin,
             lo, hi FROM lineitem, s)
SELECT bin, round(min(lo) + (bin - 1) * (min(hi) - min(lo)) / 20, 6) AS lower, round(min(lo) + bin * (min(hi) - min(lo)) / 20, 6) AS upper,
       CAST(count(*) AS BIGINT) AS count FROM b GROUP BY bin""", ids="A14")
def q_histogram(spark, sf_dir):
    h = fr.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", r6("lower").alias("lower"), r6("upper").alias("upper"), "count")


@register("grid_summary", """
WITH s AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_discount) AS y0, max(l_discount) AS y1 FROM lineitem),
b AS (SELECT CASE WHEN l_quantity = x1 THEN 5 ELSE CAST(floor(5 * (l_quantity - x0) / (x1 - x0)) AS BIGINT) + 1 END AS bx,
             CASE WHEN l_discount = y1 THEN 4 ELSE CAST(floor(4 * (l_discount - y0) / (y1 - y0)) AS BIGINT) + 1 END AS bin_y,
             l_extendedprice FROM lineitem, s)
SELECT bx AS bin_x, bin_y, CAST(count(*) AS BIGINT) AS count, round(avg(l_extendedprice), 6) AS mean_l_extendedprice FROM b GROUP BY 1, 2""",
          ids="A15")
def q_grid_summary(spark, sf_dir):
    g = fr.grid_summary(table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount", "l_extendedprice", 5, 4)
    return g.select(F.col("bx").alias("bin_x"), F.col("by").alias("bin_y"), "count", r6("mean_l_extendedprice").alias("mean_l_extendedprice"))


@register("score_summary", """
SELECT round(avg(o_totalprice), 6) AS mean, round(stddev_pop(o_totalprice), 6) AS std_pop,
       round(stddev_samp(o_totalprice), 6) AS std_samp, CAST(count(o_totalprice) AS BIGINT) AS n FROM orders""", ids="A17")
def q_score_summary(spark, sf_dir):
    s = fr.score_summary(table(spark, sf_dir, "orders"), "o_totalprice")
    return s.select(*[r6(c).alias(c) for c in ("mean", "std_pop", "std_samp")], "n")


@register("batch_mean_loss", """
WITH b AS (SELECT l_orderkey // 100 AS batch, avg(l_discount) AS m FROM lineitem GROUP BY 1)
SELECT round(avg(m), 6) AS mean_of_batch_means, CAST(count(*) AS BIGINT) AS batches,
       round((SELECT avg(l_discount) FROM lineitem), 6) AS row_mean FROM b""", ids="A19")
def q_batch_mean_loss(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("batch", F.floor(F.col("l_orderkey") / 100))
    m = fr.mean_of_batch_means(li, "batch", "l_discount")
    rm = li.agg(r6(F.avg("l_discount")).alias("row_mean"))
    return m.select(r6("mean_of_batch_means").alias("mean_of_batch_means"), "batches").crossJoin(rm)


@register("narrow_types", """
SELECT 'l_linenumber' AS col_name, CASE WHEN min(l_linenumber) > -128 AND max(l_linenumber) < 127 THEN 'tinyint' WHEN min(l_linenumber) > -32768 AND max(l_linenumber) < 32767 THEN 'smallint' WHEN min(l_linenumber) > -2147483648 AND max(l_linenumber) < 2147483647 THEN 'int' ELSE 'bigint' END AS dtype FROM lineitem
UNION ALL SELECT 'l_orderkey' AS col_name, CASE WHEN min(l_orderkey) > -128 AND max(l_orderkey) < 127 THEN 'tinyint' WHEN min(l_orderkey) > -32768 AND max(l_orderkey) < 32767 THEN 'smallint' WHEN min(l_orderkey) > -2147483648 AND max(l_orderkey) < 2147483647 THEN 'int' ELSE 'bigint' END AS dtype FROM lineitem
UNION ALL SELECT 'l_quantity', CASE WHEN min(l_quantity) > -3.4028234663852886e38 AND max(l_quantity) < 3.4028234663852886e38
  THEN 'float' ELSE 'double' END FROM lineitem""", ids="X23")
def q_narrow_types(spark, sf_dir):
    """The type of each column after ``narrow_types``."""
    li = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_orderkey", "l_quantity")
    return _types_after(li, fr.narrow_types(li))


def _types_after(before, after):
    """``(col_name, dtype)`` of the narrowed table; the values must still be equal."""
    same = [F.max(F.abs(F.col(c).cast("double") - F.col(f"_{c}").cast("double"))).alias(c) for c in before.columns]
    both = before.select("*", *[F.col(c).cast(t).alias(f"_{c}") for c, t in after.dtypes])
    one = both.agg(*same)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col_name"), F.when(F.col(c) <= 1e-3, t).alias("dtype")) for c, t in after.dtypes])))


@register("narrow_cast", """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS l_extendedprice FROM lineitem""", ids="X23 P12")
def q_narrow_cast(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return fr.narrow_types(li, ["l_extendedprice"])


# ---------------------------------------------------------------------------------------------------
# sorts, limits, slices, set operations
# ---------------------------------------------------------------------------------------------------

@register("sort_multi", """
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem ORDER BY l_suppkey, l_shipdate, l_orderkey, l_linenumber""",
          ids="O01")
def q_sort_multi(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return li.orderBy("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")


@register("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey", ids="O02")
def q_sort_desc(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice") \
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@register("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10", ids="O03")
def q_head_n(spark, sf_dir):
    return fr.head(table(spark, sf_dir, "orders"), 10, ["o_orderkey"])


@register("tail_n", "SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 10) ORDER BY o_orderkey", ids="O04")
def q_tail_n(spark, sf_dir):
    return fr.tail(table(spark, sf_dir, "orders"), 10, ["o_orderkey"])


@register("top_k", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15", ids="O05")
def q_top_k(spark, sf_dir):
    return fr.top_k(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 15, "p_partkey")


@register("slice_rows", """
SELECT o_orderkey, o_orderdate, pos FROM (SELECT o_orderkey, o_orderdate,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders) WHERE pos >= 100 AND pos < 350""", ids="O07")
def q_slice_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return fr.slice_rows(o, ["o_orderdate", "o_orderkey"], 100, 350)


@register("union_all", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""", ids="U01")
def q_union_all(spark, sf_dir):
    def norm(df, key, p):
        return df.select(F.col(key).alias("key"), F.col(f"{p}_name").alias("name"),
                         F.col(f"{p}_nationkey").alias("nationkey"), F.col(f"{p}_acctbal").alias("acctbal"))
    return fr.concat([norm(table(spark, sf_dir, "customer"), "c_custkey", "c"),
                      norm(table(spark, sf_dir, "supplier"), "s_suppkey", "s")])


@register("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem", ids="U02")
def q_distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@register("distinct_subset", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT o_custkey, o_orderkey, o_orderdate,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""", ids="U03")
def q_distinct_subset(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return fr.unique_by(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------------------------------------------
# scalar expressions
# ---------------------------------------------------------------------------------------------------

@register("replace_first", "SELECT p_partkey, regexp_replace(p_name, '[ea]', 'E') AS name_first FROM part", ids="X01")
def q_replace_first(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", tx.replace_first("p_name", "e|a", "E").alias("name_first"))


_DUR_SQL = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 's'
       WHEN l_linenumber % 3 = 1 THEN CAST(l_linenumber AS VARCHAR) || 'm' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 's'
       ELSE '1h' || CAST(l_linenumber AS VARCHAR) || 'm' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 's' END AS time_text
  FROM lineitem)"""


def durations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    n = F.col("l_linenumber").cast("string")
    txt = (F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit("s")))
            .when(F.col("l_linenumber") % 3 == 1, F.concat(n, F.lit("m"), q, F.lit("s")))
            .otherwise(F.concat(F.lit("1h"), n, F.lit("m"), q, F.lit("s"))))
    return li.select("l_orderkey", "l_linenumber", txt.alias("time_text"))


@register("parse_duration", f"""
SELECT l_orderkey, l_linenumber, CAST(coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)h', 1) AS DOUBLE), 0) * 3600
  + coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)m', 1) AS DOUBLE), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)s', 1) AS DOUBLE), 0) AS DOUBLE) AS seconds FROM {_DUR_SQL} d""", ids="X09")
def q_parse_duration(spark, sf_dir):
    d = durations(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber", tx.parse_duration("time_text").alias("seconds"))


@register("est_time", f"""
WITH d AS (SELECT l_linenumber, coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)h', 1) AS DOUBLE), 0) * 3600
  + coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)m', 1) AS DOUBLE), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(time_text, '(\\d+)s', 1) AS DOUBLE), 0) AS seconds, l_orderkey FROM {_DUR_SQL} x)
SELECT l_linenumber, round(avg(seconds / NULLIF(l_orderkey, 0)), 6) AS sec_per_sample FROM d GROUP BY 1""", ids="A18 X09")
def q_est_time(spark, sf_dir):
    d = durations(spark, sf_dir).withColumn("seconds", tx.parse_duration("time_text"))
    return d.groupBy("l_linenumber").agg(r6(F.avg(F.try_divide(F.col("seconds"), F.col("l_orderkey")))).alias("sec_per_sample"))


@register("format_duration", """
WITH s AS (SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN t = 0 THEN '0s' ELSE
  (CASE WHEN t // 3600 > 0 THEN CAST(t // 3600 AS VARCHAR) || 'h' ELSE '' END) ||
  (CASE WHEN (t % 3600) // 60 > 0 THEN CAST((t % 3600) // 60 AS VARCHAR) || 'm' ELSE '' END) ||
  (CASE WHEN t % 60 > 0 THEN CAST(t % 60 AS VARCHAR) || 's' ELSE '' END) END AS duration FROM s""", ids="X10")
def q_format_duration(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", tx.format_duration("l_extendedprice").alias("duration"))


@register("strip_markup", """
SELECT p_partkey, p_name || ' ' || p_brand || ' [1] ' || CAST(p_size AS VARCHAR) AS cell FROM part""", ids="X11")
def q_strip_markup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    marked = F.concat(F.lit("[bold]"), "p_name", F.lit("[/] [#ff0000]"), "p_brand", F.lit("[/#ff0000] [1] [link=http://x]"), F.col("p_size").cast("string"), F.lit("[/link]"))
    cells = p.select("p_partkey", tx.strip_markup(marked).alias("[b]cell[/b]"))
    return tx.strip_markup_names(cells)


@register("weight_from_name", """
WITH f AS (SELECT p_partkey, 'model_' || p_brand || CASE WHEN p_size % 2 = 0 THEN '_w' || CAST(p_size AS VARCHAR) || '_' ELSE '' END
             || CASE WHEN p_size % 3 = 0 THEN '_W' || CAST(p_size * 2 AS VARCHAR) || '_' ELSE '' END || '.csv' AS file FROM part)
SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(file, '.*_[wW](\\d+)_', 1) AS DOUBLE), 1.0) AS weight FROM f""", ids="X12")
def q_weight_from_name(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = F.col("p_size")
    name = F.concat(F.lit("model_"), "p_brand",
                    F.when(s % 2 == 0, F.concat(F.lit("_w"), s.cast("string"), F.lit("_"))).otherwise(F.lit("")),
                    F.when(s % 3 == 0, F.concat(F.lit("_W"), (s * 2).cast("string"), F.lit("_"))).otherwise(F.lit("")),
                    F.lit(".csv"))
    return p.select("p_partkey", tx.weight_from_name(name).alias("weight"))


@register("cut_bins", """
SELECT c_custkey, CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 1 WHEN c_acctbal > 0 AND c_acctbal <= 3000 THEN 2
  WHEN c_acctbal > 3000 AND c_acctbal <= 6000 THEN 3 WHEN c_acctbal > 6000 AND c_acctbal <= 9000 THEN 4 END AS bal_cat FROM customer""",
          ids="X13")
def q_cut_bins(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", num.cut("c_acctbal", [-1000, 0, 3000, 6000, 9000]).alias("bal_cat"))


@register("ceil_cap", "SELECT c_custkey, least(CAST(ceil(c_acctbal / 1500.0) AS DOUBLE), 5.0) AS bal_cap FROM customer", ids="X14")
def q_ceil_cap(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", num.ceil_cap("c_acctbal", 1500.0, 5.0).alias("bal_cap"))


@register("round_or_raw", """
SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice / 7.0, 2) AS VARCHAR) AS r2 FROM lineitem""", ids="X15")
def q_round_or_raw(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", num.round_or_raw(F.col("l_extendedprice") / 7.0, 2).alias("r2"))


@register("sigmoid_label", """
SELECT event_id, round(1 / (1 + exp(-(value - 50) / 10.0)), 6) AS prob,
       CAST(1 / (1 + exp(-(value - 50) / 10.0)) >= 0.5 AS INTEGER) AS label FROM events""", ids="X17")
def q_sigmoid_label(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = num.sigmoid((F.col("value") - 50) / 10.0)
    return ev.select("event_id", r6(p).alias("prob"), (p >= 0.5).cast("int").alias("label"))


# crc32 (polynomial 0xEDB88320) of the 8 id bytes, lowest first: one step for each bit
_CRC_SQL = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(0, 64), lambda i: (c_custkey >> CAST(i AS INTEGER)) & 1),
  lambda c, b: CASE WHEN xor(c & 1, b) = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END), CAST(4294967295 AS BIGINT))"""


@register("hash_split_crc", f"SELECT c_custkey, {_CRC_SQL} < 0.2 * 4294967296.0 AS in_test FROM customer", ids="X24 R03")
def q_hash_split_crc(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", num.in_test_crc("c_custkey", 0.2).alias("in_test"))


_LE_HEX = "(" + " || ".join(f"substr(lpad(hex(c_custkey), 16, '0'), {15 - 2 * i}, 2)" for i in range(8)) + ")"


@register("hash_split_md5", f"""
SELECT c_custkey, CAST(('0x' || right(md5(unhex({_LE_HEX})), 2))::INTEGER < 256 * 0.2 AS BOOLEAN) AS in_test FROM customer""",
          ids="X25 R03")
def q_hash_split_md5(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", num.in_test_md5("c_custkey", 0.2).alias("in_test"))


@register("composite_id", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_orderkey * 1000 + l_quantity) AS BIGINT) AS cid FROM lineitem""", ids="X26")
def q_composite_id(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", num.composite_id("l_orderkey", "l_quantity").alias("cid"))
