"""Queries: reproducible splits and samples.

The oracle orders rows by the same ``md5(seed || id)`` text, so every split is compared row by row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as sp
from ..operators.gram import covariance, vector, weighted_moments
from .catalog import register, table

SEED = 42


def _hash_sql(id_col: str, seed=SEED) -> str:
    return f"md5('{seed}' || CAST({id_col} AS VARCHAR))"


def _pos_sql(id_col: str, partition: str = "", seed=SEED) -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({part}ORDER BY {_hash_sql(id_col, seed)}, {id_col}) - 1"


@register("random_split_exact", f"""
WITH p AS (SELECT o_orderkey, {_pos_sql('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos,
       CASE WHEN pos < floor(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM p""", ids="R01")
def q_random_split_exact(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return sp.random_split_exact(o, "o_orderkey", 0.2, SEED)


@register("holdout_split", f"""
WITH p AS (SELECT c_custkey, {_pos_sql('c_custkey')} AS pos, count(*) OVER () AS n FROM customer)
SELECT c_custkey, CAST(pos AS BIGINT) AS pos,
       CASE WHEN pos < ceil(n * 0.33::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM p""", ids="R02")
def q_holdout_split(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return sp.random_split_exact(c, "c_custkey", 0.33, SEED, round_up=True)


@register("stratified_split", f"""
WITH c AS (SELECT c_mktsegment, count(*) AS ns FROM customer GROUP BY 1),
t AS (SELECT *, sum(ns) OVER () AS n FROM c),
u AS (SELECT *, ceil(n * 0.2::DOUBLE) AS nt FROM t),
e AS (SELECT *, nt * ns / n AS ex FROM u),
q AS (SELECT *, floor(ex) AS q, ex - floor(ex) AS frac FROM e),
l AS (SELECT *, nt - sum(q) OVER () AS lft, row_number() OVER (ORDER BY frac DESC, c_mktsegment) AS rk FROM q),
a AS (SELECT c_mktsegment, q + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS quota FROM l),
p AS (SELECT c_custkey, c_mktsegment, {_pos_sql('c_custkey', 'c_mktsegment')} AS pos FROM customer)
SELECT c_custkey, c_mktsegment, CAST(pos AS BIGINT) AS pos,
       CASE WHEN pos < quota THEN 'test' ELSE 'train' END AS split FROM p JOIN a USING (c_mktsegment)""", ids="R04")
def q_stratified_split(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sp.stratified_split(c, "c_custkey", "c_mktsegment", 0.2, SEED)


@register("strata_shares", f"""
WITH c AS (SELECT c_mktsegment, count(*) AS ns FROM customer GROUP BY 1),
t AS (SELECT *, sum(ns) OVER () AS n FROM c),
u AS (SELECT *, ceil(n * 0.2::DOUBLE) AS nt FROM t),
e AS (SELECT *, nt * ns / n AS ex FROM u),
q AS (SELECT *, floor(ex) AS q, ex - floor(ex) AS frac FROM e),
l AS (SELECT *, nt - sum(q) OVER () AS lft, row_number() OVER (ORDER BY frac DESC, c_mktsegment) AS rk FROM q)
SELECT c_mktsegment, CAST(q + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS BIGINT) AS test_rows,
       CAST(ns AS BIGINT) AS all_rows FROM l""", ids="R04 A05")
def q_strata_shares(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    s = sp.stratified_split(c, "c_custkey", "c_mktsegment", 0.2, SEED)
    return s.groupBy("c_mktsegment").agg(F.count_if(F.col("split") == "test").cast("long").alias("test_rows"),
                                         F.count(F.lit(1)).alias("all_rows"))


def _kfold_sql(k: int) -> str:
    return f"""
WITH p AS (SELECT o_orderkey, {_pos_sql('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders),
f AS (SELECT o_orderkey, pos, n // {k} AS q, n % {k} AS r FROM p)
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos,
       CAST(CASE WHEN pos < r * (q + 1) THEN pos // (q + 1) ELSE r + (pos - r * (q + 1)) // q END AS INTEGER) AS fold
FROM f"""


@register("kfold", _kfold_sql(7), ids="R05")
def q_kfold(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return sp.kfold(o, "o_orderkey", 7, SEED)


@register("kfold_sizes", f"""
WITH k AS ({_kfold_sql(7)})
SELECT fold, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY fold""", ids="R05")
def q_kfold_sizes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return sp.kfold(o, "o_orderkey", 7, SEED).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("positional_split", """
SELECT o_orderkey, o_orderpriority, CAST(pos AS BIGINT) AS pos, CASE WHEN pos < 800 THEN 'train' ELSE 'val' END AS split
FROM (SELECT o_orderkey, o_orderpriority,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)""",
          ids="R06")
def q_positional_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return sp.positional_split(o, "o_orderpriority", ["o_orderdate", "o_orderkey"], 800).drop("o_orderdate")


@register("shuffle", f"""
SELECT o_orderkey, o_totalprice, CAST({_pos_sql('o_orderkey', seed=7)} AS BIGINT) AS pos FROM orders""", ids="R07")
def q_shuffle(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sp.shuffle(o, "o_orderkey", 7)


@register("sample_n", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash_sql('o_orderkey')}, o_orderkey LIMIT 100""", ids="R08")
def q_sample_n(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sp.sample_n(o, "o_orderkey", 100, SEED)


ROUNDS = 200


@register("bootstrap", f"""
WITH q AS (SELECT o_orderkey, o_totalprice, {_pos_sql('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders),
d AS (SELECT r.round, q.pos AS j, q.n FROM q, range(0, {ROUNDS}) r(round)),
k AS (SELECT round, CAST('0x' || substr(md5('{SEED}' || CAST(round AS VARCHAR) || '-' || CAST(j AS VARCHAR)), 1, 12) AS BIGINT) % n AS pos,
             count(*) AS weight FROM d GROUP BY 1, 2)
SELECT CAST(k.round AS BIGINT) AS round, CAST(sum(weight) AS BIGINT) AS draws, CAST(count(*) AS BIGINT) AS distinct_rows,
       round(sum(weight * o_totalprice) / sum(weight), 4) AS mean_price FROM k JOIN q USING (pos) GROUP BY k.round""", ids="R09")
def q_bootstrap(spark, sf_dir):
    """Bootstrap means of 200 rounds."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    b = sp.bootstrap(o, "o_orderkey", ROUNDS, SEED)
    return b.groupBy("round").agg(F.sum("weight").alias("draws"), F.count(F.lit(1)).alias("distinct_rows"),
                                  F.round(F.sum(F.col("weight") * F.col("o_totalprice")) / F.sum("weight"), 4).alias("mean_price"))


@register("bootstrap_tree", f"""
SELECT CAST(r.round AS BIGINT) AS round, n AS draws, true AS near_mean FROM (SELECT count(*) AS n FROM orders), range(0, {ROUNDS}) r(round)""", ids="R09")
def q_bootstrap_tree(spark, sf_dir):
    """Bootstrap weights of 200 rounds drawn down a tree of buckets: each round has one draw for each row, and its weighted
    mean is within six standard errors of the rows' mean."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    w = sp.bootstrap_weights(o, "o_orderkey", ROUNDS, SEED).select(vector(["o_totalprice"]).alias("v"), "weights")
    n, mean, var = covariance(o.select(vector(["o_totalprice"]).alias("v")), "v", 1)
    far = 6 * (var[0, 0] / max(n, 1)) ** 0.5
    rows = [(int(r), round(float(g[0, 0])), bool(abs(g[0, 1] / g[0, 0]) <= far)) for r, g in weighted_moments(w, "v", 1, "weights", ROUNDS, shift=mean).itertuples(index=False)]
    return spark.createDataFrame(rows, "round long, draws long, near_mean boolean")
