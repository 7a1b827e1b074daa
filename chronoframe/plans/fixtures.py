"""Derived test tables (FIXTURES.md part 3), each as a Spark builder and the same table as DuckDB SQL.

All are pure functions of the driver tables, so they grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.split import hash_int
from .catalog import table

# prediction files A, B, C: deterministic scores in [0, 1) with ties, from labels ⋈ documents
PRED_SQL = """(SELECT l.doc_id AS id, l.quality AS y, l.toxic AS toxic,
  ((l.doc_id * 37 + d.n_chars) % 100) / 100::DOUBLE AS score_a,
  ((l.doc_id * 11 + d.n_chars * 3) % 50) / 50::DOUBLE AS score_b,
  (d.n_chars % 20) / 20::DOUBLE AS score_c
  FROM labels l JOIN documents d USING (doc_id))"""


def predictions(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.select(F.col("doc_id").alias("id"), F.col("quality").alias("y"), "toxic",
                    (((F.col("doc_id") * 37 + F.col("n_chars")) % 100) / 100.0).alias("score_a"),
                    (((F.col("doc_id") * 11 + F.col("n_chars") * 3) % 50) / 50.0).alias("score_b"),
                    ((F.col("n_chars") % 20) / 20.0).alias("score_c"))


# the same predictions as one long table (method, id, prediction) – the form of one file per method
PRED_LONG_SQL = f"""(SELECT 'a' AS method, id, score_a AS prediction FROM {PRED_SQL} p
  UNION ALL SELECT 'b', id, score_b FROM {PRED_SQL} p
  UNION ALL SELECT 'c', id, score_c FROM {PRED_SQL} p WHERE toxic = 0)"""


def predictions_long(spark, sf_dir):
    """Method ``c`` has no rows for toxic documents (a file with missing ids)."""
    p = predictions(spark, sf_dir)
    st = F.array(F.struct(F.lit("a").alias("method"), F.col("score_a").alias("prediction")),
                 F.struct(F.lit("b").alias("method"), F.col("score_b").alias("prediction")),
                 F.struct(F.lit("c").alias("method"), F.col("score_c").alias("prediction")))
    return (p.select("id", "toxic", F.inline(st))
             .where((F.col("method") != "c") | (F.col("toxic") == 0)).drop("toxic"))


# regression predictions of three models on lineitem: truth l_extendedprice
REG_SQL = """(SELECT l_orderkey, l_linenumber, m.model, l_extendedprice AS y,
  CASE m.model WHEN 'm1' THEN l_quantity * 1000 WHEN 'm2' THEN l_quantity * 950 + 500
       ELSE l_extendedprice * (1 - l_discount) END AS p
  FROM lineitem, (VALUES ('m1'), ('m2'), ('m3')) m(model))"""


def regression_predictions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    st = F.array(F.struct(F.lit("m1").alias("model"), (F.col("l_quantity") * 1000).alias("p")),
                 F.struct(F.lit("m2").alias("model"), (F.col("l_quantity") * 950 + 500).alias("p")),
                 F.struct(F.lit("m3").alias("model"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p")))
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"), F.inline(st))


# bootstrap predictions: orders × 200 rounds, prediction = truth × (0.9 + (md5(round, key) mod 200) / 1000)
ROUNDS = 200
BOOT_SQL = f"""(SELECT r.round, o_orderkey AS id, o_totalprice AS y,
  o_totalprice * (0.9::DOUBLE + (CAST('0x' || substr(md5('b' || CAST(r.round AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) % 200) / 1000::DOUBLE) AS p
  FROM orders, range(0, {ROUNDS}) r(round))"""


def bootstrap_predictions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("y"))
    r = o.select("id", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long"))).alias("round"))
    jitter = F.pmod(hash_int("b", "round", "id"), F.lit(200)) / 1000.0
    return r.withColumn("p", F.col("y") * (F.lit(0.9) + jitter))


# boxes from lineitem: integer coordinates from keys and quantities
BOX_SQL = """(SELECT l_orderkey, l_linenumber,
  l_linenumber * 10 AS ax0, CAST(l_quantity AS INTEGER) AS ay0, l_linenumber * 10 + 40 AS ax1, CAST(l_quantity AS INTEGER) + 50 AS ay1,
  l_linenumber * 10 + CAST(round(l_discount * 100) AS INTEGER) AS bx0, CAST(l_quantity AS INTEGER) + CAST(round(l_tax * 100) AS INTEGER) AS by0,
  l_linenumber * 10 + CAST(round(l_discount * 100) AS INTEGER) + 30 AS bx1,
  CAST(l_quantity AS INTEGER) + CAST(round(l_tax * 100) AS INTEGER) + 60 AS by1 FROM lineitem)"""


def boxes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    dx = F.round(F.col("l_discount") * 100).cast("int")
    dy = F.round(F.col("l_tax") * 100).cast("int")
    ax0 = F.col("l_linenumber") * 10
    return li.select("l_orderkey", "l_linenumber", ax0.alias("ax0"), q.alias("ay0"), (ax0 + 40).alias("ax1"),
                     (q + 50).alias("ay1"), (ax0 + dx).alias("bx0"), (q + dy).alias("by0"),
                     (ax0 + dx + 30).alias("bx1"), (q + dy + 60).alias("by1"))
