"""Queries: vector tables (O06, X18, X20, X21, G01–G03, J09, F17) on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import vectors as vx
from ..operators.split import random_split_exact
from .catalog import r6, register, table

SEED = 11
LAM = 0.75          # 1 − λ = 0.25 is exact in binary and decimal


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def _partner_sql(seed=SEED) -> str:
    return f"""p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                row_number() OVER (ORDER BY md5('{seed}' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos,
                count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, (pos + 1 + CAST('0x' || substr(md5('{seed}shift'), 1, 12) AS BIGINT) % greatest(n - 1, 1)) % n AS ppos FROM p),
m AS (SELECT s.vec_id, s.label, s.x, q.vec_id AS partner_id, q.label AS partner_label, q.x AS xp
      FROM s JOIN p q ON q.pos = s.ppos)"""


@register("random_partner", f"""
WITH {_partner_sql()}
SELECT vec_id, label, partner_id AS partner_vec_id, partner_label FROM m""", ids="J09")
def q_random_partner(spark, sf_dir):
    e = _emb(spark, sf_dir).select("vec_id", "label")
    return vx.random_partner(e, "vec_id", SEED, cols=["vec_id", "label"]).drop("pos")


@register("mixup", f"""
WITH {_partner_sql()},
z AS (SELECT *, list_transform(range(1, len(x) + 1), lambda i: {LAM}::DOUBLE * x[i] + (1 - {LAM}::DOUBLE) * xp[i]) AS mx FROM m)
SELECT vec_id, partner_id, label, partner_label, {LAM}::DOUBLE AS lam, round(list_sum(mx), 6) AS mixed_sum,
       round(mx[1], 6) AS mixed_first FROM z""", ids="G01 J09")
def q_mixup(spark, sf_dir):
    m = vx.mixup(_emb(spark, sf_dir), "vec_id", "embedding", "label", LAM, SEED)
    return m.select("vec_id", "partner_id", "label", "partner_label", "lam",
                    r6(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v)).alias("mixed_sum"),
                    r6(F.element_at("embedding", 1)).alias("mixed_first"))


@register("cutmix", f"""
WITH {_partner_sql()},
c AS (SELECT *, CAST(floor(len(x) * (1 - {LAM}::DOUBLE)) AS INTEGER) AS cut FROM m),
d AS (SELECT *, CAST(CAST('0x' || substr(md5('{SEED}' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % (len(x) - cut + 1) AS INTEGER) AS st FROM c),
z AS (SELECT *, list_slice(x, 1, st) || list_slice(xp, st + 1, st + cut) || list_slice(x, st + cut + 1, len(x)) AS mx FROM d)
SELECT vec_id, partner_id, label, partner_label, st AS cut_start, cut AS cut_len, 1.0::DOUBLE - cut / len(x) AS lam,
       round(list_sum(mx), 6) AS mixed_sum, round(mx[st + 1], 6) AS first_cut_cell, CAST(len(mx) AS INTEGER) AS d FROM z""",
          ids="G02")
def q_cutmix(spark, sf_dir):
    m = vx.cutmix(_emb(spark, sf_dir), "vec_id", "embedding", "label", LAM, SEED)
    return m.select("vec_id", "partner_id", "label", "partner_label", "cut_start", "cut_len", "lam",
                    r6(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v)).alias("mixed_sum"),
                    r6(F.element_at("embedding", F.col("cut_start") + 1)).alias("first_cut_cell"),
                    F.size("embedding").alias("d"))


@register("add_noise", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
z AS (SELECT vec_id, list_transform(range(0, len(x)), lambda i: x[i + 1]
        + (CAST('0x' || substr(md5('5' || CAST(vec_id AS VARCHAR) || '-' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296::DOUBLE)
          * 0.1::DOUBLE + 0.01::DOUBLE) AS nx FROM e)
SELECT vec_id, round(list_sum(nx), 6) AS noisy_sum, round(nx[1], 6) AS noisy_first FROM z""", ids="G03")
def q_add_noise(spark, sf_dir):
    n = vx.add_noise(_emb(spark, sf_dir), "vec_id", "embedding", 0.1, 0.01, 5)
    return n.select("vec_id", r6(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v)).alias("noisy_sum"),
                    r6(F.element_at("embedding", 1)).alias("noisy_first"))


@register("array_top_k", """
SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(i - 1 AS INTEGER) AS idx FROM (
  SELECT vec_id, i, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS rank
  FROM (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings))
WHERE rank <= 3""", ids="O06")
def q_array_top_k(spark, sf_dir):
    e = _emb(spark, sf_dir)
    t = e.select("vec_id", F.posexplode(vx.array_top_k("embedding", 3)).alias("rank", "idx"))
    return t.select("vec_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("idx").cast("int").alias("idx"))


@register("poly_bounds", """
WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS poly FROM embeddings)
SELECT vec_id, list_min(list_filter(poly, lambda v, i: i % 2 = 1)) AS xmin, list_min(list_filter(poly, lambda v, i: i % 2 = 0)) AS ymin,
       list_max(list_filter(poly, lambda v, i: i % 2 = 1)) AS xmax, list_max(list_filter(poly, lambda v, i: i % 2 = 0)) AS ymax
FROM p""", ids="X20")
def q_poly_bounds(spark, sf_dir):
    e = _emb(spark, sf_dir)
    b = e.select("vec_id", vx.poly_bounds(F.col("embedding").cast("array<double>")).alias("b"))
    return b.select("vec_id", "b.xmin", "b.ymin", "b.xmax", "b.ymax")


@register("flatten_array", """
WITH f AS (SELECT vec_id, flatten([list_slice(CAST(embedding AS DOUBLE[]), 1, 2), list_slice(CAST(embedding AS DOUBLE[]), 3, len(embedding)),
                                   [CAST(label AS DOUBLE)]]) AS v FROM embeddings)
SELECT vec_id, CAST(len(v) AS INTEGER) AS n, v[1] AS first, v[len(v)] AS last, round(list_sum(v), 6) AS total FROM f""", ids="X21")
def q_flatten_array(spark, sf_dir):
    e = _emb(spark, sf_dir)
    x = F.col("embedding").cast("array<double>")
    nested = F.array(F.slice(x, 1, 2), F.slice(x, F.lit(3), F.size(x)))
    f = e.select("vec_id", vx.flatten_values(e, [nested, F.col("label")]).alias("v"))     # a nested array and a scalar
    return f.select("vec_id", F.size("v").alias("n"), F.element_at("v", 1).alias("first"), F.element_at("v", -1).alias("last"),
                    r6(F.aggregate("v", F.lit(0.0), lambda a, v: a + v)).alias("total"))


@register("softmax", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
m AS (SELECT *, list_transform(x, lambda v: exp(v - list_max(x))) AS ex FROM e),
s AS (SELECT vec_id, list_transform(ex, lambda v: v / list_sum(ex)) AS p FROM m)
SELECT vec_id, round(p[1], 6) AS p_first, round(list_max(p), 6) AS p_max, round(list_sum(p), 6) AS p_total FROM s""",
          ids="X18")
def q_softmax(spark, sf_dir):
    from ..operators.metrics import softmax
    e = _emb(spark, sf_dir).select("vec_id", softmax(F.col("embedding")).alias("p"))
    return e.select("vec_id", r6(F.element_at("p", 1)).alias("p_first"), r6(F.array_max("p")).alias("p_max"),
                    r6(F.aggregate("p", F.lit(0.0), lambda a, v: a + v)).alias("p_total"))


@register("knn", """
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
             row_number() OVER (ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos, count(*) OVER () AS n
           FROM embeddings),
q AS (SELECT * FROM p WHERE pos < floor(n * 0.2::DOUBLE)), t AS (SELECT * FROM p WHERE pos >= floor(n * 0.2::DOUBLE)),
d AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.label,
             list_sum(list_transform(range(1, len(q.x) + 1), lambda i: (q.x[i] - t.x[i]) * (q.x[i] - t.x[i]))) AS d2 FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) AS rk FROM d)
SELECT qid AS vec_id, label, count(*) / 5::DOUBLE AS share FROM r WHERE rk <= 5 GROUP BY 1, 2""", ids="F17")
def q_knn(spark, sf_dir):
    e = random_split_exact(_emb(spark, sf_dir), "vec_id", 0.2, 42)
    train = e.where(F.col("split") == "train").drop("split", "pos")
    query = e.where(F.col("split") == "test").drop("split", "pos")
    return vx.knn_class_share(train, query, "vec_id", "embedding", "label", k=5)
