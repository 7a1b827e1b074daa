"""Queries: metrics and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..operators.gram import corr_pairs
from ..operators.order import average_rank
from ..operators.split import bootstrap_counts, hash_int
from ..operators.vectors import random_partner
from .catalog import r6, register, table
from .q_vectors import _partner_sql
from .fixtures import (BOOT_SQL, BOX_SQL, PRED_LONG_SQL, PRED_SQL, REG_SQL, boxes, bootstrap_predictions, predictions,
                       predictions_long, regression_predictions)


SEED = 42


def _r6all(df, keep=()):
    return df.select(*keep, *[r6(c).alias(c) for c in df.columns if c not in keep])


@register("reg_metrics", f"""
SELECT model, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(y)), 6) AS r2,
       round(avg(abs((y - p) / NULLIF(y, 0))), 6) AS mape,
       round(avg(2 * abs(y - p) / NULLIF(abs(y) + abs(p), 0)), 6) AS smape
FROM {REG_SQL} r GROUP BY model""", ids="M01 M02 M03 M04")
def q_reg_metrics(spark, sf_dir):
    m = mt.regression_metrics(regression_predictions(spark, sf_dir), "y", "p", ["model"])
    return _r6all(m, ["model"])


@register("score_table", f"""
SELECT model, CAST(round_even(avg(abs(y - p)), 2) AS VARCHAR) AS MAE,
       CAST(round_even(sqrt(avg((y - p) * (y - p))), 2) AS VARCHAR) AS RMSE,
       CAST(round_even(avg(abs((y - p) / NULLIF(y, 0))), 4) AS VARCHAR) AS MAPE
FROM {REG_SQL} r GROUP BY model""", ids="M15 X15")
def q_score_table(spark, sf_dir):
    rp = regression_predictions(spark, sf_dir)
    a = mt.score_table(rp, "model", "y", "p", digits=2, metrics=("mae", "rmse"))
    b = mt.score_table(rp, "model", "y", "p", digits=4, metrics=("mape",))
    return a.join(b, "model")


@register("accuracy", f"""
SELECT round(avg(CASE WHEN y = CAST(score_a >= 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM {PRED_SQL} p""", ids="M05")
def q_accuracy(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("pred", (F.col("score_a") >= 0.5).cast("int"))
    return _r6all(mt.accuracy(p, "y", "pred"))


@register("zero_one_cost", f"""
SELECT CAST(count(*) FILTER (WHERE y <> CAST(score_a >= 0.5 AS INTEGER)) AS BIGINT) AS cost FROM {PRED_SQL} p""",
          ids="M06")
def q_zero_one_cost(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("pred", (F.col("score_a") >= 0.5).cast("int"))
    return mt.zero_one_cost(p, "y", "pred")


@register("confusion", f"""
SELECT y AS actual, CAST(floor(score_b * 3) AS INTEGER) AS predicted, CAST(count(*) AS BIGINT) AS count
FROM {PRED_SQL} p GROUP BY 1, 2""", ids="M07")
def q_confusion(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("pred", F.floor(F.col("score_b") * 3).cast("int"))
    return mt.confusion_long(p, "y", "pred")


@register("confusion_matrix", f"""
SELECT a.actual, CAST(count(*) FILTER (WHERE predicted = 0) AS BIGINT) AS "0", CAST(count(*) FILTER (WHERE predicted = 1) AS BIGINT) AS "1",
       CAST(count(*) FILTER (WHERE predicted = 2) AS BIGINT) AS "2"
FROM (VALUES (0), (1), (2)) a(actual)
LEFT JOIN (SELECT y AS actual, CAST(floor(score_b * 3) AS INTEGER) AS predicted FROM {PRED_SQL} p) c USING (actual) GROUP BY a.actual""", ids="M07")
def q_confusion_matrix(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("pred", F.floor(F.col("score_b") * 3).cast("int"))
    return mt.confusion_matrix(p, "y", "pred", [0, 1, 2]).withColumn("actual", F.col("actual").cast("int"))


def _auc_sql(score: str) -> str:
    return f"""(SELECT sum(CASE WHEN a.y = 1 AND b.y = 0 AND a.{score} > b.{score} THEN 1.0
                      WHEN a.y = 1 AND b.y = 0 AND a.{score} = b.{score} THEN 0.5 ELSE 0 END)
        / (sum(CASE WHEN a.y = 1 AND b.y = 0 THEN 1 ELSE 0 END)) FROM {PRED_SQL} a, {PRED_SQL} b)"""


@register("roc_auc", f"""
SELECT round({_auc_sql('score_a')}, 6) AS auc_a, round({_auc_sql('score_b')}, 6) AS auc_b""", ids="M08")
def q_roc_auc(spark, sf_dir):
    m = mt.roc_auc_many(predictions(spark, sf_dir), "y", ["score_a", "score_b"])
    return m.agg(*[r6(F.max(F.when(F.col("score") == f"score_{x}", F.col("auc")))).alias(f"auc_{x}") for x in "ab"])


@register("roc_auc_by_group", f"""
WITH p AS (SELECT * FROM {PRED_SQL} x),
r AS (SELECT toxic, score_a, sum(y) AS pos, count(*) - sum(y) AS neg FROM p GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY toxic ORDER BY score_a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM r)
SELECT toxic, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c GROUP BY toxic""",
          ids="M08 E05")
def q_roc_auc_by_group(spark, sf_dir):
    a = mt.roc_auc(predictions(spark, sf_dir), "y", "score_a", group=["toxic"])
    return a.select("toxic", r6("auc").alias("auc"))


@register("log_loss", f"""
SELECT round(-avg(y * ln(least(greatest(score_a, 1e-15), 1 - 1e-15))
                 + (1 - y) * ln(1 - least(greatest(score_a, 1e-15), 1 - 1e-15))), 6) AS log_loss FROM {PRED_SQL} p""",
          ids="M13")
def q_log_loss(spark, sf_dir):
    return _r6all(mt.log_loss(predictions(spark, sf_dir), "y", "score_a"))


@register("iou", f"""
WITH b AS {BOX_SQL},
i AS (SELECT *, greatest(least(ax1, bx1) - greatest(ax0, bx0) + 1, 0) * greatest(least(ay1, by1) - greatest(ay0, by0) + 1, 0) AS inter FROM b)
SELECT l_orderkey, l_linenumber, round(inter / ((ax1 - ax0 + 1) * (ay1 - ay0 + 1) + (bx1 - bx0 + 1) * (by1 - by0 + 1) - inter), 6) AS iou
FROM i""", ids="M09")
def q_iou(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return b.select("l_orderkey", "l_linenumber",
                    r6(mt.iou("ax0", "ay0", "ax1", "ay1", "bx0", "by0", "bx1", "by1")).alias("iou"))


_Z95 = mt.z_critical(0.95)


@register("rmse_ci", f"""
WITH e AS (SELECT (y - p) * (y - p) AS e2 FROM {REG_SQL} r WHERE model = 'm3'),
s AS (SELECT avg(e2) AS m, stddev_samp(e2) AS sd, count(e2) AS n FROM e)
SELECT round(sqrt(m), 4) AS rmse, round(sqrt(m - {_Z95!r} * sd / sqrt(n)), 4) AS lower,
       round(sqrt(m + {_Z95!r} * sd / sqrt(n)), 4) AS upper FROM s""", ids="M10")
def q_rmse_ci(spark, sf_dir):
    rp = regression_predictions(spark, sf_dir).where(F.col("model") == "m3")
    ci = mt.rmse_ci(rp, "y", "p", 0.95, method="z")
    return ci.select(*[F.round(c, 4).alias(c) for c in ci.columns])


@register("rmse_ci_t", f"""
WITH e AS (SELECT (y - p) * (y - p) AS e2 FROM {REG_SQL} r WHERE model = 'm3'),
s AS (SELECT avg(e2) AS m, stddev_samp(e2) AS sd, count(e2) AS n FROM e),
z AS (SELECT *, {_Z95!r} AS z, n - 1 AS f FROM s),
t AS (SELECT *, z + (z ** 3 + z) / (4 * f) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * f ** 2) AS t FROM z)
SELECT round(sqrt(m), 4) AS rmse, round(sqrt(m - t * sd / sqrt(n)), 4) AS lower, round(sqrt(m + t * sd / sqrt(n)), 4) AS upper FROM t""", ids="M10")
def q_rmse_ci_t(spark, sf_dir):
    """The t interval; the SQL takes the t quantile from its series in 1/f, exact to the digits shown for f > 1000."""
    rp = regression_predictions(spark, sf_dir).where(F.col("model") == "m3")
    ci = mt.rmse_ci(rp, "y", "p", 0.95)
    return ci.select(*[F.round(c, 4).alias(c) for c in ci.columns])


@register("bias_variance", f"""
WITH b AS {BOOT_SQL},
i AS (SELECT id, avg(p) AS pbar, any_value(y) AS y, avg((p - y) * (p - y)) AS mse, var_pop(p) AS var FROM b GROUP BY id)
SELECT round(avg(mse), 4) AS mse, round(avg((pbar - y) * (pbar - y)), 4) AS bias, round(avg(var), 4) AS var FROM i""",
          ids="M11 R09")
def q_bias_variance(spark, sf_dir):
    bv = mt.bias_variance(bootstrap_predictions(spark, sf_dir), "round", "id", "p", "y")
    return bv.select(*[F.round(c, 4).alias(c) for c in bv.columns])


_REFIT_ROUNDS = 200


@register("bias_variance_refit", f"""
WITH o AS (SELECT o_orderkey AS id, o_totalprice / 1000::DOUBLE + 3 * (o_orderkey % 97) AS y, (o_orderkey % 97)::DOUBLE AS x,
    CAST('0x' || substr(md5('{SEED}' || 'refit' || '-' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) % 5 AS part FROM orders),
q AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}' || CAST(id AS VARCHAR)), id) - 1 AS pos, count(*) OVER () AS n FROM o WHERE part > 0),
k AS (SELECT r.round, CAST('0x' || substr(md5('{SEED}' || CAST(round AS VARCHAR) || '-' || CAST(pos AS VARCHAR)), 1, 12) AS BIGINT) % n AS pos, count(*) AS w
      FROM q, range(0, {_REFIT_ROUNDS}) r(round) GROUP BY 1, 2),
m AS (SELECT round, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM k JOIN q USING (pos) GROUP BY round),
f AS (SELECT round, any_value(mx) AS mx, any_value(my) AS my, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope
      FROM k JOIN q USING (pos) JOIN m USING (round) GROUP BY round),
p AS (SELECT id, y, my + slope * (x - mx) AS p FROM f, o WHERE part = 0),
i AS (SELECT id, avg(p) AS pbar, any_value(y) AS y, avg((p - y) * (p - y)) AS mse, var_pop(p) AS var FROM p GROUP BY id)
SELECT round(avg(mse), 6) AS mse, round(avg((pbar - y) * (pbar - y)), 6) AS bias, round(avg(var), 6) AS var, {_REFIT_ROUNDS}::INTEGER AS rounds FROM i""",
          ids="M11 R09")
def q_bias_variance_refit(spark, sf_dir):
    """Least squares fitted again in each of 200 bootstrap rounds of the training rows, judged on the other rows."""
    part = (hash_int(SEED, F.lit("refit"), "id") % 5).alias("part")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 97).cast("double").alias("x"), "o_totalprice")
    o = o.select("id", "x", (F.col("o_totalprice") / 1000 + 3 * F.col("x")).alias("y"), part)
    train = o.where("part > 0")
    train = bootstrap_counts(train.select("id", "x", "y"), "id", _REFIT_ROUNDS, SEED, "w")
    bv = mt.bias_variance_refit(train, o.where("part = 0"), "y", ["x"], "w", _REFIT_ROUNDS)
    return bv.select(*[r6(c).alias(c) for c in ("mse", "bias", "var")], "rounds")


@register("all_close", """
SELECT round(max(abs(o_totalprice * 0.9::DOUBLE - (o_totalprice - o_totalprice * 0.1::DOUBLE))), 6) AS max_abs_diff,
       CAST(0 AS BIGINT) AS unmatched,
       max(abs(o_totalprice * 0.9::DOUBLE - (o_totalprice - o_totalprice * 0.1::DOUBLE))) <= 1e-6 AS all_close
FROM orders""", ids="M17")
def q_all_close(spark, sf_dir):
    # an old and a new computation of the same feature must agree
    o = table(spark, sf_dir, "orders")
    a = o.select("o_orderkey", (F.col("o_totalprice") * 0.9).alias("p"))
    b = o.select("o_orderkey", (F.col("o_totalprice") - F.col("o_totalprice") * 0.1).alias("p"))
    r = mt.all_close(a, b, ["o_orderkey"], ["p"], 1e-6)
    return r.select(r6("max_abs_diff").alias("max_abs_diff"), "unmatched", "all_close")


@register("corr_matrix", """
SELECT a, b, round(corr, 6) AS corr FROM (
  SELECT unnest(['l_quantity', 'l_quantity', 'l_quantity', 'l_extendedprice', 'l_extendedprice', 'l_extendedprice',
                 'l_discount', 'l_discount', 'l_discount']) AS a,
         unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_quantity', 'l_extendedprice', 'l_discount',
                 'l_quantity', 'l_extendedprice', 'l_discount']) AS b,
         unnest([corr(l_quantity, l_quantity), corr(l_quantity, l_extendedprice), corr(l_quantity, l_discount),
                 corr(l_extendedprice, l_quantity), corr(l_extendedprice, l_extendedprice), corr(l_extendedprice, l_discount),
                 corr(l_discount, l_quantity), corr(l_discount, l_extendedprice), corr(l_discount, l_discount)]) AS corr
  FROM lineitem)""", ids="A12")
def q_corr_matrix(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    c = mt.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return c.select("a", "b", r6("corr").alias("corr"))


_WIDE = 300


@register("corr_wide", f"""
WITH l AS (SELECT vec_id AS i, k, CASE WHEN (vec_id + k) % 11 <> 0 THEN embedding[k % 64 + 1]::DOUBLE * embedding[(k * 7 + 3) % 64 + 1]::DOUBLE + k / 100::DOUBLE END AS x
           FROM embeddings, range({_WIDE}) r(k))
SELECT 'c' || a.k AS a, 'c' || b.k AS b, round(corr(a.x, b.x), 6) AS corr FROM l a JOIN l b USING (i) GROUP BY a.k, b.k""", ids="A12")
def q_corr_wide(spark, sf_dir):
    """Vectors of 300 entries with nulls, 90 000 pairs."""
    e, i = F.col("embedding"), F.col("vec_id")
    cell = lambda k: F.when((i + k) % 11 != 0, F.get(e, k % 64).cast("double") * F.get(e, (k * 7 + 3) % 64).cast("double") + k / 100)
    v = table(spark, sf_dir, "embeddings").select(F.transform(F.sequence(F.lit(0), F.lit(_WIDE - 1)), cell).alias("v"))
    return corr_pairs(v, [f"c{k}" for k in range(_WIDE)], vec="v").select("a", "b", r6("corr").alias("corr"))


@register("corr_with_target", """
SELECT "column", round(corr, 6) AS corr FROM (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS "column",
  unnest([corr(l_quantity, l_extendedprice), corr(l_discount, l_extendedprice), corr(l_tax, l_extendedprice)]) AS corr FROM lineitem)
ORDER BY corr DESC""", ids="A12")
def q_corr_with_target(spark, sf_dir):
    c = mt.corr_with_target(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return c.select("column", r6("corr").alias("corr"))


@register("avg_rank", f"""
SELECT id, score_b, rank() OVER (ORDER BY score_b) + (count(*) OVER (PARTITION BY score_b) - 1) / 2.0 AS score_b_rank
FROM {PRED_SQL} p""", ids="W10")
def q_avg_rank(spark, sf_dir):
    p = predictions(spark, sf_dir).select("id", "score_b")
    return average_rank(p, "score_b")


_KENDALL_SQL = f"""(WITH d AS (SELECT score_a AS x, score_b AS y, count(*) AS c FROM {PRED_SQL} p GROUP BY 1, 2),
  pr AS (SELECT sum(CASE WHEN (a.x - b.x) * (a.y - b.y) > 0 THEN a.c * b.c ELSE 0 END) / 2 AS conc,
                sum(CASE WHEN (a.x - b.x) * (a.y - b.y) < 0 THEN a.c * b.c ELSE 0 END) / 2 AS disc FROM d a, d b),
  n AS (SELECT sum(c) AS n FROM d),
  tx AS (SELECT sum(t * (t - 1) / 2) AS n1 FROM (SELECT sum(c) AS t FROM d GROUP BY x)),
  ty AS (SELECT sum(t * (t - 1) / 2) AS n2 FROM (SELECT sum(c) AS t FROM d GROUP BY y))
  SELECT (conc - disc) / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2)) FROM pr, n, tx, ty)"""


@register("corr_three", f"""
WITH r AS (SELECT score_a, score_b,
     rank() OVER (ORDER BY score_a) + (count(*) OVER (PARTITION BY score_a) - 1) / 2.0 AS ra,
     rank() OVER (ORDER BY score_b) + (count(*) OVER (PARTITION BY score_b) - 1) / 2.0 AS rb FROM {PRED_SQL} p)
SELECT round(corr(score_a, score_b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman,
       round({_KENDALL_SQL}, 6) AS kendall FROM r""", ids="A13 W10")
def q_corr_three(spark, sf_dir):
    p = predictions(spark, sf_dir).select("score_a", "score_b")
    c = mt.correlations(p, "score_a", "score_b")
    return c.select(*[r6(x).alias(x) for x in ("pearson", "spearman", "kendall")])


_ALIGNED_SQL = f"""(SELECT id, x.prediction AS x, y.prediction AS y FROM (SELECT id, prediction FROM {PRED_LONG_SQL} p WHERE method = 'a') x
  JOIN (SELECT id, prediction FROM {PRED_LONG_SQL} p WHERE method = 'c') y USING (id))"""


@register("corr_aligned", f"""
WITH r AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
     rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM {_ALIGNED_SQL} j)
SELECT round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman,
       round({_KENDALL_SQL.replace('score_a AS x, score_b AS y', 'x, y').replace(f'FROM {PRED_SQL} p GROUP BY', f'FROM {_ALIGNED_SQL} k GROUP BY')}, 6) AS kendall FROM r""", ids="J06 A13 W10")
def q_corr_aligned(spark, sf_dir):
    """Two prediction tables, one of which lacks ids, aligned before the three correlations."""
    p = predictions_long(spark, sf_dir)
    j = mt.align(p.where("method = 'a'"), p.where("method = 'c'"), "id", "prediction")
    c = mt.correlations(j, "x", "y")
    return c.select(*[r6(x).alias(x) for x in ("pearson", "spearman", "kendall")])


EMB_PARTNER_SEED = 11


@register("mixed_loss", f"""
WITH {_partner_sql(EMB_PARTNER_SEED)},
l AS (SELECT *, list_max(x) AS mx, ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) AS lse FROM m)
SELECT round(avg(0.75::DOUBLE * -(x[label + 1] - mx - lse) + 0.25::DOUBLE * -(x[partner_label + 1] - mx - lse)), 6) AS mixed_loss
FROM l""", ids="M12 J09")
def q_mixed_loss(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    p = random_partner(e, "vec_id", EMB_PARTNER_SEED, cols=["label"])
    return _r6all(mt.mixed_loss(p, "embedding", "label", "partner_label", 0.75))


@register("consistency_loss", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda v: v * 0.5) AS x2 FROM embeddings),
s AS (SELECT *, list_max(x) AS m1, list_max(x2) AS m2 FROM e),
t AS (SELECT *, list_transform(x, lambda v: exp(v - m1)) AS e1, list_transform(x2, lambda v: exp(v - m2)) AS e2 FROM s),
u AS (SELECT *, list_transform(e1, lambda v: v / list_sum(e1)) AS p1, list_transform(e2, lambda v: v / list_sum(e2)) AS p2 FROM t)
SELECT round(avg(-(x[label + 1] - m1 - ln(list_sum(e1)))
                 + 0.1 * list_sum(list_transform(range(1, len(p1) + 1), lambda i: (p1[i] - p2[i]) * (p1[i] - p2[i])))), 6)
       AS consistency_loss
FROM u""", ids="M14 X18")
def q_consistency_loss(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    e = e.withColumn("x2", F.transform(F.col("embedding").cast("array<double>"), lambda v: v * 0.5))
    return _r6all(mt.consistency_loss(e, "embedding", "x2", "label", 0.1))
