"""Queries: ensembling of prediction tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensemble as en
from ..operators.metrics import roc_auc
from ..operators.split import kfold
from .catalog import r6, register, table
from .fixtures import PRED_LONG_SQL, PRED_SQL, predictions, predictions_long

SEED = 42


@register("ens_mean", f"""
SELECT id, round(sum(prediction) / (SELECT count(DISTINCT method) FROM {PRED_LONG_SQL} q), 6) AS prediction
FROM {PRED_LONG_SQL} p GROUP BY id""", ids="E01 J07")
def q_ens_mean(spark, sf_dir):
    return en.ensemble_mean(predictions_long(spark, sf_dir))


@register("ens_missing_ids", f"""
SELECT id, CAST(count(DISTINCT method) AS BIGINT) AS methods_present FROM {PRED_LONG_SQL} p GROUP BY id
HAVING count(DISTINCT method) < (SELECT count(DISTINCT method) FROM {PRED_LONG_SQL} q)""", ids="E01 J07")
def q_ens_missing_ids(spark, sf_dir):
    return en.missing_ids(predictions_long(spark, sf_dir))


# class votes: method file names carry weights (m_w3_a → 3, m_w1_b → 1, m_c → default 1)
VOTE_SQL = f"""(SELECT CASE method WHEN 'a' THEN 'm_w3_a' WHEN 'b' THEN 'm_w1_b' ELSE 'm_c' END AS method, id,
  CAST(CAST(floor(prediction * 3) AS BIGINT) AS VARCHAR) AS prediction FROM {PRED_LONG_SQL} p)"""


def votes(spark, sf_dir):
    p = predictions_long(spark, sf_dir)
    name = F.when(F.col("method") == "a", "m_w3_a").when(F.col("method") == "b", "m_w1_b").otherwise("m_c")
    return p.select(name.alias("method"), "id", F.floor(F.col("prediction") * 3).cast("long").cast("string").alias("prediction"))


def _vote_sql(weighted: bool) -> str:
    w = ("coalesce(TRY_CAST(NULLIF(regexp_extract(method, '.*_[wW](\\d+)_', 1), '') AS DOUBLE), 1.0)"
         if weighted else "1.0::DOUBLE")
    return f"""
WITH t AS (SELECT id, prediction, sum({w}) AS votes, min(method) AS first FROM {VOTE_SQL} v GROUP BY 1, 2)
SELECT id, prediction, votes FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, first, prediction) AS rk FROM t) WHERE rk = 1"""


@register("ens_vote", _vote_sql(False), ids="E02 A11")
def q_ens_vote(spark, sf_dir):
    return en.ensemble_vote(votes(spark, sf_dir))


@register("ens_vote_weighted", _vote_sql(True), ids="E03 X12")
def q_ens_vote_weighted(spark, sf_dir):
    return en.ensemble_vote(votes(spark, sf_dir), weighted=True)


@register("ens_rank", f"""
WITH p AS (SELECT method, id, prediction,
             row_number() OVER (PARTITION BY method ORDER BY prediction, CAST(id AS VARCHAR)) - 1 AS pos
           FROM {PRED_LONG_SQL} x),
m AS (SELECT id, avg(pos) AS mean FROM p GROUP BY id),
r AS (SELECT id, row_number() OVER (ORDER BY mean, CAST(id AS VARCHAR)) - 1 AS rk, count(*) OVER () AS n FROM m)
SELECT id, round(rk / (n - 1), 6) AS prediction FROM r""", ids="E04 W09")
def q_ens_rank(spark, sf_dir):
    r = en.ensemble_rank(predictions_long(spark, sf_dir))
    return r.select("id", r6("prediction").alias("prediction"))


def _folds_sql(k: int) -> str:
    return f"""(WITH p AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}' || CAST(id AS VARCHAR)), id) - 1 AS pos,
                            count(*) OVER () AS n FROM {PRED_SQL} x),
  f AS (SELECT *, n // {k} AS q, n % {k} AS r FROM p)
  SELECT *, CAST(CASE WHEN pos < r * (q + 1) THEN pos // (q + 1) ELSE r + (pos - r * (q + 1)) // q END AS INTEGER) AS fold FROM f)"""


def _long_with_folds(spark, sf_dir, k=3):
    p = kfold(predictions(spark, sf_dir), "id", k, SEED)
    st = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"score_{m}").alias("prediction")) for m in "abc"])
    return p.select("id", "y", "fold", F.inline(st))


@register("ens_proba_auc", f"""
WITH f AS {_folds_sql(3)},
e AS (SELECT fold, id, y, (score_a + score_b + score_c) / 3 AS s FROM f),
g AS (SELECT fold, s, sum(y) AS pos, count(*) - sum(y) AS neg FROM e GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT fold, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c GROUP BY fold""", ids="E05 R05 M08")
def q_ens_proba_auc(spark, sf_dir):
    lp = _long_with_folds(spark, sf_dir)
    mean = en.ensemble_proba(lp, group=["fold", "y"])
    return roc_auc(mean, "y", "prediction", group=["fold"]).select("fold", r6("auc").alias("auc"))


@register("ens_auc_mean", f"""
WITH f AS {_folds_sql(3)},
e AS (SELECT fold, id, y, (score_a + score_b + score_c) / 3 AS s FROM f),
g AS (SELECT fold, s, sum(y) AS pos, count(*) - sum(y) AS neg FROM e GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT fold, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY fold)
SELECT round(avg(auc), 6) AS mean_auc, CAST(count(*) AS BIGINT) AS folds FROM a""", ids="E05 R05 M08")
def q_ens_auc_mean(spark, sf_dir):
    mean = en.ensemble_proba(_long_with_folds(spark, sf_dir), group=["fold", "y"])
    return roc_auc(mean, "y", "prediction", group=["fold"]).agg(r6(F.avg("auc")).alias("mean_auc"), F.count("auc").alias("folds"))


@register("ens_minmax", f"""
WITH f AS {_folds_sql(3)},
l AS (SELECT fold, id, 'a' AS method, score_a AS v FROM f UNION ALL SELECT fold, id, 'b', score_b FROM f
      UNION ALL SELECT fold, id, 'c', score_c FROM f),
s AS (SELECT fold, method, min(v) AS lo, max(v) AS hi FROM l GROUP BY 1, 2)
SELECT fold, id, round(avg((v - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END), 6) AS prediction
FROM l JOIN s USING (fold, method) GROUP BY fold, id""", ids="E06 F06")
def q_ens_minmax(spark, sf_dir):
    lp = _long_with_folds(spark, sf_dir).drop("y")
    m = en.ensemble_minmax(lp, group=["fold"])
    return m.select("fold", "id", r6("prediction").alias("prediction"))


@register("tta_accuracy", """
WITH e AS (SELECT vec_id, label, m.model, v.variant, v.vi FROM embeddings,
             (VALUES (0), (1), (2)) m(model), (VALUES ('plain', 0), ('aug', 1)) v(variant, vi))
SELECT model, variant, round(avg(CASE WHEN (CASE WHEN (vec_id + model + vi) % 4 = 0 THEN (label + 1) % 10 ELSE label END) = label
                                      THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM e GROUP BY 1, 2""", ids="E08")
def q_tta_accuracy(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    runs = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(vn).alias("variant"), F.lit(vi).alias("vi"))
                     for m in range(3) for vn, vi in (("plain", 0), ("aug", 1))])
    x = e.select("vec_id", "label", F.inline(runs))
    pred = F.when((F.col("vec_id") + F.col("model") + F.col("vi")) % 4 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    acc = en.evaluate_models(x.withColumn("pred", pred), "model", "variant", "label", "pred")
    return acc.select("model", "variant", r6("accuracy").alias("accuracy"))
