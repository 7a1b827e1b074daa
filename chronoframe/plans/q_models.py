"""Queries: models and model selection.

Least squares, gradient descents, cross-validation and model imputation have the same numbers in SQL.  Values
of the other fits depend on solvers; their queries return what must hold of them: row counts, the settings
tried, and that the model beats the mean or the largest class.
"""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..operators import models as md
from ..operators import prepare as pr
from ..operators import trees as tr
from ..operators.split import hash_bytes, kfold, random_split_exact, stratified_split, with_row_id
from ..operators.vectors import vector_width
from ..session import materialize
from ..sources.io import scratch_path
from .catalog import register, table
from .fixtures import PRED_SQL, predictions
from .q_frame import NULLABLE_SQL, nullable
from .q_prepare import SEGMENTS, housing

_LI_X = ["l_quantity", "l_discount", "l_tax"]


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@register("linreg", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""", ids="F11")
def q_linreg(spark, sf_dir):
    m = md.fit_linear(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_quantity"])
    return _rows(spark, [(round(float(m.coefficients[0]), 4), round(float(m.intercept), 4))], "slope double, intercept double")


def _gd_sql(err: str, rate: str, iters: int, data: str) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT * FROM {data}), r AS (SELECT 0 AS it, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  UNION ALL SELECT it + 1, w0 - {rate} * avg(e), w1 - {rate} * avg(e * a), w2 - {rate} * avg(e * b)
  FROM (SELECT r.it, r.w0, r.w1, r.w2, d.a, d.b, {err} AS e FROM r, d WHERE r.it < {iters}) GROUP BY it, w0, w1, w2)
SELECT unnest([0, 1, 2]) AS weight_index, unnest([round(w0, 6), round(w1, 6), round(w2, 6)]) AS weight FROM r WHERE it = {iters}"""


@register("linreg_gd", _gd_sql("r.w0 + r.w1 * d.a + r.w2 * d.b - d.y", "0.5", 20,
                               "(SELECT l_extendedprice / 10000 AS y, l_discount AS a, l_tax AS b FROM lineitem)"), ids="F12")
def q_linreg_gd(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") / 1e4).alias("y"), "l_discount", "l_tax")
    w = md.linreg_gd(li, "y", ["l_discount", "l_tax"], lr=0.5, iters=20)
    return _rows(spark, [(i, round(float(v), 6)) for i, v in enumerate(w)], "weight_index int, weight double")


@register("logreg_gd", _gd_sql("1 / (1 + exp(-(r.w0 + r.w1 * d.a + r.w2 * d.b))) - d.y", "0.3", 30,
                               f"(SELECT y, score_a AS a, score_b AS b FROM {PRED_SQL} p)"), ids="F13")
def q_logreg_gd(spark, sf_dir):
    w = md.logreg_gd(predictions(spark, sf_dir), "y", ["score_a", "score_b"], lr=0.3, iters=30)
    return _rows(spark, [(i, round(float(v), 6)) for i, v in enumerate(w)], "weight_index int, weight double")


@register("logreg", f"SELECT CAST(count(*) AS BIGINT) AS rows, true AS not_worse_than_base FROM {PRED_SQL} p", ids="F13 M13")
def q_logreg(spark, sf_dir):
    """The fitted model's log loss is not above that of the base rate."""
    p = predictions(spark, sf_dir)
    xs = ["score_a", "score_b", "score_c"]
    m = md.fit_logistic(p, "y", xs)
    scored = md.score_rows(m, p, xs, vector_to_array("probability")[1], "p").crossJoin(F.broadcast(p.agg(F.avg("y").alias("base"))))
    a, b = mt.log_loss(scored, "y", "p").first()[0], mt.log_loss(scored, "y", "base").first()[0]
    return _rows(spark, [(scored.count(), a <= b + 1e-9)], "rows long, not_worse_than_base boolean")


_TEST_SQL = "SELECT '{name}' AS model, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS rows, true AS beats_mean FROM lineitem"


def _lineitem_split(spark, sf_dir):
    """A target that the features explain but for a part that they do not know (the price)."""
    y = (F.col("l_quantity") * (1 - F.col("l_discount")) * 100 + F.col("l_extendedprice") / 1000).alias("y")
    li = with_row_id(table(spark, sf_dir, "lineitem").select(*_LI_X, y, "l_orderkey", "l_linenumber"))
    li = materialize(li.select(*_LI_X, "y", hash_bytes(42, "rid").alias("key")), "split")     # every model and score reads it
    s = random_split_exact(li, "key", 0.2, 42, with_pos=False, hashed=True).drop("key")
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _reg_eval(spark, sf_dir, name, fit):
    """Fit on four fifths of lineitem; on the rest the model must have a lower RMSE than the mean."""
    train, test = _lineitem_split(spark, sf_dir)
    m = fit(train)
    mean = train.agg(F.avg("y").alias("_mean"))
    scored = md.score_rows(m, test, _LI_X, F.col("prediction"), "p").crossJoin(F.broadcast(mean))
    one = scored.agg(F.count("p").alias("rows"), F.avg((F.col("p") - F.col("y")) ** 2).alias("a"), F.avg((F.col("_mean") - F.col("y")) ** 2).alias("b"))
    return m, one.select(F.lit(name).alias("model"), "rows", (F.col("a") < F.col("b")).alias("beats_mean"))


@register("tree_reg", _TEST_SQL.format(name="tree"), ids="F14")
def q_tree_reg(spark, sf_dir):
    return _reg_eval(spark, sf_dir, "tree", lambda d: md.fit_tree(d, "y", _LI_X, depth=5))[1]


@register("forest", _TEST_SQL.format(name="forest"), ids="F15")
def q_forest(spark, sf_dir):
    return _reg_eval(spark, sf_dir, "forest", lambda d: md.fit_forest(d, "y", _LI_X, trees=10, depth=5))[1]


@register("gbt", _TEST_SQL.format(name="gbt"), ids="F16")
def q_gbt(spark, sf_dir):
    """20 rounds of depth 5 here; ``fit_gbt`` itself defaults to 1000 rounds of depth 10 at step 0.01."""
    return _reg_eval(spark, sf_dir, "gbt", lambda d: md.fit_gbt(d, "y", _LI_X, rounds=20, depth=5, eta=0.1))[1]


@register("importances", """
SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature, unnest([true, false, false]) AS leads, true AS sums_to_one""", ids="F19")
def q_importances(spark, sf_dir):
    """The quantity leads the importances; together they make 1."""
    m, _ = _reg_eval(spark, sf_dir, "forest", lambda d: md.fit_forest(d, "y", _LI_X, trees=10, depth=5))
    imp = md.importances(m, _LI_X)
    total = abs(sum(v for _, v in imp) - 1) < 1e-6
    return _rows(spark, [(f, i == 0, total) for i, (f, _) in enumerate(imp)], "feature string, leads boolean, sums_to_one boolean")


# ---------------------------------------------------------------------------------------------------
# trees number by number: the SQL grows the same trees from the rows, level by level
# ---------------------------------------------------------------------------------------------------

_TREE_ROWS = "(SELECT l_quantity AS x0, l_discount AS x1, l_tax AS x2, l_quantity * (1 - l_discount) + l_extendedprice / 100000 AS y FROM lineitem)"


def _grow_sql(rows: str, tag: str, depth: int) -> str:
    """CTEs that grow a regression tree on ``rows`` (y, x0, x1, x2, others): ``{tag}n`` are the rows with their leaf ``node``,
    ``{tag}t`` the nodes.  Cuts lie between neighbouring values of a feature in the whole table."""
    out = [f"{tag}g AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nx FROM (SELECT DISTINCT unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS v FROM {rows}))",
           f"{tag}n0 AS (SELECT *, 1 AS node FROM {rows})"]
    for level in range(depth):
        out += [f"""{tag}u{level} AS (SELECT node, f, v, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM (
  SELECT node, y, unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS v FROM {tag}n{level}) GROUP BY node, f, v)""",
                f"""{tag}c{level} AS (SELECT node, f, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(q) OVER w AS ql, sum(n) OVER t AS nt, sum(s) OVER t AS st, sum(q) OVER t AS qt
  FROM {tag}u{level} WINDOW w AS (PARTITION BY node, f ORDER BY v), t AS (PARTITION BY node, f))""",
                f"""{tag}b{level} AS (SELECT * FROM (SELECT node, c.f, (c.v + g.nx) / 2 AS thr, nt, st / nt AS value,
    ((qt - st * st / nt) - (ql - sl * sl / nl) - ((qt - ql) - (st - sl) * (st - sl) / (nt - nl))) / nt AS gain
  FROM {tag}c{level} c JOIN {tag}g g ON g.f = c.f AND g.v = c.v WHERE nt > nl)
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, thr) = 1)""",
                f"""{tag}n{level + 1} AS (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
    ELSE 2 * r.node + CASE WHEN CASE b.f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= b.thr THEN 0 ELSE 1 END END AS node FROM {tag}n{level} r LEFT JOIN {tag}b{level} b ON b.node = r.node)"""]
    inner = " UNION ALL ".join(f"SELECT node, f, thr, gain, nt AS n, value FROM {tag}b{level}" for level in range(depth))
    out += [f"{tag}l AS (SELECT node, count(*) AS n, avg(y) AS value FROM {tag}n{depth} GROUP BY node)",
            f"{tag}n AS (SELECT r.*, l.value FROM {tag}n{depth} r JOIN {tag}l l ON l.node = r.node)",
            f"{tag}t AS ({inner} UNION ALL SELECT node, NULL, NULL, NULL, n, value FROM {tag}l)"]
    return ",\n".join(out)


def _boost_sql(rounds: int, depth: int, eta: float) -> str:
    """CTEs of boosted trees: after the first tree each is grown on twice the rest, and counts with the step ``eta``."""
    out = [_grow_sql(_TREE_ROWS, "a0", depth)]
    for r in range(1, rounds):
        step = 1.0 if r == 1 else eta
        target, so_far = ("y", "0.0") if r == 1 else ("goal", "p")
        out += [f"r{r} AS (SELECT x0, x1, x2, {target} AS goal, {so_far} + {step} * value AS p, 2 * ({target} - ({so_far} + {step} * value)) AS y FROM a{r - 1}n)", _grow_sql(f"r{r}", f"a{r}", depth)]
    return ",\n".join(out)


_NODE_SQL = "SELECT {r}::INTEGER AS tree, CAST(node AS BIGINT) AS node, CAST(f AS INTEGER) AS feature, round(thr, 6) AS threshold, round(gain, 6) AS gain, CAST(n AS BIGINT) AS rows, round(value, 6) AS value FROM a{r}t"


def _tree_rows(spark, sf_dir):
    y = (F.col("l_quantity") * (1 - F.col("l_discount")) + F.col("l_extendedprice") / 100000).alias("y")
    return table(spark, sf_dir, "lineitem").select(*_LI_X, y)


def _node_rows(nodes):
    return nodes.select("tree", "node", "feature", *[F.round(c, 6).alias(c) for c in ("threshold", "gain")], "rows", F.round("value", 6).alias("value"))


@register("tree_nodes", f"WITH {_grow_sql(_TREE_ROWS, 'a0', 3)}\n" + _NODE_SQL.format(r=0), ids="F14")
def q_tree_nodes(spark, sf_dir):
    """Every node of a tree of depth 3."""
    return _node_rows(tr.node_table(md.fit_tree(_tree_rows(spark, sf_dir), "y", _LI_X, depth=3, bins=64)))


@register("gbt_nodes", f"WITH {_boost_sql(3, 2, 0.1)}\n" + "\nUNION ALL ".join(_NODE_SQL.format(r=r) for r in range(3)), ids="F16")
def q_gbt_nodes(spark, sf_dir):
    """Every node of three boosted trees of depth 2."""
    return _node_rows(tr.node_table(md.fit_gbt(_tree_rows(spark, sf_dir), "y", _LI_X, rounds=3, depth=2, eta=0.1, bins=64)))


@register("gbt_scores", f"""
WITH {_boost_sql(3, 2, 0.1)}
SELECT x0 AS l_quantity, x1 AS l_discount, x2 AS l_tax, round(any_value(p + 0.1 * value), 6) AS prediction FROM a2n GROUP BY x0, x1, x2""", ids="F16 F14")
def q_gbt_scores(spark, sf_dir):
    """Scores of every distinct feature row by joins with the node table, without the model."""
    x = _tree_rows(spark, sf_dir)
    nodes = tr.node_table(md.fit_gbt(x, "y", _LI_X, rounds=3, depth=2, eta=0.1, bins=64))
    scored = tr.score_by_nodes(x.select(*_LI_X).distinct(), nodes, _LI_X, _LI_X, boosted=True)
    return scored.select(*_LI_X, F.round("prediction", 6).alias("prediction"))


@register("tree_importances", f"""
WITH {_grow_sql(_TREE_ROWS, 'a0', 3)},
w AS (SELECT f, sum(gain * n) AS g FROM a0t WHERE f IS NOT NULL GROUP BY f)
SELECT n.name AS feature, round(coalesce(w.g, 0) / (SELECT sum(g) FROM w), 6) AS importance
FROM (VALUES (0, 'l_quantity'), (1, 'l_discount'), (2, 'l_tax')) n(i, name) LEFT JOIN w ON w.f = n.i""", ids="F19 F14")
def q_tree_importances(spark, sf_dir):
    m = md.fit_tree(_tree_rows(spark, sf_dir), "y", _LI_X, depth=3, bins=64)
    return tr.importances_by_nodes(tr.node_table(m), _LI_X).select("feature", F.round("importance", 6).alias("importance"))


@register("forest_by_nodes", f"""
SELECT count(*) AS feature_rows, 10 AS trees, true AS same_scores, true AS same_importances
FROM (SELECT DISTINCT x0, x1, x2 FROM {_TREE_ROWS})""", ids="F15 F19")
def q_forest_by_nodes(spark, sf_dir):
    """Scores and importances of a forest from its node table are those of the model."""
    x = _tree_rows(spark, sf_dir)
    m = md.fit_forest(x, "y", _LI_X, trees=10, depth=4)
    nodes, rows = tr.node_table(m), x.select(*_LI_X).distinct()
    both = tr.score_by_nodes(rows, nodes, _LI_X, _LI_X, boosted=False).join(md.score_rows(m, rows, _LI_X, F.col("prediction"), "p"), _LI_X)
    one = both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("prediction") - F.col("p"))).alias("d")).first()
    mine = {r["feature"]: r["importance"] for r in tr.importances_by_nodes(nodes, _LI_X).collect()}
    same = all(abs(mine[f] - v) < 1e-9 for f, v in md.importances(m, _LI_X))
    trees = nodes.agg(F.count_distinct("tree")).first()[0]
    return _rows(spark, [(one["n"], trees, one["d"] < 1e-9, same)], "feature_rows long, trees int, same_scores boolean, same_importances boolean")


def _vector_columns(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    d = vector_width(e, "embedding")
    return e.select("vec_id", (F.col("label") < 5).cast("double").alias("y"), *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(d)])


@register("forest_classifier", "SELECT CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS rows, true AS beats_majority FROM embeddings", ids="F15 M05")
def q_forest_classifier(spark, sf_dir):
    """Classes by the signs of the first two cells: the forest must beat the largest class."""
    x = _vector_columns(spark, sf_dir).withColumn("y", F.when(F.col("e0") > 0, F.lit(1.0)).otherwise(F.lit(0.0)) + F.when(F.col("e1") > 0, F.lit(2.0)).otherwise(F.lit(0.0)))
    s = random_split_exact(x, "vec_id", 0.2, 42)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    xs = [c for c in x.columns if c.startswith("e")]
    m = md.fit_forest(train, "y", xs, trees=20, depth=6, classifier=True)
    scored = md.score_rows(m, test, xs, F.col("prediction"), "p")
    share = test.groupBy("y").count().agg((F.max("count") / F.sum("count")).alias("top"))
    return mt.accuracy(scored, "y", "p").crossJoin(scored.agg(F.count("p").alias("rows"))).crossJoin(share).select(
        "rows", (F.col("accuracy") > F.col("top")).alias("beats_majority"))


@register("linear_svc", "SELECT CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS rows, true AS accuracy_in_range FROM embeddings", ids="F18")
def q_linear_svc(spark, sf_dir):
    """Scored on rows that it was not trained on."""
    s = random_split_exact(_vector_columns(spark, sf_dir), "vec_id", 0.2, 42)
    xs = [c for c in s.columns if c.startswith("e")]
    m = md.fit_linear_svc(s.where(F.col("split") == "train"), "y", xs)
    scored = md.score_rows(m, s.where(F.col("split") == "test"), xs, F.col("prediction"), "p")
    return scored.agg(F.count("p").alias("rows"), F.avg((F.col("p") == F.col("y")).cast("double")).between(0.3, 1.0).alias("accuracy_in_range"))


@register("linear_svc_signs", "SELECT CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS rows, true AS beats_majority FROM embeddings", ids="F18")
def q_linear_svc_signs(spark, sf_dir):
    """Two classes by a sum of two cells: better than the larger class by at least a tenth of the rows, on rows not trained on."""
    x = _vector_columns(spark, sf_dir).withColumn("y", (F.col("e0") + F.col("e1") / 2 > 0).cast("double"))
    s = random_split_exact(x, "vec_id", 0.2, 42)
    xs = [c for c in x.columns if c.startswith("e")]
    m = md.fit_linear_svc(s.where(F.col("split") == "train"), "y", xs)
    scored = md.score_rows(m, s.where(F.col("split") == "test"), xs, F.col("prediction"), "p")
    ones = F.avg("y")
    return scored.agg(F.count("p").alias("rows"), (F.avg((F.col("p") == F.col("y")).cast("double")) > F.greatest(ones, 1 - ones) + 0.1).alias("beats_majority"))


@register("model_roundtrip", "SELECT CAST(count(*) AS BIGINT) AS rows, 0.0::DOUBLE AS max_diff FROM lineitem", ids="K07 F20 K06")
def q_model_roundtrip(spark, sf_dir):
    li = with_row_id(table(spark, sf_dir, "lineitem").select(*_LI_X, "l_extendedprice", "l_orderkey", "l_linenumber"))
    model = md.linear_pipeline(_LI_X, "l_extendedprice").fit(li)
    loaded = md.save_and_load(model, scratch_path(spark, "model"))
    path = scratch_path(spark, "predictions")
    loaded.transform(li).select("rid", "prediction").write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    a = model.transform(li).select("rid", F.col("prediction").alias("p0"))
    return a.join(back, "rid").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("p0") - F.col("prediction"))).alias("max_diff"))


@register("cross_val", """
WITH p AS (SELECT o_orderkey, o_totalprice AS y, dayofyear(o_orderdate) AS x,
             row_number() OVER (ORDER BY md5('42' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
f AS (SELECT *, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1) ELSE n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM p),
c AS (SELECT k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f, (SELECT DISTINCT fold FROM f) k WHERE f.fold <> k.fold GROUP BY k.fold)
SELECT CAST(fold AS INTEGER) AS fold, round(sqrt(avg((y - a - b * x) ** 2)), 3) AS rmse FROM f JOIN c USING (fold) GROUP BY fold""", ids="V01 R05")
def q_cross_val(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.dayofyear("o_orderdate").alias("doy"))
    scores = md.cross_val_scores(o, "o_orderkey", "o_totalprice", ["doy"], lambda: LinearRegression(
        featuresCol="features", labelCol="o_totalprice", regParam=0.0, solver="normal"), k=5)
    return _rows(spark, [(f, round(s, 3)) for f, s in scores], "fold int, rmse double")


_HOUSE_X = ["c_acctbal", "n_orders", "order_sum"]


def _prepared_housing(spark, sf_dir):
    """The housing-like table with imputed numbers; target in thousands."""
    h = housing(spark, sf_dir).where(F.col("target").isNotNull())
    h = h.select("c_custkey", "c_acctbal", F.col("n_orders").cast("double").alias("n_orders"), "order_sum", (F.col("target") / 1000).alias("y"))
    return materialize(pr.impute(h, _HOUSE_X, "median"), "housing")


def _forest():
    return RandomForestRegressor(featuresCol="features", labelCol="y", seed=42)


def _search_rows(spark, res):
    """Number, parameters and whether the score is a finite number above 0, for every setting."""
    return _rows(spark, [(i, json.dumps(p, sort_keys=True), bool(0 < s < float("inf"))) for i, (p, s) in enumerate(res)], "trial int, params string, scored boolean")


def _search_sql(sets) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{json.dumps(p, sort_keys=True)}', true)" for i, p in enumerate(sets)) + ") t(trial, params, scored)"


_GRIDS = [{"numTrees": [3, 10, 20], "maxDepth": [2, 3, 4, 5]}, {"subsamplingRate": [0.8], "numTrees": [3, 10], "featureSubsetStrategy": ["1", "2", "all"]}]


@register("grid_search", _search_sql(md.expand_grids(_GRIDS)), ids="V02")
def q_grid_search(spark, sf_dir):
    """A list of two grids: 12 and 6 settings in 5 folds."""
    return _search_rows(spark, md.grid_search(_prepared_housing(spark, sf_dir), "c_custkey", "y", _HOUSE_X, _forest(), _GRIDS, k=5, parallelism=8))


_STRATEGIES = ["mean", "median", "most_frequent"]


@register("preparation_search", _search_sql([{"strategy": s, "top_k": k} for s in _STRATEGIES for k in (1, 2, 3)]), ids="V05 F01 F10")
def q_preparation_search(spark, sf_dir):
    """Imputer strategy and number of features, on customers of whom some have no orders."""
    y = (F.col("c_acctbal") / 7 + F.coalesce("order_sum", F.lit(0.0)) / 1e5).alias("y")
    h = housing(spark, sf_dir).select("c_custkey", "c_acctbal", F.col("n_orders").cast("double").alias("n_orders"), "order_sum", y)
    rank = lambda d: [r["column"] for r in mt.corr_with_target(d, _HOUSE_X, "y").orderBy(F.desc(F.abs("corr")), "column").collect()]
    make = lambda: LinearRegression(featuresCol="features", labelCol="y", regParam=0.01)
    return _search_rows(spark, md.preparation_search(h, "c_custkey", "y", _HOUSE_X, make, _STRATEGIES, [1, 2, 3], rank))


_SPACE = {"regParam": ("loguniform", 1e-6, 1e2), "aggregationDepth": ("int", 2, 4)}


@register("random_search", "SELECT CAST(60 AS BIGINT) AS trials, true AS scored, true AS in_range", ids="V03 S13")
def q_random_search(spark, sf_dir):
    """60 trials in 5 folds."""
    ridge = LinearRegression(featuresCol="features", labelCol="y", solver="normal")
    res = md.random_search(_prepared_housing(spark, sf_dir), "c_custkey", "y", _HOUSE_X, ridge, _SPACE, trials=60, k=5, parallelism=8)
    ok = all(0 < s < float("inf") for _, s in res)
    inside = all(lo <= p[n] <= hi for p, _ in res for n, (_, lo, hi) in _SPACE.items())
    return _rows(spark, [(len(res), ok, inside)], "trials long, scored boolean, in_range boolean")


@register("random_search_stops", "SELECT CAST(8 AS BIGINT) AS trials, CAST(12 AS BIGINT) AS after_restart, true AS same_scores", ids="V03")
def q_random_search_stops(spark, sf_dir):
    """A search in batches of four that ends when a batch brings less than the gain asked for; a second one with the same log runs
    only what the first has not, and finds its scores."""
    ridge = LinearRegression(featuresCol="features", labelCol="y", solver="normal")
    data, log = _prepared_housing(spark, sf_dir), scratch_path(spark, "trials")
    common = dict(k=3, parallelism=4, batch=4, log=log)
    a = md.random_search(data, "c_custkey", "y", _HOUSE_X, ridge, _SPACE, trials=12, min_gain=float("inf"), **common)
    b = md.random_search(data, "c_custkey", "y", _HOUSE_X, ridge, _SPACE, trials=12, **common)
    return _rows(spark, [(len(a), len(b), b[: len(a)] == a and spark.read.parquet(log).count() == len(b))], "trials long, after_restart long, same_scores boolean")


_PENALTIES = (0.0, 10.0, 1000.0, 100000.0)


@register("ridge_search", f"""
WITH p AS (SELECT o_orderkey, o_totalprice / 1000::DOUBLE AS y, dayofyear(o_orderdate)::DOUBLE AS x,
             row_number() OVER (ORDER BY md5('42' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
f AS (SELECT *, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1) ELSE n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM p),
c AS (SELECT k.fold, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS cxy, var_pop(x) AS cxx FROM f, (SELECT DISTINCT fold FROM f) k WHERE f.fold <> k.fold GROUP BY k.fold)
SELECT l.penalty, CAST(fold AS INTEGER) AS fold, round(sqrt(avg((y - my - cxy / (cxx + l.penalty) * (x - mx)) ** 2)), 6) AS rmse
FROM f JOIN c USING (fold), (VALUES {", ".join(f"({p}::DOUBLE)" for p in _PENALTIES)}) l(penalty) GROUP BY l.penalty, fold""", ids="V02 V01")
def q_ridge_search(spark, sf_dir):
    """Four penalties in five folds from one scan."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("y"), F.dayofyear("o_orderdate").alias("doy"))
    scores = md.ridge_search(o, "o_orderkey", "y", ["doy"], _PENALTIES, k=5)
    return _rows(spark, [(p, f, round(s, 6)) for p, f, s in scores], "penalty double, fold int, rmse double")


_HALVING = [{"numTrees": t, "maxDepth": d} for t, d in ((2, 2), (4, 3), (6, 4), (8, 5))]


@register("halving_search", """
SELECT CAST(round AS INTEGER) AS round, CAST(n AS BIGINT) AS candidates, true AS scored FROM (VALUES (0, 4), (1, 1)) t(round, n)""", ids="V04 R08")
def q_halving_search(spark, sf_dir):
    log = md.halving_search(_prepared_housing(spark, sf_dir), "c_custkey", "y", _HOUSE_X, _forest(), _HALVING, eta=3, min_fraction=1 / 3)
    rounds = sorted({r for r, _, _ in log})
    return _rows(spark, [(r, sum(x == r for x, _, _ in log), all(0 < s < float("inf") for x, _, s in log if x == r)) for r in rounds], "round int, candidates long, scored boolean")


@register("trial_table", """
WITH p AS (SELECT o_orderkey, o_orderpriority, o_totalprice / 100000::DOUBLE AS score,
             row_number() OVER (ORDER BY md5('42' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS pos,
             count(*) OVER () AS n FROM orders),
f AS (SELECT *, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1)
                     ELSE n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM p),
s AS (SELECT o_orderpriority AS trial, fold, avg(score) AS score FROM f GROUP BY 1, 2),
t AS (SELECT trial, avg(score) AS mean_score, stddev_pop(score) AS std_score, CAST(count(*) AS BIGINT) AS folds FROM s GROUP BY 1)
SELECT trial, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score, folds,
       CAST(row_number() OVER (ORDER BY mean_score, trial) AS INTEGER) AS rank FROM t""", ids="V06 R05 A17")
def q_trial_table(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 1e5).alias("score"))
    f = kfold(o, "o_orderkey", 5, 42)
    s = f.groupBy(F.col("o_orderpriority").alias("trial"), "fold").agg(F.avg("score").alias("score"))
    t = md.trial_table(s, "trial", "score")
    return t.select("trial", F.round("mean_score", 6).alias("mean_score"), F.round("std_score", 6).alias("std_score"),
                    "folds", "rank")


@register("blend", """
WITH n AS (SELECT count(*) AS n, CAST(floor(count(*) * 0.4::DOUBLE) AS BIGINT) AS rest FROM embeddings)
SELECT rest - CAST(floor(rest * 0.5::DOUBLE) AS BIGINT) AS hold_rows, CAST(floor(rest * 0.5::DOUBLE) AS BIGINT) AS rows, true AS auc_in_range FROM n""", ids="E07 F13 R02")
def q_blend(spark, sf_dir):
    x = _vector_columns(spark, sf_dir)
    cells = [c for c in x.columns if c.startswith("e")]
    s = random_split_exact(x, "vec_id", 0.4, 42)
    rest = s.where(F.col("split") == "test").drop("split", "pos")
    train = s.where(F.col("split") == "train").drop("split", "pos")
    h = random_split_exact(rest, "vec_id", 0.5, 7)
    hold, test = h.where(F.col("split") == "train").drop("split", "pos"), h.where(F.col("split") == "test").drop("split", "pos")
    half = len(cells) // 2      # two base models on the two halves of the vector
    out = md.blend(train, hold, test, "y", {"b1": cells[:half], "b2": cells[half:]})
    auc = mt.roc_auc(out, "y", "blend")
    return hold.agg(F.count(F.lit(1)).alias("hold_rows")).crossJoin(out.agg(F.count("blend").alias("rows"))).crossJoin(
        auc.select(F.col("auc").between(0.0, 1.0).alias("auc_in_range")))


@register("tabular_regression", """
SELECT unnest(['linear', 'forest']) AS model, true AS has_interval""", ids="T03 R04 F09 F11 F15 M10")
def q_tabular_regression(spark, sf_dir):
    h = housing(spark, sf_dir).where(F.col("target").isNotNull()).withColumn("n_orders", F.col("n_orders").cast("double"))
    h = h.withColumn("bal_bin", F.least(F.ceil((F.col("c_acctbal") + 1000) / 2500), F.lit(5)))
    s = materialize(stratified_split(materialize(h, "housing"), "c_custkey", "bal_bin", 0.2, 42), "split")     # fits and scores read it many times
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    num = ["c_acctbal", "n_orders", "order_sum"]
    prep = lambda d: pr.prepare(d, num, ["c_mktsegment"], strategy="median", fit_on=train,
                                known={"c_mktsegment": SEGMENTS})
    tr, te = prep(train), prep(test)
    tr, te = materialize(tr, "train"), materialize(te, "test")
    rows = []
    for name, est in (("linear", LinearRegression(featuresCol="features", labelCol="target")),
                      ("forest", RandomForestRegressor(featuresCol="features", labelCol="target", numTrees=10, seed=42))):
        ci = mt.rmse_ci(est.fit(tr).transform(te), "target", "prediction", 0.95, method="t").first()
        rows.append((name, bool(0 < ci["rmse"] <= ci["upper"] and not ci["lower"] > ci["rmse"])))
    return _rows(spark, rows, "model string, has_interval boolean")


@register("impute_by_model", f"""
WITH n AS {NULLABLE_SQL}, m AS (SELECT regr_slope(qty, o_totalprice) AS b, regr_intercept(qty, o_totalprice) AS a FROM n)
SELECT o_orderkey, round(coalesce(qty, a + b * o_totalprice), 4) AS qty FROM n, m""", ids="F02")
def q_impute_by_model(spark, sf_dir):
    f = md.impute_by_model(nullable(spark, sf_dir), "qty", ["o_totalprice"])
    return f.select("o_orderkey", F.round("qty", 4).alias("qty"))


@register("run_models", "SELECT unnest(['LR', 'RF']) AS model, true AS beats_mean, true AS has_all_scores", ids="V07 M15")
def q_run_models(spark, sf_dir):
    train, test = _lineitem_split(spark, sf_dir)
    t = md.run_models(train, test, "y", _LI_X, ["linear", "RF"])
    full = F.lit(True)
    for c in ("MAE", "MSE", "RMSE", "MAPE", "SMAPE", "R2"):
        full = full & F.col(c).isNotNull()
    return t.select("model", (F.col("R2").cast("double") > 0).alias("beats_mean"), full.alias("has_all_scores"))


@register("run_models_all", "SELECT unnest(['LR', 'DT', 'RF', 'GBT']) AS model, true AS beats_mean, true AS has_all_scores", ids="V07 M15 F14 F16")
def q_run_models_all(spark, sf_dir):
    train, test = _lineitem_split(spark, sf_dir)
    t = md.run_models(train, test, "y", _LI_X, ["all"])
    full = F.lit(True)
    for c in ("MAE", "MSE", "RMSE", "MAPE", "SMAPE", "R2"):
        full = full & F.col(c).isNotNull()
    return t.select("model", (F.col("R2").cast("double") > 0).alias("beats_mean"), full.alias("has_all_scores"))
