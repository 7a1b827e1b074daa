"""Fitted trees as a table of nodes (F14–F16, F19): one row for each node, from which scores and importances are
recomputed by joins and aggregates.

The table comes from the model's own saved form, so the driver does not walk the trees.  Nodes are numbered as in a heap:
the root is 1, the children of ``n`` are ``2n`` and ``2n + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.io import scratch_path


def node_table(model) -> DataFrame:
    """``tree, node, feature, threshold, left_values, value, impurity, gain, rows, weight, tree_weight`` of a fitted tree, forest or
    boosted ensemble.  ``feature`` is null at a leaf; a split sends values up to ``threshold`` (of a categorical feature: those in
    ``left_values``) to the left; ``value`` is the node's prediction, ``rows`` its number of rows, ``weight`` their weights' sum."""
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    data = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.select(F.lit(0).alias("tree"), "*")
    weights = [float(w) for w in getattr(model, "treeWeights", [1.0])]
    regression = "Regression" in type(model).__name__
    stats = F.col("impurityStats")
    flat = data.select("tree", "id", F.col("leftChild").alias("l"), F.col("rightChild").alias("r"),
                       F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature"),
                       F.when((F.col("leftChild") >= 0) & (F.col("split.numCategories") < 0), F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
                       F.when((F.col("leftChild") >= 0) & (F.col("split.numCategories") >= 0), F.col("split.leftCategoriesOrThreshold")).alias("left_values"),
                       F.col("prediction").alias("value"), "impurity", F.when(F.col("leftChild") >= 0, F.col("gain")).alias("gain"), F.col("rawCount").alias("rows"),
                       (F.get(stats, F.lit(0)) if regression else F.aggregate(stats, F.lit(0.0), lambda a, c: a + c)).alias("weight"),
                       F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("tree") + 1).alias("tree_weight"))

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        kids = {i: (a, b) for i, a, b in zip(pdf["id"], pdf["l"], pdf["r"]) if a >= 0}
        place, todo = {0: 1}, [0]
        while todo:
            i = todo.pop()
            for child, at in zip(kids.get(i, ()), (2 * place[i], 2 * place[i] + 1)):
                place[child] = at
                todo.append(child)
        return pd.DataFrame({"tree": pdf["tree"], "id": pdf["id"], "node": pdf["id"].map(place)})

    places = flat.select("tree", "id", "l", "r").groupBy("tree").applyInPandas(number, "tree int, id int, node long")      # the nodes of one tree
    return materialize(flat.join(places, ["tree", "id"]).select("tree", "node", *[c for c in flat.columns if c not in ("tree", "id", "l", "r")]), "nodes")


def leaves_of(df: DataFrame, nodes: DataFrame, xs: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``key…, tree, node, value, tree_weight``: the leaf of every row in every tree, one join with the nodes for each level.  A
    row with a null feature has no leaves; NaN goes right, as it does in the models."""
    size = nodes.agg(F.max("tree").alias("t"), F.max(F.when(F.col("feature").isNotNull(), F.floor(F.log2("node")))).alias("d")).first()
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in xs])
    at = df.where(whole).select(*key, F.array(*[F.col(c).cast("double") for c in xs]).alias("_x"),
                                F.explode(F.sequence(F.lit(0), F.lit(size["t"] or 0))).alias("tree"), F.lit(1).cast("long").alias("node"))
    splits = nodes.where(F.col("feature").isNotNull()).select("tree", "node", "feature", "threshold", "left_values")
    for _ in range(0 if size["d"] is None else int(size["d"]) + 1):
        x = F.get("_x", F.col("feature"))
        left = F.when(F.col("threshold").isNull(), F.array_contains("left_values", x)).otherwise(x <= F.col("threshold"))
        step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 0).otherwise(1))
        at = at.join(splits, ["tree", "node"], "left").select(*key, "_x", "tree", step.alias("node"))
    return at.join(nodes.select("tree", "node", "value", "tree_weight"), ["tree", "node"]).select(*key, "tree", "node", "value", "tree_weight")


def score_by_nodes(df: DataFrame, nodes: DataFrame, xs: Sequence[str], key: Sequence[str], boosted: bool) -> DataFrame:
    """``key…, prediction`` by the node table alone: the weighted sum of the trees' values, or their mean.  Every row counts, so
    ``key`` should be unique; rows with a null feature get null."""
    found = leaves_of(df, nodes, xs, key).groupBy(*key)
    total = found.agg((F.sum(F.col("value") * F.col("tree_weight")) if boosted else F.avg("value")).alias("prediction"))
    return df.select(*key).distinct().join(total, list(key), "left")


def importances_by_nodes(nodes: DataFrame, names: Sequence[str], boosted: bool = False) -> DataFrame:
    """``feature, importance``, descending: gains weighted with the rows that they part, summed by feature; of a forest each
    tree's make 1 first; all make 1.  Features that part nothing have 0."""
    parts = nodes.where(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    if not boosted:
        parts = parts.join(parts.groupBy("tree").agg(F.sum("g").alias("s")), "tree").withColumn("g", F.try_divide("g", "s"))
    sums = parts.groupBy("feature").agg(F.sum("g").alias("g"))
    every = nodes.sparkSession.createDataFrame(list(enumerate(names)), "i int, name string")
    total = sums.agg(F.sum("g").alias("total"))
    out = every.join(sums, F.col("i") == F.col("feature"), "left").crossJoin(total)       # one row
    return out.select(F.col("name").alias("feature"), F.coalesce(F.try_divide("g", "total"), F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")
