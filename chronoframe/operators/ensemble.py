"""Ensembling of prediction tables.

Predictions arrive as one long table ``(method, id, prediction)`` – one method per input file – and are
combined with ``groupBy(id)`` (never a chain of joins, so the number of methods does not multiply the
plan).  Rows are keyed by id only; an id missing from a method is reported by :func:`missing_ids`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import weight_from_name
from .order import global_position


def n_methods(preds: DataFrame, method: str = "method") -> DataFrame:
    """Number of methods (files) as a one-row table."""
    return preds.agg(F.countDistinct(method).alias("_nm"))


def ensemble_mean(preds: DataFrame, id_col: str = "id", value: str = "prediction", method: str = "method",
                  digits: int = 6) -> DataFrame:
    """Per id the sum of predictions divided by the number of *files* (not of the rows the id has),
    rounded to ``digits``."""
    s = preds.groupBy(id_col).agg(F.sum(value).alias("_s"))
    return s.crossJoin(n_methods(preds, method)).select(   # one-row side
        id_col, F.round(F.col("_s") / F.col("_nm"), digits).alias(value))


def ensemble_vote(preds: DataFrame, id_col: str = "id", value: str = "prediction", method: str = "method",
                  weighted: bool = False) -> DataFrame:
    """Majority vote on the textual value per id; with ``weighted`` every vote counts the
    weight in its method's name (X12).  Ties go to the value whose first vote comes from the lowest
    method name, then to the smaller value (A11).  A vote group holds one row per method of one id."""
    v = preds.withColumn("_v", F.col(value).cast("string"))
    w = weight_from_name(F.col(method)) if weighted else F.lit(1.0)
    tally = v.groupBy(id_col, "_v").agg(F.sum(w).alias("_votes"), F.min(method).alias("_first"))
    best = Window.partitionBy(id_col).orderBy(F.desc("_votes"), "_first", "_v")
    return (tally.withColumn("_rk", F.row_number().over(best)).where(F.col("_rk") == 1)
                 .select(id_col, F.col("_v").alias(value), F.col("_votes").alias("votes")))


def ensemble_rank(preds: DataFrame, id_col: str = "id", value: str = "prediction", method: str = "method") -> DataFrame:
    """Rank averaging.  Per method, 0-based position of each row in the order (value, id as text);
    per id the mean position; the result is the 0-based position of that mean over all ids (ties by id
    text) divided by ``n − 1`` (null for one id).  Both positions are range-bucketed (W09), never one task for the table."""
    p = preds.select(method, id_col, value, F.col(id_col).cast("string").alias("_key"))
    per = global_position(p, [value, "_key"], name="_pos", partition_by=[method])
    avg = per.groupBy(id_col, "_key").agg(F.avg("_pos").alias("_mean"))
    fin = global_position(avg, ["_mean", "_key"], name="_r", with_count="_n")
    return fin.select(id_col, F.try_divide(F.col("_r"), F.col("_n") - 1).alias(value))


def minmax_per_method(preds: DataFrame, value: str = "prediction", method: str = "method",
                      group: Sequence[str] = ()) -> DataFrame:
    """F06 per method (and group): ``(x − min) / (max − min)``, a constant method maps to 0."""
    keys = [method, *group]
    st = preds.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    rng = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))
    return preds.join(st, keys).withColumn(value, (F.col(value) - F.col("_lo")) / rng).drop("_lo", "_hi")


def ensemble_minmax(preds: DataFrame, id_col: str = "id", value: str = "prediction", method: str = "method",
                    group: Sequence[str] = ()) -> DataFrame:
    """Min-max scale each method's scores within the evaluated set, then average per id."""
    s = minmax_per_method(preds, value, method, group)
    return s.groupBy(*group, id_col).agg(F.avg(value).alias(value))


def ensemble_proba(preds: DataFrame, id_col: str = "id", value: str = "prediction", group: Sequence[str] = ()) -> DataFrame:
    """Mean of the models' class probabilities per row (the ids' own rows, not the file count)."""
    return preds.groupBy(*group, id_col).agg(F.avg(value).alias(value))


def missing_ids(preds: DataFrame, id_col: str = "id", method: str = "method") -> DataFrame:
    """Ids absent from some method: ``(id, methods_present)`` for ids seen by fewer than all methods."""
    per = preds.groupBy(id_col).agg(F.countDistinct(method).alias("methods_present"))
    return per.crossJoin(n_methods(preds, method)).where(F.col("methods_present") < F.col("_nm")).drop("_nm")


def evaluate_models(preds: DataFrame, model: str, variant: str, y: str, p: str) -> DataFrame:
    """Accuracy of every (model, variant), e.g. fold models on augmented and plain inputs."""
    return preds.groupBy(model, variant).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))
