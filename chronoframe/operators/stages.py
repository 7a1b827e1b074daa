"""F09 as ML pipeline stages: an estimator that learns fill values, means, deviations and categories, and the
transformer with what it has learned; ratio features, the choice of features, and the encoding of wide columns as
stages of their own.  All keep their settings in one JSON parameter, so pipelines that hold them can be saved and read
back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import prepare as pr
from .metrics import corr_with_target


class _Settings(Params):
    settings = Param(Params._dummy(), "settings", "settings or fitted values as JSON", typeConverter=TypeConverters.toString)

    def _put(self, **values) -> None:
        self._set(settings=json.dumps(values))

    def _got(self) -> dict:
        return json.loads(self.getOrDefault(self.settings))


class ColumnPreparer(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fit: one aggregate for the fill values (:func:`prepare.fit_imputer`), one for means and population
    deviations of the filled columns, and the sorted categories."""

    @keyword_only
    def __init__(self, numeric: Sequence[str] = (), categorical: Sequence[str] = (), strategy: str = "median"):
        super().__init__()
        self._put(numeric=list(numeric), categorical=list(categorical), strategy=strategy)

    def _fit(self, df: DataFrame) -> ColumnPreparerModel:
        s = self._got()
        fills = pr.fit_imputer(df, s["numeric"], s["strategy"])
        stats = pr.fit_standard(pr.apply_imputer(df, fills, s["numeric"]), s["numeric"])
        fill, stat = fills.first(), stats.first()          # one row each
        columns = {c: {"fill": fill[f"_fill_{c}"], "mean": stat[f"_mu_{c}"], "std": stat[f"_sd_{c}"]} for c in s["numeric"]}
        return ColumnPreparerModel(columns=columns, categories={c: pr.categories(df, c) for c in s["categorical"]})


class ColumnPreparerModel(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Apply: plain column expressions with the fitted values as literals."""

    @keyword_only
    def __init__(self, columns: dict | None = None, categories: dict | None = None):
        super().__init__()
        self._put(columns=columns or {}, categories=categories or {})

    def _transform(self, df: DataFrame) -> DataFrame:
        s, types = self._got(), dict(df.dtypes)
        new = {}
        for c, v in s["columns"].items():
            x = F.nanvl(F.col(c), F.lit(None)) if types[c] in ("double", "float") else F.col(c)
            new[c] = (F.coalesce(x.cast("double"), F.lit(v["fill"])) - F.lit(v["mean"])) / F.lit(v["std"] or 1.0)
        df = df.withColumns(new) if new else df
        for c, values in s["categories"].items():
            df = pr.one_hot(df, c, values)
        return df


class RatioFeatures(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """P17 as a stage: for every ``(name, above, below)`` a column ``above / below``, null where the divisor is 0."""

    @keyword_only
    def __init__(self, ratios: Sequence[tuple[str, str, str]] = ()):
        super().__init__()
        self._put(ratios=[list(r) for r in ratios])

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {name: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) for name, a, b in self._got()["ratios"]}
        return df.withColumns(new) if new else df


class TopFeatures(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """F10 as a stage: fit ranks ``features`` by the size of their correlation with ``target`` (ties by name; none last) and keeps ``k``."""

    @keyword_only
    def __init__(self, features: Sequence[str] = (), target: str = "", k: int = 1):
        super().__init__()
        self._put(features=list(features), target=target, k=k)

    def _fit(self, df: DataFrame) -> TopFeaturesModel:
        s = self._got()
        ranked = corr_with_target(df, s["features"], s["target"]).select(F.col("column").alias("feature"), F.coalesce(F.abs("corr"), F.lit(-1.0)).alias("importance"))
        return TopFeaturesModel(drop=sorted(set(s["features"]) - set(pr.top_features(ranked, s["k"]))))


class TopFeaturesModel(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Leaves out the features that were not kept; other columns stay."""

    @keyword_only
    def __init__(self, drop: Sequence[str] | None = None):
        super().__init__()
        self._put(drop=list(drop or ()))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self._got()["drop"])


class WideEncoder(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """F04 for columns of any number of categories: fit writes the dictionary as a table below ``folder`` (a new one for each fit), and the
    model keeps its path only."""

    @keyword_only
    def __init__(self, columns: Sequence[str] = (), folder: str = "", output: str = "hot"):
        super().__init__()
        self._put(columns=list(columns), folder=folder, output=output)

    def _fit(self, df: DataFrame) -> WideEncoderModel:
        s = self._got()
        path = f"{s['folder'].rstrip('/')}/dictionary-{uuid.uuid4().hex[:12]}"
        pr.wide_dictionary(df, s["columns"]).write.parquet(path)
        return WideEncoderModel(columns=s["columns"], path=path, output=s["output"])


class WideEncoderModel(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """One dictionary join for each column; ``output`` is a struct (size, indices, values)."""

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None, path: str = "", output: str = "hot"):
        super().__init__()
        self._put(columns=list(columns or ()), path=path, output=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self._got()
        return pr.one_hot_sparse(df, df.sparkSession.read.parquet(s["path"]), s["columns"], s["output"])
