"""Fitted preparation of model tables.

``ExactPrepare`` is an ``Estimator`` whose model keeps the exact medians of the numeric
columns, the modes of the category columns and the categories in order. The model fills and
aligns any frame the same way, and is saved and loaded like any other pipeline stage.

A numeric column without values is filled with 0; a category column without values stays
null. A category that the training rows lack gets all zeros. Ties of the mode go to the
smallest value.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .splits import exact_percentiles

FILLED = "__imp"


def _long(df: DataFrame, cols: list[str], kind: str) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(kind).alias("value")) for c in cols]))) \
        .filter(F.col("value").isNotNull())


def category_column(col: str, value: str) -> str:
    """Name of the one-hot column of a category."""
    return f"{col}={value}__oh"


class _Columns(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)


class ExactPrepare(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, numeric=(), categorical=()):
        super().__init__()
        self._set(numeric=list(numeric), categorical=list(categorical))

    def _fit(self, df: DataFrame) -> ExactPrepareModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        medians = {}
        if numeric:
            values = _long(df, numeric, "double").filter(~F.isnan("value"))
            medians = {r["feature"]: r["percentiles"][0] for r in exact_percentiles(values, "value", [0.5], ["feature"]).collect()}    # a row per column
        found: dict[str, list[tuple[int, str]]] = {c: [] for c in categorical}
        if categorical:
            for r in _long(df, categorical, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).collect():   # a row per category
                found[r["feature"]].append((-r["n"], r["value"]))
        model = ExactPrepareModel()
        model._set(numeric=numeric, categorical=categorical, medians=[float(medians.get(c, 0.0)) for c in numeric],
                   modes=[min(found[c])[1] if found[c] else "" for c in categorical],
                   categories=[sorted(v for _, v in found[c]) for c in categorical])
        return model


class ExactPrepareModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<numeric>__imp`` (filled), fills the category columns and adds their one-hot
    columns (see :meth:`outputs`)."""

    medians = Param(Params._dummy(), "medians", "exact medians of the numeric columns", TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "most frequent values of the category columns", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "training categories of each category column", TypeConverters.identity)

    def __init__(self):
        super().__init__()

    def outputs(self) -> tuple[list[str], list[str]]:
        numeric = [c + FILLED for c in self.getOrDefault("numeric")]
        pairs = zip(self.getOrDefault("categorical"), self.getOrDefault("categories"))
        return numeric, [category_column(c, v) for c, values in pairs for v in values]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, m in zip(self.getOrDefault("numeric"), self.getOrDefault("medians")):
            x = F.col(f"`{c}`").cast("double")
            out[c + FILLED] = F.when(x.isNull() | F.isnan(x), F.lit(m)).otherwise(x)
        for c, mode, values in zip(*(self.getOrDefault(p) for p in ("categorical", "modes", "categories"))):
            x = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(mode)) if values else F.col(f"`{c}`").cast("string")
            out[c] = x
            out |= {category_column(c, v): F.coalesce((x == F.lit(v)).cast("double"), F.lit(0.0)) for v in values}
        return df.withColumns(out) if out else df
