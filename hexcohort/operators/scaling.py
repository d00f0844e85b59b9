"""Median imputation and feature scaling with the learned numbers kept as Params.

A fitted model is a pure projection: one literal offset and factor per column.
The standard scaler uses the population deviation; a zero spread scales by 1.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.operators.moments import column_stats
from hexcohort.operators.quantiles import medians, quantile_values

SCALERS = ("standard", "minmax", "robust")


class ImputeModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "columns to fill", TypeConverters.toListString)
    fills = Param(Params._dummy(), "fills", "value per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, fills: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = zip(self.getOrDefault(self.columns), self.getOrDefault(self.fills))
        return dataset.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills})


class MedianImpute(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fills the given columns with their exact medians."""

    columns = Param(Params._dummy(), "columns", "columns to fill", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ImputeModel:
        med = medians(dataset, [c for c in self.getOrDefault(self.columns) if c in dataset.columns])
        return ImputeModel(columns=list(med), fills=[float(v) for v in med.values()])


def scaler_stats(df: DataFrame, columns: list[str], method: str, complete: bool = False) -> tuple[list[float], list[float]]:
    """(offset, divisor) per column; unknown methods count as standard."""
    if method == "robust":
        q = quantile_values(df, columns, [0.25, 0.5, 0.75])
        offset = [q[c][1] for c in columns]
        spread = [q[c][2] - q[c][0] for c in columns]
    else:
        st = column_stats(df, columns, complete)
        offset = [st[c]["lo" if method == "minmax" else "mean"] for c in columns]
        spread = [st[c]["hi"] - st[c]["lo"] if method == "minmax" else st[c]["std"] for c in columns]
    # a constant column leaves only rounding dust, which counts as no spread
    tiny = [10 * 2.220446049250313e-16 * max(abs(o), 1.0) for o in offset]
    return [float(o) for o in offset], [float(s) if s > t else 1.0 for s, t in zip(spread, tiny)]


class ScaleModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    offsets = Param(Params._dummy(), "offsets", "value subtracted per column", TypeConverters.toListFloat)
    spreads = Param(Params._dummy(), "spreads", "divisor per column", TypeConverters.toListFloat)
    fills = Param(Params._dummy(), "fills", "value for NULL per column; empty for none", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector column; empty for none", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of scaled columns; empty for none", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, offsets: list[float] | None = None,
                 spreads: list[float] | None = None, fills: list[float] | None = None,
                 outputCol: str = "features", prefix: str = ""):
        super().__init__()
        self._setDefault(outputCol="features", prefix="", fills=[])
        self._set(**self._input_kwargs)

    def scaled(self) -> dict:
        """Scaled column expressions by column name; the columns themselves stay as they are."""
        cols, fills = self.getOrDefault(self.columns), self.getOrDefault(self.fills)
        value = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in zip(cols, fills)} if fills else {}
        return {c: (value.get(c, F.col(c)) - F.lit(o)) / F.lit(s)
                for c, o, s in zip(cols, self.getOrDefault(self.offsets), self.getOrDefault(self.spreads))}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        exprs, prefix, vec = self.scaled(), self.getOrDefault(self.prefix), self.getOrDefault(self.outputCol)
        if prefix:
            dataset = dataset.withColumns({prefix + c: e for c, e in exprs.items()})
        if vec:
            dataset = dataset.withColumn(vec, array_to_vector(F.array(*exprs.values())))
        return dataset


class Scale(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``standard`` | ``minmax`` | ``robust``; anything else means standard."""

    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "scaling method", TypeConverters.toString)
    impute = Param(Params._dummy(), "impute", "scale NULL as the column median", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column; empty for none", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of scaled columns; empty for none", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, method: str = "standard", impute: bool = False,
                 outputCol: str = "features", prefix: str = ""):
        super().__init__()
        self._setDefault(method="standard", impute=False, outputCol="features", prefix="")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ScaleModel:
        cols = self.getOrDefault(self.columns)
        fills: list[float] = []
        if self.getOrDefault(self.impute):
            med = medians(dataset, cols)
            fills = [float(med.get(c, 0.0)) for c in cols]
            dataset = dataset.select(*[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in zip(cols, fills)])
        offsets, spreads = scaler_stats(dataset, cols, self.getOrDefault(self.method), bool(fills))
        return ScaleModel(columns=cols, offsets=offsets, spreads=spreads, fills=fills,
                          outputCol=self.getOrDefault(self.outputCol), prefix=self.getOrDefault(self.prefix))
