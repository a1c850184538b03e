"""Exact median imputation as a pipeline stage that saves and loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.operators.ranks import exact_quantiles


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    def _name(self, columns: Sequence[str], filled: Sequence[str]) -> None:
        if len(columns) != len(filled):
            raise ValueError("as many output columns as input columns are needed")
        self._set(inputCols=list(columns), outputCols=list(filled))


class ExactMedianImputer(Estimator, _Columns):
    """Fits the exact median (middle of the two middle values) of every input
    column. Null and NaN are missing; a column without values has no median and
    the fit fails."""

    def __init__(self, columns: Sequence[str] = (), filled: Sequence[str] = ()):
        super().__init__()
        self._name(columns, filled)

    def _fit(self, df: DataFrame) -> ExactMedianModel:
        columns = self.getInputCols()
        found = {r["feature"]: r["quantile"] for r in exact_quantiles(df, columns, [0.5]).collect()}  # a row per column
        empty = [c for c in columns if c not in found]
        if empty:
            raise ValueError(f"columns without values have no median: {empty}")
        return ExactMedianModel(columns, self.getOutputCols(), [found[c] for c in columns])


class ExactMedianModel(Model, _Columns):
    """Input columns as doubles with their medians in place of null and NaN."""

    medians = Param(Params._dummy(), "medians", "median of each input column", TypeConverters.toListFloat)

    def __init__(self, columns: Sequence[str] = (), filled: Sequence[str] = (), medians: Sequence[float] = ()):
        super().__init__()
        self._name(columns, filled)
        self._set(medians=list(medians))

    def getMedians(self) -> list[float]:
        return self.getOrDefault(self.medians)

    def _transform(self, df: DataFrame) -> DataFrame:
        def whole(column: str, median: float):
            c = F.col(column).cast("double")
            return F.when(c.isNull() | F.isnan(c), F.lit(median)).otherwise(c)

        return df.withColumns({
            out: whole(c, m) for c, out, m in zip(self.getInputCols(), self.getOutputCols(), self.getMedians())
        })
