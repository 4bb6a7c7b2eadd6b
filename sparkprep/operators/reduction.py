"""Principal components: enough of them for a share of the variance, or a given number."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark import keyword_only
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import col, number, numeric_columns, require, small_frame
from sparkprep.functions.statistics import column_statistics
from sparkprep.operators.stages import FittedModel, FittingStage, listed, parameter
from sparkprep.operators.wide import centred_array, covariance, principal_axes
from sparkprep.workspace import land

#: Columns up to which a row's vector is assembled from columns of its own.
ASSEMBLED = 1_000


def select_components(
    ratios: list[float], threshold: float, n_components: int | None, rows: int
) -> int:
    """Smallest number whose cumulative ratio reaches the threshold, else all."""
    limit = max(1, min(len(ratios), rows))
    if n_components is not None:
        return max(1, min(n_components, limit))
    total = 0.0
    for i, r in enumerate(ratios[:limit]):
        total += r
        if total >= threshold:
            return i + 1
    return limit


def centred_vectors(df: DataFrame, columns: list[str], means: list[float], out: str) -> DataFrame:
    """The row with ``out``, the vector of its values minus the fitted means.

    A missing value is an error, as a component score would have none.
    """
    if len(columns) > ASSEMBLED:
        return df.withColumn(out, array_to_vector(centred_array(df, columns, means)))
    shifted = {f"__x{i}": number(df, c) - F.lit(m) for i, (c, m) in enumerate(zip(columns, means))}
    assembler = VectorAssembler(inputCols=list(shifted), outputCol=out, handleInvalid="error")
    return assembler.transform(df.withColumns(shifted)).drop(*shifted)


def _pca_model(spark, axes: np.ndarray, ratios: list[float]) -> PCAModel:
    jvm = spark._jvm.org.apache.spark.ml.feature
    matrix = _py2java(spark.sparkContext, DenseMatrix(*axes.shape, axes.ravel(order="F")))
    shares = _py2java(spark.sparkContext, Vectors.dense(ratios))
    made = jvm.PCAModel(f"pca_{uuid.uuid4().hex[:12]}", matrix, shares)
    made.set(made.getParam("k"), len(ratios))
    return PCAModel(made).setInputCol("__x").setOutputCol("__pc")


class _ReducerParams:
    variance_threshold = parameter("variance_threshold", "cumulative share of variance to keep")
    n_components = parameter("n_components", "fixed number of components instead")
    max_columns = parameter("max_columns", "columns of one covariance matrix; more are reduced by subspace iteration")
    max_components = parameter("max_components", "components the iteration may take to reach the threshold")


class FeatureReducer(FittingStage, _ReducerParams):
    @keyword_only
    def __init__(
        self,
        *,
        variance_threshold=0.95,
        n_components=None,
        max_columns=5_000,
        max_components=256,
        label=presets.LABEL,
        split_col=presets.SPLIT,
        preserve_cols=tuple(presets.PRESERVED),
    ):
        super().__init__()
        self._setDefault(
            variance_threshold=0.95,
            n_components=None,
            max_columns=5_000,
            max_components=256,
            label=presets.LABEL,
            split_col=presets.SPLIT,
            preserve_cols=list(presets.PRESERVED),
        )
        self._set(**listed(self._input_kwargs))

    def columns_of(self, dataset: DataFrame) -> list[str]:
        columns = numeric_columns(dataset, self.metadata())
        if not columns:
            raise ValueError("no numeric columns for principal components")
        return columns

    def _fit(self, dataset: DataFrame) -> "FeatureReducerModel":
        columns = self.columns_of(dataset)
        found = column_statistics(dataset, columns, {"rows": lambda v: F.count(F.lit(1)), "mean": F.avg})
        means = [found[c]["mean"] if found[c]["mean"] is not None else 0.0 for c in columns]
        return self.fit_centred(dataset, columns, means, found[columns[0]]["rows"] or 0)

    def fit_centred(self, dataset: DataFrame, columns: list[str], means: list[float], rows: int) -> "FeatureReducerModel":
        """The model of ``columns`` whose means and number of rows are known."""
        if rows < 2:
            raise ValueError("principal components need at least two rows")
        if len(columns) > self.value("max_columns"):
            pca, ratios = self._iterated(dataset, columns, means, rows)
        else:
            shifted = [(number(dataset, c) - F.lit(float(m))).alias(f"__x{i}") for i, (c, m) in enumerate(zip(columns, means))]
            axes, variances, _ = np.linalg.svd(covariance(dataset.select(*shifted), rows))
            with np.errstate(invalid="ignore"):  # columns without variance have no shares
                ratios = [float(r) for r in variances / variances.sum()]
            pca = _pca_model(dataset.sparkSession, axes, ratios)
        k = select_components(
            ratios, self.value("variance_threshold"), self.value("n_components"), rows
        )
        axes = pca.pc.toArray()
        largest = np.abs(axes).argmax(axis=0)
        signs = np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        model = self.fitted_model(
            FeatureReducerModel,
            {
                "columns": columns,
                "means": means,
                "components": k,
                "ratios": ratios[:k],
                "signs": [float(s) for s in signs[:k]],
                "rows": rows,
            },
        )
        model.pca = pca
        return model


    def _iterated(self, dataset, columns: list[str], means: list[float], rows: int) -> tuple[PCAModel, list[float]]:
        """The model of more columns than one covariance matrix takes; the centred rows are landed, as each round reads them."""
        spark = dataset.sparkSession
        spread = column_statistics(dataset, columns, {"variance": F.var_samp})
        total = sum(spread[c]["variance"] or 0.0 for c in columns)
        landed = land(dataset.select(centred_array(dataset, columns, means).alias("x")), "centred-rows")
        settings = (self.value(p) for p in ("variance_threshold", "n_components", "max_components"))
        axes, ratios = principal_axes(landed, len(columns), rows, total, *settings)
        return _pca_model(spark, axes, ratios), ratios


class _ReducerWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.pca.write().save(f"{path}/pca")


class _ReducerReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.pca = PCAModel.load(f"{path}/pca")
        return model


class FeatureReducerModel(FittedModel, _ReducerParams):
    """Projects on the fitted axes, centred by the fitted means; the sign of an axis makes
    its largest loading positive. Keeps the metadata columns, drops every other one."""

    def __init__(self, state: dict | None = None, **settings):
        super().__init__(state, **settings)
        self.pca: PCAModel | None = None

    def copy(self, extra=None):
        that = super().copy(extra)
        that.pca = self.pca
        return that

    def write(self):
        return _ReducerWriter(self)

    @classmethod
    def read(cls):
        return _ReducerReader(cls)

    def _require_fitted(self) -> None:
        if self.pca is None:
            raise ValueError("the reducer has not been fitted")

    @property
    def component_columns(self) -> list[str]:
        return [f"PC{i + 1}" for i in range(self.fitted["components"])]

    def explained_variance_ratio(self) -> list[float]:
        self._require_fitted()
        return list(self.fitted["ratios"])

    def cumulative_variance(self) -> list[float]:
        self._require_fitted()
        return [float(x) for x in np.cumsum(self.fitted["ratios"])]

    def variance_report(self, spark) -> DataFrame:
        """One row per component: own and cumulative share of the variance."""
        both = zip(self.explained_variance_ratio(), self.cumulative_variance())
        rows = [(i + 1, f"PC{i + 1}", r, c) for i, (r, c) in enumerate(both)]
        return small_frame(
            spark, rows, "position int, component string, ratio double, cumulative double"
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self._require_fitted()
        state = self.fitted
        require(dataset, state["columns"])
        kept = [c for c in dataset.columns if c in self.metadata()]
        vectors = centred_vectors(dataset, state["columns"], state["means"], "__x")
        scores = self.pca.transform(vectors).withColumn("__a", vector_to_array("__pc"))
        components = [
            (F.get("__a", F.lit(i)) * F.lit(s)).alias(f"PC{i + 1}")
            for i, s in enumerate(state["signs"])
        ]
        return scores.select(*components, *[col(c) for c in kept])
