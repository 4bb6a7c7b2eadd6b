"""Scaling of numeric columns, per column by skewness or one method for all."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import col, number, numeric_columns, small_frame
from sparkprep.functions.statistics import column_statistics
from sparkprep.operators.quantiles import column_quantiles
from sparkprep.operators.stages import FittedModel, FittingStage, listed, parameter

METHODS = ("auto", "standard", "minmax", "robust")


def learn_scaling(
    df: DataFrame, columns: list[str], method: str = "auto", skew_threshold: float = 1.0, quantiles: str = "exact"
) -> dict[str, dict]:
    """Per column: method, centre, scale and the statistics behind them.

    ``auto`` takes min-max where the absolute population skewness exceeds the threshold,
    else standard. A column without spread is only centred.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    found = column_statistics(
        df,
        columns,
        {
            "n": F.count,
            "mean": F.avg,
            "std": F.stddev_pop,
            "min": F.min,
            "max": F.max,
            "skew": F.skewness,
        },
    )
    return scaling_state(df, found, columns, method, skew_threshold, quantiles)


def scaling_state(
    df: DataFrame,
    found: dict[str, dict],
    columns: list[str],
    method: str,
    skew_threshold: float,
    quantiles: str = "exact",
) -> dict[str, dict]:
    """:func:`learn_scaling` from known statistics of the columns of ``df``, which only quartiles are read from."""
    counts = {c: found[c]["n"] or 0 for c in columns}
    quartiles = {}
    if method == "robust":
        quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], counts, quantiles)
    state: dict[str, dict] = {}
    for c in columns:
        low, high, skew = found[c]["min"], found[c]["max"], found[c]["skew"]
        spread = counts[c] > 0 and low != high
        kind = method
        if method == "auto":
            skewed = spread and skew is not None and abs(skew) > skew_threshold
            kind = "minmax" if skewed else "standard"
        if counts[c] == 0:
            centre, scale = 0.0, 1.0
        elif kind == "standard":
            centre, scale = found[c]["mean"], found[c]["std"]
        elif kind == "minmax":
            centre, scale = low, high - low
        else:
            first, centre, third = quartiles[c]
            scale = third - first
        if not spread:
            centre = low if low is not None else 0.0
        state[c] = {
            "method": kind,
            "centre": centre,
            "scale": scale if spread and scale else 1.0,
            "skewness": skew if spread else None,
            "rows": counts[c],
        }
    return state


def apply_scaling(df: DataFrame, state: dict[str, dict]) -> DataFrame:
    """``(x - centre) / scale`` for the fitted columns present; nothing is clipped."""
    out = []
    for name in df.columns:
        if name in state:
            s = state[name]
            scaled = (number(df, name) - F.lit(s["centre"])) / F.lit(s["scale"])
            out.append(scaled.alias(name))
        else:
            out.append(col(name))
    return df.select(*out)


class _ScalerParams:
    method = parameter("method", "auto, standard, minmax or robust")
    skew_threshold = parameter("skew_threshold", "absolute skewness above which auto takes minmax")
    quantiles = parameter("quantiles", "'exact' quartiles for robust, or 'approximate' ones from one pass")


class FeatureScaler(FittingStage, _ScalerParams):
    """Scales every numeric column that is neither label, split tag nor preserved."""

    @keyword_only
    def __init__(
        self,
        *,
        method="auto",
        skew_threshold=1.0,
        quantiles="exact",
        label=presets.LABEL,
        split_col=presets.SPLIT,
        preserve_cols=tuple(presets.PRESERVED),
    ):
        super().__init__()
        self._setDefault(
            method="auto",
            skew_threshold=1.0,
            quantiles="exact",
            label=presets.LABEL,
            split_col=presets.SPLIT,
            preserve_cols=list(presets.PRESERVED),
        )
        self._set(**listed(self._input_kwargs))

    def _fit(self, dataset: DataFrame) -> "FeatureScalerModel":
        columns = numeric_columns(dataset, self.metadata())
        if not columns:
            raise ValueError("no numeric columns to scale")
        state = learn_scaling(
            dataset, columns, self.value("method"), self.value("skew_threshold"), self.value("quantiles")
        )
        return self.fitted_model(FeatureScalerModel, state)


class FeatureScalerModel(FittedModel, _ScalerParams):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return apply_scaling(dataset, self.fitted)

    @property
    def scalers(self) -> dict[str, str]:
        return {c: s["method"] for c, s in self.fitted.items()}

    def scaler_report(self, spark) -> DataFrame:
        rows = [
            (c, s["method"], s["centre"], s["scale"], s["skewness"])
            for c, s in self.fitted.items()
        ]
        return small_frame(
            spark, rows, "column string, method string, centre double, scale double, skewness double"
        )
