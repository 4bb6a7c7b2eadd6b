"""Missing values: drop sparse columns and unlabelled rows, fill the rest."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep import presets
from sparkprep.functions.columns import (
    col,
    number,
    numeric_columns,
    rounded_percent,
    small_frame,
    string_columns,
    value,
)
from sparkprep.functions.statistics import presence
from sparkprep.functions.text import UNKNOWN
from sparkprep.operators.quantiles import column_quantiles
from sparkprep.operators.stages import FittedModel, FittingStage, listed, parameter


def learn_imputation(
    df: DataFrame, label: str, skip: set[str], threshold: float, zero_fill: list[str], quantiles: str = "exact"
) -> dict:
    """Columns to drop and values to fill, from one counting pass and the medians.

    Sparseness is judged over all rows, fill values over the labelled ones.
    """
    columns = [c for c in df.columns if c not in skip]
    if not columns:
        raise ValueError("no columns to examine for missing values")
    labelled = value(df, label).isNotNull() if label in df.columns else F.lit(True)
    found = presence(df, columns, labelled)
    n, _, kept, _ = found[columns[0]]
    missing = {c: n - found[c][1] for c in columns}
    percent = {c: rounded_percent(missing[c], n) for c in columns}
    dropped = [c for c in columns if c != label and percent[c] > threshold * 100]
    present = {c: found[c][3] for c in columns}

    numeric = numeric_columns(df, skip | {label, *dropped})
    by_median = [c for c in numeric if c not in zero_fill]
    rows = df.where(labelled) if label in df.columns else df
    medians = column_quantiles(rows, by_median, [0.5], present, quantiles)
    fills: dict[str, dict] = {}
    for c in numeric:
        if c in zero_fill:
            fills[c] = {"method": "constant", "value": 0, "rationale": "absent means none"}
        else:
            fills[c] = {
                "method": "median", "value": medians[c][0], "rationale": "median of the column",
            }
    for c in string_columns(df, skip | {label, *dropped}):
        fills[c] = {"method": "constant", "value": UNKNOWN, "rationale": "placeholder category"}
    for c, fill in fills.items():
        fill["missing_count"] = kept - present[c]
    return {
        "rows": n,
        "rows_labelled": kept,
        "dropped": dropped,
        "fills": fills,
        "missing": [
            {"column": c, "missing_count": missing[c], "missing_percentage": percent[c]}
            for c in columns
        ],
    }


def apply_imputation(df: DataFrame, state: dict, label: str) -> DataFrame:
    """Drop and fill in one projection; an absent label column is fine."""
    rows = df.where(value(df, label).isNotNull()) if label in df.columns else df
    out = []
    for field in df.schema.fields:
        c = field.name
        if c in state["dropped"]:
            continue
        fill = state["fills"].get(c)
        if fill is None or fill["value"] is None:
            out.append(value(df, c).alias(c))
        elif isinstance(fill["value"], str):
            out.append(F.coalesce(col(c), F.lit(fill["value"])).alias(c))
        else:
            whole = isinstance(field.dataType, T.IntegralType)
            if whole and not math.isclose(fill["value"], round(fill["value"]), abs_tol=0.0):
                out.append(F.coalesce(number(df, c), F.lit(float(fill["value"]))).alias(c))
            else:
                filled = F.lit(fill["value"]).cast(field.dataType)
                out.append(F.coalesce(value(df, c), filled).alias(c))
    return rows.select(*out)


class _MissingParams:
    threshold_drop_feature = parameter(
        "threshold_drop_feature", "drop columns missing more than this share"
    )
    zero_fill = parameter("zero_fill", "numeric columns whose missing values mean 0")
    stats_from = parameter(
        "stats_from", "'fit': statistics of the fitted table; 'transform': of each transformed one"
    )
    quantiles = parameter("quantiles", "'exact' medians, or 'approximate' ones from one pass")


class MissingValueTransformer(FittingStage, _MissingParams):
    """Learns which columns to drop and what to fill.

    With ``stats_from="fit"`` the transformed tables are filled from the fitted one, so
    validation and test rows cannot leak. ``"transform"`` recomputes drops and fill
    values from whatever table is transformed.
    """

    @keyword_only
    def __init__(
        self,
        *,
        threshold_drop_feature=0.95,
        label=presets.LABEL,
        split_col=presets.SPLIT,
        preserve_cols=tuple(presets.PRESERVED),
        zero_fill=tuple(presets.ZERO_FILLED),
        stats_from="fit",
        quantiles="exact",
    ):
        super().__init__()
        self._setDefault(
            threshold_drop_feature=0.95,
            label=presets.LABEL,
            split_col=presets.SPLIT,
            preserve_cols=list(presets.PRESERVED),
            zero_fill=list(presets.ZERO_FILLED),
            stats_from="fit",
            quantiles="exact",
        )
        self._set(**listed(self._input_kwargs))
        if stats_from not in ("fit", "transform"):
            raise ValueError("stats_from must be 'fit' or 'transform'")

    def _fit(self, dataset: DataFrame) -> "MissingValueModel":
        return self.fitted_model(MissingValueModel, _learn(self, dataset))


class MissingValueModel(FittedModel, _MissingParams):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        again = self.value("stats_from") == "transform"
        state = _learn(self, dataset) if again else self.fitted
        return apply_imputation(dataset, state, self.value("label"))

    @property
    def dropped_features(self) -> list[str]:
        return self.fitted["dropped"]

    def imputation_report(self, spark) -> DataFrame:
        """One row per column that was filled or dropped, with method, value and counts."""
        return imputation_report(spark, self.fitted)


def imputation_report(spark, state: dict) -> DataFrame:
    percents = {m["column"]: m for m in state["missing"]}
    rows = [
        (c, "drop", None, percents[c]["missing_count"], percents[c]["missing_percentage"],
         "too sparse")
        for c in state["dropped"]
    ]
    for c, fill in state["fills"].items():
        if fill["missing_count"] > 0:
            shown = fill["value"]
            shown = shown if isinstance(shown, str) or shown is None else repr(float(shown))
            rows.append(
                (c, fill["method"], shown, fill["missing_count"],
                 percents[c]["missing_percentage"], fill["rationale"])
            )
    return small_frame(
        spark,
        rows,
        "column string, method string, value string, missing_count long, "
        "missing_percentage double, rationale string",
    )


def _learn(stage, df: DataFrame) -> dict:
    label = stage.value("label")
    return learn_imputation(
        df,
        label,
        stage.metadata() - {label},
        stage.value("threshold_drop_feature"),
        list(stage.value("zero_fill")),
        stage.value("quantiles"),
    )
