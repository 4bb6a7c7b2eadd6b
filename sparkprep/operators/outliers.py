"""Outlier removal: declared valid ranges, then optionally upper 3 x IQR fences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import keyword_only
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import number, one_row_to_many, percent2, small_frame
from sparkprep.functions.numeric import outside
from sparkprep.operators.profile import iqr_bounds, outlier_profile
from sparkprep.operators.quantiles import column_quantiles
from sparkprep.operators.stages import FittedModel, FittingStage, listed, parameter

Ranges = Mapping[str, tuple[float, float]]


def domain_violations(df: DataFrame, ranges: Ranges) -> dict[str, Column]:
    """Per ruled column present, in rule order: is the row's value outside its range?"""
    return {c: outside(number(df, c), *ranges[c]) for c in ranges if c in df.columns}


def any_of(tests: list[Column]) -> Column:
    result = F.lit(False)
    for t in tests:
        result = result | t
    return result


def domain_filter(df: DataFrame, ranges: Ranges) -> DataFrame:
    """Rows without a value outside its inclusive range; missing values are valid."""
    return df.where(~any_of(list(domain_violations(df, ranges).values())))


def upper_fences(df: DataFrame, ranges: Ranges, factor: float = 3.0, quantiles: str = "exact") -> dict[str, float]:
    """``min(Q3 + factor*IQR, valid maximum)`` per ruled column that has values."""
    ruled = [c for c in ranges if c in df.columns]
    quartiles = column_quantiles(df, ruled, [0.25, 0.75], method=quantiles)
    fences = {c: iqr_bounds(quartiles[c], factor) for c in ruled}
    return {c: min(f[1], ranges[c][1]) for c, f in fences.items() if f is not None}


def fence_filter(df: DataFrame, fences: Mapping[str, float]) -> DataFrame:
    """Rows without a value above its upper fence."""
    return df.where(~any_of(list(_above(df, fences).values())))


def _above(df: DataFrame, fences: Mapping[str, float]) -> dict[str, Column]:
    return {
        c: F.coalesce(number(df, c) > F.lit(float(f)), F.lit(False))
        for c, f in fences.items()
        if c in df.columns
    }


def removal_reasons(
    df: DataFrame, ranges: Ranges, fences: Mapping[str, float] | None = None
) -> DataFrame:
    """Rows removed per column, from one aggregate.

    A row outside several ranges counts for the first rule only. Fence counts run over
    the rows that pass every range, are not net of each other, and are listed only for
    columns without range violations.
    """
    bad = domain_violations(df, ranges)
    names = list(bad)
    if not names:
        return small_frame(df.sparkSession, [], "column string, count long, reason string")
    aggs, earlier = [], F.lit(False)
    for i, c in enumerate(names):
        aggs.append(F.count_if(bad[c] & ~earlier).alias(f"d{i}"))
        earlier = earlier | bad[c]
    above = _above(df, fences or {})
    aggs += [F.count_if(above[c] & ~earlier).alias(f"s{names.index(c)}") for c in above]
    records = []
    for i, c in enumerate(names):
        by_fence = F.col(f"s{i}") if c in above else F.lit(0).cast("long")
        in_range = F.col(f"d{i}") == 0
        records.append(
            [
                ("column", F.lit(c)),
                ("count", F.when(in_range, by_fence).otherwise(F.col(f"d{i}"))),
                (
                    "reason",
                    F.when(in_range, F.lit("above statistical fence")).otherwise(
                        F.lit("outside valid range")
                    ),
                ),
            ]
        )
    return one_row_to_many(df.agg(*aggs), records).where(F.col("count") > 0)


def removal_totals(
    df: DataFrame, ranges: Ranges, fences: Mapping[str, float] | None = None
) -> DataFrame:
    """Rows before, after and removed, and the removed percent (0 for an empty table)."""
    outside_range = any_of(list(domain_violations(df, ranges).values()))
    removed = outside_range | any_of(list(_above(df, fences or {}).values()))
    agg = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(removed).alias("rows_removed"))
    return agg.select(
        "rows_before",
        (F.col("rows_before") - F.col("rows_removed")).alias("rows_after"),
        "rows_removed",
        percent2(F.col("rows_removed"), F.col("rows_before")).alias("removal_percentage"),
    )


class _OutlierParams:
    valid_ranges = parameter("valid_ranges", "column -> inclusive (minimum, maximum), in order")
    remove_statistical_outliers = parameter(
        "remove_statistical_outliers", "also remove rows above the IQR fences"
    )
    iqr_factor = parameter("iqr_factor", "fence distance in IQRs")
    stats_from = parameter("stats_from", "table the fences come from: 'fit' or 'transform'")
    quantiles = parameter("quantiles", "'exact' quartiles, or 'approximate' ones from one pass")

    def ranges(self) -> dict[str, tuple[float, float]]:
        return {c: (float(a), float(b)) for c, (a, b) in self.value("valid_ranges").items()}


class OutlierRemovalTransformer(FittingStage, _OutlierParams):
    @keyword_only
    def __init__(
        self,
        *,
        valid_ranges=None,
        remove_statistical_outliers=False,
        iqr_factor=3.0,
        stats_from="fit",
        quantiles="exact",
        label=presets.LABEL,
        split_col=presets.SPLIT,
        preserve_cols=tuple(presets.PRESERVED),
    ):
        super().__init__()
        self._setDefault(
            valid_ranges={c: list(r) for c, r in presets.VALID_RANGES.items()},
            remove_statistical_outliers=False,
            iqr_factor=3.0,
            stats_from="fit",
            quantiles="exact",
            label=presets.LABEL,
            split_col=presets.SPLIT,
            preserve_cols=list(presets.PRESERVED),
        )
        given = listed(self._input_kwargs)
        if given.get("valid_ranges") is None:
            given.pop("valid_ranges", None)
        else:
            given["valid_ranges"] = {c: list(r) for c, r in given["valid_ranges"].items()}
        self._set(**given)
        if stats_from not in ("fit", "transform"):
            raise ValueError("stats_from must be 'fit' or 'transform'")

    def _fit(self, dataset: DataFrame) -> "OutlierRemovalModel":
        learn = self.value("remove_statistical_outliers") and self.value("stats_from") == "fit"
        return self.fitted_model(
            OutlierRemovalModel, {"fences": _fences(self, dataset) if learn else {}}
        )


def _fences(stage, df: DataFrame) -> dict[str, float]:
    ranges = stage.ranges()
    return upper_fences(domain_filter(df, ranges), ranges, stage.value("iqr_factor"), stage.value("quantiles"))


class OutlierRemovalModel(FittedModel, _OutlierParams):
    def fences(self, df: DataFrame) -> dict[str, float]:
        if not self.value("remove_statistical_outliers"):
            return {}
        if self.value("stats_from") == "transform":
            return _fences(self, df)
        return self.fitted["fences"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ranges = self.ranges()
        return fence_filter(domain_filter(dataset, ranges), self.fences(dataset))

    def outlier_report(self, df: DataFrame) -> dict[str, DataFrame]:
        """Profiles before and after, reasons and totals for transforming ``df``."""
        ranges, fences = self.ranges(), self.fences(df)
        return {
            "before_cleaning": outlier_profile(df, ranges, self.value("iqr_factor")),
            "after_cleaning": outlier_profile(
                fence_filter(domain_filter(df, ranges), fences), ranges, self.value("iqr_factor")
            ),
            "removal_summary": removal_reasons(df, ranges, fences),
            "totals": removal_totals(df, ranges, fences),
        }
