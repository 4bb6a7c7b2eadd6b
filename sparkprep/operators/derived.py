"""Derived numeric columns: guarded ratios, densities, contributions and flags."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import number
from sparkprep.functions.numeric import above_flag, guarded_ratio
from sparkprep.operators.stages import Stage, listed, parameter


def derived_columns(
    df: DataFrame, ratios=(), densities=(), contributions=(), flags=()
) -> dict[str, Column]:
    """New columns whose sources are all present; missing results become 0."""
    present = set(df.columns)
    new: dict[str, Column] = {}
    for name, num, den in ratios:
        if {num, den} <= present:
            new[name] = guarded_ratio(number(df, num), number(df, den))
    for name, source, divisor in densities:
        if source in present:
            new[name] = F.coalesce(number(df, source) / F.lit(float(divisor)), F.lit(0.0))
    for name, source, factor in contributions:
        if source in present:
            new[name] = F.coalesce(number(df, source) * F.lit(float(factor)), F.lit(0.0))
    for name, source, threshold in flags:
        if source in present:
            new[name] = above_flag(number(df, source), float(threshold))
    return new


class FeatureEngineer(Transformer, Stage):
    """Adds the derived columns in one projection; needs no fitting."""

    add_ratios = parameter("add_ratios", "add the ratio columns")
    add_energy_density = parameter("add_energy_density", "add the density columns")
    add_caloric_contributions = parameter("add_caloric_contributions", "add contributions")
    add_boolean_flags = parameter("add_boolean_flags", "add the threshold flags")
    ratios = parameter("ratios", "list of (new column, numerator, denominator)")
    densities = parameter("densities", "list of (new column, source, divisor)")
    contributions = parameter("contributions", "list of (new column, source, factor)")
    flags = parameter("flags", "list of (new column, source, strict threshold)")

    @keyword_only
    def __init__(
        self,
        *,
        add_ratios=True,
        add_energy_density=True,
        add_caloric_contributions=True,
        add_boolean_flags=True,
        ratios=tuple(presets.RATIOS),
        densities=tuple(presets.ENERGY_DENSITY),
        contributions=tuple(presets.CALORIES),
        flags=tuple(presets.FLAGS),
    ):
        super().__init__()
        self._setDefault(
            add_ratios=True,
            add_energy_density=True,
            add_caloric_contributions=True,
            add_boolean_flags=True,
            ratios=[list(r) for r in presets.RATIOS],
            densities=[list(r) for r in presets.ENERGY_DENSITY],
            contributions=[list(r) for r in presets.CALORIES],
            flags=[list(r) for r in presets.FLAGS],
        )
        self._set(**listed(self._input_kwargs))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def chosen(switch: str, rules: str) -> list:
            return self.value(rules) if self.value(switch) else []

        return dataset.withColumns(
            derived_columns(
                dataset,
                chosen("add_ratios", "ratios"),
                chosen("add_energy_density", "densities"),
                chosen("add_caloric_contributions", "contributions"),
                chosen("add_boolean_flags", "flags"),
            )
        )
