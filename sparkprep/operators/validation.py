"""Data-quality checks: each gives rows (check, column, value, passed)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.columns import col, number, one_row_to_many, require, small_frame
from sparkprep.functions.statistics import column_statistics, per_position, presence
from sparkprep.operators.profile import compare_counts, null_and_infinite
from sparkprep.operators.quantiles import exact_quantiles
from sparkprep.operators.reduction import FeatureReducerModel

SCHEMA = "check string, column string, value double, passed boolean"


def _rows(df: DataFrame, rows: list[tuple[str, str, float | None, bool]]) -> DataFrame:
    shown = [(c, n, None if v is None else float(v), bool(ok)) for c, n, v, ok in rows]
    return small_frame(df.sparkSession, shown, SCHEMA)


def _record(check: str, column: str, shown: Column, passed: Column) -> list[tuple[str, Column]]:
    return [
        ("check", F.lit(check)),
        ("column", F.lit(column)),
        ("value", shown.cast("double")),
        ("passed", F.coalesce(passed, F.lit(False))),
    ]


def _from_aggregate(
    df: DataFrame, aggregates: Mapping[str, Column], records: list
) -> DataFrame:
    """Checks over named aggregates of one pass."""
    if not records:
        return small_frame(df.sparkSession, [], SCHEMA)
    return one_row_to_many(df.agg(*[c.alias(n) for n, c in aggregates.items()]), records)


def check_retention(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Share of rows and columns kept, no missing cell left, label complete."""
    total = before.count()
    found = presence(after, after.columns)
    kept = found[label][0]
    missing = sum(n - present for n, present, _, _ in found.values())
    no_label = kept - found[label][1]
    return _rows(
        after,
        [
            ("rows retained", "*", kept / total if total else None, kept <= total),
            (
                "columns retained",
                "*",
                len(after.columns) / len(before.columns),
                len(after.columns) <= len(before.columns),
            ),
            ("missing cells", "*", missing, missing == 0),
            ("label missing", label, no_label, no_label == 0),
        ],
    )


def check_types(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Columns have the expected type; value 1 where they do."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _rows(
        df,
        [("data type", c, actual.get(c) == t, actual.get(c) == t) for c, t in expected.items()],
    )


def check_domain(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    label: str,
    extra_ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """No negative value, no value outside its range, label complete."""
    rules = {c: r for c, r in {**ranges, **(extra_ranges or {})}.items() if c in df.columns}
    low = per_position([r[0] for r in rules.values()])
    high = per_position([r[1] for r in rules.values()])
    found = column_statistics(
        df,
        list(rules),
        {
            "negative": lambda v: F.count_if(v < 0),
            "outside": lambda v: F.count_if((v < low) | (v > high)),
        },
    )
    rows = []
    for c in rules:
        negative, outside = found[c]["negative"] or 0, found[c]["outside"] or 0
        rows.append(("negative values", c, negative, negative == 0))
        rows.append(("outside range", c, outside, outside == 0))
    n, present, _, _ = presence(df, [label])[label]
    rows.append(("label missing", label, n - present, n == present))
    return _rows(df, rows)


def check_derived(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No missing and no infinite value in the derived columns."""
    rows = []
    for r in null_and_infinite(df, columns).collect():
        rows.append(("null values", r["column"], r["null_count"], r["null_count"] == 0))
        rows.append(("infinite values", r["column"], r["infinite_count"], r["infinite_count"] == 0))
    return _rows(df, rows)


def check_onehot(df: DataFrame, column: str, encoded: Sequence[str]) -> DataFrame:
    """Values are 0 or 1, a row has at most one 1, the source column is gone."""
    total = F.lit(0.0)
    strange = F.lit(False)
    for c in encoded:
        total = total + number(df, c)
        strange = strange | ~F.coalesce(number(df, c).isin(0.0, 1.0), F.lit(False))
    sums = ~F.coalesce(total.isin(0.0, 1.0), F.lit(False))
    return _from_aggregate(
        df,
        {"strange": F.count_if(strange), "sums": F.count_if(sums)},
        [
            _record("values not 0 or 1", column, F.col("strange"), F.col("strange") == 0),
            _record("row sums not 0 or 1", column, F.col("sums"), F.col("sums") == 0),
            _record(
                "source removed",
                column,
                F.lit(float(column not in df.columns)),
                F.lit(column not in df.columns),
            ),
        ],
    )


def check_target_encoding(df: DataFrame, column: str) -> DataFrame:
    """The encoded column is numeric and within [0, 1]."""
    numeric = column in df.columns and df.schema[column].dataType.simpleString() == "double"
    if not numeric:
        return _rows(df, [("numeric", column, 0, False)])
    v = number(df, column)
    return _from_aggregate(
        df,
        {"low": F.min(v), "high": F.max(v)},
        [
            _record("numeric", column, F.lit(1.0), F.lit(True)),
            _record("minimum", column, F.col("low"), F.col("low") >= 0),
            _record("maximum", column, F.col("high"), F.col("high") <= 1),
        ],
    )


def _by_part(df: DataFrame, split_col: str, columns: Sequence[str], functions: Mapping) -> dict:
    """Column -> statistic on train and on the other rows, from one pass."""
    train = F.col("train")
    aggregates = {}
    for name, f in functions.items():
        aggregates[f"train_{name}"] = lambda v, f=f: f(F.when(train, v))
        aggregates[f"test_{name}"] = lambda v, f=f: f(F.when(~train, v))
    return column_statistics(df, columns, aggregates, train=col(split_col) == "train")


def _gap(a: float | None, b: float | None) -> float:
    return math.inf if a is None or b is None else abs(a - b)


def check_encoder_leak(
    df: DataFrame, groups: Mapping[str, Sequence[str]], split_col: str, kinds: Mapping[str, str]
) -> DataFrame:
    """Mean absolute difference of train and held-out means per encoded feature.

    Below 0.001 it is suspicious; a one-hot feature also needs both maxima to be 1.
    """
    columns = [c for cs in groups.values() for c in cs]
    found = _by_part(df, split_col, columns, {"mean": F.avg, "max": F.max})
    rows = []
    for feature, encoded in groups.items():
        stats = [found[c] for c in encoded]
        if not stats:
            continue
        gap = sum(_gap(s["train_mean"], s["test_mean"]) for s in stats) / len(stats)
        suspicious = gap < 0.001
        if kinds.get(feature) == "onehot":
            for side in ("train_max", "test_max"):
                suspicious &= max((s[side] or 0.0) for s in stats) == 1.0
        rows.append(("encoder leak hint", feature, gap, not suspicious))
    return _rows(df, rows)


def check_scaled_train(train: DataFrame, methods: Mapping[str, str]) -> DataFrame:
    """On the fitted rows: mean 0 and deviation 1 for standard, range 0 to 1 for min-max,
    median 0 for robust. A column without spread stays at 0."""
    found = column_statistics(
        train,
        list(methods),
        {"n": F.count, "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max},
    )
    robust = [c for c, m in methods.items() if m == "robust"]
    medians = exact_quantiles(train, robust, [0.5], {c: found[c]["n"] or 0 for c in robust})
    near = 1e-6
    rows = []
    for c, method in methods.items():
        s = found[c]
        flat = s["min"] is not None and s["max"] - s["min"] < near
        if method == "standard":
            rows.append(("train mean", c, s["mean"], _gap(s["mean"], 0.0) < near))
            rows.append(("train deviation", c, s["std"], flat or _gap(s["std"], 1.0) < near))
        elif method == "minmax":
            rows.append(("train minimum", c, s["min"], _gap(s["min"], 0.0) < near))
            rows.append(("train maximum", c, s["max"], flat or _gap(s["max"], 1.0) < near))
        else:
            rows.append(("train median", c, medians[c][0], _gap(medians[c][0], 0.0) < near))
    return _rows(train, rows)


def check_scaler_leak(test: DataFrame, methods: Mapping[str, str]) -> DataFrame:
    """Held-out rows that look perfectly scaled hint at a leak; value 1 where they do.

    The tolerances hold the relative part of a usual closeness test as well.
    """
    found = column_statistics(
        test,
        list(methods),
        {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    rows = []
    for c, method in methods.items():
        s = found[c]
        if method == "standard":
            leaked = _gap(s["mean"], 0.0) <= 0.05 and _gap(s["std"], 1.0) <= 0.02 + 1e-5
        elif method == "minmax":
            leaked = _gap(s["min"], 0.0) <= 0.01 and _gap(s["max"], 1.0) <= 0.01 + 1e-5
        else:
            continue
        rows.append(("scaler leak hint", c, leaked, not leaked))
    return _rows(test, rows)


def check_same_bounds(df: DataFrame, columns: Sequence[str], split_col: str) -> DataFrame:
    """Columns whose minimum and maximum coincide in train and held-out rows (value 1)."""
    found = _by_part(df, split_col, columns, {"min": F.min, "max": F.max})
    rows = []
    for c in columns:
        s = found[c]
        same = all(
            s[f"train_{e}"] is not None and s[f"train_{e}"] == s[f"test_{e}"] for e in ("min", "max")
        )
        rows.append(("same bounds", c, same, True))
    return _rows(df, rows)


def check_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Columns that must be present; value 1 where they are."""
    return _rows(df, [("column present", c, c in df.columns, c in df.columns) for c in wanted])


def check_reduction(
    model: FeatureReducerModel,
    before: DataFrame,
    after: DataFrame,
    label: str,
    split_col: str,
) -> DataFrame:
    """Variance reached, a component chosen, label and split counts unchanged, PC1 reported.

    The deviation of PC1 is its root eigenvalue, not 1, so it is shown and not judged.
    """
    require(after, [label, split_col])
    reached = model.cumulative_variance()[-1]
    components = model.fitted["components"]
    threshold = model.value("variance_threshold")
    complete = components == len(model.fitted["columns"])
    fixed = _rows(
        after,
        [
            ("variance reached", "*", reached, reached >= threshold or complete),
            ("components", "*", components, components > 0),
        ],
    )
    parts = [fixed]
    for key in (label, split_col):
        differing = compare_counts(before, after, key).agg(
            F.count_if(~F.col("match")).alias("n")
        )
        parts.append(
            one_row_to_many(
                differing, [_record("counts unchanged", key, F.col("n"), F.col("n") == 0)]
            )
        )
    parts.append(check_first_component(after, split_col))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def check_first_component(df: DataFrame, split_col: str, column: str = "PC1") -> DataFrame:
    """PC1 is centred on train; its deviation and its held-out mean are shown."""
    v, train = number(df, column), col(split_col) == "train"
    test = col(split_col) == "test"
    return _from_aggregate(
        df,
        {
            "train_mean": F.avg(F.when(train, v)),
            "train_std": F.stddev_samp(F.when(train, v)),
            "test_mean": F.avg(F.when(test, v)),
            "test_std": F.stddev_samp(F.when(test, v)),
        },
        [
            _record("train mean", column, F.col("train_mean"), F.abs(F.col("train_mean")) < 0.01),
            _record("train deviation", column, F.col("train_std"), F.lit(True)),
            _record("test mean", column, F.col("test_mean"), F.lit(True)),
            _record("test deviation", column, F.col("test_std"), F.lit(True)),
        ],
    )
