"""Profiles and comparisons of tables; every result is a small DataFrame.

Statistics of all columns come from one pass over the table, never one job per column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkprep.functions.columns import (
    col,
    number,
    one_row_to_many,
    rounded_percent,
    small_frame,
    value,
)
from sparkprep.functions.statistics import (
    column_statistics,
    distinct_counts,
    exploded,
    per_position,
    presence,
)
from sparkprep.operators.quantiles import exact_quantiles, exact_quantiles_by

QUARTILES = [0.25, 0.5, 0.75]


def missing_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Per column: missing count and percent, type, distinct non-null values.

    Sorted by percent descending, equal ones in column order. Exact distinct counts shuffle
    the distinct values of every column; ``exact_distinct=False`` takes sketches instead.
    """
    if exact_distinct:
        found = {
            r["position"]: (r["rows"], r["missing"], r["distinct"])
            for r in distinct_counts(df).collect()
        }
    else:
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(value(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
            *[F.approx_count_distinct(value(df, c)).alias(f"d{i}") for i, c in enumerate(df.columns)],
        ).first()
        found = {
            i: (row["n"], row["n"] - row[f"c{i}"], row[f"d{i}"]) for i in range(len(df.columns))
        }
    rows = []
    for i, f in enumerate(df.schema.fields):
        n, missing, distinct = found.get(i, (0, 0, 0))
        percent = rounded_percent(missing, n)
        rows.append((f.name, i, missing, percent, f.dataType.simpleString(), distinct))
    return small_frame(
        df.sparkSession,
        sorted(rows, key=lambda r: (-r[3], r[1])),
        "column string, position int, missing_count long, missing_percentage double, "
        "dtype string, unique_values long",
    )


def top_missing(profile: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` columns of a missing profile that miss anything."""
    return (
        profile.where(F.col("missing_percentage") > 0)
        .orderBy(F.desc("missing_percentage"), "position")
        .limit(n)
    )


def remaining_nulls(df: DataFrame) -> DataFrame:
    """One row: ``remaining`` missing cells over all columns."""
    missing = [value(df, c).isNull().cast("long") for c in df.columns]
    per_row = F.aggregate(F.array(*missing), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("remaining"))


def class_distribution(df: DataFrame, label: str, valid: Sequence[str] | None = None) -> DataFrame:
    """Count and share of each upper-cased label value; ``valid`` limits the values."""
    c = col(label)
    rows = df.where(c.isNotNull())
    if valid is not None:
        rows = rows.where(F.lower(c).isin([v.lower() for v in valid]))
    counts = rows.groupBy(F.upper(c).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # The window runs over one row per class.
    whole = F.sum("n").over(Window.partitionBy())
    return counts.select("label", "n", (F.col("n") / whole).alias("share")).orderBy("label")


def outlier_profile(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], factor: float = 3.0
) -> DataFrame:
    """Per ruled column: counts outside the range and outside the IQR fences, and extremes."""
    ruled = [c for c in ranges if c in df.columns]
    quartiles = exact_quantiles(df, ruled, QUARTILES)
    fences = {c: iqr_bounds(quartiles[c], factor) or (None, None) for c in ruled}
    low = per_position([float(ranges[c][0]) for c in ruled])
    high = per_position([float(ranges[c][1]) for c in ruled])
    lower = per_position([fences[c][0] for c in ruled])
    upper = per_position([fences[c][1] for c in ruled])
    found = column_statistics(
        df,
        ruled,
        {
            "negative": lambda v: F.count_if(v < 0),
            "below": lambda v: F.count_if(v < low),
            "above": lambda v: F.count_if(v > high),
            "beyond": lambda v: F.count_if((v < lower) | (v > upper)),
            "min": F.min,
            "max": F.max,
        },
    )
    rows = [
        (
            c,
            found[c]["negative"] or 0,
            found[c]["below"] or 0,
            found[c]["above"] or 0,
            float(ranges[c][0]),
            float(ranges[c][1]),
            found[c]["beyond"] or 0,
            *fences[c],
            found[c]["min"],
            found[c]["max"],
            quartiles[c][1],
        )
        for c in ruled
    ]
    return small_frame(df.sparkSession, rows, OUTLIER_SCHEMA)


OUTLIER_SCHEMA = (
    "column string, negative_count long, below_min long, above_max long, valid_min double, "
    "valid_max double, statistical_outliers long, iqr_lower double, iqr_upper double, "
    "min double, max double, median double"
)


def iqr_bounds(quartiles: Sequence[float | None], factor: float) -> tuple[float, float] | None:
    """Fences ``Q1 - factor*IQR`` and ``Q3 + factor*IQR``; None without values."""
    first, third = quartiles[0], quartiles[-1]
    if first is None or third is None:
        return None
    spread = third - first
    return first - factor * spread, third + factor * spread


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    found = column_statistics(
        df,
        columns,
        {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    counts = {c: found[c]["n"] or 0 for c in columns}
    quartiles = exact_quantiles(df, columns, QUARTILES, counts=counts)
    rows = [
        (c, counts[c], found[c]["mean"], found[c]["std"], found[c]["min"], *quartiles[c],
         found[c]["max"])
        for c in columns
    ]
    return small_frame(
        df.sparkSession,
        rows,
        "column string, count long, mean double, std double, min double, q25 double, "
        "q50 double, q75 double, max double",
    )


def correlations(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    order: Mapping[str, float],
    strong_from: float = 0.1,
) -> DataFrame:
    """Correlation of each column with the label mapped to numbers, largest first.

    ``strong`` tells whether the absolute value reaches ``strong_from``.
    """
    pairs = [x for k, v in order.items() for x in (F.lit(k), F.lit(float(v)))]
    y = F.try_element_at(F.create_map(*pairs), col(label))
    found = column_statistics(df, columns, {"r": lambda v: F.corr(v, F.col("y"))}, y=y)
    rows = []
    for c in columns:
        r = found[c]["r"]
        r = None if r is None or math.isnan(r) else r
        rows.append((c, r, None if r is None else abs(r), r is not None and abs(r) >= strong_from))
    rows.sort(key=lambda x: (x[1] is None, -(x[1] or 0.0), x[0]))
    return small_frame(
        df.sparkSession,
        rows,
        "column string, correlation double, strength double, strong boolean",
    )


def strongest(correlated: DataFrame, n: int = 5) -> DataFrame:
    return correlated.orderBy(F.desc_nulls_last("strength"), "column").limit(n)


def compare_extremes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: maximum and median before and after, and the cut of the maximum in percent."""
    rows = []
    for df, side in ((before, "before"), (after, "after")):
        medians = exact_quantiles(df, columns, [0.5])
        agg = df.agg(*[F.max(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
        rows.append(
            one_row_to_many(
                agg,
                [
                    [
                        ("column", F.lit(c)),
                        (f"max_{side}", F.col(f"m{i}")),
                        (f"median_{side}", F.lit(medians[c][0]).cast("double")),
                    ]
                    for i, c in enumerate(columns)
                ],
            )
        )
    cut = F.try_divide(F.col("max_before") - F.col("max_after"), F.col("max_before")) * 100.0
    return rows[0].join(rows[1], "column").select(
        "column",
        "max_before",
        "max_after",
        "median_before",
        "median_after",
        (F.rint(cut * 100.0) / 100.0).alias("max_reduction_pct"),
    )


def compare_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Row counts per value of ``key`` in two tables, aligned on both sides, with equality."""
    left = before.groupBy(col(key).alias("value")).agg(F.count(F.lit(1)).alias("n_before"))
    right = after.groupBy(col(key).alias("value_r")).agg(F.count(F.lit(1)).alias("n_after"))
    return left.join(right, F.col("value").eqNullSafe(F.col("value_r")), "full_outer").select(
        F.coalesce("value", "value_r").alias("value"),
        F.coalesce("n_before", F.lit(0)).alias("n_before"),
        F.coalesce("n_after", F.lit(0)).alias("n_after"),
        F.col("n_before").eqNullSafe(F.col("n_after")).alias("match"),
    )


def compare_missing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing counts and percents before and after, for columns that missed any before."""

    def counts(df: DataFrame, side: str) -> DataFrame:
        found = presence(df, df.columns)
        rows = [
            (c, n - filled, (n - filled) / n * 100.0 if n else None)
            for c, (n, filled, _, _) in found.items()
        ]
        return small_frame(
            df.sparkSession, rows, f"column string, missing_{side} long, pct_{side} double"
        )

    first = counts(before, "before").where(F.col("missing_before") > 0)
    return first.join(counts(after, "after"), "column", "left").orderBy(
        F.desc("pct_before"), "column"
    )


def split_statistics(df: DataFrame, columns: Sequence[str], split: str = "split_group") -> DataFrame:
    """Mean and sample deviation of each column per split, one row per (split, column)."""
    names = F.array(*[F.lit(c) for c in columns])
    return (
        exploded(df, columns, split=col(split))
        .groupBy("split", F.get(names, F.col("position")).alias("column"))
        .agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    )


def null_and_infinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null (or NaN) and infinite values per column."""
    infinite = F.lit(float("inf"))
    found = column_statistics(
        df,
        columns,
        {
            "nulls": lambda v: F.count_if(v.isNull()),
            "infinite": lambda v: F.count_if(F.abs(v) == infinite),
        },
    )
    rows = [(c, found[c]["nulls"] or 0, found[c]["infinite"] or 0) for c in columns]
    return small_frame(
        df.sparkSession, rows, "column string, null_count long, infinite_count long"
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum of each column, empty bins included.

    ``density`` is the count scaled so that the bars of a column have area 1.
    """
    extremes = column_statistics(df, columns, {"low": F.min, "high": F.max, "n": F.count})
    edges, indexes = [], []
    for c in columns:
        low, high, n = extremes[c]["low"], extremes[c]["high"], extremes[c]["n"]
        if not n:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        edges += [(c, b, low + b * width, low + (b + 1) * width, n) for b in range(bins)]
        v = number(df, c)
        position = F.floor((v - low) / (high - low) * bins).cast("int")
        index = F.when(v.isNotNull(), F.least(position, F.lit(bins - 1)))
        indexes.append(F.struct(F.lit(c).alias("column"), index.alias("bin")))
    template = small_frame(
        df.sparkSession, edges, "column string, bin int, lower double, upper double, total long"
    )
    if not indexes:
        return template.select(
            "column", "bin", "lower", "upper", F.lit(0).cast("long").alias("n"),
            F.lit(0.0).alias("density"),
        )
    filled = (
        df.select(F.inline(F.array(*indexes)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    return template.join(filled, ["column", "bin"], "left").select(
        "column",
        "bin",
        "lower",
        "upper",
        n.alias("n"),
        (n / (F.col("total") * (F.col("upper") - F.col("lower")))).alias("density"),
    )


def box_statistics(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Minimum, exact quartiles and maximum of each column per class."""
    quartiles = exact_quantiles_by(df, by, columns, [0.0, *QUARTILES, 1.0])
    names = ["low", "q25", "q50", "q75", "high"]
    return quartiles.select(
        col(by).alias("label"),
        "column",
        *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)],
    )


def clip_to_quantile(df: DataFrame, column: str, probability: float = 0.99) -> DataFrame:
    """Rows whose value does not exceed the exact quantile of the column."""
    bound = exact_quantiles(df, [column], [probability])[column][0]
    return df.where(number(df, column) <= F.lit(bound).cast("double"))
