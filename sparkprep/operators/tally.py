"""One aggregation for what several fitted stages need to know of the same rows.

Every stage states its needs as cells, (token, number) pairs of a row; the cells of all stages are exploded together and
aggregated by place and token in one pass. The result has one row per token, so it is landed, and the
driver takes only the rows that a stage says it needs: a stated number of tokens for each place.

Columns of numbers are a place of their own, with the column's name as token. They are not exploded: each task
adds up its batches column by column, and the moments of all tasks are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sparkprep.functions.columns import number
from sparkprep.functions.statistics import per_position
from sparkprep.workspace import land

ROWS = "rows"


def cell(token: Column | None, v: Column | None = None) -> Column:
    no_token, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    return F.struct(
        (no_token if token is None else token.cast("string")).alias("token"),
        (no_number if v is None else v.cast("double")).alias("v"),
    )


def number_cells(df: DataFrame, columns: Sequence[str]) -> Column:
    """One cell per column, whose name is the token."""
    return F.array(*[cell(F.lit(c), number(df, c)) for c in columns])


def _at(place: int, cells: Column) -> Column:
    return F.transform(
        cells, lambda x: F.struct(F.lit(place).alias("place"), x["token"].alias("token"), x["v"].alias("v"))
    )


_MOMENTS = "token string, n long, filled long, mean double, m2 double, m3 double, low double, high double"


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Rows, filled cells, mean, second and third moment about it, least and largest value of two sets of rows."""
    if a is None or not a[1]:
        return (b[0] + (a[0] if a else 0), *b[1:])
    if not b[1]:
        return (a[0] + b[0], *a[1:])
    n, apart = a[1] + b[1], b[2] - a[2]
    share = a[1] * (b[1] / n)
    square = apart * apart
    return (
        a[0] + b[0],
        n,
        a[2] + apart * (b[1] / n) if math.isfinite(apart) else a[2] + b[2],
        a[3] + b[3] + square * share,
        a[4] + b[4] + square * apart * share * ((a[1] - b[1]) / n) + 3 * apart * (a[1] * b[3] - b[1] * a[3]) / n,
        min(a[5], b[5]),
        max(a[6], b[6]),
    )


def _batch_moments(column: pa.Array) -> tuple:
    x = column.drop_null().to_numpy(zero_copy_only=False)
    if not len(x):
        return len(column), 0, None, None, None, None, None
    with np.errstate(invalid="ignore", over="ignore"):
        # About the first value, so that equal values have no variance.
        mean = x[0] + (x - x[0]).mean() if np.isfinite(x[0]) else x.mean()
        off = x - mean
        square = off * off
        moments = mean, square.sum(), (square * off).sum(), x.min(), x.max()
    return len(column), len(x), *map(float, moments)


def _moment_rows(names: Sequence[str], found: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 2 + [pa.float64()] * 5
    columns = [pa.array(list(v), k) for v, k in zip(zip(*found), kinds)]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), *columns], ["token", "n", "filled", "mean", "m2", "m3", "low", "high"]
    )


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """token (the column), n, filled, mean, variance, low, high, skew of columns of numbers, NaN read as NULL."""
    names = list(columns)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[tuple | None] = [None] * len(names)
        for batch in batches:
            if batch.num_rows:
                total = [_merged(t, _batch_moments(c)) for t, c in zip(total, batch.columns)]
        if total[0] is not None:
            yield _moment_rows(names, total)

    def merge(table: pa.Table) -> pa.Table:
        total = None
        for r in table.sort_by("token").to_pylist():
            total = _merged(total, tuple(r[c] for c in ("n", "filled", "mean", "m2", "m3", "low", "high")))
        return pa.Table.from_batches([_moment_rows([table.column("token")[0].as_py()], [total])])

    rows = df.select(*[number(df, c).alias(f"__{i}") for i, c in enumerate(names)])
    found = rows.mapInArrow(add, _MOMENTS).groupBy("token").applyInArrow(merge, _MOMENTS)
    skew = F.when(F.col("m2") != 0, F.sqrt(F.col("filled").cast("double")) * F.col("m3") / F.pow("m2", F.lit(1.5)))
    variance = F.try_divide(F.col("m2"), F.col("filled"))
    return found.select("token", "n", "filled", "mean", variance.alias("variance"), "low", "high", skew.alias("skew"))


class Tally:
    """Landed statistics: place, token, n, filled, mean, variance, low, high, skew.

    ``numbers`` names a place and its columns of numbers.
    """

    def __init__(self, df: DataFrame, asks: Mapping[str, Column], numbers: Mapping[str, Sequence[str]] = {}):
        self.places = {name: i for i, name in enumerate([*asks, ROWS, *numbers])}
        cells = [*asks.values(), F.array(cell(None))]
        placed = [_at(i, c) for i, c in enumerate(cells)]
        rows = df.select(F.inline(F.concat(*placed)))
        found = rows.groupBy("place", "token").agg(
            F.count(F.lit(1)).alias("n"),
            F.count("v").alias("filled"),
            F.avg("v").alias("mean"),
            F.var_pop("v").alias("variance"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.skewness("v").alias("skew"),
        )
        for name, columns in numbers.items():
            if columns:
                moments = column_moments(df, columns).select(F.lit(self.places[name]).alias("place"), "*")
                found = found.unionByName(moments)
        self.table = land(found, "tally")

    def of(self, name: str) -> DataFrame:
        return self.table.where(F.col("place") == self.places[name]).drop("place")

    def most(self, bounds: Mapping[str, int]) -> dict[str, list[Row]]:
        """The ``bounds[name]`` most frequent tokens of each place (equal counts by token, a null one first), in one read."""
        wanted = {**bounds, ROWS: 1}
        limits = [wanted.get(name, 0) for name in self.places]
        limit = F.get(F.array(*[F.lit(x) for x in limits]), F.col("place"))
        order = Window.partitionBy("place").orderBy(F.col("token").isNotNull(), F.desc("n"), "token")
        ranked = self.table.where(limit > 0).withColumn("rank", F.row_number().over(order))
        rows = ranked.where(F.col("rank") <= limit).orderBy("place", "rank").collect()
        names = list(self.places)
        out: dict[str, list[Row]] = {name: [] for name in names}
        for r in rows:
            out[names[r["place"]]].append(r)
        return out


def number_statistics(rows: Sequence[Row]) -> dict[str, dict]:
    """Column -> n, mean, std, min, max and skew, from the rows of a place of numbers."""
    return {
        r["token"]: {
            "n": r["filled"],
            "mean": r["mean"],
            "std": None if r["variance"] is None else math.sqrt(r["variance"]),
            "min": r["low"],
            "max": r["high"],
            "skew": r["skew"],
        }
        for r in rows
    }


def indicator_statistics(ones: int, rows: int) -> dict:
    """The statistics of a column of ``ones`` ones and zeros else."""
    share = ones / rows if rows else 0.0
    variance = share * (1 - share)
    return {
        "n": rows,
        "mean": share if rows else None,
        "std": math.sqrt(variance),
        "min": (1.0 if ones == rows else 0.0) if rows else None,
        "max": (1.0 if ones else 0.0) if rows else None,
        "skew": (1 - 2 * share) / math.sqrt(variance) if variance else None,
    }


def weighted_statistics(tables: Mapping[str, DataFrame], centres: Mapping[str, float]) -> dict[str, dict]:
    """The statistics of columns given as tables (value, n), all in one pass.

    Moments are taken about ``centres``, numbers near the means, so that no precision is lost.
    """
    names = list(tables)
    if not names:
        return {}
    union = None
    for i, name in enumerate(names):
        part = tables[name].select(F.lit(i).alias("position"), F.col("value").alias("v"), "n")
        union = part if union is None else union.unionByName(part)
    off = F.col("v") - per_position([centres[c] for c in names])
    moments = [F.sum(F.col("n") * off**k).alias(f"m{k}") for k in (1, 2, 3)]
    found = union.groupBy("position").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), *moments)
    out = {c: indicator_statistics(0, 0) | {"n": 0} for c in names}
    for r in found.collect():
        n, a = r["n"], [r[f"m{k}"] / r["n"] for k in (1, 2, 3)]
        variance = max(a[1] - a[0] ** 2, 0.0) if r["low"] != r["high"] else 0.0
        third = a[2] - 3 * a[0] * a[1] + 2 * a[0] ** 3
        out[names[r["position"]]] = {
            "n": n,
            "mean": centres[names[r["position"]]] + a[0],
            "std": math.sqrt(variance),
            "min": r["low"],
            "max": r["high"],
            "skew": third / variance**1.5 if variance else None,
        }
    return out
