"""Statistics of many columns in one pass.

The columns are exploded to (position, value) rows and aggregated by position. The
aggregate then has a few expressions instead of a few per column; with dozens of columns
the wide form outgrows what the JVM compiles and is several times slower. Partial
aggregation reduces every task to one row per column before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.columns import number, value

Aggregate = Callable[[Column], Column]


def per_position(bounds: Sequence[float | None]) -> Column:
    """The constant of the row's column, from one constant per column."""
    return F.get(F.array(*[F.lit(b).cast("double") for b in bounds]), F.col("position"))


def exploded(df: DataFrame, columns: Sequence[str], **carried: Column) -> DataFrame:
    """Rows (carried..., position, v), NaN read as NULL."""
    values = F.array(*[number(df, c) for c in columns])
    kept = [c.alias(n) for n, c in carried.items()]
    return df.select(*kept, F.posexplode(values).alias("position", "v"))


def column_statistics(
    df: DataFrame,
    columns: Sequence[str],
    aggregates: Mapping[str, Aggregate],
    **carried: Column,
) -> dict[str, dict]:
    """Column -> aggregate name -> value, None where the table has no rows."""
    empty = {name: None for name in aggregates}
    result = {c: dict(empty) for c in columns}
    if not columns:
        return result
    rows = exploded(df, columns, **carried).groupBy("position")
    for r in rows.agg(*[f(F.col("v")).alias(n) for n, f in aggregates.items()]).collect():
        result[columns[r["position"]]] = {n: r[n] for n in aggregates}
    return result


def presence(df: DataFrame, columns: Sequence[str], chosen: Column | None = None) -> dict:
    """Column -> (rows, non-null values, chosen rows, non-null values among them)."""
    among = F.lit(True) if chosen is None else chosen
    flags = F.array(*[value(df, c).isNotNull() for c in columns])
    rows = df.select(among.alias("chosen"), F.posexplode(flags).alias("position", "present"))
    found = rows.groupBy("position").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("present").alias("present"),
        F.count_if("chosen").alias("chosen"),
        F.count_if(F.col("present") & F.col("chosen")).alias("both"),
    )
    result = {c: (0, 0, 0, 0) for c in columns}
    for r in found.collect():
        result[columns[r["position"]]] = (r["rows"], r["present"], r["chosen"], r["both"])
    return result


def distinct_counts(df: DataFrame) -> DataFrame:
    """Per column position: rows, missing cells and exact distinct non-null values.

    Every cell becomes a narrow typed record, a text its 128-bit hash; equal ones are merged in
    each task before the single shuffle, so a frequent value costs no more than a rare one and no
    text is moved.
    """
    records = []
    for i, field in enumerate(df.schema.fields):
        c = value(df, field.name)
        kind = field.dataType
        whole = isinstance(kind, (T.IntegralType, T.BooleanType))
        real = isinstance(kind, (T.FloatType, T.DoubleType))
        text = None if whole or real else c.cast("string")
        records.append(
            F.struct(
                F.lit(i).alias("position"),
                (c.cast("long") if whole else F.lit(None).cast("long")).alias("w"),
                (c.cast("double") if real else F.lit(None).cast("double")).alias("r"),
                (F.unhex(F.md5(text)) if text is not None else F.lit(None).cast("binary")).alias("t"),
            )
        )
    cells = df.select(F.inline(F.array(*records)))
    merged = cells.groupBy("position", "w", "r", "t").agg(F.count(F.lit(1)).alias("n"))
    missing = F.col("w").isNull() & F.col("r").isNull() & F.col("t").isNull()
    return merged.groupBy("position").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(~missing).alias("distinct"),
    )
