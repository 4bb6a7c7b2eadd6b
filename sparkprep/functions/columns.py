"""Column helpers: quoting, type families, NaN handling, small result frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col(_quoted(name))


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Integers, floats and decimals; booleans and dates are not numeric."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def value(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL."""
    return F.expr(f"nanvl({_quoted(name)}, NULL)") if is_floating(df, name) else col(name)


def number(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN read as NULL."""
    if is_floating(df, name):
        return F.expr(f"nanvl(CAST({_quoted(name)} AS DOUBLE), NULL)")
    return F.expr(f"CAST({_quoted(name)} AS DOUBLE)")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One projection that turns every NaN into NULL."""
    return df.select(*[value(df, n).alias(n) for n in df.columns])


def percent2(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, half-even rounded to two places; 0 of 0 is 0."""
    share = part.cast("double") / whole * F.lit(100.0)
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.rint(share * 100.0) / 100.0)


def rounded_percent(part: int, whole: int) -> float:
    """:func:`percent2` of driver-held counts."""
    return round(part / whole * 100.0 * 100.0) / 100.0 if whole else 0.0


def one_row_to_many(agg: DataFrame, records: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn a one-row aggregate into one row per record, each a list of (name, column)."""
    structs = [F.struct(*[c.alias(n) for n, c in record]) for record in records]
    return agg.select(F.inline(F.array(*structs)))


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Frame of driver-held rows (fitted statistics). Its size is known to the optimizer."""
    fields = T.StructType.fromDDL(schema)
    arrow = {
        T.StringType(): pa.string(),
        T.DoubleType(): pa.float64(),
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.BooleanType(): pa.bool_(),
    }
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    table = pa.table(
        {f.name: pa.array(list(v), arrow[f.dataType]) for f, v in zip(fields, columns)}
    )
    return spark.createDataFrame(table, fields)
