"""Delimited and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep import presets
from sparkprep.functions.columns import col
from sparkprep.sources.records import records

CORRUPT = "_corrupt_line"
COMPRESSED = (".gz", ".bz2", ".zst")


def header_names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Field names of the header line; reads one line."""
    reader = spark.read.option("sep", sep).option("header", True).option("escape", '"')
    return reader.csv(path).columns


def null_if_token(c: Column, null_tokens: Sequence[str]) -> Column:
    return F.when(~c.isin(list(null_tokens)), c)


def extra_fields(line: Column, sep: str) -> Column:
    """Separators in a line outside its quoted parts."""
    bare = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    columns: Sequence[str] | None = None,
    numeric: Sequence[str] = (),
    null_tokens: Sequence[str] = tuple(presets.NULL_TOKENS),
    multi_line: bool | None = None,
) -> DataFrame:
    """Header-led delimited text as strings, with ``numeric`` columns as doubles.

    Lines with more fields than the header are skipped, shorter ones padded with nulls;
    null tokens and unreadable numbers become NULL. ``columns`` keeps the listed ones that
    exist. Every file's header must name the same columns in the same order; another one is an error.

    Line breaks inside quotes belong to the field. Plain files are split and read by many tasks all the
    same (see :mod:`sparkprep.sources.records`); ``multi_line=True`` reads each file by one task, which is the
    default where all files are compressed and one task reads each anyway, and ``multi_line=False`` takes every line as a record.
    """
    if multi_line is None and all(f.endswith(COMPRESSED) for f in spark.read.text(path).inputFiles()):
        multi_line = True
    names = header_names(spark, path, sep)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    if multi_line is None:
        raw = _from_records(spark, path, sep, names)
    else:
        raw = (
            spark.read.schema(schema)
            .option("sep", sep)
            .option("header", True)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False)
            .option("enforceSchema", False)
            .option("multiLine", multi_line)
            .csv(path)
        )
    line = col(CORRUPT)
    # Spark refuses to scan the corrupt line alone, as a plain count would; this reads a field.
    first = F.length(F.concat_ws("", col(names[0]))) >= 0
    whole = raw.where(first & (line.isNull() | (extra_fields(line, sep) < len(names))))
    wanted = [n for n in (columns or names) if n in names]
    out = []
    for n in wanted:
        text = null_if_token(col(n), null_tokens)
        if n in numeric:
            parsed = text.try_cast("double")
            out.append(F.when(~F.isnan(parsed), parsed).alias(n))
        else:
            out.append(text.alias(n))
    return whole.select(*out)


def _from_records(spark: SparkSession, path: str, sep: str, names: Sequence[str]) -> DataFrame:
    """The records of plain files as strings, without the header of each."""
    quoted = ["`" + n.replace("`", "``") + "` string" for n in [*names, CORRUPT]]
    options = {
        "sep": sep,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "multiLine": "true",
    }
    read = records(spark, path, sep).where(F.trim("record") != "")
    cells = read.select("first", F.from_csv("record", ", ".join(quoted), options).alias("cells"))
    told = F.array(*[F.lower(F.trim(F.coalesce(F.col("cells")[n], F.lit("")))) for n in names])
    same = told == F.array(*[F.lit(n.strip().lower()) for n in names])
    data = (
        F.when(~F.col("first"), True)
        .when(same, False)
        .otherwise(F.raise_error(F.lit(f"a file under {path} has another header")).cast("boolean"))
    )
    return cells.where(data).select("cells.*")


def missing_names(available: Sequence[str], wanted: Sequence[str]) -> list[str]:
    return [n for n in wanted if n not in available]


def read_csv(
    spark: SparkSession, path: str, numeric: Sequence[str] = (), **options
) -> DataFrame:
    """A comma-separated table with a header."""
    return read_delimited(spark, path, sep=",", numeric=numeric, **options)


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write a table; Parquet between stages, ``csv`` with a header for other readers."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(format).save(path)
