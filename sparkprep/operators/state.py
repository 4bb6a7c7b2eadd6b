"""Profiles that merge: one stored state per chunk of a table, so that a new chunk is read alone.

A state is a small DataFrame with one row per column: rows, filled cells, the first three moments about the mean, extremes, a quantile
sketch (KLL) and a distinct-count sketch (HLL). Counts, moments and extremes of merged states are those of
the whole table; quantiles and distinct counts lie within the sketches' errors, whatever the number of chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.columns import col, number, numeric_columns, value

#: Size of the quantile sketches; see :func:`rank_error`.
K = 1024
DISTINCT_BITS = 14

STATE = (
    "column string, rows long, filled long, numbers long, mean double, m2 double, m3 double, low double, high double, "
    "quantiles binary, distinct binary"
)


def rank_error(k: int = K) -> float:
    """Largest error of the rank of a quantile, as a share of the values, in 99 of 100 sketches of size ``k``."""
    return 2.296 / k**0.9021


def profile_state(df: DataFrame, columns: Sequence[str] | None = None, k: int = K) -> DataFrame:
    """The state of the columns of one chunk, from one pass; text columns have no moments and quantiles."""
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    cells = [
        F.struct(
            F.lit(i).alias("place"),
            value(df, c).cast("string").alias("token"),
            (number(df, c) if c in numeric else F.lit(None).cast("double")).alias("v"),
        )
        for i, c in enumerate(columns)
    ]
    spread = F.var_pop("v") * F.count("v")
    found = df.select(F.inline(F.array(*cells))).groupBy("place").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("token").alias("filled"),
        F.count("v").alias("numbers"),
        F.avg("v").alias("mean"),
        spread.alias("m2"),
        F.coalesce(F.skewness("v") * F.count("v") * F.pow(F.stddev_pop("v"), F.lit(3.0)), spread * 0.0).alias("m3"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.kll_sketch_agg_double("v", F.lit(k)).alias("quantiles"),
        F.hll_sketch_agg("token", F.lit(DISTINCT_BITS)).alias("distinct"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(F.get(names, F.col("place")).alias("column"), *T.StructType.fromDDL(STATE).names[1:])


def merge_states(states: DataFrame) -> DataFrame:
    """One state per column from the rows of any number of states; associative, in any order."""
    # Moments are moved to one centre, the mean of all, where they add up.
    whole = states.groupBy("column").agg(
        (F.sum(F.col("mean") * F.col("numbers")) / F.sum(F.when(F.col("numbers") > 0, F.col("numbers")))).alias("centre")
    )
    off, n = F.col("mean") - F.col("centre"), F.col("numbers")
    m2 = F.col("m2") + n * off * off
    m3 = F.col("m3") + 3 * off * F.col("m2") + n * off * off * off
    return states.join(F.broadcast(whole), "column").groupBy("column").agg(  # one row per column
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.sum("numbers").alias("numbers"),
        F.max("centre").alias("mean"),
        F.sum(m2).alias("m2"),
        F.sum(m3).alias("m3"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double(F.when(n > 0, F.col("quantiles"))).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def quantile_columns(probabilities: Sequence[float]) -> Column:
    """Approximate quantiles of a state's row, null where the column has no numbers."""
    asked = [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))) for p in probabilities]
    return F.when(F.col("numbers") > 0, F.array(*asked))


def state_report(state: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: rows, missing cells, mean, std, skewness, extremes, distinct values and quantiles (approximate)."""
    n, m2 = F.col("numbers"), F.col("m2")
    variance = m2 / n
    return state.select(
        "column",
        "rows",
        (F.col("rows") - F.col("filled")).alias("missing"),
        F.col("numbers").alias("n"),
        "mean",
        F.sqrt(variance).alias("std"),
        F.when(m2 > 0, F.col("m3") / n / F.pow(variance, F.lit(1.5))).alias("skew"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        F.hll_sketch_estimate("distinct").alias("distinct"),
        quantile_columns(probabilities).alias("quantiles"),
    )


def statistics_of(state: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Column -> n, mean, std, min, max and skew, as fitted stages take them."""
    rows = state_report(state).where(F.col("column").isin(list(columns))).collect()
    empty = dict.fromkeys(("n", "mean", "std", "min", "max", "skew"))
    return {c: dict(empty) for c in columns} | {r["column"]: {k: r[k] for k in empty} for r in rows}


class ProfileStore:
    """States of the chunks of one table in a folder, one Parquet table per chunk."""

    def __init__(self, spark: SparkSession, path: str, label: str | None = None):
        self.spark, self.path, self.label = spark, path.rstrip("/"), label

    def add(self, df: DataFrame, chunk: str) -> None:
        """Store the state of a chunk; a chunk that is there is replaced, so adding it again counts it once."""
        profile_state(df).write.mode("overwrite").parquet(f"{self.path}/states/chunk={chunk}")
        if self.label:
            classes = df.groupBy(col(self.label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
            classes.write.mode("overwrite").parquet(f"{self.path}/classes/chunk={chunk}")

    def state(self) -> DataFrame:
        """The merged state; reads states only."""
        return merge_states(self.spark.read.schema(STATE).parquet(f"{self.path}/states/chunk=*"))

    def class_counts(self) -> DataFrame:
        """Rows per class over all chunks."""
        classes = self.spark.read.schema("label string, n long").parquet(f"{self.path}/classes/chunk=*")
        return classes.groupBy("label").agg(F.sum("n").alias("n"))


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], k: int = K
) -> dict[str, list[float | None]]:
    """Quantiles per column from sketches, all columns in one pass; ranks are off by :func:`rank_error` at most."""
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if columns:
        values = F.array(*[number(df, c) + F.lit(0.0) for c in columns])
        rows = df.select(F.posexplode(values).alias("place", "v")).groupBy("place")
        found = rows.agg(F.count("v").alias("numbers"), F.kll_sketch_agg_double("v", F.lit(k)).alias("quantiles"))
        for r in found.select("place", quantile_columns(probabilities).alias("q")).where("q IS NOT NULL").collect():
            result[columns[r["place"]]] = list(r["q"])
    return result
