"""Saved splits: one table partitioned by part, and its metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import col
from sparkprep.operators.splitting import PARTS, split_balance, split_distribution
from sparkprep.sources.reports import write_report


def save_splits(df: DataFrame, path: str, split_col: str = presets.SPLIT) -> dict[str, str]:
    """Write the tagged table partitioned by part; returns part -> folder.

    Each task writes its own rows of each part, so nothing is shuffled.
    """
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return {p: f"{path}/{split_col}={p}" for p in PARTS}


def load_split(
    spark: SparkSession,
    path: str,
    part: str,
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
) -> tuple[DataFrame, DataFrame]:
    """Features and label of one part; only its folder is read."""
    rows = spark.read.parquet(path).where(col(split_col) == part)
    return rows.drop(label, split_col), rows.select(col(label))


def load_train_data(spark: SparkSession, path: str, **names: str) -> tuple[DataFrame, DataFrame]:
    return load_split(spark, path, "train", **names)


def load_val_data(spark: SparkSession, path: str, **names: str) -> tuple[DataFrame, DataFrame]:
    return load_split(spark, path, "val", **names)


def load_test_data(spark: SparkSession, path: str, **names: str) -> tuple[DataFrame, DataFrame]:
    return load_split(spark, path, "test", **names)


def split_metadata(
    df: DataFrame,
    config: Mapping[str, object],
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
) -> DataFrame:
    """One row per class and part with share, plus configuration and balance."""
    settings = [F.lit(str(v)).alias(k) for k, v in config.items()]
    balance = split_balance(df, label, split_col).first()
    return split_distribution(df, label, split_col).select(
        "*",
        F.lit(balance["max_deviation"]).alias("max_deviation"),
        F.lit(balance["is_balanced"]).alias("is_balanced"),
        *settings,
    )


def save_split_metadata(
    df: DataFrame,
    config: Mapping[str, object],
    path: str,
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
) -> None:
    write_report(split_metadata(df, config, label, split_col), path)
