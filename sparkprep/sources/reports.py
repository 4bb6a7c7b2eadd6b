"""Reports are small DataFrames, written as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_report(report: DataFrame, path: str) -> None:
    """One JSON file; a report has a row per column, class or check."""
    report.repartition(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
