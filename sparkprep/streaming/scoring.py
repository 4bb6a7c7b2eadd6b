"""Fitted stages on a stream: every transform is a projection, filter or broadcast join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, files: int = 1_000) -> DataFrame:
    """New Parquet files of a folder, at most ``files`` per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def prepare_stream(
    model, rows: DataFrame, output_path: str, checkpoint_path: str
) -> StreamingQuery:
    """Transform the rows available now with a fitted model and append them as Parquet.

    ``checkpoint_path`` belongs to ``output_path``: it holds which files have been read, so a later run
    with both goes on where the last one ended. The output's own log numbers its batches by the
    checkpoint, so an output that another checkpoint has filled is refused. Statistics come from the fit; stages that would recompute them per table
    (``stats_from="transform"``) cannot run on a stream.
    """
    for stage in getattr(model, "stages", [model]):
        if stage.hasParam("stats_from") and stage.getOrDefault("stats_from") == "transform":
            raise ValueError("a stream needs statistics from the fit")
    spark = rows.sparkSession
    if _exists(spark, f"{output_path}/_spark_metadata") and not _exists(spark, f"{checkpoint_path}/commits"):
        raise ValueError(f"{output_path} was filled with another checkpoint than {checkpoint_path}")
    return (
        model.transform(rows)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
