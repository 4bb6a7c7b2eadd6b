"""Session defaults and the shared folder for landed intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkprep")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        # Wide projections outgrow what the JVM compiles as one method; split them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Do not record a Python call site for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    A temporary folder is used only when the whole session runs on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    return None


@cache
def _local_folder() -> str:
    """A folder of this process, which is gone when it ends."""
    folder = tempfile.mkdtemp(prefix="sparkprep-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def application_folder(spark: SparkSession) -> str:
    """Where this application lands its tables."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{folder}/sparkprep-{spark.sparkContext.applicationId}"


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_landed(spark: SparkSession) -> None:
    """Delete every table this application has landed; for the end of a job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For plans that several fitting passes would otherwise recompute (a join, a gzip
    scan). The written table survives lost executors and keeps column pruning and
    filter pushdown, which a cached or checkpointed row store does not. A cluster without
    ``spark.checkpoint.dir`` is an error, as it is for every other landed table.
    """
    spark = df.sparkSession
    path = run_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
