"""Shared scratch space for intermediate tables.

Intermediate results that more than one job needs are written as Parquet below
the folder the cluster names in ``spark.checkpoint.dir``. They outlive any
executor, their size is known once written, and later reads prune columns.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session.

    A temporary folder stands in only on a local master with no setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if context.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="usagelens-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_dir(spark)}/usagelens/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
