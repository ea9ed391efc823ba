"""Writing tables, snapshots and reports."""

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.sources.jdbc import JdbcSource


def append_table(df: DataFrame, target) -> None:
    """Add rows to a Parquet folder or a database table."""
    if isinstance(target, JdbcSource):
        df.write.jdbc(target.url, target.table, mode="append", properties=target.properties)
    else:
        df.write.mode("append").parquet(target)


def replace_dates(df: DataFrame, target: str, key: str = "Date") -> None:
    """Write ``df`` partitioned by ``key``, replacing only the dates it holds.

    Running it again with the same rows changes nothing. The rebalance hint
    gathers each date into few files and splits a date too large for one task.
    """
    (
        df.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(target)
    )


def clear_dates(
    spark: SparkSession, target: str, start: str, end: str, kept: DataFrame, key: str = "Date"
) -> None:
    """Empty the dates of ``[start, end]`` in a table by date that ``kept`` does not hold.

    Their folders go, so the driver handles one name per cleared date.
    """
    present = spark.read.parquet(target).where(F.col(key).cast("string").between(str(start), str(end)))
    gone = present.select(F.col(key).cast("string").alias(key)).distinct()
    gone = gone.join(kept.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_anti")
    context = spark.sparkContext
    for row in gone.collect():
        path = context._jvm.org.apache.hadoop.fs.Path(f"{target}/{key}={row[key]}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def write_snapshot(df: DataFrame, folder: str, at: datetime) -> str:
    """Write a snapshot named after a point in time and return its path."""
    path = f"{folder}/processed_data_{at:%Y-%m-%d_%H%M%S}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_daily_summary(summary: DataFrame, target: str) -> None:
    """Create the summary table if absent and replace the dates in ``summary``."""
    replace_dates(summary, target, "Date")


def read_if_present(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A scan of a Parquet folder, or None when the folder is missing or has no files."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return found if schema is None else spark.read.schema(schema).parquet(path)


def load_once(spark: SparkSession, target: str, loader: Callable[[], DataFrame]) -> DataFrame:
    """Fill ``target`` from ``loader`` unless it already holds rows."""
    present = read_if_present(spark, target)
    if present is None or present.isEmpty():
        loader().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_report(df: DataFrame, path: str) -> None:
    """Write a report as one CSV file with a header; a report has one row per chunk."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def to_json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in column ``json``, NULL fields included."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
