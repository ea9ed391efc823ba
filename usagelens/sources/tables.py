"""Scans of usage-record, processed and prediction tables."""

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import day_range
from usagelens.schemas import PREDICTION_COLUMNS, PROCESSED_SCHEMA
from usagelens.sources.jdbc import JdbcSource
from usagelens.storage import scratch_path


def read_source(spark: SparkSession, source, schema=None) -> DataFrame:
    """A frame from a Parquet path, a JDBC source, or a frame passed through."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, JdbcSource):
        return source.read(spark)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def scan_cdr(spark: SparkSession, source, start, end, column: str = "DP_DATE") -> DataFrame:
    """Records whose calendar day lies in ``[start, end]``, both included."""
    if isinstance(source, JdbcSource):
        return source.read_range(spark, start, end)
    df = read_source(spark, source)
    return df.where(day_range(df, column, start, end))


def scan_processed(spark: SparkSession, source, start: str, end: str) -> DataFrame:
    """Processed records with ISO text ``Date`` in ``[start, end]``.

    On a table partitioned by ``Date`` this prunes partitions.
    """
    schema = PROCESSED_SCHEMA if isinstance(source, str) else None
    return read_source(spark, source, schema).where(F.col("Date").between(start, end))


def scan_string_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Records whose ``column`` lies between two texts in text order.

    Times after midnight on the end day sort after the bare end date and fall
    out, and impossible dates compare as plain text.
    """
    return df.where(F.col(column).cast("string").between(start, end))


def scan_predictions(spark: SparkSession, source) -> DataFrame:
    """The five prediction columns monitoring needs; other columns are not read."""
    return read_source(spark, source).select(*PREDICTION_COLUMNS)


def scan_snapshots(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows of several processed snapshots, kept with their copies."""
    return spark.read.schema(PROCESSED_SCHEMA).parquet(*paths)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns, kept with their copies."""
    return reduce(DataFrame.unionByName, frames)


def seed_rows(df: DataFrame, n: int = 10_000) -> DataFrame:
    """Any ``n`` rows, or all if fewer, with ``DP_DATE`` parsed to a timestamp.

    The frame is written first, as it may come out in another order each time it is read;
    ``scan_seed`` takes rows of a Parquet table as it lies. Runs at once.
    """
    path = scratch_path(df.sparkSession, "seeds")
    df.write.parquet(path)
    return scan_seed(df.sparkSession, path, n, df.schema)


def scan_seed(spark: SparkSession, path: str, n: int = 10_000, schema=None) -> DataFrame:
    """Any ``n`` rows of a Parquet table, or all if fewer, with ``DP_DATE`` parsed to a timestamp.

    Files are taken in the order of their names until they hold ``n`` rows, and only the last
    one is cut. Their numbers of rows come from the footers, of twice as many files each time, so
    neither data nor footers of the other files are read. Runs at once.
    """
    table = read_source(spark, path, schema)
    # Listed names are escaped as in a URL.
    files = sorted(unquote(f) for f in table.inputFiles())

    def of(paths):
        # The base path keeps the columns that folder names hold.
        return spark.read.schema(table.schema).option("basePath", path).parquet(*paths)

    whole, room, at, step = [], n, 0, 1
    cut = None
    while room > 0 and at < len(files):
        some = files[at : at + step]
        counts = of(some).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        rows = {_name(r["file"]): r["rows"] for r in counts.collect()}
        for file in some:
            held = rows.get(_name(file), 0)
            if held > room > 0:
                cut = (file, room)
            elif room > 0:
                whole.append(file)
            room -= held
        at, step = at + step, step * 2
    parts = [of(whole)] if whole else []
    if cut:
        parts.append(of([cut[0]]).where(F.col("_metadata.row_index") < cut[1]).select(*table.columns))
    seeds = union_all(*parts) if parts else table.limit(0)
    return seeds.withColumn("DP_DATE", F.col("DP_DATE").try_cast("timestamp"))


def _name(path: str) -> str:
    """A file's path without its scheme, which listings write in several ways."""
    return unquote(re.sub("^[a-z0-9]+:/+", "/", path))
