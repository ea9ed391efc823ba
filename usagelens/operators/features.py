"""Per-date statistics and log features for the churn model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import resolve
from usagelens.operators.nulls import fill_numeric
from usagelens.schemas import STAT_COLUMNS, TARGET
from usagelens.storage import materialize

# Statistics rows sent to every executor; one row is under 200 bytes.
BROADCAST_ROWS = 100_000


def feature_names() -> list[str]:
    """The 32 model inputs: base columns, their date statistics, and the log of each."""
    stats = [f"{c}_{s}" for c in STAT_COLUMNS for s in ("sum", "mean", "stddev")]
    plain = STAT_COLUMNS + stats
    return plain + [f"{c}_log" for c in plain]


def add_date_stats(
    df: DataFrame,
    columns: list[str] | None = None,
    key: str = "Date",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds sum, mean and sample deviation of ``columns`` over all rows of the same date.

    The statistics are aggregated with map-side partial sums and written out, then
    put back on the rows, which are never shuffled by date. A NULL date is a group
    like any other.
    """
    columns = columns or STAT_COLUMNS
    stats = df.groupBy(F.col(key).alias("stat_key")).agg(
        F.count(F.lit(1)).alias("stat_rows"),
        *[
            made
            for c in columns
            for made in (
                F.sum(c).alias(f"{c}_sum"),
                F.mean(c).alias(f"{c}_mean"),
                F.stddev(c).alias(f"{c}_stddev"),
            )
        ],
    )
    joined = attach_stats(df, materialize(stats, "date-stats"), key, broadcast_rows)
    return joined.drop("stat_key", "stat_rows")


def attach_stats(df: DataFrame, stats: DataFrame, key: str, broadcast_rows: int) -> DataFrame:
    """Joins ``stats`` (one row per ``stat_key``, with ``stat_rows``) onto ``df``.

    Up to ``broadcast_rows`` statistics are broadcast. Beyond that only those of
    the largest groups are; every other group then holds less than one
    ``broadcast_rows``-th of the rows, so a shuffle by key has no hot partition.
    """
    same = F.col(key).eqNullSafe(F.col("stat_key"))
    if stats.count() <= broadcast_rows:
        return df.join(F.broadcast(stats), same, "left")
    by_size = stats.orderBy(F.desc("stat_rows"), "stat_key")
    large = materialize(by_size.limit(broadcast_rows), "large-groups")
    keys = large.select(F.col("stat_key").alias("large_key"))
    in_large = F.col(key).eqNullSafe(F.col("large_key"))
    rest = df.join(F.broadcast(keys), in_large, "left_anti")
    return df.join(F.broadcast(large), same).unionByName(rest.join(stats, same, "left"))


def log_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``<column>_log`` = ln(1 + x), NULL for x <= -1."""
    return df.select("*", *[F.log1p(c).alias(f"{c}_log") for c in columns])


def build_features(
    df: DataFrame,
    fill: str = "after",
    target: str = TARGET,
    drop_unlabeled: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The labelled feature table.

    ``fill="after"`` replaces missing values by 0 once all features are made, so
    statistics skip them. ``fill="before"`` fills the input instead: missing
    values count as 0, and the deviation of a one-row date stays NULL. Filling
    also gives unlabelled rows class 0 unless ``drop_unlabeled``.
    """
    if fill not in ("after", "before"):
        raise ValueError(f"fill must be 'after' or 'before', not {fill!r}")
    target = resolve(df, target)
    if drop_unlabeled:
        df = df.where(F.col(target).isNotNull())
    if fill == "before":
        df = fill_numeric(df, 0)
    plain = feature_names()[: len(feature_names()) // 2]
    made = log_features(add_date_stats(df, STAT_COLUMNS, "Date", broadcast_rows), plain)
    if fill == "after":
        made = fill_numeric(made, 0)
    return made.withColumnRenamed(target, "label")
