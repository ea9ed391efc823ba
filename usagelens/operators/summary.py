"""Totals and means per day, per subscriber and per class."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import day_of, day_range
from usagelens.schemas import RAW_MEASURES, SUMMARY_SCHEMA, TARGET


def summary_totals() -> list:
    """The four totals of the daily summary, before rounding."""
    return [
        F.sum("DP_MOC_COUNT").alias("Total_Outgoing_Calls"),
        F.sum("DP_MOC_DURATION").alias("Total_Outgoing_Call_Time"),
        F.sum("DP_DATA_COUNT").alias("Total_Data_Purchases"),
        F.sum("DP_DATA_VOLUME").alias("Total_Data_Volume"),
    ]


def as_summary(totals: DataFrame) -> DataFrame:
    """Round totals to the summary types: whole numbers, and volume to 2 decimals."""
    columns = []
    for field in SUMMARY_SCHEMA.fields:
        value = F.col(field.name)
        if field.name == "Total_Data_Volume":
            value = F.round(value, 2)
        elif field.name != "Date":
            value = F.round(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return totals.select(*columns)


def daily_summary(df: DataFrame, start, end=None, column: str = "DP_DATE") -> DataFrame:
    """Calls, call time, purchases and data volume per day from ``start`` to ``end``.

    ``end`` defaults to today. Map-side partial sums leave one row per day and
    task for the shuffle, whatever the share of one day.
    """
    last = F.current_date() if end is None else end
    inside = df.where(day_range(df, column, start, last))
    return as_summary(inside.groupBy(day_of(df, column).alias("Date")).agg(*summary_totals()))


def recent_summary(df: DataFrame, days: int, today=None, column: str = "DP_DATE") -> DataFrame:
    """``daily_summary`` from ``days`` days before ``today`` (default the current date) up to it."""
    last = F.current_date() if today is None else F.lit(today).cast("date")
    return daily_summary(df, F.date_sub(last, days), last, column)


def user_call_time(df: DataFrame) -> DataFrame:
    """Outgoing call time per subscriber."""
    return df.groupBy("User").agg(F.sum("M_Out_Call_Time").alias("M_Out_Call_Time_sum"))


def daily_mean_data(df: DataFrame) -> DataFrame:
    """Mean data volume per date."""
    return df.groupBy("Date").agg(F.avg("M_Data_Sum").alias("M_Data_Sum_avg"))


def class_counts(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Rows per class."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def sum_by_date(df: DataFrame, key: str = "DP_DATE") -> DataFrame:
    """Sums of the eight measures per ``key``, sorted by it.

    Rows without a key are left out and a sum over NULLs only is 0.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in RAW_MEASURES])
        .orderBy(key)
    )


def mean_by_date(df: DataFrame, key: str = "DP_DATE") -> DataFrame:
    """Means of the eight measures per ``key``, sorted by it; over NULLs only NULL."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.avg(c).alias(c) for c in RAW_MEASURES])
        .orderBy(key)
    )


def high_watermark(df: DataFrame, column: str = "Date") -> DataFrame:
    """The largest value of ``column``, NULL when there is none."""
    return df.agg(F.max(column).alias("high_watermark"))


def distinct_dates(df: DataFrame, start, end=None, column: str = "DP_DATE") -> DataFrame:
    """The calendar days that occur from ``start`` to ``end`` (default today)."""
    last = F.current_date() if end is None else end
    inside = df.where(day_range(df, column, start, last))
    return inside.select(day_of(df, column).alias("Date")).distinct()
