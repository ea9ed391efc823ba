"""Calendar-day predicates that reach the file scan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.columns import resolve


def day_of(df: DataFrame, name: str) -> Column:
    """The calendar day of a date, timestamp or text column; unreadable text gives NULL."""
    if isinstance(df.schema[resolve(df, name)].dataType, T.StringType):
        return F.col(name).try_cast("timestamp").cast("date")
    return F.col(name).cast("date")


def day_range(df: DataFrame, name: str, start, end) -> Column:
    """True when the day of ``name`` lies in ``[start, end]``, both included.

    ``start`` and ``end`` are dates, ISO strings or columns. For date and
    timestamp columns the test stays on the bare column, so Parquet row groups
    and partitions outside the range are skipped.
    """
    kind = df.schema[resolve(df, name)].dataType
    first, last = (x if isinstance(x, Column) else F.lit(x) for x in (start, end))
    first, last = first.cast("date"), last.cast("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        column = F.col(name)
        after_last = F.date_add(last, 1).cast(kind)
        return (column >= first.cast(kind)) & (column < after_last)
    return day_of(df, name).between(first, last)
