"""Row-wise reshaping of usage records."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import lenient_double, lenient_int, resolve
from usagelens.operators.nulls import nan_to_null
from usagelens.operators.sampling import sample_n


def transform_cdr(df: DataFrame) -> DataFrame:
    """Raw records to the nine processed columns, in one projection."""
    stamp = F.col("DP_DATE")
    if isinstance(df.schema[resolve(df, "DP_DATE")].dataType, T.StringType):
        stamp = stamp.try_cast("timestamp")
    return df.select(
        F.date_format(stamp, "yyyy-MM-dd").alias("Date"),
        F.col("DP_MSISDN").cast("string").alias("User"),
        lenient_int(df, "DP_MOC_COUNT").alias("M_Out_Call_Count"),
        lenient_double(df, "DP_MOC_DURATION").alias("M_Out_Call_Time"),
        lenient_double(df, "DP_DATA_VOLUME").alias("M_Data_Sum"),
        lenient_int(df, "DP_DATA_COUNT").alias("M_Data_Count"),
        lenient_int(df, "DP_MTC_COUNT").alias("M_In_Call_Count"),
        lenient_double(df, "DP_MTC_DURATION").alias("M_In_Call_Time"),
        lenient_int(df, "PSEUDO_CHURNED").alias("M_Tenure_Churn"),
    )


def class_rows(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(column) == value)


def latest_rows(
    df: DataFrame, n: int = 100, by: str = "DP_DATE", tiebreak: tuple[str, ...] = ("id",)
) -> DataFrame:
    """The ``n`` newest rows; ``tiebreak`` columns make the choice among equals fixed."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).desc() for c in tiebreak]).limit(n)


def augment(
    df: DataFrame,
    n: int,
    now: datetime,
    jitter_s: int = 300,
    sigma: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """``n`` sampled rows stamped near ``now`` with relative noise on every measure.

    ``DP_DATE`` becomes ``now`` plus a whole number of seconds in
    ``[-jitter_s, jitter_s]``, every numeric column but ``id`` is multiplied by
    1 + N(0, sigma), ``id`` is dropped and NaN becomes NULL.
    """
    picked = sample_n(df, n, seed)
    jitter = F.floor(F.rand(seed + 1) * (2 * jitter_s + 1)).cast("int") - jitter_s
    stamped = F.timestamp_seconds(F.unix_timestamp(F.lit(now).cast("timestamp")) + jitter)
    columns = []
    for i, field in enumerate(picked.schema.fields):
        if field.name.lower() == "id":
            continue
        if field.name.lower() == "dp_date":
            columns.append(stamped.alias(field.name))
        elif isinstance(field.dataType, T.NumericType):
            noise = 1 + F.randn(seed + 2 + i) * sigma
            columns.append((F.col(field.name) * noise).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return nan_to_null(picked.select(*columns))
