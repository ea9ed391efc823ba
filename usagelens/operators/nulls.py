"""Filling, dropping and coercing missing values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import lenient_double


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """NULL and NaN in numeric columns become ``value``; text is left alone."""
    return df.fillna(value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns becomes NULL."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without NULL in ``columns``."""
    return df.dropna(subset=columns)


def null_shares(df: DataFrame) -> DataFrame:
    """One row with the share of NULLs in every column; NULL shares on an empty frame."""
    return df.agg(
        *[F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(c) for c in df.columns]
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """The columns with at least one value. Runs one aggregate over ``df``."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def drop_sparse_columns(df: DataFrame, threshold: float = 0.6) -> DataFrame:
    """The columns whose share of NULLs is at most ``threshold``.

    Runs one aggregate over ``df``; an empty frame keeps all its columns.
    """
    shares = null_shares(df).first()
    return df.select(*[c for c in df.columns if shares[c] is None or shares[c] <= threshold])


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default all) as doubles; what is no number becomes NULL."""
    chosen = set(columns or df.columns)
    return df.select(
        *[lenient_double(df, c).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )
