"""Column lookup and casts that yield NULL instead of failing."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` called ``name``, ignoring case, as the frame spells it."""
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise ValueError(f"no column {name!r} among {df.columns}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns, leaving out ``exclude`` (case ignored)."""
    skipped = {name.lower() for name in exclude}
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name.lower() not in skipped
    ]


def text_to_double(column: Column) -> Column:
    """Text as a double, NULL when it is no number.

    The pattern is there for speed: a failed cast costs an exception per row.
    """
    return F.when(column.rlike(NUMBER), column.try_cast("double"))


def lenient_double(df: DataFrame, name: str) -> Column:
    """``name`` as a double; text that is no number and non-numeric types give NULL."""
    kind = df.schema[resolve(df, name)].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(F.col(name))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.col(name).try_cast("double")
    return F.lit(None).cast("double")


def lenient_int(df: DataFrame, name: str, to: str = "int") -> Column:
    """``name`` as an integer, truncating; text goes through double so "3.7" gives 3."""
    column = F.col(name)
    if isinstance(df.schema[resolve(df, name)].dataType, T.StringType):
        column = text_to_double(column)
    return column.try_cast(to)
