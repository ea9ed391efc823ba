"""Order-dependent results over groups of any size.

A window over one group sorts that group in one task. Here rows are range
partitioned over group and order columns together, so that a large group spreads
over many tasks; totals of the slices then carry from one slice to the next.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.storage import materialize


def range_slices(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` cut into slices that follow each other in ``order``.

    Slices have near-equal size as long as few rows are equal in all of
    ``order``. They are written out, so their numbers stay fixed for every later
    use of the result.
    """
    ordered = df.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    return materialize(ordered, "slices")


def sums_before(
    df: DataFrame, by: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """Per row, the sums of ``values`` over the rows of its group that sort before it.

    ``by`` and ``order`` together must be unique. Adds ``<value>_before`` for each
    of ``values``. NULL in ``by`` forms a group of its own; without ``by`` there is one group.
    """
    sliced = range_slices(df, by + order)
    # At most one row per slice and one more per group.
    per_slice = sliced.groupBy(*by, "slice").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(c).alias(f"carry_{c}") for c in [*by, "slice"]]
    carry = per_slice.select(
        *keys, *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"carry_{v}") for v in values]
    )
    inside = (
        Window.partitionBy(*by, "slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = sliced.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"{v}_before") for v in values]
    )
    same = [F.col(c).eqNullSafe(F.col(f"carry_{c}")) for c in by]
    same.append(F.col("slice") == F.col("carry_slice"))
    return local.join(carry, same).select(
        *df.columns,
        *[(F.col(f"{v}_before") + F.col(f"carry_{v}")).alias(f"{v}_before") for v in values],
    )


def rows_at(
    df: DataFrame, order: list[str], positions: Callable[[int], list[int]]
) -> dict[int, tuple[tuple, int, int]]:
    """What stands at some 1-based positions of the sorted frame.

    Per position the ``order`` values, the number of rows that sort before them, and the
    number of rows equal in them. ``positions`` names the positions given the number of
    rows. Equal rows are counted first, map-side, so many copies are one row of
    the ranking; the driver gets one row per position.
    """
    cells = materialize(df.groupBy(*order).agg(F.count(F.lit(1)).alias("n")), "cells")
    places = positions(cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    if not places:
        return {}
    placed = sums_before(cells, [], order, ["n"])
    wanted = df.sparkSession.createDataFrame([(p,) for p in places], "place long")
    here = (F.col("n_before") < F.col("place")) & (F.col("place") <= F.col("n_before") + F.col("n"))
    found = placed.join(F.broadcast(wanted), here).collect()
    return {r["place"]: (tuple(r[c] for c in order), r["n_before"], r["n"]) for r in found}


def numbered(df: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``place``, 1 to n among the rows equal in ``by``, in no particular order.

    Rows are numbered within the partitions they are read in, which are written out, and
    totals carry from one to the next; so many equal rows do not meet in one task.
    """
    written = materialize(
        df.withColumn("slice", F.spark_partition_id()).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "numbered",
    )
    per_slice = written.groupBy(*by, "slice").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *[F.col(c).alias(f"carry_{c}") for c in [*by, "slice"]],
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carry"),
    )
    local = written.withColumn(
        "local", F.row_number().over(Window.partitionBy(*by, "slice").orderBy("row"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"carry_{c}")) for c in [*by, "slice"]]
    return local.join(carry, same).select(*df.columns, (F.col("local") + F.col("carry")).alias("place"))
