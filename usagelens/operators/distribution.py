"""Shapes of single columns: scaling, skew repair, histogram and density."""

from math import exp, pi, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.storage import materialize


def beside(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Every row of ``df`` with the columns of ``stats``, a frame of one row, which is broadcast.

    A scalar subquery would stand in the plan once per use and be planned as often.
    """
    return df.crossJoin(F.broadcast(stats))


def min_max_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``scaled_<column>`` = (x - min) / (max - min); NULL for a constant column."""
    bounds = df.agg(
        *[F.min(c).alias(f"lowest of {c}") for c in columns],
        *[F.max(c).alias(f"highest of {c}") for c in columns],
    )
    scaled = []
    for c in columns:
        low, high = F.col(f"lowest of {c}"), F.col(f"highest of {c}")
        scaled.append(F.try_divide(F.col(c) - low, high - low).alias(f"scaled_{c}"))
    return beside(df, bounds).select(*df.columns, *scaled)


def reflect_transform(df: DataFrame, column: str) -> DataFrame:
    """Mirrors a column at its maximum plus 1 and takes the reciprocal log.

    Adds ``reflected`` = (max + 1) - x and ``adjusted`` = 1 / ln(reflected), which
    is NULL at the maximum, and keeps only these two and the column itself.
    """
    top = df.agg((F.max(column) + 1).alias("highest and 1"))
    reflected = (F.col("highest and 1") - F.col(column)).alias("reflected")
    return beside(df.select(column), top).select(F.col(column), reflected).select(
        "*", F.try_divide(F.lit(1.0), F.log("reflected")).alias("adjusted")
    )


def positive_log(df: DataFrame, column: str) -> DataFrame:
    """Rows with a positive ``column``, with ``log_transformed`` = ln(1 + x)."""
    return df.where(F.col(column) > 0).withColumn("log_transformed", F.log1p(column))


def log_profile(df: DataFrame, column: str) -> DataFrame:
    """Mean and sample standard deviation of ln(1 + x) over positive values."""
    return positive_log(df, column).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("log_transformed").alias("mean"),
        F.stddev_samp("log_transformed").alias("std"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30, weight: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [min, max], the last one closed.

    A constant column is spread over [x - 0.5, x + 0.5]. Empty bins have count 0. With ``weight``
    each row counts that often.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    values = df.select(F.col(column).cast("double").alias("x"), times.alias("times")).where("x is not null")
    spread = values.agg(F.min("x").alias("low"), F.max("x").alias("high")).select(
        F.when(F.col("low") == F.col("high"), F.col("low") - 0.5)
        .otherwise(F.col("low"))
        .alias("low"),
        F.when(F.col("low") == F.col("high"), F.col("high") + 0.5)
        .otherwise(F.col("high"))
        .alias("high"),
    )
    placed = beside(values, spread)
    low, high = F.col("low"), F.col("high")
    width = (high - low) / bins
    bin_of = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    counted = placed.groupBy(bin_of.alias("bin")).agg(F.sum("times").cast("long").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return beside(every.join(counted, "bin", "left"), spread).select(
        "bin",
        (low + F.col("bin") * width).alias("left_edge"),
        (low + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def density_shape(df: DataFrame, column: str = "x", weight: str | None = None) -> DataFrame:
    """One row: range, number of values and Scott's bandwidth, deviation times n^(-1/5).

    With ``weight`` each row stands for that many equal values.
    """
    x = F.col(column)
    if weight is None:
        n, std = F.count(x), F.stddev_samp(x)
    else:
        w = F.when(x.isNotNull(), F.col(weight).cast("double"))
        n = F.coalesce(F.sum(w), F.lit(0.0))
        # Deviations from the mean need a second look at the values.
        mean = df.agg(F.try_divide(F.sum(w * x), F.sum(w)).alias("mean of values"))
        df = beside(df, mean)
        away = F.col("mean of values") - x
        std = F.when(n > 1, F.sqrt(F.try_divide(F.sum(w * away * away), n - 1)))
    shape = df.agg(F.min(x).alias("low"), F.max(x).alias("high"), n.cast("double").alias("total"), std.alias("std"))
    return shape.select("low", "high", "total", (F.col("std") * F.pow("total", F.lit(-0.2))).alias("h"))


def kde(df: DataFrame, column: str, grid: int = 200, block: int = 50, weight: str | None = None) -> DataFrame:
    """Gaussian density of ``column`` at ``grid`` even points from its min to its max.

    The bandwidth follows Scott's rule: sample deviation times n^(-1/5). Each task adds
    up the grid points over its own rows, ``block`` points in one projection, and one row of
    sums per task and block of points reaches the shuffle. With ``weight`` each row stands for
    that many equal values. Every value meets every point; ``kde_binned`` costs less.
    """
    source = df.select(F.col(column).cast("double").alias("x"), *([] if weight is None else [F.col(weight).alias("w")]))
    shape = density_shape(source, "x", None if weight is None else "w")
    step = (F.col("high") - F.col("low")) / (grid - 1)
    times = 1 if weight is None else F.col("w")

    def place_of(point):
        return F.col("low") + point * F.col("step")

    def mass(number):
        u = F.try_divide(place_of(F.col("block") * block + number) - F.col("x"), F.col("h"))
        return F.sum(F.exp(-0.5 * u * u) * times).alias(f"mass_{number}")

    shape = shape.withColumn("step", step)
    blocks = F.explode(F.sequence(F.lit(0), F.lit((grid - 1) // block))).alias("block")
    rows = beside(source.where("x is not null"), shape).select("*", blocks)
    sums = rows.groupBy("block").agg(*map(mass, range(block)))
    points = [
        F.struct((F.col("block") * block + i).alias("point"), F.col(f"mass_{i}").alias("mass"))
        for i in range(block)
    ]
    summed = sums.select(F.inline(F.array(*points))).where(F.col("point") < grid)
    return beside(summed, shape).select(
        "point",
        place_of(F.col("point")).alias("x"),
        F.try_divide(F.col("mass"), F.col("total") * F.col("h") * sqrt(2 * pi)).alias("density"),
    )


def kde_binned(df: DataFrame, column: str, grid: int = 200, bins: int = 2048, reach: float = 6.0) -> DataFrame:
    """``kde`` from binned values: (point, x, density, error_bound).

    A value's weight is split between the two of ``bins`` even places next to it, nearer ones
    getting more, and the density adds up the places within ``reach`` bandwidths of a point. Rows are
    read once for their range and once to be binned, with map-side sums of at most ``bins``
    rows a task; the rest is bins times grid, however many rows there are.

    For places d apart and bandwidth h, splitting replaces the kernel by chords between
    places, wrong by at most (d / h)^2 / 8 of its peak, and what lies beyond the reach is less than
    exp(-reach^2 / 2) of it. ``error_bound`` is their sum times the peak of the density's kernel.
    """
    source = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    shape = density_shape(source).withColumn("width", (F.col("high") - F.col("low")) / (bins - 1))
    shape = shape.withColumn("step", (F.col("high") - F.col("low")) / (grid - 1))
    shape = materialize(shape, "density-shape")
    at = F.coalesce(F.try_divide(F.col("x") - F.col("low"), F.col("width")), F.lit(0.0))
    placed = beside(source, shape).select(at.alias("at"))
    first = F.least(F.floor("at"), F.lit(bins - 2)).cast("int")
    share = F.col("at") - F.col("first")
    # Two rows a value would be shuffled as sums of two kinds instead: by the place before it.
    sums = (
        placed.withColumn("first", first)
        .groupBy("first")
        .agg(F.sum(1 - share).alias("near"), F.sum(share).alias("far"))
    )
    ends = F.array(
        F.struct(F.col("first").alias("bin"), F.col("near").alias("weight")),
        F.struct((F.col("first") + 1).alias("bin"), F.col("far").alias("weight")),
    )
    weights = sums.select(F.inline(ends)).groupBy("bin").agg(F.sum("weight").alias("weight"))
    spots = beside(weights, shape).withColumn("spot", F.col("low") + F.col("bin") * F.col("width"))
    low = F.ceil(F.try_divide(F.col("spot") - reach * F.col("h") - F.col("low"), F.col("step")))
    high = F.floor(F.try_divide(F.col("spot") + reach * F.col("h") - F.col("low"), F.col("step")))
    near = F.sequence(F.greatest(low, F.lit(0)).cast("int"), F.least(high, F.lit(grid - 1)).cast("int"))
    met = spots.where((F.col("step") > 0) & (F.greatest(low, F.lit(0)) <= F.least(high, F.lit(grid - 1))))
    met = met.select("spot", "weight", "h", "low", "step", F.explode(near).alias("point"))
    u = F.try_divide(F.col("low") + F.col("point") * F.col("step") - F.col("spot"), F.col("h"))
    mass = met.groupBy("point").agg(F.sum(F.col("weight") * F.exp(-0.5 * u * u)).alias("mass"))
    every = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("point")).join(mass, "point", "left")
    peak = F.try_divide(F.lit(1.0), F.col("h") * sqrt(2 * pi))
    part = F.try_divide(F.col("width"), F.col("h"))
    usable = F.when(F.col("step") > 0, F.coalesce("mass", F.lit(0.0)))
    return beside(every, shape).where("total > 0").select(
        "point",
        (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        F.try_divide(usable * peak, F.col("total")).alias("density"),
        ((part * part / 8 + exp(-reach * reach / 2)) * peak).alias("error_bound"),
    )
