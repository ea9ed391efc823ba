"""Profiles of columns and their relation to the churn label."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import correlation, numeric_columns, r_squared, resolve
from usagelens.functions.columns import text_to_double
from usagelens.operators.selection import quantiles_of, values_of
from usagelens.schemas import RAW_TARGET, TARGET
from usagelens.storage import materialize


def class_summary(df: DataFrame, group: str = TARGET, block: int = 6) -> DataFrame:
    """Sum, mean, min, max, count, variance and skewness of every other column per class.

    Text counts as the number it spells, if any; min and max of text compare as
    text. Works on ``block`` columns at a time: the statistics of more columns
    outgrow one compiled aggregate and run several times slower. Text columns are first
    reduced to the number of rows per class and text by hashing, so no row is sorted for their ends.
    Each block reads only its own columns, so ``df`` should be a scan.
    """
    group = resolve(df, group)
    numeric = numeric_columns(df, exclude=[group])
    other = [c for c in df.columns if c != group and c not in numeric]

    blocks = []
    for i in range(0, len(numeric), block):
        stats = [
            made
            for c in numeric[i : i + block]
            for made in (
                F.sum(c).alias(f"{c}_sum"),
                F.avg(c).alias(f"{c}_avg"),
                F.min(c).alias(f"{c}_min"),
                F.max(c).alias(f"{c}_max"),
                F.count(c).alias(f"{c}_count"),
                F.variance(c).alias(f"{c}_variance"),
                F.skewness(c).alias(f"{c}_skewness"),
            )
        ]
        blocks.append(df.groupBy(F.col(group).alias("block_key")).agg(*stats))
    if other:
        blocks.append(_text_summary(df, group, other))
    if not blocks:
        return df.select(group).distinct()

    made = blocks[0].withColumnRenamed("block_key", group)
    for found in blocks[1:]:
        same = F.col(group).eqNullSafe(F.col("block_key"))
        made = made.join(found, same).drop("block_key")
    return made.select(group, *[f"{c}_{k}" for c in df.columns if c != group for k in SUMMARY_KINDS])


SUMMARY_KINDS = ("sum", "avg", "min", "max", "count", "variance", "skewness")


def text_counts(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(class, place, text, n, x): rows per class, column and text, and the number the text spells.

    Dates and other types count as the text they are written as, and spell no number.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    spells = [isinstance(types[c], (T.StringType, T.BooleanType)) for c in columns]
    texts = df.select(
        F.col(group).alias("class"),
        F.posexplode(F.array(*[F.col(c).cast("string") for c in columns])).alias("place", "text"),
    )
    counted = texts.groupBy("class", "place", "text").agg(F.count(F.lit(1)).alias("n"))
    # Numbers in text are read once per text here, not once per row.
    spelt = F.get(F.array(*map(F.lit, spells)), F.col("place"))
    number = F.when(spelt, F.coalesce(text_to_double(F.col("text")), F.col("text").try_cast("boolean").cast("double")))
    return counted.withColumn("x", number)


def text_statistics(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics per ``keys`` of a frame of ``text_counts``, with each text counted ``n`` times."""
    n = F.when(F.col("x").isNotNull(), F.col("n"))
    means = counted.groupBy(*keys).agg(
        F.sum(n * F.col("x")).alias("sum"),
        F.try_divide(F.sum(n * F.col("x")), F.sum(n).cast("double")).alias("avg"),
        F.min("text").alias("min"),
        F.max("text").alias("max"),
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("n"))), F.lit(0)).alias("count"),
        F.sum(n).alias("numbers"),
    )
    kept = [c for c in means.columns if c not in keys]
    named = means.select(*[F.col(k).alias(f"of_{k}") for k in keys], *kept)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    away = F.col("x") - F.col("avg")
    spread = counted.join(named, same).groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in kept],
        F.sum(n * away * away).alias("m2"),
        F.sum(n * away * away * away).alias("m3"),
    )
    total, m2 = F.col("numbers"), F.col("m2")
    return spread.select(
        *keys,
        "sum",
        "avg",
        "min",
        "max",
        "count",
        F.when(total > 1, F.try_divide(m2, total - 1)).alias("variance"),
        F.try_divide(F.try_divide("m3", total), F.pow(F.try_divide(m2, total), F.lit(1.5))).alias("skewness"),
    )


def _text_summary(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    counted = materialize(text_counts(df, group, columns), "texts")
    found = text_statistics(counted, ["class", "place"])
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(place, kind):
        picked = F.max(F.when(F.col("place") == place, F.col(kind)))
        if kind in ("min", "max"):
            picked = picked.cast(types[columns[place]])
        return picked.alias(f"{columns[place]}_{kind}")

    return found.groupBy(F.col("class").alias("block_key")).agg(
        *[value(i, kind) for i in range(len(columns)) for kind in SUMMARY_KINDS]
    )


def profile(df: DataFrame, user: str = "User", approximate: bool = False) -> DataFrame:
    """Record count and number of distinct subscribers."""
    distinct = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return df.agg(
        F.count(F.lit(1)).alias("record_count"), distinct.alias("distinct_subscribers")
    )


def subscriber_sketches(df: DataFrame, day: str = "Date", user: str = "User", bits: int = 14) -> DataFrame:
    """(day, record_count, sketch): per day a sketch of its distinct subscribers.

    Sketches are a few kilobytes each, whatever the number of records, and those of any days can
    be merged, so a table of them answers ranges of days without the records.
    """
    return df.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"), F.hll_sketch_agg(F.col(user).cast("string"), bits).alias("sketch")
    )


def subscribers_between(sketches: DataFrame, start=None, end=None) -> DataFrame:
    """Records and about how many distinct subscribers the days from ``start`` to ``end`` have.

    The relative standard error is near 0.8 / sqrt(2^bits), below 1 % for 14 bits.
    """
    inside = sketches
    if start is not None:
        inside = inside.where(F.col("day") >= F.lit(start))
    if end is not None:
        inside = inside.where(F.col("day") <= F.lit(end))
    return inside.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_subscribers"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs in every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def moments(df: DataFrame, column: str) -> DataFrame:
    """Skewness, mean and sample standard deviation of one column."""
    return df.agg(
        F.skewness(column).alias("skewness"),
        F.mean(column).alias("mean"),
        F.stddev(column).alias("stddev"),
    )


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max, one row per numeric column.

    ``df`` is read once: its values are written as (column, value) rows, from which all else
    follows. Quartiles are exact. Runs at once.
    """
    columns = columns or numeric_columns(df)
    spark = df.sparkSession
    values = values_of(df, columns)
    basics = values.groupBy("place").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("x").alias("mean"),
        F.stddev("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    # One row per column.
    known = {r["place"]: r for r in basics.collect()}
    quartiles = quantiles_of(values, {p: r["count"] for p, r in known.items()}, QUARTILES)
    by_place = {row[0]: row[1:] for row in quartiles}
    rows = []
    for place, name in enumerate(columns):
        r = known.get(place)
        ends = (r["min"], *by_place[place], r["max"]) if r else (None,) * 5
        rows.append((name, r["count"] if r else 0, r["mean"] if r else None, r["std"] if r else None, *ends))
    return spark.createDataFrame(
        rows,
        "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double",
    )


def target_correlations(df: DataFrame, target: str = TARGET, nulls: str = "zero") -> DataFrame:
    """Correlation of each numeric column but the last with ``target``.

    ``nulls="zero"`` counts a missing value as 0, ``"skip"`` leaves the pair out.
    """
    columns = numeric_columns(df, exclude=[df.columns[-1]])
    filled = 0.0 if nulls == "zero" else None
    stats = {"correlation": correlation(F.col("x"), F.col("y"))}
    return _per_pair(df, target, columns, stats, filled)


def top_correlated(df: DataFrame, target: str = TARGET, absolute: bool = False) -> DataFrame:
    """The column with the largest correlation, signed unless ``absolute``."""
    found = target_correlations(df, target)
    size = F.abs("correlation") if absolute else F.col("correlation")
    usable = F.col("correlation").isNotNull() & ~F.isnan("correlation")
    return found.where(usable).orderBy(size.desc(), "feature").limit(1)


def r2_vs_target(df: DataFrame, target: str = RAW_TARGET) -> DataFrame:
    """R2 of the target read as a guess of each feature, over pairs without NULL.

    Features with at most one such pair are left out.
    """
    target = resolve(df, target)
    truth, guess = F.col("x"), F.col("y")
    stats = {"n": _pairs(truth, guess), "r2": r_squared(truth, guess)}
    return _per_pair(df, target, numeric_columns(df, [target]), stats).where("n > 1")


def regression_vs_target(df: DataFrame, target: str = RAW_TARGET) -> DataFrame:
    """Least-squares line of the target over each feature.

    Features with at most one complete pair are left out.
    """
    target = resolve(df, target)
    x, y = F.col("x"), F.col("y")
    stats = {
        "n": F.regr_count(y, x),
        "slope": F.regr_slope(y, x),
        "intercept": F.regr_intercept(y, x),
        "r2": F.regr_r2(y, x),
    }
    return _per_pair(df, target, numeric_columns(df, [target]), stats).where("n > 1")


def _per_pair(df: DataFrame, target: str, features: list[str], stats: dict, filled=None):
    """Aggregates of ``x`` (a feature) and ``y`` (the target) per feature.

    Rows become one (feature, x, y) each, so the compiled aggregate stays small
    however many features there are; partial sums leave one row per feature and
    task for the shuffle. ``filled`` stands in for NULL in both.
    """

    def number(c):
        value = F.col(c).cast("double")
        return value if filled is None else F.coalesce(value, F.lit(filled))

    pairs = df.select(
        number(target).alias("y"),
        F.posexplode(F.array(*[number(c) for c in features])).alias("place", "x"),
    )
    names = F.array(*[F.lit(c) for c in features])
    found = pairs.groupBy("place").agg(*[value.alias(name) for name, value in stats.items()])
    return found.select(F.get(names, F.col("place")).alias("feature"), *stats)


def _pairs(a, b):
    return F.count(F.when(a.isNotNull() & b.isNotNull(), 1))
