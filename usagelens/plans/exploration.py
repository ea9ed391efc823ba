"""Exploring processed records: twelve profiles by name, and all of them as one long table."""

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions import numeric_columns, resolve
from usagelens.operators import distribution, nulls, profile, summary
from usagelens.operators.distribution import beside
from usagelens.schemas import TARGET
from usagelens.storage import materialize

MEASURE = "M_Data_Sum"
SCALED = [TARGET, MEASURE, "M_Data_Count"]
# Statistics of a class summary that are numbers.
SPREAD = ("sum", "avg", "count", "variance", "skewness")


class Exploration(Mapping):
    """Profiles by name. A frame is made when it is first asked for, and not before."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def explore(df: DataFrame) -> Exploration:
    """Every profile of processed records, by name.

    Nothing runs here. Asking for ``scaled`` or what builds on it counts NULLs once, to drop sparse
    columns; where a column to be scaled is sparse itself, all columns stay. ``log_profile``
    looks for the best-correlated column first, and has no rows if there is none.
    """

    def scaled() -> DataFrame:
        dense = nulls.drop_sparse_columns(df, 0.6)
        kept = dense if set(SCALED) <= set(dense.columns) else df
        return distribution.min_max_scale(kept, SCALED)

    def scaled_log() -> DataFrame:
        return found["scaled"].withColumn("log_transformed", F.log1p(f"scaled_{MEASURE}"))

    def log_profile() -> DataFrame:
        top = profile.top_correlated(df).first()
        if top is None:
            return distribution.log_profile(df, MEASURE).limit(0)
        return distribution.log_profile(df, top["feature"])

    found = Exploration(
        {
            "class_summary": lambda: profile.class_summary(df),
            "profile": lambda: profile.profile(df),
            "null_counts": lambda: profile.null_counts(df),
            "class_counts": lambda: summary.class_counts(df),
            "moments": lambda: profile.moments(df, MEASURE),
            "correlations": lambda: profile.target_correlations(df),
            "scaled": scaled,
            "scaled_moments": lambda: profile.moments(found["scaled"], f"scaled_{MEASURE}"),
            "reflected": lambda: distribution.reflect_transform(found["scaled"], f"scaled_{MEASURE}"),
            "histogram": lambda: distribution.histogram(scaled_log(), "log_transformed"),
            "density": lambda: distribution.kde(scaled_log(), "log_transformed"),
            "log_profile": log_profile,
        }
    )
    return found


def _by_column(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Per class and numeric column its counts, ends and central moments, also of ln(1 + x) for x > 0."""
    values = df.select(
        F.col(target).cast("double").alias("class"),
        F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("place", "x"),
    )
    log = F.when(F.col("x") > 0, F.log1p("x"))
    found = values.groupBy("class", "place").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("x").alias("n"),
        F.sum("x").alias("sum"),
        F.avg("x").alias("avg"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.variance("x").alias("variance"),
        F.var_pop("x").alias("spread"),
        F.skewness("x").alias("skewness"),
        F.count(log).alias("log_n"),
        F.avg(log).alias("log_avg"),
        F.var_pop(log).alias("log_spread"),
    )
    return found.withColumn("column", F.get(F.array(*[F.lit(c) for c in columns]), F.col("place"))).drop("place")


def _long(df: DataFrame, part: str, keys: list[Column], values: dict[str, Column]) -> DataFrame:
    """(part, key, value, text): one row per row of ``df`` and value. Texts keep to ``text``."""
    kinds = {f.name: f.dataType.typeName() for f in df.select(*[v.alias(n) for n, v in values.items()]).schema.fields}

    def entry(name, value):
        is_text = kinds[name] == "string"
        label = [*keys, F.lit(name)] if len(values) > 1 or not keys else keys
        return F.struct(
            F.concat_ws("/", *label).alias("key"),
            (F.lit(None) if is_text else value).cast("double").alias("value"),
            (value if is_text else F.lit(None)).cast("string").alias("text"),
        )

    entries = F.array(*[entry(n, v) for n, v in values.items()])
    return df.select(F.lit(part).alias("part"), F.inline(entries).alias("key", "value", "text"))


def _class_key() -> Column:
    return F.coalesce(F.col("class").cast("string"), F.lit("null"))


def _together(by_column: DataFrame) -> DataFrame:
    """Per column the statistics of all classes, merged from their central moments."""
    own = Window.partitionBy("column")
    n, rows = F.col("n"), F.col("rows")
    mean = F.try_divide(F.sum(n * F.col("avg")).over(own), F.sum(n).over(own).cast("double"))
    log_mean = F.try_divide(F.sum(F.col("log_n") * F.col("log_avg")).over(own), F.sum("log_n").over(own).cast("double"))
    y = F.coalesce("class", F.lit(0.0))
    filled = F.coalesce(F.col("sum"), F.lit(0.0))
    placed = by_column.select(
        "*",
        mean.alias("mean"),
        log_mean.alias("log_mean"),
        y.alias("y"),
        (filled / rows).alias("filled"),
        (F.sum(filled).over(own) / F.sum(rows).over(own)).alias("filled_mean"),
        (F.sum(y * rows).over(own) / F.sum(rows).over(own)).alias("y_mean"),
    )
    away = F.coalesce(F.col("avg") - F.col("mean"), F.lit(0.0))
    m2 = n * F.coalesce("spread", F.lit(0.0))
    m3 = F.coalesce(F.col("skewness") * n * F.pow("spread", F.lit(1.5)), F.lit(0.0))
    log_away = F.coalesce(F.col("log_avg") - F.col("log_mean"), F.lit(0.0))
    x_off, y_off = F.col("filled") - F.col("filled_mean"), F.col("y") - F.col("y_mean")
    gap = F.coalesce(F.col("avg") - F.col("filled"), F.lit(0.0))
    inside = m2 + n * gap * gap + (rows - n) * F.col("filled") * F.col("filled")
    total = placed.groupBy("column").agg(
        F.sum(rows).alias("rows"),
        F.sum(n).alias("n"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.first("mean").alias("mean"),
        F.sum(m2 + n * away * away).alias("m2"),
        F.sum(m3 + 3 * away * m2 + n * away * away * away).alias("m3"),
        F.sum("log_n").alias("log_n"),
        F.first("log_mean").alias("log_mean"),
        F.sum(F.col("log_n") * (F.coalesce("log_spread", F.lit(0.0)) + log_away * log_away)).alias("log_m2"),
        F.sum(rows * x_off * y_off).alias("co"),
        F.sum(inside + rows * x_off * x_off).alias("x2"),
        F.sum(rows * y_off * y_off).alias("y2"),
    )

    def deviation(m2, n):
        return F.when(F.col(n) > 1, F.sqrt(F.try_divide(F.col(m2), F.col(n) - 1)))

    return total.select(
        "column",
        "rows",
        "n",
        "min",
        "max",
        "mean",
        deviation("m2", "n").alias("stddev"),
        F.try_divide(
            F.try_divide("m3", "n"), F.pow(F.try_divide("m2", "n"), F.lit(1.5))
        ).alias("skewness"),
        "log_n",
        "log_mean",
        deviation("log_m2", "log_n").alias("log_std"),
        F.try_divide(F.col("co"), F.sqrt(F.col("x2")) * F.sqrt(F.col("y2"))).alias("correlation"),
    )


def exploration_report(df: DataFrame, target: str = TARGET, user: str = "User") -> DataFrame:
    """All parts of ``explore`` as one table (part, key, value, text).

    Three aggregates over ``df`` are written at once and shared by all parts: numbers by class and
    column, texts by class and column, and values of the measure. Statistics over all classes are
    merged from those of the classes, and histogram and density come from the counted values.
    ``scaled`` and ``reflected`` have entries per record, keyed by date and subscriber.
    """
    target, user = resolve(df, target), resolve(df, user)
    numeric = numeric_columns(df)
    texts = [c for c in df.columns if c not in numeric]
    by_column = materialize(_by_column(df, target, numeric), "by-column")
    by_text = profile.text_counts(df.withColumn(target, F.col(target).cast("double")), target, texts)
    names = F.array(*[F.lit(c) for c in texts])
    by_text = materialize(by_text.withColumn("column", F.get(names, F.col("place"))).drop("place"), "by-text")
    x = F.col(MEASURE).cast("double")
    by_value = materialize(df.groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("n")), "by-value")
    total = materialize(_together(by_column), "by-column-all")

    features = [c for c in numeric if c != df.columns[-1]]
    correlated = total.where(F.col("column").isin(features))
    usable = F.col("correlation").isNotNull() & ~F.isnan("correlation")
    top = correlated.where(usable).orderBy(F.desc("correlation"), "column").limit(1)
    of_measure = total.where(F.col("column") == MEASURE)
    width = F.col("max") - F.col("min")

    spread = by_column.where(F.col("column") != target).withColumn("count", F.col("n"))
    null_texts = by_text.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("text").isNull(), F.col("n"))), F.lit(0)).alias("missing")
    )
    null_numbers = total.select("column", (F.col("rows") - F.col("n")).alias("missing"))
    counted = by_column.where(F.col("column") == target)
    people = by_text if user in texts else df.select(F.lit(user).alias("column"), F.col(user).cast("string").alias("text"))
    people = people.where((F.col("column") == user) & F.col("text").isNotNull())
    size = total.where(F.col("column") == target).select(F.col("rows").alias("record_count"))
    size = beside(size, people.agg(F.count_distinct("text").alias("distinct_subscribers")))

    ends = total.where(F.col("column").isin(SCALED)).agg(
        *[F.max(F.when(F.col("column") == c, F.col(e))).alias(f"{e} of {c}") for c in SCALED for e in ("min", "max")]
    )

    def scaled(c):
        low, high = F.col(f"min of {c}"), F.col(f"max of {c}")
        return F.try_divide(F.col(c).cast("double") - low, high - low)

    rows = beside(df.select("Date", user, *SCALED), ends)
    row_key = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("Date", user)]
    place = scaled(MEASURE)
    # The largest scaled value is 1, or there is none.
    reflected = 2.0 - place
    bounds = of_measure.select("min", "max")
    logged = beside(by_value, bounds).select(F.log1p(F.try_divide(F.col("x") - F.col("min"), width)).alias("x"), "n")
    logged = materialize(logged.where("x is not null"), "log-values")

    parts = [
        _long(spread, "class_summary", [_class_key(), F.col("column")], {s: F.col(s) for s in (*SPREAD, "min", "max")}),
        _long(
            profile.text_statistics(by_text, ["class", "column"]),
            "class_summary",
            [_class_key(), F.col("column")],
            {s: F.col(s) for s in (*SPREAD, "min", "max")},
        ),
        _long(size, "profile", [], {c: F.col(c) for c in ("record_count", "distinct_subscribers")}),
        _long(null_numbers.unionByName(null_texts), "null_counts", [F.col("column")], {"n": F.col("missing")}),
        _long(counted, "class_counts", [_class_key()], {"n": F.col("rows")}),
        _long(of_measure, "moments", [], {c: F.col(c) for c in ("skewness", "mean", "stddev")}),
        _long(correlated, "correlations", [F.col("column")], {"correlation": F.col("correlation")}),
        _long(rows, "scaled", row_key, {c: scaled(c) for c in SCALED}),
        _long(
            of_measure.where(width > 0),
            "scaled_moments",
            [],
            {
                "skewness": F.col("skewness"),
                "mean": F.try_divide(F.col("mean") - F.col("min"), width),
                "stddev": F.try_divide(F.col("stddev"), width),
            },
        ),
        _long(rows, "reflected", row_key, {"reflected": reflected, "adjusted": F.try_divide(F.lit(1.0), F.log(reflected))}),
        _long(
            distribution.histogram(logged, "x", weight="n"),
            "histogram",
            [F.col("bin").cast("string")],
            {c: F.col(c) for c in ("left_edge", "right_edge", "count")},
        ),
        _long(
            distribution.kde(logged, "x", weight="n"),
            "density",
            [F.col("point").cast("string")],
            {c: F.col(c) for c in ("x", "density")},
        ),
        _long(
            top, "log_profile", [F.col("column")], {"n": F.col("log_n"), "mean": F.col("log_mean"), "std": F.col("log_std")}
        ),
    ]
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return made
