"""One query per operator over the given tables: name -> (spark, folder) -> frame."""

from datetime import datetime

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas, sinks, sources
from usagelens.operators import (
    distribution,
    features,
    model,
    monitoring,
    nulls,
    profile,
    sampling,
    summary,
    transform,
)
from usagelens.plans import (
    DateRanges,
    exploration_report,
    explore_raw,
    monitoring_report,
    prepare,
    run,
    train_churn,
)
from usagelens.registry import inputs
from usagelens.sources import files
from usagelens.storage import materialize, scratch_path
from usagelens.streaming import ingest_stream, monitor_stream, stream_daily_summary

QUERIES = {}

START, END = "2024-01-08", "2024-01-17"
NOW = datetime(2024, 2, 1, 12, 0, 0)


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as sums in another order differ in the last bits.

    A mean of 128 amounts in cents has nine decimals, so per-date results keep as
    many: none then lies halfway between two roundings.
    """
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def text_time(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# --- scans and loads ---------------------------------------------------------


@query
def scan_date_range(spark, sf):
    rows = sources.scan_cdr(spark, f"{sf}/events.parquet", START, END, column="ts")
    return rows.select("event_id", "user_id", "event_type", "value")


@query
def scan_date_range_lines(spark, sf):
    rows = sources.scan_cdr(
        spark, f"{sf}/lineitem.parquet", "1997-03-01", "1997-05-31", column="l_shipdate"
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def scan_processed_range(spark, sf):
    target = scratch_path(spark, "processed")
    sinks.replace_dates(inputs.processed(spark, sf), target)
    return rounded(sources.scan_processed(spark, target, START, END))


@query
def scan_string_range(spark, sf):
    rows = sources.scan_string_range(inputs.cdr(spark, sf), "DP_TS", START, END)
    return rows.select("id", "DP_MSISDN", text_time("DP_TS").alias("DP_TS"))


@query
def predictions_scan(spark, sf):
    return rounded(sources.scan_predictions(spark, inputs.predictions(spark, sf)))


@query
def snapshot_union(spark, sf):
    rows = materialize(inputs.processed(spark, sf), "processed")
    folder = scratch_path(spark, "snapshots")
    parts = [
        rows.where("Date <= '2024-01-10'"),
        rows.where("Date > '2024-01-10' and Date <= '2024-01-20'"),
        rows.where("Date > '2024-01-15'"),
    ]
    paths = [
        sinks.write_snapshot(part, folder, datetime(2024, 1, 10 + i)) for i, part in enumerate(parts)
    ]
    return rounded(sources.scan_snapshots(spark, paths))


def _csv_copy(spark, sf, compression="none"):
    path = scratch_path(spark, "csv")
    rows = inputs.cdr(spark, sf).drop("DP_TS")
    rows.write.option("header", True).option("compression", compression).csv(path)
    return path


def _numbers(df):
    """Loaded texts as numbers, so that the text form of a double does not matter."""
    kept = ["id", "DP_DATE", "DP_MSISDN", *schemas.RAW_MEASURES, schemas.RAW_TARGET]
    return rounded(
        df.select(*[F.col(c) if c == "DP_DATE" else F.col(c).cast("double").alias(c) for c in kept])
    )


@query
def csv_load_untyped(spark, sf):
    return _numbers(sources.load_csv_untyped(spark, _csv_copy(spark, sf), add_id=False))


@query
def csv_load_typed(spark, sf):
    loaded = sources.load_csv_typed(spark, _csv_copy(spark, sf), schemas.RAW_SCHEMA)
    return _numbers(loaded.withColumn("DP_DATE", F.date_format("DP_DATE", "yyyy-MM-dd")))


@query
def csv_gz_load(spark, sf):
    path = _csv_copy(spark, sf, "gzip")
    return _numbers(sources.load_csv_untyped(spark, path, add_id=False, partitions=8))


@query
def csv_surrogate_ids(spark, sf):
    path = scratch_path(spark, "csv")
    inputs.cdr(spark, sf).drop("id", "DP_TS").write.option("header", True).csv(path)
    loaded = sources.load_csv_untyped(spark, path)
    return loaded.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


# Values a CSV file must quote, and what it holds for missing ones.
QUOTED_TEXTS = ['x "y" z', "a,b", "line\nbreak", '"', "plain"]


@query
def csv_quoted_roundtrip(spark, sf):
    texts = F.array(*[F.lit(t) for t in [*QUOTED_TEXTS, *files.MISSING_TEXTS]])
    path = scratch_path(spark, "csv")
    rows = inputs.cdr(spark, sf).select("id", F.get(texts, F.col("id") % F.size(texts)).alias("note"))
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return sources.load_csv_untyped(spark, path, add_id=False, line_breaks=True)


@query
def seed_scan(spark, sf):
    """Taken from a written table, of which only the first files are read."""
    path = scratch_path(spark, "cdr")
    inputs.cdr(spark, sf).write.parquet(path)
    rows = spark.read.parquet(path)
    seeds = sources.scan_seed(spark, path, 2000)
    known = seeds.join(rows.select("id"), "id", "left_semi").agg(F.count(F.lit(1)).alias("n_known"))
    counts = seeds.agg(F.count("DP_DATE").alias("n_rows"), F.count_distinct("id").alias("n_ids"))
    return counts.crossJoin(F.broadcast(known))


# --- sinks -------------------------------------------------------------------


@query
def append_roundtrip(spark, sf):
    target = scratch_path(spark, "appended")
    rows = inputs.processed(spark, sf)
    sinks.append_table(rows, target)
    sinks.append_table(rows, target)
    return rounded(spark.read.parquet(target))


@query
def snapshot_roundtrip(spark, sf):
    folder = scratch_path(spark, "snapshots")
    path = sinks.write_snapshot(inputs.processed(spark, sf), folder, NOW)
    return rounded(sources.scan_snapshots(spark, [path]))


@query
def daily_summary_table(spark, sf):
    """The summary written twice still has one row per date."""
    target = scratch_path(spark, "summary")
    found = summary.daily_summary(inputs.cdr(spark, sf), START, END)
    sinks.write_daily_summary(found, target)
    sinks.write_daily_summary(found, target)
    return as_double(sinks.read_if_present(spark, target, schemas.SUMMARY_SCHEMA), "Total_Data_Volume")


@query
def load_once(spark, sf):
    target = scratch_path(spark, "loaded")
    sinks.load_once(spark, target, lambda: inputs.processed(spark, sf))
    return rounded(sinks.load_once(spark, target, lambda: inputs.processed(spark, sf)))


@query
def report_roundtrip(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_report(monitoring.monitor(inputs.predictions(spark, sf)), path)
    return _report(spark.read.option("header", True).option("inferSchema", True).csv(path))


@query
def json_records(spark, sf):
    rows = inputs.cdr(spark, sf).select("id", "DP_MSISDN", "DP_MOC_COUNT", "DP_MOC_DURATION")
    json = sinks.to_json_records(rows)
    return rounded(
        json.select(
            *[
                F.get_json_object("json", f"$.{c}").cast(rows.schema[c].dataType).alias(c)
                for c in rows.columns
            ],
            F.col("json").contains('"DP_MOC_DURATION":null').alias("null_kept"),
        )
    )


# --- projections, filters, missing values ------------------------------------


@query
def transform_cdr(spark, sf):
    return rounded(transform.transform_cdr(inputs.cdr(spark, sf)))


@query
def transform_cdr_text(spark, sf):
    return rounded(transform.transform_cdr(inputs.cdr_text(spark, sf)))


@query
def transform_cdr_lines(spark, sf):
    return rounded(inputs.processed_lines(spark, sf), 4)


@query
def class_filter_count(spark, sf):
    return summary.class_counts(
        transform.class_rows(inputs.labelled(spark, sf), "M_TENURE_CHURN", 0)
    )


@query
def fill_zero(spark, sf):
    return rounded(nulls.fill_numeric(inputs.processed(spark, sf), 0))


@query
def nan_to_null(spark, sf):
    rows = inputs.cdr(spark, sf).select(
        "id", F.coalesce("DP_MOC_DURATION", F.lit(float("nan"))).alias("DP_MOC_DURATION")
    )
    return rounded(nulls.nan_to_null(rows))


@query
def dropna_pairs(spark, sf):
    rows = inputs.processed(spark, sf).select("Date", "User", "M_Out_Call_Time", "M_Data_Sum")
    return rounded(nulls.drop_null_rows(rows, ["M_Out_Call_Time", "M_Data_Sum"]))


@query
def drop_all_null_cols(spark, sf):
    rows = inputs.processed(spark, sf).withColumn("Unused", F.lit(None).cast("double"))
    return rounded(nulls.drop_all_null_columns(rows))


@query
def drop_sparse_cols(spark, sf):
    rows = nulls.fill_numeric(inputs.processed(spark, sf)).withColumn(
        "Heavy", F.when(F.col("M_Data_Count") >= 3, F.col("M_Data_Sum"))
    )
    return rounded(nulls.drop_sparse_columns(rows, 0.6))


@query
def coerce_numeric(spark, sf):
    return rounded(nulls.coerce_numeric(inputs.cdr_text(spark, sf)))


# --- aggregates --------------------------------------------------------------


@query
def daily_summary(spark, sf):
    return as_double(summary.daily_summary(inputs.cdr(spark, sf), START, END), "Total_Data_Volume")


@query
def daily_summary_lines(spark, sf):
    found = summary.daily_summary(inputs.cdr_lines(spark, sf), "1996-01-01", "1998-12-31")
    return as_double(found, "Total_Data_Volume")


@query
def recent_summary(spark, sf):
    """The last week before the current date, with the records moved to end on it and the result moved back."""
    rows = materialize(inputs.cdr(spark, sf), "cdr")
    last = rows.agg(F.max("DP_DATE")).first()[0]
    moved = F.date_diff(F.current_date(), F.lit(last))
    recent = summary.recent_summary(rows.withColumn("DP_DATE", F.date_add("DP_DATE", moved)), 7)
    return as_double(recent.withColumn("Date", F.date_sub("Date", moved)), "Total_Data_Volume")


@query
def user_call_time(spark, sf):
    return rounded(summary.user_call_time(inputs.processed(spark, sf)))


@query
def daily_mean_data(spark, sf):
    return rounded(summary.daily_mean_data(inputs.processed(spark, sf)), 9)


@query
def class_summary(spark, sf):
    rows = materialize(inputs.labelled(spark, sf), "labelled")
    return rounded(profile.class_summary(rows), 4)


@query
def class_summary_lines(spark, sf):
    rows = inputs.processed_lines(spark, sf).select(
        "M_Out_Call_Count", "M_Out_Call_Time", "M_Data_Sum", "M_Tenure_Churn"
    )
    return rounded(profile.class_summary(rows), 2)


@query
def class_counts(spark, sf):
    return summary.class_counts(inputs.labelled(spark, sf))


@query
def record_profile(spark, sf):
    return profile.profile(inputs.processed(spark, sf))


@query
def subscriber_sketches(spark, sf):
    """Subscribers of three ranges of days from one table of daily sketches, and whether they are near."""
    rows = inputs.processed(spark, sf)
    sketches = materialize(profile.subscriber_sketches(rows), "sketches")
    ranges = {"all": (None, None), "middle": (START, END), "first": (None, "2024-01-03")}
    found = []
    for name, (start, end) in ranges.items():
        inside = F.lit(True) if start is None else F.col("Date") >= start
        inside = inside if end is None else inside & (F.col("Date") <= end)
        exact = rows.where(inside).agg(F.count_distinct("User").alias("exact_subscribers"))
        about = profile.subscribers_between(sketches, start, end).crossJoin(F.broadcast(exact))
        near = F.abs(F.col("distinct_subscribers") / F.col("exact_subscribers") - 1) <= 0.04
        found.append(about.select(F.lit(name).alias("days"), "record_count", "exact_subscribers", near.alias("near")))
    return sources.union_all(*found)


@query
def null_counts(spark, sf):
    return profile.null_counts(inputs.processed(spark, sf))


@query
def moments(spark, sf):
    return rounded(profile.moments(inputs.processed(spark, sf), "M_Data_Sum"))


@query
def sum_by_date(spark, sf):
    return rounded(summary.sum_by_date(inputs.cdr(spark, sf)))


@query
def mean_by_date(spark, sf):
    return rounded(summary.mean_by_date(inputs.cdr(spark, sf)), 9)


@query
def describe(spark, sf):
    return rounded(profile.describe(inputs.cdr(spark, sf), schemas.RAW_MEASURES))


@query
def describe_lines(spark, sf):
    columns = ["DP_MOC_COUNT", "DP_MOC_DURATION", "DP_DATA_VOLUME"]
    return rounded(profile.describe(inputs.cdr_lines(spark, sf), columns))


@query
def high_watermark(spark, sf):
    return summary.high_watermark(inputs.processed(spark, sf))


@query
def distinct_dates(spark, sf):
    return summary.distinct_dates(inputs.cdr(spark, sf), START, END)


@query
def target_correlations(spark, sf):
    return rounded(profile.target_correlations(inputs.labelled(spark, sf)))


@query
def target_correlations_lines(spark, sf):
    return rounded(profile.target_correlations(inputs.processed_lines(spark, sf)))


@query
def top_correlated(spark, sf):
    return rounded(profile.top_correlated(inputs.labelled(spark, sf)))


@query
def r2_vs_target(spark, sf):
    rows = inputs.before_last_day(inputs.cdr(spark, sf), "DP_DATE")
    return rounded(profile.r2_vs_target(rows))


@query
def regression_vs_target(spark, sf):
    rows = inputs.before_last_day(inputs.cdr(spark, sf), "DP_DATE")
    return rounded(profile.regression_vs_target(rows))


@query
def raw_exploration(spark, sf):
    """R2 per usable column of untyped records in a text date range."""
    return rounded(explore_raw(inputs.cdr_text(spark, sf), START, END)["r2"])


@query
def histogram(spark, sf):
    return rounded(distribution.histogram(inputs.processed(spark, sf), "M_Data_Sum", 30))


@query
def kde_density(spark, sf):
    rows = distribution.positive_log(inputs.processed(spark, sf), "M_Data_Sum")
    return rounded(distribution.kde(rows, "log_transformed", 200))


@query
def log_profile(spark, sf):
    return rounded(distribution.log_profile(inputs.processed(spark, sf), "M_Data_Sum"))


@query
def kde_density_binned(spark, sf):
    rows = distribution.positive_log(inputs.processed(spark, sf), "M_Data_Sum")
    return rounded(distribution.kde_binned(rows, "log_transformed", 200, 512))


@query
def explore_job(spark, sf):
    """All twelve parts of the exploration of filled records."""
    rows = materialize(nulls.fill_numeric(inputs.labelled(spark, sf)), "filled")
    return rounded(exploration_report(rows), 4)


# --- features and transforms -------------------------------------------------


@query
def date_window_features(spark, sf):
    return rounded(features.add_date_stats(inputs.processed(spark, sf)), 9)


@query
def date_window_features_many_days(spark, sf):
    """More dates than are broadcast."""
    rows = inputs.processed(spark, sf)
    return rounded(features.add_date_stats(rows, broadcast_rows=5), 9)


@query
def date_window_features_lines(spark, sf):
    columns = ["M_Out_Call_Count", "M_Data_Count"]
    rows = inputs.processed_lines(spark, sf).select("Date", *columns)
    return rounded(features.add_date_stats(rows, columns))


@query
def log_features(spark, sf):
    rows = inputs.processed(spark, sf)
    return rounded(features.log_features(rows, schemas.STAT_COLUMNS))


@query
def feature_table(spark, sf):
    return rounded(features.build_features(inputs.labelled(spark, sf)), 9)


@query
def feature_table_filled_first(spark, sf):
    return rounded(features.build_features(inputs.labelled(spark, sf), fill="before"), 9)


@query
def min_max_scale(spark, sf):
    rows = inputs.labelled(spark, sf)
    return rounded(
        distribution.min_max_scale(rows, ["M_Tenure_Churn", "M_Data_Sum", "M_Data_Count"])
    )


@query
def reflect_transform(spark, sf):
    scaled = distribution.min_max_scale(inputs.processed(spark, sf), ["M_Data_Sum"])
    return rounded(distribution.reflect_transform(scaled, "scaled_M_Data_Sum"))


@query
def latest_100(spark, sf):
    rows = transform.latest_rows(inputs.cdr(spark, sf), 100, "DP_TS", ("id",))
    return rounded(
        rows.select("id", text_time("DP_TS").alias("DP_TS"), "DP_MSISDN", "DP_MOC_DURATION")
    )


# --- samples and model -------------------------------------------------------


@query
def sample_n(spark, sf):
    rows = inputs.cdr(spark, sf)
    picked = materialize(sampling.sample_n(rows, 200), "picked")
    known = picked.select("id", "DP_MSISDN").join(
        rows.select("id", "DP_MSISDN"), ["id", "DP_MSISDN"], "left_semi"
    )
    counts = picked.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))
    return counts.crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("n_known"))))


@query
def oversample(spark, sf):
    """Every drawn row, with the number of its copies, which follow from date and subscriber."""
    rows = inputs.labelled(spark, sf).withColumnRenamed("M_Tenure_Churn", "label")
    drawn = sampling.oversample(rows.select("Date", "User", "label"), key=["Date", "User"])
    return drawn.groupBy("Date", "User", "label").agg(F.count(F.lit(1)).alias("copies"))


@query
def oversample_random(spark, sf):
    """Random draws of about 20 times the rows of class 1."""
    rows = materialize(
        inputs.labelled(spark, sf).withColumnRenamed("M_Tenure_Churn", "label"), "labelled"
    )
    drawn = sampling.oversample(rows).groupBy("label").agg(F.count(F.lit(1)).alias("drawn"))
    ratio = F.col("drawn") / F.col("source_rows")
    # Five standard errors of a mean of Poisson(20) draws.
    reach = 5 * F.sqrt(20 / F.col("source_rows"))
    near = F.when(F.col("label") == 1, F.abs(ratio - 20) <= reach).otherwise(ratio == 1)
    source = summary.class_counts(rows, "label").withColumnRenamed("count", "source_rows")
    return source.join(drawn, "label").select("label", "source_rows", near.alias("near_factor"))


@query
def oversample_exact(spark, sf):
    repeated = sampling.oversample_exact(inputs.labelled(spark, sf), "M_Tenure_Churn", 20)
    return repeated.select("Date", "User", "M_Tenure_Churn", "copy")


@query
def random_split(spark, sf):
    rows = materialize(inputs.cdr(spark, sf).select("id"), "ids")
    train, test = sampling.random_split(rows)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    n = F.count(F.lit(1))
    # Five standard errors of a share of 0.8.
    near = F.abs(F.count_if(F.col("part") == "train") / n - 0.8) <= 5 * F.sqrt(0.16 / n)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        near.alias("near_share"),
    )


@query
def key_split(spark, sf):
    train, test = sampling.split_by_key(inputs.cdr(spark, sf).select("id", "DP_MSISDN"))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def auc_hard(spark, sf):
    return rounded(monitoring.auc_hard(inputs.predictions(spark, sf)))


# Rows the forest search learns from, on average; None is the whole training part.
TRAIN_ROWS = None


@query
def churn_predictions(spark, sf):
    """The full search on rows known by key, and what must hold for every prediction."""
    made = materialize(features.build_features(inputs.labelled(spark, sf)), "features")
    day = F.dayofmonth(F.col("Date").cast("date"))
    keyed = made.withColumn("key", F.col("User").cast("long") * 31 + day)
    train_part, test_part = sampling.split_by_key(keyed, "key")
    balanced = materialize(sampling.oversample_exact(train_part, "label", 20).drop("copy"), "train")
    fitted = model.train(model.assemble(balanced), fold_by=["Date", "User"])
    flat = model.flatten_predictions(model.score(fitted, model.assemble(test_part)))
    higher = (F.col("probability_1") > F.col("probability_0")).cast("double")
    return flat.select(
        "Date",
        "User",
        "label",
        (F.abs(F.col("probability_0") + F.col("probability_1") - 1) < 1e-9).alias("sums_to_one"),
        F.col("probability_1").between(0, 1).alias("is_share"),
        (F.col("prediction") == higher).alias("agrees"),
        F.lit(len(fitted.avgMetrics)).alias("grid_points"),
        F.lit(fitted.getNumFolds()).alias("folds"),
    )


def _all_days(rows, column):
    """Ranges from the first to the last day of some rows."""
    day = F.col(column).cast("date").cast("string")
    first, last = rows.agg(F.min(day), F.max(day)).first()
    return DateRanges(first, last, first, last)


def _rows_known(spark, flat, table, out):
    """Whether all predictions are rows of the table, and were written."""
    known = flat.join(table, ["Date", "User"], "left_semi").count()
    return known == flat.count() == spark.read.parquet(out).count() and known > 0


@query
def run_job(spark, sf):
    """All days prepared and trained on in one run, with the full search; predictions are rows of the table.

    ``prepared_rows`` counts the days from START to END; ``rows_known`` also says that no row
    of any day is missing.
    """
    rows = inputs.cdr(spark, sf)
    target, out = scratch_path(spark, "processed"), scratch_path(spark, "predictions")
    auc, flat = run(spark, _all_days(rows, "DP_DATE"), rows, target, out, learn_rows=TRAIN_ROWS)
    prepared = spark.read.parquet(target).select(F.col("Date").cast("string").alias("Date"), "User")
    whole = prepared.count() == rows.count()
    return prepared.where(F.col("Date").between(START, END)).agg(
        F.count(F.lit(1)).alias("prepared_rows"),
        F.lit(whole and _rows_known(spark, flat, prepared, out)).alias("rows_known"),
        F.lit(0 <= auc <= 1).alias("auc_is_share"),
    )


@query
def train_job(spark, sf):
    """The full search over all days of a processed table; its predictions are rows of that table."""
    rows = materialize(inputs.processed(spark, sf), "processed")
    out = scratch_path(spark, "predictions")
    auc, flat = train_churn(spark, _all_days(rows, "Date"), rows, out, learn_rows=TRAIN_ROWS)
    table = rows.select(F.col("Date").cast("string").alias("Date"), "User")
    return table.agg(
        F.count(F.lit(1)).alias("table_rows"),
        F.count_distinct("Date").alias("days"),
        F.lit(_rows_known(spark, flat, table, out)).alias("rows_known"),
        F.lit(0 <= auc <= 1).alias("auc_is_share"),
    )


@query
def predictions_flat(spark, sf):
    pair = F.array("probability_0", "probability_1")
    rows = inputs.predictions(spark, sf).select(
        "Date",
        "User",
        "label",
        "prediction",
        array_to_vector(pair).alias("probability"),
        array_to_vector(F.transform(pair, lambda p: p * 10)).alias("rawPrediction"),
        array_to_vector(F.array(F.col("label").cast("double"), "prediction")).alias("features"),
    )
    return rounded(model.flatten_predictions(rows))


# --- monitoring --------------------------------------------------------------


def _report(report, dates=("chunk", "start_date", "end_date")):
    return rounded(report.withColumns({c: F.col(c).cast("date") for c in dates}))


@query
def single_class_guard(spark, sf):
    rows = inputs.predictions(spark, sf)
    one = monitoring.has_both_classes(rows.where("label = 0")).withColumn("input", F.lit("one"))
    both = monitoring.has_both_classes(rows).withColumn("input", F.lit("both"))
    left = monitoring.monitor(rows.where("label = 0")).agg(F.count(F.lit(1)).alias("report_rows"))
    return one.unionByName(both).crossJoin(F.broadcast(left))


@query
def chunk_by_count(spark, sf):
    rows = inputs.predictions(spark, sf).select("Date", "User")
    return monitoring.assign_chunks(rows, by=10)


@query
def chunk_by_count_copies(spark, sf):
    """Rows of which most are equal to others."""
    rows = inputs.predictions(spark, sf).select("Date", "prediction")
    chunks = monitoring.assign_chunks(rows, by=10, tiebreak=("prediction",))
    return chunks.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("Date").alias("start_date"),
        F.max("Date").alias("end_date"),
        F.sum("prediction").alias("predicted"),
    )


@query
def monitoring_job_by_count(spark, sf):
    path = scratch_path(spark, "report")
    report = monitoring_report(spark, inputs.predictions(spark, sf), path, by=10)
    written = spark.read.schema(report.schema).option("header", True).csv(path)
    return _report(written.withColumn("chunk", F.col("chunk").cast("string")), ("start_date", "end_date"))


@query
def chunk_by_count_lines(spark, sf):
    rows = inputs.table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    keys = ("l_orderkey", "l_linenumber")
    chunks = monitoring.assign_chunks(rows, 10, "l_shipdate", keys)
    return chunks.groupBy("chunk").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("start_date"),
        F.max(F.col("l_shipdate").cast("date")).alias("end_date"),
        F.sum("l_orderkey").alias("order_keys"),
    )


@query
def chunk_metrics(spark, sf):
    chunks = monitoring.assign_chunks(inputs.predictions(spark, sf), "day")
    return rounded(monitoring.chunk_metrics(chunks))


@query
def chunk_metrics_lines(spark, sf):
    """ROC-AUC of one large chunk per line status, scored by price."""
    price = F.col("l_extendedprice")
    rows = inputs.table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("chunk"),
        F.col("l_shipdate").alias("Date"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (price >= 40000).cast("double").alias("prediction"),
        price.alias("probability_1"),
    )
    return rounded(monitoring.chunk_metrics(rows))


@query
def monitor_report(spark, sf):
    return _report(monitoring.monitor(inputs.predictions(spark, sf)))


@query
def monitor_reference(spark, sf):
    """The second half of the period judged by the bounds of the first half."""
    rows = inputs.predictions(spark, sf)
    return _report(monitoring.monitor(rows.where("Date < '2024-01-13'"), rows.where("Date >= '2024-01-13'")))


@query
def new_since(spark, sf):
    rows = inputs.predictions(spark, sf)
    marks = {"first": None, "middle": "2024-01-12", "latest": rows.agg(F.max("Date")).first()[0]}
    return sources.union_all(
        *[
            monitoring.new_since(rows, last).withColumn("mark", F.lit(name))
            for name, last in marks.items()
        ]
    )


@query
def rows_since(spark, sf):
    rows = monitoring.rows_since(inputs.predictions(spark, sf), "2024-01-20")
    return rounded(rows)


# --- incremental jobs --------------------------------------------------------


@query
def augment_batch(spark, sf):
    """Noise is 1 + N(0, 0.1): relative means and deviations within five standard errors."""
    rows = inputs.cdr(spark, sf).drop("DP_TS").withColumn("ones", F.lit(100.0))
    made = materialize(transform.augment(rows, 200, NOW), "augmented")
    away = F.abs(F.unix_timestamp("DP_DATE") - F.unix_timestamp(F.lit(NOW)))
    n = F.count("ones")
    return made.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max(away) <= 300).alias("near_now"),
        F.lit("id" in made.columns).alias("has_id"),
        (F.abs(F.mean("ones") - 100) <= 5 * 10 / F.sqrt(n)).alias("near_mean"),
        (F.abs(F.stddev("ones") - 10) <= 5 * 10 / F.sqrt(2 * n)).alias("near_deviation"),
    )


def _in_two_steps(rows, folder, run):
    """Writes rows up to a day, runs the stream, then writes the rest and runs it again."""
    rows.where("Date <= '2024-01-15'").write.mode("append").parquet(folder)
    run().awaitTermination()
    rows.where("Date > '2024-01-15'").write.mode("append").parquet(folder)
    run().awaitTermination()


@query
def stream_ingest(spark, sf):
    rows = inputs.processed(spark, sf)
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "ingested", "state"))
    _in_two_steps(rows, folder, lambda: ingest_stream(spark, folder, out, state, rows.schema))
    return rounded(spark.read.schema(rows.schema).parquet(out).drop("batch"))


@query
def stream_daily_totals(spark, sf):
    rows = inputs.cdr(spark, sf).withColumn("Date", F.date_format("DP_DATE", "yyyy-MM-dd"))
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "summary", "state"))
    _in_two_steps(
        rows,
        folder,
        lambda: stream_daily_summary(spark, folder, out, state, rows.schema, column="DP_TS"),
    )
    return as_double(sinks.read_if_present(spark, out, schemas.SUMMARY_SCHEMA), "Total_Data_Volume")


@query
def stream_monitor(spark, sf):
    rows = inputs.predictions(spark, sf)
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "monitor", "state"))
    _in_two_steps(rows, folder, lambda: monitor_stream(spark, folder, out, state, rows.schema))
    report = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/report")
    return _report(report)


@query
def prepared_table(spark, sf):
    """Prepared twice, as a rerun would, and read back from the snapshot."""
    ranges = DateRanges(START, END, START, END)
    target, folder = scratch_path(spark, "processed"), scratch_path(spark, "snapshots")
    rows = inputs.cdr(spark, sf)
    prepare(spark, ranges, rows, target)
    prepare(spark, ranges, rows, target, folder, NOW)
    return rounded(sources.scan_snapshots(spark, [f"{folder}/processed_data_2024-02-01_120000.parquet"]))


@query
def prepared_table_rerun(spark, sf):
    """Prepared again after a day has gone from the source."""
    ranges = DateRanges(START, END, START, END)
    target = scratch_path(spark, "processed")
    rows = inputs.cdr(spark, sf)
    prepare(spark, ranges, rows, target)
    prepare(spark, ranges, rows.where("DP_DATE <> date'2024-01-12'"), target)
    return rounded(spark.read.schema(schemas.PROCESSED_SCHEMA).parquet(target))


@query
def stream_daily_late(spark, sf):
    """Half of every day's records arrives after all days have been seen."""
    rows = inputs.cdr(spark, sf)
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "summary", "state"))
    for half in (0, 1):
        rows.where(F.col("id") % 2 == half).write.mode("append").parquet(folder)
        stream_daily_summary(spark, folder, out, state, rows.schema, column="DP_TS").awaitTermination()
    return as_double(sinks.read_if_present(spark, out, schemas.SUMMARY_SCHEMA), "Total_Data_Volume")


@query
def stream_monitor_single_class(spark, sf):
    rows = inputs.predictions(spark, sf).where("label = 0")
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "monitor", "state"))
    _in_two_steps(rows, folder, lambda: monitor_stream(spark, folder, out, state, rows.schema))
    report = spark.read.option("header", True).csv(f"{out}/report")
    measured = spark.read.parquet(f"{out}/metrics")
    return measured.agg(
        F.count(F.lit(1)).alias("days"), F.sum("n").alias("rows"), F.lit(report.count()).alias("report_rows")
    )
