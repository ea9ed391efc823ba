"""The jobs users run from end to end."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from usagelens.operators import features, model, monitoring, nulls, profile
from usagelens.operators.transform import transform_cdr
from usagelens.plans.config import DateRanges
from usagelens.plans.exploration import Exploration
from usagelens.schemas import RAW_TARGET
from usagelens.sinks import append_table, clear_dates, replace_dates, write_report, write_snapshot
from usagelens.sources import scan_cdr, scan_predictions, scan_processed, scan_string_range
from usagelens.storage import materialize


def prepare(
    spark: SparkSession,
    ranges: DateRanges,
    source,
    table: str,
    snapshots: str | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Scan raw records, transform them, and replace the range's dates in the processed table.

    The range in the table is then what this run prepared: dates of the range without
    records are cleared. With ``snapshots`` also writes a snapshot folder. Returns
    the rows of this run, from a written copy; none leave the table as it was.
    """
    rows = transform_cdr(scan_cdr(spark, source, ranges.start, ranges.end))
    prepared = materialize(rows, "prepared")
    if prepared.isEmpty():
        return prepared
    replace_dates(prepared, table)
    clear_dates(spark, table, ranges.start, ranges.end, kept=prepared.select("Date"))
    if snapshots:
        write_snapshot(prepared, snapshots, at or datetime.now())
    return prepared


def train_churn(
    spark: SparkSession,
    ranges: DateRanges,
    table,
    predictions: str | None = None,
    fill: str = "after",
    **options,
) -> tuple[float, DataFrame]:
    """Features, balancing, forest search and flat predictions over the processed range.

    Appends the predictions to a table when one is named. Returns the ROC-AUC of
    the hard prediction on the test part, and the predictions.
    """
    made = features.build_features(
        scan_processed(spark, table, ranges.processed_start, ranges.processed_end), fill
    )
    _, scored = model.train_and_score(made, **options)
    flat = materialize(model.flatten_predictions(scored), "predictions")
    if predictions:
        append_table(flat, predictions)
    return model.hard_evaluator().evaluate(flat), flat


def run(
    spark: SparkSession,
    ranges: DateRanges,
    source,
    table: str,
    predictions: str | None = None,
    **options,
) -> tuple[float, DataFrame]:
    """Prepare, then train; training is refused when preparing gave no rows."""
    if prepare(spark, ranges, source, table).isEmpty():
        raise ValueError("no prepared records, nothing to train on")
    return train_churn(spark, ranges, table, predictions, **options)


def explore_raw(df: DataFrame, start: str, end: str, column: str = "DP_DATE") -> Exploration:
    """Fit of the churn label against every usable raw column in a text date range.

    Finding the usable columns runs one aggregate; a profile is made when it is asked for.
    """
    numbers = nulls.drop_all_null_columns(
        nulls.coerce_numeric(scan_string_range(df, column, start, end))
    )
    if RAW_TARGET not in numbers.columns:
        raise ValueError(f"{RAW_TARGET} has no numeric value in the range")
    return Exploration(
        {
            "r2": lambda: profile.r2_vs_target(numbers),
            "regression": lambda: profile.regression_vs_target(numbers),
            "describe": lambda: profile.describe(numbers),
        }
    )


def monitoring_report(spark: SparkSession, source, path: str | None = None, by="day") -> DataFrame:
    """Monitoring report over a predictions table, written as CSV when a path is given."""
    tiebreak = ("probability_1", "label", "prediction")
    report = monitoring.monitor(scan_predictions(spark, source), by=by, tiebreak=tiebreak)
    if path:
        write_report(report, path)
    return report
