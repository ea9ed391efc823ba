"""Incremental ingestion, daily summary and monitoring with Structured Streaming.

Every sink rewrites what a batch owns (its own folder, or whole dates), so a
batch run again after a failure leaves the same result.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions import day_of
from usagelens.operators.monitoring import (
    assign_chunks,
    cell_merges,
    cell_metrics,
    monitor,
    score_cells,
    thresholds,
    two_classes,
    with_alerts,
)
from usagelens.operators.summary import as_summary, summary_totals
from usagelens.schemas import SUMMARY_SCHEMA
from usagelens.sinks import read_if_present, replace_dates, write_report
from usagelens.streaming.partials import Partials


def _file_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int | None):
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: T.StructType,
    interval: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append record files to a table as they arrive.

    Each batch owns the partition ``batch=<id>`` of the table. Without
    ``interval`` the query takes what is there and stops.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    stream = _file_stream(spark, in_dir, schema, files_per_trigger)
    return _start(stream.writeStream.foreachBatch(append), checkpoint, interval)


def daily_totals_stream(stream: DataFrame, column: str, watermark: str) -> DataFrame:
    """Running totals per day of event time; one state row per open day."""
    timed = stream.withColumn("event_time", F.col(column).cast("timestamp"))
    return (
        timed.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", "1 day").alias("day"))
        .agg(*summary_totals())
        .select(F.col("day.start").cast("date").alias("Date"), *SUMMARY_SCHEMA.fieldNames()[1:])
    )


def daily_partials(spark: SparkSession, checkpoint: str) -> Partials:
    """The summary's totals per batch and day, below the checkpoint of its stream."""
    totals = SUMMARY_SCHEMA.fieldNames()[1:]
    return Partials(spark, f"{checkpoint}/partials", ["Date"], {c: F.sum(c) for c in totals}, "Date")


def add_to_summary(partials: Partials, batch: DataFrame, batch_id: int, out_dir: str, column: str) -> None:
    """Add up one batch and replace the days it touches in the summary table.

    Reads the batch and earlier sums, no earlier records. Running it again changes nothing.
    """
    sums = batch.groupBy(day_of(batch, column).alias("Date")).agg(*summary_totals())
    written = partials.put(sums, batch_id)
    replace_dates(as_summary(partials.of_same_days(written)), out_dir, "Date")
    partials.compact(batch_id, written.schema)


def stream_daily_summary(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: T.StructType,
    column: str = "DP_DATE",
    watermark: str | None = None,
    interval: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Keep the daily summary table up to date as record files arrive.

    Every batch keeps its totals per day below ``checkpoint``. A day that occurs in new files becomes
    the sum of what all batches hold of it, so late files count in full and no
    record is read twice. With a ``watermark`` running totals are kept as state
    instead; records of a day that closed before the watermark are then dropped.
    """
    stream = _file_stream(spark, in_dir, schema, files_per_trigger)
    if watermark:

        def upsert(batch: DataFrame, batch_id: int) -> None:
            replace_dates(as_summary(batch), out_dir, "Date")

        totals = daily_totals_stream(stream, column, watermark)
        return _start(totals.writeStream.outputMode("update").foreachBatch(upsert), checkpoint, interval)

    partials = daily_partials(spark, checkpoint)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        add_to_summary(partials, batch, batch_id, out_dir, column)

    return _start(stream.writeStream.foreachBatch(refresh), checkpoint, interval)


def score_partials(spark: SparkSession, checkpoint: str) -> Partials:
    """Counts per batch, day and score, below the checkpoint of the monitoring stream."""
    return Partials(spark, f"{checkpoint}/partials", ["chunk", "score"], cell_merges(), "chunk")


def add_to_monitoring(partials: Partials, batch: DataFrame, batch_id: int, out_dir: str) -> None:
    """Count one batch of predictions and renew the metrics of its days, the bounds and the report.

    Reads the batch and earlier counts, no earlier predictions. Running it again changes nothing.
    """
    spark = batch.sparkSession
    cells = score_cells(assign_chunks(batch, "day"))
    written = partials.put(cells, batch_id)
    metrics_dir = f"{out_dir}/metrics"
    measured = cell_metrics(partials.of_same_days(written))
    replace_dates(measured, metrics_dir, "chunk")
    partials.compact(batch_id, written.schema)
    known = read_if_present(spark, metrics_dir, measured.schema)
    if known is None:
        return
    ranges = known.agg(F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high"))
    usable = ranges.select(two_classes().alias("usable")).scalar()
    plain = known.drop("label_low", "label_high")
    write_report(with_alerts(plain, thresholds(plain)).where(usable), f"{out_dir}/report")


def monitor_stream(
    spark: SparkSession,
    pred_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: T.StructType,
    interval: str | None = None,
    files_per_trigger: int | None = None,
    by="day",
    tiebreak: tuple[str, ...] = ("User",),
) -> StreamingQuery:
    """Refresh the monitoring report whenever prediction files arrive.

    Every batch keeps its counts per day and score below ``checkpoint``, from which all metrics
    follow; days that occur in new files are measured again from the counts of all
    batches, and no prediction is read twice. Metrics of all days lie in ``out_dir/metrics``.
    Bounds and alerts come from all days and go to ``out_dir/report`` as CSV, which is
    empty while all rows have one class. New rows move every chunk by count, so with
    ``by=n`` all rows are measured again.
    """
    partials = score_partials(spark, checkpoint)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if by == "day":
            add_to_monitoring(partials, batch, batch_id, out_dir)
        else:
            table = spark.read.schema(schema).parquet(pred_dir)
            write_report(monitor(table, by=by, tiebreak=tiebreak), f"{out_dir}/report")

    stream = _file_stream(spark, pred_dir, schema, files_per_trigger)
    return _start(stream.writeStream.foreachBatch(refresh), checkpoint, interval)
