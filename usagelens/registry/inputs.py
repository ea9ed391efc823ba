"""Usage-record tables derived from the given tables.

``cdr`` has one row per subscriber and active day of ``events``; ``cdr_lines``
has one row per row of ``lineitem`` and stands for a table too large to profile
casually.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.operators.transform import transform_cdr


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cdr(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records.

    The window that finds the next active day sorts one row per day of a
    subscriber, so its groups are bounded by the calendar. It is left out of the
    plan when the label is not used.
    """

    def count_of(kind):
        return F.count_if(F.col("event_type") == kind).cast("int")

    def sum_of(kind):
        return F.sum(F.when(F.col("event_type") == kind, F.col("value")))

    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("DP_MSISDN"), F.col("ts").cast("date").alias("DP_DATE"))
        .agg(
            F.min("event_id").alias("id"),
            F.min("ts").cast("timestamp").alias("DP_TS"),
            count_of("click").alias("DP_MOC_COUNT"),
            sum_of("click").alias("DP_MOC_DURATION"),
            count_of("view").alias("DP_MTC_COUNT"),
            sum_of("view").alias("DP_MTC_DURATION"),
            count_of("signup").alias("DP_MOSMS_COUNT"),
            count_of("error").alias("DP_MTSMS_COUNT"),
            count_of("purchase").alias("DP_DATA_COUNT"),
            sum_of("purchase").alias("DP_DATA_VOLUME"),
        )
    )
    next_day = F.lead("DP_DATE").over(Window.partitionBy("DP_MSISDN").orderBy("DP_DATE"))
    stays = next_day <= F.date_add("DP_DATE", 1)
    return daily.select(
        "id",
        "DP_DATE",
        "DP_TS",
        "DP_MSISDN",
        "DP_MOC_COUNT",
        "DP_MOC_DURATION",
        "DP_MTC_COUNT",
        "DP_MTC_DURATION",
        "DP_MOSMS_COUNT",
        "DP_MTSMS_COUNT",
        "DP_DATA_COUNT",
        "DP_DATA_VOLUME",
        F.when(stays, 0).otherwise(1).alias("PSEUDO_CHURNED"),
    )


def cdr_text(spark: SparkSession, sf: str) -> DataFrame:
    """``cdr`` as loaded without types, with some values that are no numbers."""
    raw = cdr(spark, sf).drop("DP_TS")
    text = {c: F.col(c).cast("string") for c in raw.columns}
    text["DP_MTC_COUNT"] = F.when(F.col("DP_MTC_COUNT") == 2, "two").otherwise(
        text["DP_MTC_COUNT"]
    )
    text["DP_DATA_COUNT"] = F.concat(text["DP_DATA_COUNT"], F.lit(".7"))
    return raw.select(*[value.alias(c) for c, value in text.items()])


def processed(spark: SparkSession, sf: str) -> DataFrame:
    return transform_cdr(cdr(spark, sf))


def before_last_day(df: DataFrame, column: str) -> DataFrame:
    """All days but the last: the label looks one day ahead, and there is no day after it."""
    return df.where(F.col(column) < df.agg(F.max(column)).scalar())


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return before_last_day(processed(spark, sf), "Date")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled records with a score made from three counts."""
    one = (F.col("M_In_Call_Count") + 1) / (
        F.col("M_In_Call_Count") + F.col("M_Data_Count") + F.col("M_Out_Call_Count") + 2
    )
    return (
        labelled(spark, sf)
        .select("Date", "User", F.col("M_Tenure_Churn").alias("label"), one.alias("probability_1"))
        .select(
            "Date",
            "User",
            "label",
            F.when(F.col("probability_1") >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
            (1 - F.col("probability_1")).alias("probability_0"),
            "probability_1",
        )
    )


def cdr_lines(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("DP_DATE"),
        F.col("l_suppkey").alias("DP_MSISDN"),
        F.col("l_quantity").cast("int").alias("DP_MOC_COUNT"),
        price.alias("DP_MOC_DURATION"),
        F.col("l_linenumber").alias("DP_MTC_COUNT"),
        (price * F.col("l_tax")).alias("DP_MTC_DURATION"),
        F.lit(0).alias("DP_MOSMS_COUNT"),
        F.lit(0).alias("DP_MTSMS_COUNT"),
        F.col("l_linenumber").alias("DP_DATA_COUNT"),
        (price * F.col("l_discount")).alias("DP_DATA_VOLUME"),
        (F.col("l_returnflag") == "R").cast("int").alias("PSEUDO_CHURNED"),
    )


def processed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return transform_cdr(cdr_lines(spark, sf))
