"""Canonical schemas and column groups of the usage-record tables."""

from pyspark.sql import types as T

# Table and column names shared with existing data files.
RAW_MEASURES = [
    "DP_MOC_COUNT",
    "DP_MOC_DURATION",
    "DP_MTC_COUNT",
    "DP_MTC_DURATION",
    "DP_MOSMS_COUNT",
    "DP_MTSMS_COUNT",
    "DP_DATA_COUNT",
    "DP_DATA_VOLUME",
]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("DP_DATE", T.TimestampType()),
        T.StructField("DP_MSISDN", T.LongType()),
        T.StructField("DP_MOC_COUNT", T.IntegerType()),
        T.StructField("DP_MOC_DURATION", T.DoubleType()),
        T.StructField("DP_MTC_COUNT", T.IntegerType()),
        T.StructField("DP_MTC_DURATION", T.DoubleType()),
        T.StructField("DP_MOSMS_COUNT", T.IntegerType()),
        T.StructField("DP_MTSMS_COUNT", T.IntegerType()),
        T.StructField("DP_DATA_COUNT", T.IntegerType()),
        T.StructField("DP_DATA_VOLUME", T.DoubleType()),
        T.StructField("PSEUDO_CHURNED", T.IntegerType()),
    ]
)

PROCESSED_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("User", T.StringType()),
        T.StructField("M_Out_Call_Count", T.IntegerType()),
        T.StructField("M_Out_Call_Time", T.DoubleType()),
        T.StructField("M_Data_Sum", T.DoubleType()),
        T.StructField("M_Data_Count", T.IntegerType()),
        T.StructField("M_In_Call_Count", T.IntegerType()),
        T.StructField("M_In_Call_Time", T.DoubleType()),
        T.StructField("M_Tenure_Churn", T.IntegerType()),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Total_Outgoing_Calls", T.LongType()),
        T.StructField("Total_Outgoing_Call_Time", T.LongType()),
        T.StructField("Total_Data_Purchases", T.LongType()),
        T.StructField("Total_Data_Volume", T.DecimalType(18, 2)),
    ]
)

TARGET = "M_Tenure_Churn"
RAW_TARGET = "PSEUDO_CHURNED"

# Columns that get per-date statistics, and the columns monitoring reads.
STAT_COLUMNS = ["M_Out_Call_Count", "M_Out_Call_Time", "M_Data_Sum", "M_Data_Count"]
PREDICTION_COLUMNS = ["label", "prediction", "probability_0", "probability_1", "Date"]
