import datetime
import math

import pytest
from pyspark.sql import functions as F

from usagelens.functions import numeric_columns, resolve
from usagelens.operators import distribution as d
from usagelens.operators import nulls, profile, summary, transform
from usagelens.schemas import PROCESSED_SCHEMA, RAW_MEASURES, RAW_SCHEMA


def test_resolve_ignores_case(spark):
    df = spark.createDataFrame([(1, "x")], "M_Tenure_Churn int, User string")
    assert resolve(df, "M_TENURE_CHURN") == "M_Tenure_Churn"
    with pytest.raises(ValueError):
        resolve(df, "missing")


def test_numeric_columns(spark):
    df = spark.createDataFrame([], "a int, b double, c string, d decimal(5,2), e bigint, f date")
    assert numeric_columns(df, ["B"]) == ["a", "d", "e"]


def test_transform_text(spark):
    columns = [f.name for f in RAW_SCHEMA.fields]
    rows = [
        ["1", "2024-01-05 13:00:00", "77", "3.7", "12.5", "x", "", "0", "0", "-2.9", "1e3", "1"],
        ["2", "no date", "78", None, "abc", "99999999999", "5", "0", "0", "NaN", " 4 ", "0"],
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    first, second = transform.transform_cdr(df).orderBy("User").collect()
    assert tuple(first) == ("2024-01-05", "77", 3, 12.5, 1000.0, -2, None, None, 1)
    assert tuple(second) == (None, "78", None, None, 4.0, None, None, 5.0, 0)
    assert transform.transform_cdr(df).schema.fieldNames() == PROCESSED_SCHEMA.fieldNames()


def test_transform_uses_schema_types(spark):
    made = transform.transform_cdr(spark.createDataFrame([], RAW_SCHEMA))
    assert [f.dataType for f in made.schema] == [f.dataType for f in PROCESSED_SCHEMA]


def test_fill_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan"), None), (1, 2.0, "x")], "a int, b double, c string")
    assert tuple(nulls.fill_numeric(df).first()) == (0, 0.0, None)
    assert nulls.nan_to_null(df).first()["b"] is None


def test_sparse_columns_are_strict(spark):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") >= 60, 1).alias("at_60"),
        F.when(F.col("id") >= 61, 1).alias("at_61"),
        F.lit(None).cast("int").alias("none"),
    )
    assert nulls.drop_sparse_columns(df, 0.6).columns == ["id", "at_60"]
    assert nulls.drop_all_null_columns(df).columns == ["id", "at_60", "at_61"]
    assert nulls.drop_sparse_columns(df.limit(0), 0.6).columns == df.columns
    assert nulls.drop_all_null_columns(df.limit(0)).columns == []


def test_daily_summary_rounds_and_fills_no_gaps(spark):
    day = datetime.datetime(2024, 1, 1, 23, 59, 59, 999999)
    rows = [
        (1, day, 1, 2, 1.25, 0, 0.0, 0, 0, 1, 0.005, 0),
        (2, day, 2, 3, 1.25, 0, 0.0, 0, 0, None, None, 0),
        (3, day + datetime.timedelta(seconds=1), 2, 3, 1.0, 0, 0.0, 0, 0, 1, 1.0, 0),
        (4, None, 2, 3, 1.0, 0, 0.0, 0, 0, 1, 1.0, 0),
    ]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    got = summary.daily_summary(df, "2024-01-01", "2024-01-01").collect()
    assert [tuple(map(str, r)) for r in got] == [("2024-01-01", "5", "3", "1", "0.01")]
    assert summary.daily_summary(df, "2024-01-01").count() == 2
    assert summary.daily_summary(df.limit(0), "2024-01-01").count() == 0


def test_pandas_like_sums(spark):
    rows = [(1, None, 1, 2, 1.0, 0, 0.0, 0, 0, 1, 1.0, 0)]
    rows += [(2, datetime.datetime(2024, 1, 1), 1, 2, None, 0, 0.0, 0, 0, 1, 1.0, 0)]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    sums, means = summary.sum_by_date(df).collect(), summary.mean_by_date(df).collect()
    assert len(sums) == 1 and sums[0]["DP_MOC_DURATION"] == 0
    assert means[0]["DP_MOC_DURATION"] is None


def test_class_summary_blocks_agree(spark, sf):
    from usagelens.registry import inputs

    df = inputs.labelled(spark, sf)
    df = df.unionByName(df.limit(3).withColumn("M_Tenure_Churn", F.lit(None).cast("int")))
    wide, narrow = (
        sorted(
            (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows.collect()),
            key=repr,
        )
        for rows in (profile.class_summary(df, block=100), profile.class_summary(df, block=1))
    )
    assert wide == narrow and len(wide) == 3


def test_class_summary_of_constants(spark):
    df = spark.createDataFrame([(1, 5.0, "7"), (1, 5.0, "x")], "M_Tenure_Churn int, a double, t string")
    got = profile.class_summary(df).first()
    assert got["a_variance"] == 0 and got["a_skewness"] is None
    assert (got["t_sum"], got["t_count"], got["t_min"], got["t_max"]) == (7.0, 2, "7", "x")


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], PROCESSED_SCHEMA)
    assert tuple(profile.profile(df).first()) == (0, 0)
    assert set(profile.null_counts(df).first()) == {0}
    assert profile.top_correlated(df).count() == 0
    assert profile.moments(df, "M_Data_Sum").first()["mean"] is None
    assert {r["count"] for r in profile.describe(df).collect()} == {0}


def test_correlation_rules(spark):
    rows = [(1.0, 5.0, 3.0, 1), (2.0, 5.0, 1.0, 0), (None, 5.0, 2.0, 0), (4.0, 5.0, 0.0, 0)]
    df = spark.createDataFrame(rows, "a double, flat double, down double, M_Tenure_Churn int")
    zero = {r[0]: r[1] for r in profile.target_correlations(df).collect()}
    skip = {r[0]: r[1] for r in profile.target_correlations(df, nulls="skip").collect()}
    assert set(zero) == {"a", "flat", "down"}
    assert zero["flat"] is None
    assert zero["a"] == pytest.approx(-0.29277, abs=1e-4) and skip["a"] != pytest.approx(zero["a"])
    assert profile.top_correlated(df).first()[0] == "down"
    assert profile.top_correlated(df.withColumn("down", -F.col("down"))).first()[0] == "a"
    flipped = profile.top_correlated(df.withColumn("down", -F.col("down")), absolute=True)
    assert flipped.first()[0] == "down"


def test_r2_edges(spark):
    rows = [(1.0, 1.0, 1.0, None, 1.0), (1.0, 2.0, 3.0, 2.0, 1.0), (1.0, None, 2.0, None, 1.0)]
    df = spark.createDataFrame(rows, "same double, b double, c double, once double, PSEUDO_CHURNED double")
    got = {r["feature"]: (r["n"], r["r2"]) for r in profile.r2_vs_target(df).collect()}
    assert got["same"] == (3, 1.0)
    assert got["b"] == (2, pytest.approx(-1.0))
    assert got["c"] == (3, pytest.approx(1 - 5 / 2))
    assert "once" not in got
    flat = profile.r2_vs_target(df.withColumn("PSEUDO_CHURNED", F.lit(0.0)))
    assert {r["feature"]: r["r2"] for r in flat.collect()}["same"] == 0.0


def test_regression_line(spark):
    df = spark.range(20).select(
        F.col("id").cast("double").alias("x"),
        F.lit(1.0).alias("flat"),
        (F.col("id") * 3.0 + 2).alias("PSEUDO_CHURNED"),
    )
    got = {r["feature"]: r for r in profile.regression_vs_target(df).collect()}
    assert (got["x"]["slope"], got["x"]["intercept"]) == (pytest.approx(3), pytest.approx(2))
    assert got["x"]["r2"] == pytest.approx(1)
    assert got["flat"]["slope"] is None


def test_scaling_and_reflection(spark):
    df = spark.createDataFrame([(0.0, 3.0), (5.0, 3.0), (10.0, 3.0), (None, 3.0)], "x double, flat double")
    scaled = d.min_max_scale(df, ["x", "flat"]).collect()
    assert [r["scaled_x"] for r in scaled] == [0.0, 0.5, 1.0, None]
    assert {r["scaled_flat"] for r in scaled} == {None}
    turned = {r["x"]: r for r in d.reflect_transform(df, "x").collect()}
    assert turned[10.0]["reflected"] == 1.0 and turned[10.0]["adjusted"] is None
    assert turned[0.0]["adjusted"] == pytest.approx(1 / math.log(11))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (3.0,), (None,)], "x double")
    got = [r["count"] for r in d.histogram(df, "x", 3).orderBy("bin").collect()]
    assert got == [2, 1, 1]
    flat = d.histogram(df.where("x = 1"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in flat] == [0, 0, 1, 0] and flat[0]["left_edge"] == 0.5
    assert {r["count"] for r in d.histogram(df.limit(0), "x", 3).collect()} == {0}


def test_density_integrates(spark):
    df = spark.range(500).select((F.sin("id") * 10).alias("x"))
    rows = d.kde(df, "x", 400).orderBy("point").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.8 < sum(r["density"] for r in rows) * step <= 1.0


def test_log_profile_needs_positive(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (3.0,)], "x double")
    got = d.log_profile(df, "x").first()
    assert got["n"] == 2 and got["mean"] == pytest.approx((math.log(2) + math.log(4)) / 2)


def test_latest_rows_breaks_ties(spark):
    df = spark.range(50).select("id", F.lit("2024-01-01").alias("DP_DATE"))
    assert sorted(r["id"] for r in transform.latest_rows(df, 3).collect()) == [47, 48, 49]


def test_raw_measures_are_in_the_schema():
    assert set(RAW_MEASURES) < set(RAW_SCHEMA.fieldNames())
