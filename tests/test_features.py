import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from usagelens.operators import features
from usagelens.schemas import PROCESSED_SCHEMA, STAT_COLUMNS, TARGET

ROWS = [
    ("2024-01-01", "a", 1, 1.0, 2.0, 3, 4, 5.0, 1),
    ("2024-01-02", "a", 2, None, 2.5, 3, 4, 5.0, 0),
    ("2024-01-02", "b", 4, 3.0, -2.0, None, 4, None, 0),
    ("2024-01-02", "b", 4, 3.0, -2.0, None, 4, None, 0),
    (None, "c", 7, 2.0, 1.0, 1, 1, 1.0, None),
    (None, "d", 9, 4.0, 1.0, 1, 1, 1.0, 1),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, PROCESSED_SCHEMA)


def windowed(df):
    day = Window.partitionBy("Date")
    made = []
    for c in STAT_COLUMNS:
        made += [
            F.sum(c).over(day).alias(f"{c}_sum"),
            F.mean(c).over(day).alias(f"{c}_mean"),
            F.stddev(c).over(day).alias(f"{c}_stddev"),
        ]
    return df.select("*", *made)


def same(a, b):
    def key(df):
        return sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()),
            key=repr,
        )

    assert a.columns == b.columns
    assert key(a) == key(b)


@pytest.mark.parametrize("limit", [100_000, 2, 1])
def test_date_stats_equal_windows(table, limit):
    """With few statistics broadcast, the other dates take the shuffled way."""
    same(features.add_date_stats(table, broadcast_rows=limit), windowed(table))


def test_date_stats_on_events(spark, sf):
    from usagelens.registry import inputs

    table = inputs.processed(spark, sf)
    same(features.add_date_stats(table, broadcast_rows=5), windowed(table))


def test_date_stats_do_not_shuffle_rows(table):
    plan = features.add_date_stats(table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_one_row_day(table):
    after = features.build_features(table).where("Date = '2024-01-01'").first()
    assert after["M_Out_Call_Count_stddev"] == 0 and after["M_Out_Call_Count_stddev_log"] == 0
    before = features.build_features(table, fill="before").where("Date = '2024-01-01'").first()
    assert before["M_Out_Call_Count_stddev"] is None


def test_fill_order_changes_means(table):
    def mean(fill):
        made = features.build_features(table, fill=fill).where("Date = '2024-01-02'")
        return made.first()["M_Out_Call_Time_mean"]

    assert mean("after") == 3.0
    assert mean("before") == 2.0
    with pytest.raises(ValueError):
        features.build_features(table, fill="never")


def test_columns_and_label(table):
    made = features.build_features(table)
    assert len(made.columns) == 37
    assert len(features.feature_names()) == 32
    assert set(features.feature_names()) < set(made.columns)
    assert made.where("User = 'c'").first()["label"] == 0
    assert features.build_features(table, drop_unlabeled=True).where("User = 'c'").isEmpty()
    assert TARGET not in made.columns


def test_log_domain(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (-0.5,), (0.0,), (1.0,)], "x double")
    got = [r["x_log"] for r in features.log_features(df, ["x"]).orderBy("x").collect()]
    assert got[:2] == [None, None]
    assert got[2:] == pytest.approx([math.log1p(x) for x in (-0.5, 0.0, 1.0)])


def test_empty(spark):
    assert features.build_features(spark.createDataFrame([], PROCESSED_SCHEMA)).count() == 0
