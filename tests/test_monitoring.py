import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from usagelens.operators import monitoring as m
from usagelens.registry import inputs

SCHEMA = "label int, prediction double, probability_0 double, probability_1 double, Date string, User string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(y, float(s >= 0.5), 1 - s, s, d, f"u{i}") for i, (y, s, d) in enumerate(rows)], SCHEMA
    )


def test_tied_scores_count_half(spark):
    df = frame(spark, [(1, 0.5, "2024-01-01"), (0, 0.5, "2024-01-01"), (1, 0.9, "2024-01-01"), (0, 0.1, "2024-01-01")])
    got = m.chunk_metrics(m.assign_chunks(df)).first()
    assert got["roc_auc"] == pytest.approx((0.5 + 1 + 1 + 1) / 4)
    assert got["accuracy"] == 0.75
    assert got["f1"] == pytest.approx(2 * 2 / (2 * 2 + 1))


def test_auc_equals_evaluator(spark, sf):
    df = inputs.predictions(spark, sf)
    got = m.chunk_metrics(df.withColumn("chunk", F.lit(1))).first()["roc_auc"]
    want = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="probability_1", metricName="areaUnderROC", numBins=0
    ).evaluate(df)
    assert got == pytest.approx(want, abs=1e-9)


def test_hard_auc_equals_evaluator(spark, sf):
    df = inputs.predictions(spark, sf)
    want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction").evaluate(df)
    assert m.auc_hard(df).first()[0] == pytest.approx(want, abs=1e-9)


def test_one_class_gives_empty_report(spark):
    df = frame(spark, [(0, 0.2, "2024-01-01"), (0, 0.7, "2024-01-02")])
    assert m.has_both_classes(df).first()[0] is False
    assert m.monitor(df).count() == 0
    assert m.monitor(df.limit(0)).count() == 0


def test_one_class_in_a_chunk(spark):
    df = frame(spark, [(0, 0.2, "2024-01-01"), (0, 0.7, "2024-01-02"), (1, 0.8, "2024-01-02")])
    got = {str(r["chunk"]): r for r in m.monitor(df).collect()}
    assert got["2024-01-01"]["roc_auc"] is None
    assert got["2024-01-01"]["roc_auc_alert"] is False
    assert got["2024-01-02"]["roc_auc"] == 1.0


def test_missing_values_count_only_in_size(spark):
    df = frame(spark, [(0, 0.2, "2024-01-01"), (1, 0.8, "2024-01-01")])
    holes = df.withColumn("label", F.lit(None).cast("int")).unionByName(
        df.withColumn("probability_1", F.lit(None).cast("double"))
    )
    got = m.chunk_metrics(m.assign_chunks(df.unionByName(holes))).first()
    assert got["n"] == 6 and got["roc_auc"] == 1.0 and got["accuracy"] == 1.0


def test_alerts_against_another_reference(spark):
    good = [(i % 2, 0.9 if i % 2 else 0.1, f"2024-01-0{1 + i % 4}") for i in range(40)]
    good += [(1, 0.2, "2024-01-05"), (0, 0.1, "2024-01-05"), (1, 0.8, "2024-01-05")] * 3
    bad = [(i % 2, 0.1 if i % 2 else 0.9, "2024-02-01") for i in range(20)]
    report = m.monitor(frame(spark, good), frame(spark, bad)).first()
    assert report["accuracy"] == 0 and report["accuracy_alert"] and report["roc_auc_alert"]


@pytest.mark.parametrize("n", [1, 3, 10, 1000])
def test_count_chunks_equal_ntile(spark, sf, n):
    df = inputs.predictions(spark, sf).select("Date", "User")
    df = df.unionByName(df.limit(5).select(F.lit(None).cast("string").alias("Date"), "User")).distinct()
    order = Window.orderBy("Date", "User")
    want = {(r[0], r[1]): r[2] for r in df.select("*", F.ntile(n).over(order)).collect()}
    got = {(r[0], r[1]): r[2] for r in m.assign_chunks(df, n).collect()}
    assert got == want


def test_positions_by_day_equal_positions_in_all_rows(spark):
    """A third of the rows on one day, some without a day."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "2024-01-02")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("2024-01-0"), F.col("id") % 7 + 1))
        .alias("d"),
        ((F.col("id") * 37) % 911).alias("k"),
    )
    places = [1, 5, 6, 400, 401, 402, 899, 900]
    order = sorted((r["d"] is not None, r["d"] or "", r["k"]) for r in df.collect())
    want = [((order[p - 1][1] or None, order[p - 1][2]), 1, 1) for p in places]
    assert m._keys_by_day(df, ["d", "k"], lambda n: places) == want
    times = df.select(F.col("d").cast("timestamp").alias("d"), "k")
    got = m._keys_by_day(times, ["d", "k"], lambda n: places)
    assert [key[1] for key, _, _ in got] == [key[1] for key, _, _ in want]


def sizes(df, n):
    found = m.assign_chunks(df, n, "d", ("k",))
    assert found.columns == [*df.columns, "chunk"]
    rows = [(r.d is not None, r.d or "", r.k, r.chunk) for r in found.collect()]
    # Chunks follow the order of the keys.
    ordered = [c for *_, c in sorted(rows)]
    assert ordered == sorted(ordered)
    return [ordered.count(c) for c in range(1, n + 1)]


def parts(rows, n):
    return [rows // n + (i < rows % n) for i in range(n)]


@pytest.mark.parametrize("rows,n", [(100, 10), (300, 100), (7, 10), (101, 1), (0, 3)])
def test_equal_rows_are_dealt_evenly(spark, rows, n):
    df = spark.createDataFrame([("2024-01-01", 5)] * rows, "d string, k int").repartition(7)
    assert sizes(df, n) == parts(rows, n)


def test_chunks_with_copies_and_nulls_are_even(spark):
    """A third of the rows equal, others copied, some without day or key."""
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "2024-01-02")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("2024-01-0"), F.col("id") % 7 + 1))
        .alias("d"),
        F.when(F.col("id") % 3 == 0, 4).when(F.col("id") % 11 > 0, F.col("id") % 11).alias("k"),
        F.col("id").alias("place"),
    ).select("d", F.coalesce("k", F.lit(0)).alias("k"))
    for n in (2, 10, 97):
        assert sizes(df, n) == parts(1000, n)


def test_count_chunks_do_not_shuffle_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    plan = m.assign_chunks(df, 10, "ts", ("event_id",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_new_since(spark):
    df = frame(spark, [(0, 0.2, "2024-01-01"), (0, 0.7, "2024-01-02")])
    assert tuple(m.new_since(df).first()) == (True, "2024-01-02")
    assert tuple(m.new_since(df, "2024-01-01").first()) == (True, "2024-01-02")
    assert tuple(m.new_since(df, "2024-01-02").first()) == (False, "2024-01-02")
    assert tuple(m.new_since(df.limit(0)).first()) == (True, None)
    assert m.rows_since(df, "2024-01-01").count() == 1
