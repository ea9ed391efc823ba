import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import distribution, profile


def values(spark, seed, n=800):
    draw = np.random.default_rng(seed)
    own = np.concatenate([draw.normal(0, 1, n // 2), draw.exponential(3, n - n // 2)])
    return own, spark.createDataFrame([(float(x),) for x in own] + [(None,)], "v double")


@pytest.mark.parametrize("bins,reach", [(2048, 6.0), (256, 3.0), (64, 2.0)])
def test_binned_density_is_within_its_bound(spark, bins, reach):
    _, df = values(spark, 1)
    exact = {r["point"]: r for r in distribution.kde(df, "v", 50).collect()}
    binned = distribution.kde_binned(df, "v", 50, bins, reach).collect()
    assert len(binned) == 50
    for r in binned:
        assert r["x"] == pytest.approx(exact[r["point"]]["x"])
        assert abs(r["density"] - exact[r["point"]]["density"]) <= r["error_bound"] + 1e-12
    if bins >= 256:
        assert binned[0]["error_bound"] < 0.05 * max(r["density"] for r in exact.values())


def test_binned_density_of_odd_columns(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert distribution.kde_binned(empty, "v").count() == 0
    flat = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert {r["density"] for r in distribution.kde_binned(flat, "v", 10).collect()} == {None}


def test_weights_stand_for_copies(spark):
    df = spark.createDataFrame([(float(i % 7), 1 + i % 3) for i in range(21)], "v double, w int")
    copies = df.select(F.explode(F.array_repeat("v", F.col("w"))).alias("v"))
    for made in (distribution.kde, distribution.histogram):
        plain = sorted(made(copies, "v", 20).collect())
        weighted = sorted(made(df, "v", 20, weight="w").collect())
        assert [list(map(pytest.approx, r)) for r in plain] == [list(r) for r in weighted]


def test_one_row_statistics_stand_once_in_the_plan(spark):
    _, df = values(spark, 2)
    for made in (distribution.kde(df, "v"), distribution.histogram(df, "v"), distribution.min_max_scale(df, ["v"])):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "scalar-subquery" not in plan and plan.count("LogicalRDD") <= 3


def test_merged_sketches_are_near(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30).cast("string").alias("Date"), (F.col("id") % 9001).cast("string").alias("User")
    )
    sketches = profile.subscriber_sketches(rows)
    assert sketches.count() == 30
    for days in (None, "15"):
        inside = rows if days is None else rows.where(F.col("Date") <= days)
        exact = inside.agg(F.count_distinct("User")).first()[0]
        found = profile.subscribers_between(sketches, end=days).first()
        assert found["record_count"] == inside.count()
        assert abs(found["distinct_subscribers"] / exact - 1) < 0.04
    assert tuple(profile.subscribers_between(sketches, "a", "b").first()) == (0, 0)


def test_class_summary_sorts_no_rows(spark):
    rows = [(i % 2, f"t{i % 5}", str(i % 4) if i % 3 else "x", i % 3 == 0, float(i)) for i in range(60)]
    rows += [(None, None, "7", None, None), (0, None, None, True, None)]
    df = spark.createDataFrame(rows, "k int, t string, s string, b boolean, v double")
    reduced = profile.text_counts(df, "k", ["t", "s", "b"])
    assert "SortAggregate" not in reduced._jdf.queryExecution().executedPlan().toString()
    found = {r["k"]: r for r in profile.class_summary(df, "k").collect()}
    assert set(found) == {0, 1, None}
    for k, row in found.items():
        own = [r for r in rows if r[0] == k]
        texts = [r[1] for r in own if r[1] is not None]
        assert (row["t_min"], row["t_max"], row["t_count"]) == (min(texts, default=None), max(texts, default=None), len(texts))
        assert row["t_sum"] is row["t_avg"] is row["t_skewness"] is None
        for name, numbers in (
            ("s", [float(r[2]) for r in own if r[2] not in (None, "x")]),
            ("b", [float(r[3]) for r in own if r[3] is not None]),
            ("v", [r[4] for r in own if r[4] is not None]),
        ):
            if not numbers:
                assert row[f"{name}_sum"] is None
                continue
            away = np.array(numbers) - np.mean(numbers)
            assert row[f"{name}_sum"] == pytest.approx(sum(numbers))
            assert row[f"{name}_avg"] == pytest.approx(np.mean(numbers))
            if len(numbers) > 1 and (away**2).sum():
                assert row[f"{name}_variance"] == pytest.approx(np.var(numbers, ddof=1))
                skew = (away**3).mean() / math.pow((away**2).mean(), 1.5)
                assert row[f"{name}_skewness"] == pytest.approx(skew, abs=1e-12)
        spelt = [r[2] for r in own if r[2] is not None]
        assert (row["s_min"], row["s_max"], row["s_count"]) == (min(spelt), max(spelt), len(spelt))
    assert dict(profile.class_summary(df, "k").dtypes)["b_min"] == "boolean"
