import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import profile, selection

ODD = [
    0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 1 - 2**-53, 1 + 2**-52, 2 - 2**-52, 3.0, 1e308, 1.7976931348623157e308, 5e-324,
    2.2250738585072014e-308, 2.225073858507201e-308, 1e-310, float("inf"), -float("inf"), 2.0**1023, 2.0**-1022, 0.1,
]


def bits_of(x):
    if math.isnan(x):
        return (1 << 63) - 1
    whole = int.from_bytes(struct.pack(">d", abs(x)), "big")
    return -whole if x < 0 else whole


def test_bits_are_those_of_the_doubles(spark):
    draw = random.Random(1)
    values = [struct.unpack(">d", draw.randbytes(8))[0] for _ in range(3000)]
    values += [2.0**e * f for e in range(-1074, 1024) for f in (1.0, 1 + 2**-52, 1 - 2**-53)]
    values += [*ODD, *[-x for x in ODD], float("nan")]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = selection.with_bits(df, "x", "bits").select("bits").toPandas()["bits"].to_list()
    assert got == [bits_of(x) for x in values]
    for x, bits in zip(values, got):
        back = selection.from_bits(bits)
        assert back == x or (math.isnan(x) and math.isnan(back))


@pytest.mark.parametrize("few", [0, 100_000])
def test_ranks_of_close_and_repeated_values(spark, monkeypatch, few):
    """Values that share all but their last bits, many copies, and both signs; all rounds or two."""
    monkeypatch.setattr(selection, "FEW", few)
    draw = random.Random(2)
    close = [1 + draw.randrange(3000) * 2**-52 for _ in range(2000)]
    columns = {
        "close": close, "copies": [draw.choice([-2.5, 0.0, 7.0]) for _ in range(2000)],
        "signs": [draw.gauss(0, 1e-300 if i % 2 else 1e300) for i in range(2000)], "holes": [None] * 1999 + [4.0],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    values = selection.values_of(df, list(columns))
    ranks = {0: [0, 7, 1999], 1: [0, 500, 1000, 1999], 2: list(range(0, 2000, 100)), 3: [0]}
    found = selection.at_ranks(values, ranks)
    for place, own in enumerate(columns.values()):
        ordered = sorted(x for x in own if x is not None)
        assert [found[place, r] for r in ranks[place]] == [ordered[r] for r in ranks[place]]


def test_describe_matches_numpy(spark):
    draw = np.random.default_rng(3)
    a, b = draw.normal(size=997), draw.integers(0, 5, 997)
    df = spark.createDataFrame([(float(x), int(y), None) for x, y in zip(a, b)], "a double, b int, c double")
    found = {r["column"]: r for r in profile.describe(df).collect()}
    for name, own in (("a", a), ("b", b)):
        row = found[name]
        assert row["count"] == 997 and row["std"] == pytest.approx(own.std(ddof=1))
        assert [row[q] for q in ("min", "q25", "q50", "q75", "max")] == pytest.approx(
            np.quantile(own, [0, 0.25, 0.5, 0.75, 1]).tolist()
        )
    assert found["c"]["count"] == 0 and found["c"]["q50"] is None
    assert {r["count"] for r in profile.describe(df.limit(0)).collect()} == {0}


def test_describe_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    df = spark.range(0, 100, 1, 2).select(F.udf(count, "double")(F.col("id").cast("double")).alias("x"))
    assert profile.describe(df, ["x"]).first()["q50"] == 49.5
    assert seen.value == 100


def skewed(spark, n=3000):
    """A third of all rows in group 0."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    return spark.range(n).select(
        group.cast("long").alias("g"), ((F.col("id") * 7919) % 10007).alias("k"), F.col("id").alias("v")
    )


def quantiles(df, columns, shares):
    """Per column with values its quantiles by name."""
    values = selection.values_of(df, columns)
    sizes = {r["place"]: r["count"] for r in values.groupBy("place").count().collect()}
    return {columns[row[0]]: dict(zip(shares, row[1:])) for row in selection.quantiles_of(values, sizes, shares)}


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_match_numpy(spark, n):
    df = skewed(spark, n).withColumn("w", F.when(F.col("v") % 2 == 0, F.col("k") / 7))
    pdf = df.toPandas()
    shares = {"low": 0.25, "mid": 0.5, "high": 0.9}
    got = quantiles(df, ["g", "k", "w"], shares)
    for c in ("g", "k", "w"):
        want = np.quantile(pdf[c].dropna().astype(float), list(shares.values()))
        assert np.allclose([got[c][s] for s in shares], want)


def test_quantiles_leave_out_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert set(quantiles(df, ["a", "b"], {"m": 0.5})) == {"a"}


def test_quantiles_between_infinite_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf,), (inf,), (1.0,), (2.0,)], "v double")
    got = quantiles(df, ["v"], {"q25": 0.25, "q50": 0.5, "q75": 0.75})["v"]
    assert list(got.values()) == [1.75, inf, inf]


@pytest.mark.parametrize("few", [0, 100_000])
def test_quantiles_of_steep_rare_and_hot_columns(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    df = skewed(spark, 20000).select(
        "g",
        F.pow(F.lit(1.001), F.col("k")).alias("steep"),
        F.when(F.col("v") % 500 == 0, F.col("k") / 7).alias("rare"),
        F.when(F.col("v") < 13000, 5.0).otherwise(F.col("v")).alias("hot"),
        F.lit(None).cast("double").alias("empty"),
    )
    pdf = df.toPandas()
    shares = {"least": 0.0, "low": 0.25, "mid": 0.5, "high": 0.75, "most": 1.0}
    got = quantiles(df, df.columns, shares)
    assert set(got) == {"g", "steep", "rare", "hot"}
    for c in got:
        want = np.quantile(pdf[c].dropna().astype(float), list(shares.values()))
        assert np.allclose([got[c][s] for s in shares], want)
