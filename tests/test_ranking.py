from pyspark.sql import functions as F

from usagelens.operators.ranking import numbered, rows_at, sums_before


def skewed(spark, n=3000):
    """A third of all rows in group 0."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    return spark.range(n).select(
        group.cast("long").alias("g"), ((F.col("id") * 7919) % 10007).alias("k"), F.col("id").alias("v")
    )


def test_sums_before_matches_brute_force(spark):
    df = skewed(spark)
    rows = df.collect()
    want = {
        (r.g, r.k): sum(o.v for o in rows if o.g == r.g and o.k < r.k) for r in rows
    }
    got = {(r.g, r.k): r.v_before for r in sums_before(df, ["g"], ["k"], ["v"]).collect()}
    assert got == want


def test_sums_before_keeps_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "g string, k int, v int")
    got = {(r.g, r.k): r.v_before for r in sums_before(df, ["g"], ["k"], ["v"]).collect()}
    assert got == {(None, 1): 0, (None, 2): 5, ("a", 1): 0}


def test_rows_at(spark):
    df = skewed(spark)
    order = sorted((r.g, r.k) for r in df.collect())
    got = rows_at(df, ["g", "k"], lambda n: [1, 17, n // 2, n, n + 5])
    assert got == {p: (order[p - 1], p - 1, 1) for p in (1, 17, 1500, 3000)}


def test_rows_at_counts_copies_once(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(1,)] * 50 + [(2,)], "k int")
    got = rows_at(df, ["k"], lambda n: [3, 4, 53, n])
    assert got == {3: ((None,), 0, 3), 4: ((1,), 3, 50), 53: ((1,), 3, 50), 54: ((2,), 53, 1)}


def test_numbered_counts_within_equal_rows(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(1,)] * 300 + [(2,)], "k int").repartition(6)
    places = {}
    for r in numbered(df, ["k"]).collect():
        places.setdefault(r.k, []).append(r.place)
    assert {k: sorted(v) for k, v in places.items()} == {
        None: list(range(1, 6)), 1: list(range(1, 301)), 2: [1],
    }


def test_rows_at_empty(spark):
    assert rows_at(skewed(spark).limit(0), ["g", "k"], lambda n: [1]) == {}
