import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k, every):
    whole = []
    for vec_id, v, _ in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((vec_id, np.floor(1024 * np.array(v, np.float32).astype(np.float64))))
    found = set()
    for q, v in whole:
        if q % every == 0:
            scored = sorted((-int(v @ w), i) for i, w in whole if i != q and len(w) == len(v))
            found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return sorted(found)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def clustered(n, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, 16))
    points = centres[draw.integers(0, 8, n)] + 0.1 * draw.normal(size=(n, 16))
    points[::7] = points[0]  # many equal vectors, so ties
    return [(int(i), [float(x) for x in p.astype(np.float32)], 0) for i, p in enumerate(points)]


@pytest.mark.parametrize("data_rows,query_rows,parallel", [(20_000, 4_000, 2), (60, 20, 1)])
def test_same_as_brute_force(spark, data_rows, query_rows, parallel):
    rows = clustered(700, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    found = topk.top_k(
        df, F.col("vec_id") % 10 == 0, 10, data_rows=data_rows, query_rows=query_rows, parallel=parallel
    )
    assert got(found) == brute_force(rows, 10, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (1, [0.5, -0.25], 0), (2, None, 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0),
        (5, [inf, 1.0], 0), (6, [1.0, 2.0, 3.0], 0), (7, [], 0), (None, [1.0, 1.0], 0), (10, [0.0, 0.0], 0),
        (20, [1.0, 2.0, 3.0], 0), (30, [], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as v", "3 as block")
    assert got(topk.top_k(df, F.col("vec_id") % 10 == 0)) == brute_force(rows, 10, 10)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_large_components(spark):
    """Finite extremes neither fail nor hide others; scores beyond a long are cut."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(3).normal(size=(60, 3)))]
    rows += [(100, [1e17, 0.0, 0.0]), (101, [-1e17, 1.0, 0.0]), (110, [1e308, -1e308, 1e308]), (111, [2.0**30, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, 5, parallel=1).collect()
    assert len(found) == 8 * 5
    own = np.array([[max(-1e150, min(1e150, float(np.floor(1024 * x)) if abs(x) < 1e300 else x * 1e10)) for x in v] for _, v in rows[:60]])
    for q in range(0, 60, 10):
        got = {r["rank"]: (r.vec_id, r.score) for r in found if r.query_id == q}
        best = sorted([(-int(s), i) for i, s in enumerate(own @ own[q]) if i != q])
        small = [(i, -s) for s, i in best]
        large = [v for v in got.values() if v[0] >= 100]
        assert [v for _, v in sorted(got.items()) if v[0] < 100] == small[: 5 - len(large)]
    assert {r.score for r in found if r.query_id == 110 and r["rank"] == 1} <= {(1 << 63) - 1}


def test_repeated_rows(spark):
    rows = [(0, [1.0], 0), (0, [1.0], 0), (1, [2.0], 0), (1, [2.0], 0), (2, [0.5], 0)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=3)
    assert got(found) == [(0, 1, 1, 2 * 1024**2), (0, 2, 1, 2 * 1024**2), (0, 3, 2, 1024**2 // 2)]


def test_trees_cover_and_prune():
    points = np.array([v for _, v, _ in clustered(3000, 2)])
    tree = topk.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(3000))
    open_nodes = [tree.root]
    while open_nodes:
        node = open_nodes.pop()
        own = tree.points[node.first : node.last]
        assert np.sqrt(((own - node.centre) ** 2).sum(1)).max() <= node.radius + 1e-9
        if node.children:
            assert [c.first for c in node.children] == [node.first, *[c.last for c in node.children[:-1]]]
            assert node.children[-1].last == node.last
        open_nodes += node.children
    search = topk.Search(points[:50] * 1024, np.arange(50), np.full(50, -np.inf), points * 1024, np.arange(3000), 10)
    list(search.run())
    assert search.compared == 50 * 3000  # without a floor nothing is excluded at first, and products are cheaper
    floors = np.sort(points[:50] @ points.T * 1024**2, axis=1)[:, -20]
    search = topk.Search(points[:50] * 1024, np.arange(50), floors, points * 1024, np.arange(3000), 10)
    assert search._excluded() >= topk.WORTH
    pruned = sorted(search.run())
    assert search.compared < 0.3 * 50 * 3000
    plain = topk.Search(points[:50] * 1024, np.arange(50), floors, points * 1024, np.arange(3000), 10)
    plain._excluded = lambda: 0.0
    # Points are no whole numbers here, so scores can differ by one when cut.
    best = [sorted(i for q, i, _ in found if q == 7) for found in (pruned, sorted(plain.run()))]
    assert best[0] == best[1]


def test_blocks_that_cannot_matter_are_not_searched(spark, monkeypatch):
    """Far clusters: queries near one of them meet few blocks, with the same result."""
    draw = np.random.default_rng(6)
    centres = 30 * draw.normal(size=(10, 8))
    rows = [(i, [float(x) for x in centres[i % 10] + 0.1 * draw.normal(size=8)], 0) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA)
    written = []
    keep = topk.materialize
    monkeypatch.setattr(topk, "materialize", lambda df, name: written.append((name, keep(df, name))) or written[-1][1])
    found = topk.top_k(df, F.col("vec_id") % 100 == 0, 10)
    assert got(found) == brute_force(rows, 10, 100)
    made = dict(written)
    blocks = made["top-k-data"].select("block").distinct().count()
    assert made["top-k-pairs"].count() < blocks


def test_given_vectors_cannot_be_pruned(spark):
    """Random directions in 64 dimensions: bounds of leaves exclude next to nothing."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("embedding").collect()
    points = topk.whole([r.embedding for r in rows], 1024)
    scores = points[:50] @ points.T
    floors = np.sort(scores, axis=1)[:, -11]
    search = topk.Search(points[:50], np.arange(50), floors, points, np.arange(len(points)), 10)
    assert search._excluded() < 0.05
