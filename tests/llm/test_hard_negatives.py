import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from usagelens.llm import hard_negatives, vectors
from usagelens.llm.oracles import ORACLES
from usagelens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every, positives=5, negatives=3, least=50, most=95, scale=256):
    """All scores of all anchors, in Python integers."""
    whole = [
        (i, [int(np.floor(scale * x)) for x in v], n)
        for i, v, n in rows
        if i is not None and n is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    made = []
    for anchor, a, label in {(i, tuple(v), n) for i, v, n in whole if i % every == 0}:
        scored = [(-sum(x * y for x, y in zip(a, v)), i, n) for i, v, n in whole if i != anchor and len(v) == len(a)]
        scored.sort(key=lambda s: s[:2])
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and least * -p_score <= 100 * -s[0] <= most * -p_score]
            for rank, (score, i, _) in enumerate(fits[:negatives], 1):
                cut = [max(-(1 << 63), min((1 << 63) - 1, -s)) for s in (p_score, score)]
                made.append((anchor, p, rank, i, *cut))
    return sorted(made)


def got(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def clustered(seed, n, width=12, tight=0.15):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width))
    of = draw.integers(0, 6, n)
    points = centres[of] + tight * draw.normal(size=(n, width))
    points[::9] = points[0]  # ties
    labels = [int(c) if draw.random() < 0.6 else int(draw.integers(0, 6)) for c in of]
    return [(int(i), [float(x) for x in p], labels[i]) for i, p in enumerate(points)]


@pytest.mark.parametrize(
    "seed,tight,blocks",
    [(1, 0.15, {}), (2, 1.0, {"block_rows": 40, "anchor_rows": 16, "parallel": 1}), (3, 0.05, {"block_rows": 30, "references": 3})],
)
def test_same_as_all_scores(spark, seed, tight, blocks):
    rows = clustered(seed, 500, tight=tight)
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **blocks)
    assert got(found) == plain(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(4, 60, width=3)
    rows += [(100, None, 1), (110, [1.0, None, 1.0], 1), (120, [nan, 1.0, 1.0], 1), (130, [inf, 1.0, 1.0], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (140, [1.0, 1.0, 1.0], None), (150, [0.0, 0.0, 0.0], 1), (160, [], 2)]
    rows += [(170, [], 3), (171, [], 2), (180, [1.0, 2.0], 1), (181, [1.0, 2.0], 1), (182, [0.5, 1.5], 2)]
    rows += [rows[0], rows[1], rows[1], (10, [1.0, 1.0, 1.0], 5)]  # repeated rows, and another one under id 10
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as key", "3 as size", "4 as v")
    assert got(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)) == plain(rows, 10)
    for none in (df.limit(0), df.where("label = 5")):
        assert hard_negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_components_beyond_exact_doubles(spark):
    rows = clustered(5, 80, width=3)
    rows += [(200, [1e17, 1.0, 2.0], 1), (201, [9e16, 5.0, 2.0], 1), (202, [8e16, 1.0, 0.0], 2)]
    rows += [(203, [6e16, -1e17, 0.0], 3), (210, [1e300, 0.0, 0.0], 2), (204, [2.0**31, 3.0, 1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=20)
    assert got(found) == plain(rows, 10)


def test_text_labels(spark):
    rows = clustered(6, 120, width=4)
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, F.concat(F.lit("l"), "label"))
    assert got(found) == plain(rows, 10)


def test_bounds_hold_and_prune():
    """Bounds of every run hold all its scores; in tight clusters most pairs are never scored."""
    rows = clustered(7, 4000, width=12, tight=0.02)
    points = vectors.scaled(np.array([v for _, v, _ in rows]), 256)
    unit, norms = hard_negatives._units(points)
    refs = hard_negatives.directions(list(points[:300]), 16)[12]
    angles = np.arccos(np.clip(unit @ refs.T, -1, 1)).astype(np.float32)
    order = np.lexsort((angles.min(axis=1), [n for _, _, n in rows]))

    def block(at):
        packed = {
            "n": len(at), "size": 12, "ids": at.astype(np.int64).tobytes(), "keys": at.astype(np.int64).tobytes(),
            "labels": np.array([rows[i][2] for i in at], np.int64).tobytes(), "norms": norms[at].tobytes(),
            "angles": angles[at].tobytes(), "points": points[at].tobytes(), "positives": "",
        }
        return hard_negatives.Block(packed)

    data, asked = block(order), block(order[::50])
    low, high, norm_low, norm_high, _, _ = data.runs()
    own = asked.angles[:, None, :]
    lower, upper = hard_negatives.interval(
        own, own, low[None], high[None], asked.norms[:, None] * norm_low, asked.norms[:, None] * norm_high
    )
    scores = asked.points @ data.points.T
    for r, first in enumerate(data.first):
        part = scores[:, first : first + hard_negatives.RUN]
        assert (part.min(axis=1) >= lower[:, r]).all() and (part.max(axis=1) <= upper[:, r]).all()
    near = hard_negatives.Search(asked, 5, None)
    near.run(data)
    far = hard_negatives.Search(asked, 3, [[(int(0.5 * s), int(0.95 * s))] for s in near.scores[:, 0, 0]])
    far.run(data)
    # Windows of half to 0.95 of a score hold most other clusters; those of the best rows hold few.
    assert near.scored < 0.2 * near.possible
    assert far.scored < 0.9 * far.possible


def test_same_as_sql(spark, sf):
    found = QUERIES["op12_hard_negatives"](spark, sf)
    assert difference(found, duck(sf), ORACLES["op12_hard_negatives"]) is None
