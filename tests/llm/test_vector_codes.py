import hashlib
from math import floor

import numpy as np
import pytest
from compare import difference, duck

from usagelens.llm import vector_codes, vectors
from usagelens.llm.oracles import ORACLES
from usagelens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"
MOST = (1 << 63) - 1


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Every part against every entry in every round, in Python integers."""
    kept = [(i, v, n) for i, v, n in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(floor(scale * x)) for x in v], n) for i, v, n in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((far(c[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = assigned()
    errors = [min(MOST, sum(d for d, _ in f)) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    made = []
    for (i, _, n), f, error in zip(whole, found, errors):
        same = sum(e for (_, _, m), e in zip(whole, errors) if m == n)
        made.append((i, "".join(f"{c:02x}" for _, c in f), error, min(MOST, same), digest))
    return sorted(made, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def drawn(seed, n, width=8, spread=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width))
    points = centres[draw.integers(0, 6, n)] + spread * draw.normal(size=(n, width))
    points[::5] = np.round(points[::5])
    labels = [None if i % 11 == 0 else i % 3 for i in range(n)]
    return [(int(i * 3 - 50), [float(x) for x in p], labels[i]) for i, p in enumerate(points)]


@pytest.mark.parametrize("seed,n,entries,rounds", [(1, 300, 16, 4), (2, 300, 40, 6), (3, 20, 256, 4)])
def test_same_as_full_scans(spark, seed, n, entries, rounds):
    rows = drawn(seed, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as code", "2 as n", "3 as v")
    found = vector_codes.code_report(df, entries=entries, rounds=rounds)
    assert got(found) == plain(rows, entries=entries, rounds=rounds)


def test_ties_repeated_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 2), 0.0, float(i % 3), 1.0], i % 2) for i in range(30)]
    rows += [(3, rows[3][1], 1)] * 4 + [(None, [0.5, 0.5, 0.5, 0.5], None)]
    odd = [(100, None, 0), (101, [1.0, None, 1.0, 1.0], 0), (102, [nan] * 4, 0), (103, [inf, 0.0, 0.0, 0.0], 0)]
    found = vector_codes.code_report(spark.createDataFrame(rows + odd, SCHEMA), entries=5)
    assert got(found) == plain(rows, entries=5)


def test_components_beyond_exact_doubles(spark):
    rows = drawn(4, 60, width=4)
    rows += [(1000, [1e17, 0.0, -1e17, 3.0], 0), (1001, [1e300, 1e17, 0.0, 0.0], 1), (1002, [1e17, 0.0, -1e17, 3.5], 0)]
    rows.append((-1000, [2.5e8, 1.0, 2.0, 3.0], 2))
    found = vector_codes.code_report(spark.createDataFrame(rows, SCHEMA), entries=6)
    assert got(found) == plain(rows, entries=6)


def test_lengths_and_empty_tables(spark):
    rows = [(1, [], 0), (2, [1.0, 2.0, 3.0], 0), (3, [1.0, 2.0, 3.0, 4.0], 0), (4, [1.0] * 8, 0), (5, [0.0] * 4, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.vec_id: (r.code, r.error) for r in vector_codes.code_report(df).collect()}
    assert found[1] == found[2] == found[4] == (None, None)
    assert found[3] == ("00000000", 0) and found[5] == ("01010101", 0)
    assert vector_codes.code_report(df.limit(0)).count() == 0
    assert [r.code for r in vector_codes.code_report(df.limit(2)).collect()] == [None, None]


def test_many_labels(spark):
    """Beyond the broadcast bound the errors by label are the same."""
    rows = [(i, [float(i % 7), 1.0, float(i % 5), 0.0], i % 4 if i % 2 else 9) for i in range(80)]
    found = vector_codes.code_report(spark.createDataFrame(rows, SCHEMA), broadcast_rows=2, entries=4)
    assert got(found) == plain(rows, entries=4)


def test_fixed_parts_compare_moved_entries_only():
    draw = np.random.default_rng(5)
    points, entries = draw.integers(-500, 500, (400, 4)).astype(float), draw.integers(-500, 500, (32, 4)).astype(float)
    none = np.full(400, -1)
    code, distance, compared = vector_codes.assign(points, none, none, entries, np.ones(32, bool))
    assert compared == 400 * 32
    moved = np.zeros(32, bool)
    moved[[3, 17]] = True
    changed = entries.copy()
    changed[3], changed[17] = changed[5], changed[20] + 1  # entry 5 now ties with the lower entry 3
    new, far, compared = vector_codes.assign(points, code, distance, changed, moved)
    full, all_far = vectors.nearest(points, changed)
    assert (new == full).all() and (far == all_far).all()
    of_moved = np.isin(code, [3, 17]).sum()
    assert compared == of_moved * 32 + (400 - of_moved) * 2
    assert vector_codes.assign(points, code, distance, entries, np.zeros(32, bool))[2] == 0


def test_same_as_sql(spark, sf):
    found = QUERIES["op13_vector_codes"](spark, sf)
    assert difference(found, duck(sf), ORACLES["op13_vector_codes"]) is None
