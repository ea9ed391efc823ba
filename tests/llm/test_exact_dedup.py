import hashlib

import pytest
from helpers import documents, lower_ascii
from pyspark.sql import functions as F

from usagelens.llm import dropping, exact_dedup


def want(rows, keep):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(lower_ascii(text), []).append((doc_id, i))
    found = []
    for text, own in groups.items():
        ids = [d for d, _ in own if d is not None]
        best = (max(ids) if keep == "largest" else min(ids)) if ids else None
        first = True
        for doc_id, _ in own:
            kept = doc_id == best and first
            first = first and not kept
            found.append((doc_id, best, len(own), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=repr)


ROWS = [
    (1, "Same"), (2, "same"), (3, "SAME"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, " "),
    (None, "same"), (None, "alone"), (9, "x" * 100_000), (10, "X" * 100_000), (11, "twice"), (11, "twice"),
]


def got(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_odd_rows(spark, keep):
    assert got(exact_dedup.exact_duplicates(documents(spark, ROWS), keep)) == want(ROWS, keep)


@pytest.mark.parametrize("share,few", [(1000, 200_000), (2, 200_000), (2, 0)])
def test_colliding_hashes_are_told_apart(spark, monkeypatch, share, few):
    """With a hash of three values nearly all groups mix texts; bytes decide."""
    monkeypatch.setattr(exact_dedup, "SHARE", share)
    monkeypatch.setattr(dropping, "FEW", few)
    rows = ROWS + [(100 + i, f"text {i % 7}") for i in range(60)]

    def weak(text):
        return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(3)).cast("string").cast("binary")

    found = exact_dedup.exact_duplicates(documents(spark, rows), "largest", hashed=weak)
    assert got(found) == want(rows, "largest")


def test_hot_group_is_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARE", 5)
    rows = [(i, "Hot text" if i % 3 else f"own {i}") for i in range(120)]
    assert got(exact_dedup.exact_duplicates(documents(spark, rows), "smallest")) == want(rows, "smallest")


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("few", [0, 200_000])
def test_drop_keeps_rows_and_columns(spark, monkeypatch, few):
    monkeypatch.setattr(dropping, "FEW", few)
    docs = documents(spark, ROWS)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.schema == docs.schema
    expected = [(d, t) for d, t in dict.fromkeys(ROWS)]
    expected = [(d, t) for d, t in expected if (d, t) in {
        (1, "Same"), (4, "É"), (5, "é"), (6, None), (8, " "), (None, "alone"), (9, "x" * 100_000), (11, "twice"),
    }]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_registered_query_has_sql(spark, sf):
    from compare import difference, duck

    from usagelens.llm.oracles import ORACLES
    from usagelens.llm.queries import QUERIES

    for name, sql in ORACLES.items():
        assert difference(QUERIES[name](spark, sf), duck(sf), sql) is None, name
