import hashlib
import random
import re

import numpy as np
import pytest
from compare import difference, duck
from helpers import documents, lower_ascii

from usagelens.llm import bitmap, decontaminate
from usagelens.llm.oracles import ORACLES
from usagelens.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(lower_ascii(text))


def sets(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(rows, items, window=10, percent=100, shingle=3):
    """(doc_id, n_words, n_hit, items), trying every window at every place."""
    cut = []
    for item_id, text in items:
        w = words_of(text)
        if w:
            cut += [(item_id, w[i : i + window]) for i in range(max(1, len(w) - window + 1))]
    made = []
    for doc_id, text in rows:
        w = words_of(text)
        hit, found = set(), set()
        for item_id, own in cut:
            size = min(shingle, len(own))
            wanted = sets(own, size)
            for i in range(len(w) - len(own) + 1):
                part = w[i : i + len(own)]
                if percent == 100:
                    same = part == own
                else:
                    same = 100 * len(sets(part, size) & wanted) >= percent * len(wanted)
                if same:
                    hit |= set(range(i, i + len(own)))
                    found.add(item_id)
        named = sorted(str(i) for i in found if i is not None)
        made.append((doc_id, len(w), len(hit), named))
    return sorted(made, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in df.collect()), key=repr)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr(
        "*", "1 as doc_id", "2 as size", "'x' as words", "3 as token"
    )


def texts(seed, docs=60, items=12):
    draw = random.Random(seed)
    known = [f"w{i}" for i in range(40)] + ["Ünder", "日本"]
    bench_rows = [(i, " ".join(draw.choices(known, k=draw.randint(1, 30)))) for i in range(items)]
    rows = []
    for i in range(docs):
        parts = [" ".join(draw.choices(known, k=draw.randint(0, 25)))]
        for _ in range(draw.randint(0, 3)):
            own = draw.choice(bench_rows)[1].split()
            if draw.random() < 0.4:
                own[draw.randrange(len(own))] = "other"
            at = draw.randint(0, max(0, len(own) - 12))
            parts.append(draw.choice([" ", ", ", "-"]).join(own[at : at + draw.randint(1, 30)]).upper())
            parts.append(" ".join(draw.choices(known, k=draw.randint(0, 9))))
        rows.append((i, " ".join(parts)))
    return rows, bench_rows


@pytest.mark.parametrize("seed,window,percent,shingle", [(1, 10, 100, 3), (2, 6, 70, 2), (3, 10, 80, 3), (4, 3, 100, 1)])
def test_same_as_trying_all_places(spark, seed, window, percent, shingle):
    rows, items = texts(seed)
    found = decontaminate.contamination(
        documents(spark, rows), bench(spark, items), window=window, percent=percent, shingle=shingle
    )
    assert got(found) == plain(rows, items, window, percent, shingle)


def test_hot_passages_and_full_filter(spark, monkeypatch):
    # Every document holds the same passage; the smallest filter lets many other places through.
    monkeypatch.setattr(decontaminate, "SHARE", 5)
    rows, items = texts(5, docs=40)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(i, f"{t} {passage} end") for i, t in rows]
    items = [*items, (99, passage), (100, f"{passage} more words")]
    found = decontaminate.contamination(documents(spark, rows), bench(spark, items), most_bits=1)
    assert got(found) == plain(rows, items)


def test_odd_rows(spark):
    ten = "a b c d e f g h i j"
    rows = [
        (1, None), (2, ""), (3, " .,; "), (4, ten), (4, ten), (4, "other"), (None, ten), (5, "one"),
        (6, ten.upper().replace(" ", "--")), (7, "a b c d e f g h i"), (8, ("x " * 3000) + ten + (" x" * 3000)),
        (9, "a b a b a b a b a b a b"),
    ]
    items = [
        (1, None), (2, ""), (3, "?!"), (4, ten), (4, ten), (10, ten + " k"), (None, "one"), (11, "a b"),
        (12, "a b a b a b a b a b"),
    ]
    found = decontaminate.contamination(documents(spark, rows), bench(spark, items))
    assert got(found) == plain(rows, items)


def test_empty_tables(spark):
    rows, items = texts(6, docs=5, items=3)
    docs, items = documents(spark, rows), bench(spark, items)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    clean = decontaminate.digests(docs, items.limit(0)).collect()
    assert len(clean) == 5
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (0, 0, nothing, False) for r in clean)


def test_passages(spark):
    ten = "a b c d e f g h i j"
    rows = [(1, f"x {ten} k y {ten}"), (2, f"{ten} {ten}"), (3, "x y")]
    found = decontaminate.passages(documents(spark, rows), bench(spark, [(1, f"{ten} k"), (2, ten)]))
    assert sorted(map(tuple, found.collect())) == [(1, 1, 12), (1, 13, 23), (2, 0, 20)]


def test_only_necessary_prefixes_are_joined(spark):
    """One shingle of a window at 100 percent, the rarest; three of ten at 80."""
    distinct = spark.createDataFrame(
        [(b"a", b"x" * 80, 3, [5, 6, 7, 8, 9, 10, 11, 12, 13, 14], list(range(10)))],
        "window_id binary, words binary, size int, tokens array<long>, at array<int>",
    )
    counts = spark.createDataFrame([(t, 100 - t) for t in range(5, 15)], "token long, n long")
    picked = [
        sorted(r.token for r in decontaminate.prefixes(distinct, counts, p).collect()) for p in (100, 80)
    ]
    assert picked == [[14], [12, 13, 14]]


def test_filter_holds_what_it_was_built_from(spark):
    draw = np.random.default_rng(1)
    tokens = draw.integers(-(1 << 63), 1 << 63, 5000)
    df = spark.createDataFrame([(int(t),) for t in tokens], "token long")
    for most_bits in (bitmap.MOST_BITS, 1 << 16):
        assert bitmap.build(df, most_bits).holds(tokens.view(np.uint64)).all()
    others = draw.integers(-(1 << 63), 1 << 63, 100_000).view(np.uint64)
    assert bitmap.build(df).holds(others).mean() < 0.001
    assert not bitmap.build(df.limit(0)).holds(others).any()


def test_same_as_sql(spark, sf):
    found = QUERIES["op11_decontaminate"](spark, sf)
    assert difference(found, duck(sf), ORACLES["op11_decontaminate"]) is None
