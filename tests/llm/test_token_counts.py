import random

import public_tokenizers
from helpers import documents

from usagelens.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute_force(model, word):
    """Fewest tokens of the best of all segmentations, each prefix anew for every word."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + model.unknown * size, best[end - 1][1] + size)]
        for begin in range(end):
            if word[begin:end] in model.scores:
                options.append((best[begin][0] + model.scores[word[begin:end]], best[begin][1] + 1))
        best.append(max(options, key=lambda o: (o[0], -o[1])))
    return best[-1][1]


def every_segmentation(scores, word):
    if not word:
        yield 0.0, 0
    for end in range(1, len(word) + 1):
        if word[:end] in scores:
            for score, n in every_segmentation(scores, word[end:]):
                yield score + scores[word[:end]], n + 1


def test_same_as_every_segmentation():
    draw = random.Random(3)
    for _ in range(20):
        tokens = {"a", "b", "c"} | {"".join(draw.choices("abc", k=draw.randint(2, 4))) for _ in range(12)}
        model = token_counts.Unigram({t: -draw.randint(1, 9) / 2 for t in tokens})
        words = {"".join(draw.choices("abc", k=draw.randint(1, 9))) for _ in range(30)}
        want = {w: max(every_segmentation(model.scores, w), key=lambda o: (o[0], -o[1]))[1] for w in words}
        assert model.counts(words) == want


def test_table(spark, sf):
    model = token_counts.unigram(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {}
    for r in token_counts.count_tokens(docs, PATH).collect():
        words = texts[r.doc_id].split()
        for w in words:
            if w not in known:
                known[w] = brute_force(model, token_counts.SPACE + w)
        assert (r.n_tokens, r.n_pretokens) == (sum(known[w] for w in words), len(words))


def test_a_prefix_is_scored_once():
    walked = list(token_counts.Trie(["abc", "abd", "ab", "x"]).walk())
    assert [(d, c) for d, c, _ in walked] == [(1, "a"), (2, "b"), (3, "c"), (3, "d"), (1, "x")]
    assert [w for *_, w in walked] == [None, "ab", "abc", "abd", "x"]


def test_odd_texts(spark, monkeypatch):
    texts = ["", None, " \n", "日本 👍", "a" * 20_000, "word " * 30_000, "퟿ é"]
    rows = [*enumerate(texts), (None, "x"), (3, "日本 👍")]
    model = token_counts.unigram(PATH)
    want = [
        (i, sum(brute_force(model, token_counts.SPACE + w) for w in (t or "").split()), len((t or "").split()))
        for i, t in rows
        if i != 4 and i != 5
    ]
    found = token_counts.count_tokens(documents(spark, rows), PATH).collect()
    got = [(r.doc_id, r.n_tokens, r.n_pretokens) for r in found if r.doc_id not in (4, 5)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r.doc_id: r.n_pretokens for r in found}[5] == 30_000
    assert token_counts.count_tokens(documents(spark, []), PATH).count() == 0
    monkeypatch.setattr(token_counts, "REMEMBERED", 2)
    fresh = token_counts.Unigram(model.scores)
    assert fresh.count_texts(["a b c d", "c d e"]) == model.count_texts(["a b c d", "c d e"])
