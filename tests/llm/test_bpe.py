import hashlib
import random

import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from usagelens.llm import bpe
from usagelens.llm.common import WORD_BPE

PATH = public_tokenizers.path(WORD_BPE)
TEXTS = [
    "",
    None,
    " \t\n",
    "Hello World's we'll 123 ½² x³",
    "İstanbul ΑΣ Σ ὈΔΥΣΣΕΎΣ café é",
    "a<|endoftext|>b <|startoftext|><|endoftext|",
    "zero​width  nb\u0085x\x1cy z",
    "日本語テキスト 👍🏽 𝒳",
    "ﬁ Å ̈́ ß ẞ ǅ",
    "\x00\x01 a\xadb",
    "'S 'T it'S don't I'd",
    "x" * 5000,
    "aé" * 3000,
    "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_same_as_library_on_odd_texts(spark, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again")]
    found = bpe.encode_documents(documents(spark, rows), PATH).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=repr) == sorted(
        ((i, *want(library, t)) for i, t in rows), key=repr
    )


def test_same_as_library_on_random_characters(library):
    draw = random.Random(5)
    model = bpe.bpe(PATH)
    ranges = [(32, 127), (128, 592), (768, 880), (0x0370, 0x0600), (0x1E00, 0x2100), (0x1F300, 0x1F700)]
    for _ in range(300):
        low, high = draw.choice(ranges)
        text = "".join(chr(draw.randrange(low, high)) if draw.random() < 0.8 else " " for _ in range(60))
        assert model.encode(text) == want(library, text)[0]


def test_fragments_are_cut_only_where_no_token_reaches():
    model = bpe.bpe(PATH)
    inside = set(model.token)
    for word in ("thqzdle", "xqjwvkz", "serendipity"):
        parts = model.split(word)
        assert "".join(parts) == word
        for left, right in zip(parts, parts[1:]):
            assert not any(left[-1] + right[0] in t for t in inside if not t.endswith("</w>"))
    assert len(model.split("xqjwvkz")) > 1


def test_digests_of_the_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encoding_digests(docs, PATH).collect():
        ids, decoded = want(library, texts[r.doc_id])
        joined = " ".join(map(str, ids))
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table_and_full_memory(spark, library, monkeypatch):
    assert bpe.encoding_digests(documents(spark, []), PATH).count() == 0
    model = bpe.Bpe(PATH)
    model.words.size = model.fragments.size = 5
    text = "many different words come and go while the memory stays as small as it is"
    assert model.encode(text) == want(library, text)[0]
    assert len(model.words) <= 5
