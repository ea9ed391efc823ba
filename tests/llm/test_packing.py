import shutil
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import documents

from usagelens.llm import packing
from usagelens.llm.bpe import bpe
from usagelens.llm.common import WORD_BPE

PATH = public_tokenizers.path(WORD_BPE)


def check(pieces, rows, capacity, vocab=PATH):
    """Pieces cover each document once, and sequences are gapless and full or powers of two."""
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        documents.setdefault(p.doc_id, []).append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        total = sum(p.length for p in own)
        assert 0 < total <= capacity and total & (total - 1) == 0
    for doc_id, text in rows:
        ids = [*bpe(vocab).encode(text or ""), 1]
        own = sorted(documents[doc_id], key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert sum(p.length for p in own) == len(ids)
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            assert p.doc_tokens == len(ids)
            if hasattr(p, "ids"):
                assert p.ids == part.tolist()
    assert len(documents) == len({d for d, _ in rows})


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(packing.pack(docs, PATH).collect(), rows, 2048)


@pytest.mark.parametrize("block", [1, 50, 10**6])
def test_odd_texts_in_small_blocks(spark, block):
    texts = ["", None, "a", "word " * 70, "one two three", " ", "x " * 16, "y " * 15]
    docs = documents(spark, list(enumerate(texts)))
    check(packing.pack(docs, PATH, 16, block_tokens=block).collect(), list(enumerate(texts)), 16)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = documents(spark, [(None, "a b"), (4, "c d e"), (4, "c d e")])
    found = packing.pack(docs, PATH, 8, with_ids=False).collect()
    assert sum(p.length for p in found) == 3 + 4 + 4
    assert {p.doc_id for p in found} == {None, 4}
    assert packing.pack(documents(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, 1000)


def test_costs_are_balanced():
    """Long and short documents mix: sequences cost nearly the same, unlike first come first served."""
    draw = np.random.default_rng(1)
    lengths = np.concatenate([draw.integers(600, 1500, 300), draw.integers(1, 60, 3000)])
    costs, room = {}, {}
    for _, _, n, sequence in packing.assign(lengths, 2048, 1 / 2048):
        costs[sequence] = costs.get(sequence, 0) + n + n * n / 2048
        room[sequence] = room.get(sequence, 0) + n
    full = [costs[s] for s in costs if room[s] == 2048]
    assert len(full) == lengths.sum() // 2048
    # In order of arrival the long ones share sequences and the short ones do.
    arrival, left = [0.0], 2048
    for n in lengths.tolist():
        while n:
            if not left:
                arrival.append(0.0)
                left = 2048
            take = min(n, left)
            arrival[-1] += take + take * take / 2048
            n, left = n - take, left - take
    assert np.std(full) < 0.7 * np.std(arrival[:-1])


def test_texts_become_objects_piece_by_piece():
    texts = ["a" * 300_000, "", "b" * 100_000, "c" * 100_000, "d" * 300_000, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, None, 3, 3, 5, 6], "text": texts})
    assert list(packing.by_pieces(batch)) == list(zip([1, None, 3, 3, 5, 6], texts))
    assert list(packing.by_pieces(batch.slice(1, 3))) == list(zip([None, 3, 3], texts[1:4]))
    assert list(packing.by_pieces(batch.slice(2, 0))) == []


def test_workers_forget_words_when_a_task_ends(spark, tmp_path):
    # A path of its own, so that no other test's words are in the encoder.
    vocab = shutil.copy(PATH, str(tmp_path / "vocab.json"))
    docs = documents(spark, [(i, f"unheardof word{i} of ours") for i in range(64)]).repartition(8)
    assert len(packing.pack(docs, vocab).collect()) >= 64

    def left(batches):
        model = bpe(vocab)
        for batch in batches:
            n = len(model.words) + len(model.fragments) + len(model.pretokens)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n] * batch.num_rows, pa.int64())})

    rows = spark.range(8, numPartitions=8).mapInArrow(left, "n long").collect()
    assert [r.n for r in rows] == [0] * 8
