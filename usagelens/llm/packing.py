"""Cost-balanced packing of documents into sequences.

A document of n tokens costs ``n + quadratic * n * n`` (dense layers and attention).
Whole sequences are cut off a long document first; the rest of it and all shorter
documents are then assigned in descending cost to the lowest-cost sequence that has
room, and a document that fits nowhere whole is cut at the room there is.

Packing needs no shuffle: each task packs its own rows, block by block as it reads
them, within a fixed number of tokens. Every block fills its sequences to the last
token; what is left over at its end becomes sequences whose lengths are powers of
two, which need no padding.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from usagelens.llm.bpe import bpe
from usagelens.llm.common import identified, pieces, release, ship

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids array<int>"
)


def assign(lengths: np.ndarray, capacity: int, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Pieces (document, start, length, sequence) that fill ``sum(lengths) // capacity``
    sequences, and further sequences of power-of-two lengths with the rest.

    Pieces of one sequence come in the order of their offsets.
    """
    placed, full = [], 0
    rest = []  # (tokens, document, start)
    for document, n in enumerate(lengths.tolist()):
        for start in range(0, n - capacity + 1, capacity):
            placed.append((document, start, capacity, full))
            full += 1
        if n % capacity:
            rest.append((n % capacity, document, n - n % capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    left = sum(r[0] for r in rest)
    rooms = [capacity] * (left // capacity)
    rooms += [1 << b for b in reversed(range(capacity.bit_length())) if left % capacity >> b & 1]
    room, cost = np.array(rooms, np.int64), np.zeros(len(rooms))
    for n, document, start in rest:
        while n:
            fits = room >= n
            if fits.any():
                at = int(np.where(fits, cost, np.inf).argmin())
            else:
                at = int(room.argmax())
            take = min(n, int(room[at]))
            placed.append((document, start, take, full + at))
            room[at] -= take
            cost[at] += take + quadratic * take * take
            n, start = n - take, start + take
    return placed


def by_pieces(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    """The rows (id, text) of a batch, of which a few texts at a time become Python objects."""
    at = 0
    for texts in pieces(batch.column(1)):
        yield from zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts.to_pylist())
        at += len(texts)


def pack(
    docs: DataFrame,
    vocab: str,
    capacity: int = 2048,
    end_id: int = 1,
    quadratic: float = 1 / 2048,
    block_tokens: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document, placed in a sequence of at most ``capacity`` tokens.

    A document is the ids of its text by ``vocab`` and ``end_id``; NULL and empty texts are
    that id alone. ``start`` counts its ids before the piece, ``offset`` the tokens of the
    sequence before it; ``ids_crc32`` is over little-endian unsigned 32-bit ids. Every
    sequence is full or as long as a power of two. Repeated rows are packed as often
    as they occur, a NULL id stays NULL, an empty table gives no rows, and other columns
    are not read. ``capacity`` must be a power of two. A block is closed once it holds
    ``block_tokens``, so a task holds that many and one document more.

    Without ``with_ids`` the column ``ids`` is left out.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship(docs.sparkSession)

    def rows(ids: list, encoded: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = np.array([len(e) // 4 for e in encoded], np.int64)
        assigned = assign(lengths, capacity, quadratic)
        document, start, length, sequence = np.array(assigned, np.int64).reshape(-1, 4).T
        order = np.argsort(sequence, kind="stable")
        document, start, length, sequence = (x[order] for x in (document, start, length, sequence))
        before = np.cumsum(length) - length
        opens = np.r_[True, sequence[1:] != sequence[:-1]]
        offset = before - np.maximum.accumulate(np.where(opens, before, 0))
        spans = [
            encoded[d][4 * s : 4 * (s + n)]
            for d, s, n in zip(document.tolist(), start.tolist(), length.tolist())
        ]
        made = {
            "doc_id": pa.array([ids[d] for d in document.tolist()], pa.int64()),
            "start": start,
            "length": length,
            "ids_crc32": np.array([zlib.crc32(s) for s in spans], np.int64),
            "doc_tokens": lengths[document],
            "sequence_id": first + sequence,
            "offset": offset,
        }
        if with_ids:
            made["ids"] = [np.frombuffer(s, "<i4") for s in spans]
        return pa.RecordBatch.from_pydict(made), int(sequence.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, end = bpe(vocab), np.uint32(end_id).tobytes()
        # The partition number makes sequence ids unique without talking to other tasks.
        first = TaskContext.get().partitionId() << 40
        ids, encoded, tokens = [], [], 0
        for batch in batches:
            for doc_id, text in by_pieces(batch):
                ids.append(doc_id)
                encoded.append(model.encode_bytes(text) + end)
                tokens += len(encoded[-1]) // 4
                if tokens >= block_tokens:
                    made, used = rows(ids, encoded, first)
                    yield made
                    first, ids, encoded, tokens, made = first + used, [], [], 0, None
                    release()
        if ids:
            yield rows(ids, encoded, first)[0]
        # The worker stays for tasks of other stages, beside which remembered words would take room.
        model.forget()
        release()

    schema = SCHEMA if with_ids else SCHEMA.removesuffix(", ids array<int>")
    return identified(docs, id_col, text_col).mapInArrow(run, schema)
