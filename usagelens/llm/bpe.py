"""BPE encoding and decoding with forced-boundary splitting.

A vocabulary token is a run of byte symbols. Where two neighbouring symbols of a
pre-token occur next to each other inside no token at all, no merge can ever reach
across them, so the pre-token is cut there for certain. Each fragment is encoded
on its own and the ids are put together. Fragments repeat far more often than
words do; both are remembered per Python worker, within a fixed number of entries.
"""

import hashlib
import json
import re
import struct
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

from usagelens.llm.common import identified, map_batches, ship

# Words and fragments a worker remembers, each; together about 200 MB at most.
REMEMBERED = 600_000

# Text of these characters alone has the same words under every Unicode version, its
# characters compose with nothing, and each has one character as lower case.
_UNUSUAL = re.compile("[^\t\n\r -~\xa1-\xac\xae-\xff]")
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"
)
# The word pattern of the vocabulary file, fixed by it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Memory(dict):
    """A dict that computes missing entries and starts anew when it is full."""

    def __init__(self, compute, size=REMEMBERED):
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.size:
            self.clear()
        if len(key) <= 100:  # long keys hardly ever come back
            self[key] = value
        return value


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where
    it prints, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._refuse_others(spec)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        vocab, merges = model["vocab"], [tuple(m) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"]
        # Merges within a fragment: a word's last one carries the word end, others do not.
        self.last = BPE(vocab, merges, end_of_word_suffix=self.suffix, cache_capacity=0)
        self.inner = BPE(vocab, merges, cache_capacity=0)
        # Neighbours inside tokens; the last byte of a word is a symbol of its own.
        self.pairs, self.end_pairs = set(), set()
        for token in vocab:
            body = token.removesuffix(self.suffix)
            found = [body[i : i + 2] for i in range(len(body) - 1)]
            if body != token and found:
                self.end_pairs.add(found.pop())
            self.pairs.update(found)
        self.symbols = dict(enumerate(byte_symbols()))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        names = {i: t for t, i in [*vocab.items(), *self.specials.items()]}
        self.token = [names[i] for i in range(max(names) + 1)]
        self.fragments = Memory(self._encode_fragment)
        self.words = Memory(lambda word: self._encode_pretoken(self._as_symbols(word)))
        self.pretokens = Memory(self._encode_pretoken)

    @staticmethod
    def _refuse_others(spec):
        """Only the kind of file this encoder is right for."""
        model, splits = spec["model"], spec["pre_tokenizer"].get("pretokenizers", [{}])
        options = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        marks = ("lstrip", "rstrip", "single_word", "normalized")
        if (
            model["type"] != "BPE"
            or not model["end_of_word_suffix"]
            or any(model.get(o) for o in options)
            or any(t[m] for t in spec["added_tokens"] for m in marks)
            or spec.get("decoder")
            or spec.get("post_processor")
            or splits[0].get("pattern") != {"Regex": PATTERN}
        ):
            raise ValueError("only lower-casing byte-level BPE files with word ends are read")

    def _as_symbols(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.symbols)

    def split(self, pretoken: str) -> list[str]:
        """The fragments of a pre-token between its forced boundaries."""
        end = len(pretoken) - 2
        pairs, cuts = self.pairs, [0]
        for i in range(end):
            if pretoken[i : i + 2] not in pairs:
                cuts.append(i + 1)
        if end >= 0 and pretoken[end:] not in self.end_pairs:
            cuts.append(end + 1)
        if len(cuts) == 1:
            return [pretoken]
        return [pretoken[i:j] for i, j in zip(cuts, [*cuts[1:], len(pretoken)])]

    def _encode_fragment(self, fragment: str) -> bytes:
        if fragment.endswith(" "):  # no byte symbol; marks the last fragment of a word
            found = self.last.tokenize(fragment[:-1])
        else:
            found = self.inner.tokenize(fragment)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _encode_pretoken(self, pretoken: str) -> bytes:
        *inner, last = self.split(pretoken)
        if not inner:
            return self._encode_fragment(f"{last} ")
        fragments = self.fragments
        return b"".join([*[fragments[f] for f in inner], fragments[f"{last} "]])

    def _parts(self, text: str) -> Iterable[bytes]:
        """Ids of a text without special tokens, one piece per word."""
        if not _UNUSUAL.search(text):
            return map(self.words.__getitem__, _WORDS.findall(text.lower()))
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [self.pretokens[pretoken] for pretoken, _ in found]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if "<|" not in text:
            return b"".join(self._parts(text))
        pieces = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                pieces.append(struct.pack("<I", self.specials[part]))
            elif part:
                pieces += self._parts(part)
        return b"".join(pieces)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def forget(self) -> None:
        """Empty the memories; what they held is worked out again when it is met."""
        for memory in (self.fragments, self.words, self.pretokens):
            memory.clear()

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space, as the library does for files without a decoder."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=4)
def bpe(path: str) -> Bpe:
    """The encoder of a vocabulary file, loaded once per worker."""
    return Bpe(path)


def encode_documents(
    docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its id, the ids of its whole text and the decoded text.

    ``vocab`` names the vocabulary file, at the same place on every executor. NULL
    text counts as empty: no ids, empty decoded text. Special tokens in a text become
    their ids. Rows are independent; repeated rows give repeated results, a NULL id
    stays NULL, an empty table gives no rows, and other columns are not read.
    """
    ship(docs.sparkSession)

    def encode(batch):
        model = bpe(vocab)
        ids = [model.encode(t) for t in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "ids": ids,
            "decoded": [model.decode(i) for i in ids],
        }

    return map_batches(
        identified(docs, id_col, text_col), encode, "doc_id long, ids array<int>, decoded string"
    )


def encoding_digests(
    docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``encode_documents`` reduced to (doc_id, n_tokens, ids_sha256, decoded_sha256).

    The digests are taken where the ids are made, so neither ids nor decoded texts
    leave the worker. Defined for the same cases.
    """
    ship(docs.sparkSession)

    def digest(batch):
        model = bpe(vocab)
        decimal = id_names(vocab)
        counts, id_hashes, text_hashes = [], [], []
        for text in batch.column(1).to_pylist():
            ids = model.encode(text)
            counts.append(len(ids))
            id_hashes.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
            text_hashes.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        return {
            "doc_id": batch.column(0),
            "n_tokens": counts,
            "ids_sha256": id_hashes,
            "decoded_sha256": text_hashes,
        }

    return map_batches(
        identified(docs, id_col, text_col),
        digest,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


@lru_cache(maxsize=4)
def id_names(vocab: str) -> list[str]:
    return [str(i) for i in range(len(bpe(vocab).token))]
