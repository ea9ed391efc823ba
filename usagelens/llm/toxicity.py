"""Toxicity: bags of subword embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (and of itself), so a
misspelling shares most of its vector with the word it stands for. A passage is the
mean of its words, and a document is judged by its worst passage of at most
``PASSAGE`` words, wherever it begins, so that one insult in a long text is not averaged away.
Embeddings and softmax are trained jointly with numpy on a bounded sample.
"""

import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.bpe import Memory
from usagelens.llm.common import identified, map_batches, ship
from usagelens.llm.learning import held_out, learning_sample

BUCKETS, DIMENSIONS, PASSAGE = 1 << 17, 10, 3
_AROUND = ".,;:!?\"'()[]{}«»“”„…¿¡*#$%&|-"
# Signs and blanks of other scripts that part words in an overlong run.
_WITHIN = re.compile("[!-/:-@\\[-`{-~\u00a1-\u00bf\u2000-\u206f\u3000-\u303f\uff01-\uff0f]+")
LONGEST_WORD, BATCH = 40, 32
PART, NGRAM = 20, 6


def words(text: str) -> list[str]:
    """Lower-case words; a run longer than ``LONGEST_WORD`` with its marks becomes ``parts``."""
    found = text.lower().split()
    if max(map(len, found), default=0) <= LONGEST_WORD - 2:
        return found
    made = []
    for word in found:
        core = word.strip(_AROUND) if len(word) > LONGEST_WORD - 2 else ""
        if len(core) > LONGEST_WORD - 2:
            made += parts(core)
        else:
            made.append(word)
    return made


def parts(run: str) -> list[str]:
    """The words between signs in an overlong run, and all of it in pieces of ``PART`` characters.

    Pieces begin with a blank and overlap, so that every n-gram of the run is in one of them.
    """
    between = [w for w in _WITHIN.split(run) if 0 < len(w) <= LONGEST_WORD - 2]
    marked, step = f"<{run}>", PART - NGRAM + 1
    return between + [" " + marked[i : i + PART] for i in range(0, len(marked) - NGRAM + 1, step)]


def ngrams(word: str) -> list[int]:
    """Buckets of a word and of its 3 to 6 character n-grams, with its ends marked.

    Signs around the word are left off. A piece of an overlong run is taken as it is.
    """
    marked = word[1:] if word[0] == " " else f"<{word.strip(_AROUND)}>"
    found = [crc32(marked.encode()) % BUCKETS]
    for n in range(3, NGRAM + 1):
        found += [crc32(marked[i : i + n].encode()) % BUCKETS for i in range(len(marked) - n + 1)]
    return found


def _worst(values: np.ndarray) -> tuple[int, int]:
    """Begin and end of the passage with the largest mean value."""
    size = min(PASSAGE, len(values))
    sums = np.cumsum(np.append(0.0, values))
    at = int(np.argmax(sums[size:] - sums[:-size]))
    return at, at + size


class Model:
    """``embedding`` per bucket, and softmax ``weights`` and ``bias`` for clean and toxic."""

    def __init__(self, embedding: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias
        self.embedding = embedding
        # What a bucket adds to the difference of the two classes: all a score needs.
        self.lean = (embedding @ (weights[1] - weights[0])).tolist()
        self.known = Memory(self._word, 500_000)

    def _word(self, word: str) -> float:
        found = ngrams(word)
        lean = self.lean
        return sum([lean[g] for g in found]) / len(found)

    def score(self, text: str) -> float:
        values = np.fromiter(map(self.known.__getitem__, words(text)), np.float64)
        value = self.bias[1] - self.bias[0]
        if len(values):
            begin, end = _worst(values)
            value += values[begin:end].mean()
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def train(
    texts: Iterable[str],
    labels,
    epochs: int = 6,
    least_steps: int = 1000,
    least_texts: int = 3,
    rate: float = 1.0,
    seed: int = 3,
) -> Model:
    """Embeddings and softmax by AdaGrad on the worst passage of each text.

    N-grams that fewer than ``least_texts`` texts hold are not learned. Few texts are gone
    through more often, for ``least_steps`` batches in all. Without texts every score
    is 0.5.
    """
    random = np.random.default_rng(seed)
    embedding = random.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights = np.array([[-1.0], [1.0]]) * random.uniform(0.5, 1.5, DIMENSIONS)
    bias = np.zeros(2)
    seen_e, seen_w, seen_b = np.full(BUCKETS, 1e-2), np.full((2, DIMENSIONS), 1.0), np.full(2, 1.0)
    numbers, bags, rows = {}, [], []
    for text in texts:
        row = []
        for word in words(text):
            if word not in numbers:
                numbers[word] = len(bags)
                bags.append(array("i", ngrams(word)))
            row.append(numbers[word])
        rows.append(np.array(row, np.int64))
    labels = np.asarray(labels, np.int64)
    if not bags:
        return Model(embedding, np.zeros((2, DIMENSIONS)), bias)
    sizes = np.array([len(b) for b in bags])
    begins = np.cumsum(sizes) - sizes
    grams = np.frombuffer(b"".join(bags), np.int32)

    # N-grams of few texts would just tell these texts apart; they stay without a vector.
    seen_in = np.zeros(BUCKETS, np.int64)
    for row in rows:
        own = {g for w in set(row.tolist()) for g in bags[w]}
        seen_in[np.fromiter(own, np.int64, len(own))] += 1
    common = seen_in >= least_texts
    embedding[~common] = 0

    def gather(chosen):
        """N-grams of some words one after another, and where each word's begin."""
        n = sizes[chosen]
        first = np.cumsum(n) - n
        return grams[np.arange(n.sum()) - np.repeat(first - begins[chosen], n)], first

    epochs = max(epochs, -(-least_steps * BATCH // len(rows)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = [i for i in order[at : at + BATCH] if len(rows[i])]
            if not batch:
                continue
            used, places = np.unique(np.concatenate([rows[i] for i in batch]), return_inverse=True)
            found, first = gather(used)
            lean = np.add.reduceat((embedding @ (weights[1] - weights[0]))[found], first) / sizes[used]
            picked, owner, stop = [], [], 0
            for k, i in enumerate(batch):
                part = places[stop : stop + len(rows[i])]
                stop += len(rows[i])
                begin, end = _worst(lean[part])
                picked.append(used[part[begin:end]])
                owner.append(np.full(end - begin, k))
            picked, owner = np.concatenate(picked), np.concatenate(owner)
            found, first = gather(picked)
            vectors = np.add.reduceat(embedding[found], first, axis=0) / sizes[picked][:, None]
            length = np.bincount(owner)
            passage = np.stack(
                [np.bincount(owner, vectors[:, d]) for d in range(DIMENSIONS)], axis=1
            ) / length[:, None]
            logits = passage @ weights.T + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            to_passage = error @ weights
            change_w, change_b = error.T @ passage / len(batch), error.mean(0)
            to_word = to_passage[owner] / (length[owner] * sizes[picked])[:, None]
            to_gram = np.repeat(to_word, sizes[picked], axis=0)
            touched, where = np.unique(found, return_inverse=True)
            change = np.stack(
                [np.bincount(where, to_gram[:, d], len(touched)) for d in range(DIMENSIONS)], axis=1
            )
            change[~common[touched]] = 0
            seen_e[touched] += (change**2).mean(1)
            embedding[touched] -= step * change / np.sqrt(seen_e[touched])[:, None]
            seen_w += change_w**2
            weights -= step * change_w / np.sqrt(seen_w)
            seen_b += change_b**2
            bias -= step * change_b / np.sqrt(seen_b)
    return Model(embedding, weights, bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_rows: int = 4000,
    max_chars: int = 100_000,
) -> bytes:
    """A model learned in one task from a bounded sample, as bytes for ``load``; runs at once.

    Half of the sample comes from each label (see ``learning_sample``).
    """
    ship(docs.sparkSession)
    sample = learning_sample(docs, labels, label, sample_rows, max_chars, balanced=True)

    def learn(frames):
        rows = pd.concat([*frames] or [pd.DataFrame({"label": [], "text": []})])
        model = train(rows["text"].tolist(), rows["label"].to_numpy())
        yield pd.DataFrame({"model": [packed(model)]})

    found = sample.select("label", "text").mapInPandas(learn, "model binary").collect()
    return bytes(found[0]["model"]) if found else packed(train([], []))


def packed(model: Model) -> bytes:
    parts = [model.embedding.ravel(), model.weights.ravel(), model.bias]
    return np.concatenate(parts).astype(np.float32).tobytes()


@lru_cache(maxsize=2)
def load(model: bytes) -> Model:
    """The model, once per worker and so with its memory of words."""
    values = np.frombuffer(model, np.float32).astype(np.float64)
    size = BUCKETS * DIMENSIONS
    return Model(
        values[:size].reshape(BUCKETS, DIMENSIONS),
        values[size : size + 2 * DIMENSIONS].reshape(2, DIMENSIONS),
        values[size + 2 * DIMENSIONS :],
    )


def score_toxicity(
    docs: DataFrame, model: bytes, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Only the text is an input of the score. NULL counts as empty, and a text without words
    gets the score of the bias alone. Repeated rows get equal scores, a NULL id stays NULL
    and is not held out, an empty table gives no rows, and other columns are not read.
    """
    ship(docs.sparkSession)

    def score(batch):
        known = load(model)
        return {
            "doc_id": batch.column(0),
            "score": np.array([known.score(t) for t in batch.column(1).to_pylist()], np.float64),
        }

    return map_batches(identified(docs, id_col, text_col), score, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
