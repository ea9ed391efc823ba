"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

Words are runs of letters, of digits or of other signs. Features are sequences of up to three
words, and of up to three word shapes: letters by their case, digits, signs as they are,
each marked where it repeats the word before. A document's value of a feature is its share among all
features of the document, so that long and short texts are alike, and its score is a
sparse dot product with the learned weights.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import byte_spans, identified, map_batches, pieces, release, ship
from usagelens.llm.hashing import byte_codes, chained, mixed, token_hashes
from usagelens.llm.learning import held_out, learning_sample

BITS = 19
SCALE = 20.0  # of the shares, so that weights stay near 1
CHUNK = 100  # texts whose features are held at once when learning

_LETTER, _DIGIT, _SIGN = 1, 2, 3


def _classes() -> np.ndarray:
    found = np.full(256, _SIGN, np.uint8)
    found[[9, 10, 11, 12, 13, 32]] = 0
    found[ord("0") : ord("9") + 1] = _DIGIT
    found[ord("A") : ord("Z") + 1] = found[ord("a") : ord("z") + 1] = found[128:] = _LETTER
    return found


CLASSES, CODES = _classes(), byte_codes(8)
IS_UPPER = np.zeros(256, bool)
IS_UPPER[ord("A") : ord("Z") + 1] = True


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the features of all texts, and for each which text it belongs to."""
    raw, starts = byte_spans(texts)
    begin, end, word = token_hashes(raw, starts, CLASSES, CODES)
    owner = np.searchsorted(starts, begin, "right") - 1
    kind = CLASSES[raw[begin]]
    uppers = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(IS_UPPER[raw], out=uppers[1:])
    upper = uppers[end] - uppers[begin]
    case = np.select([upper == 0, upper == end - begin, upper == 1], [0, 1, 2], 3)
    shape = np.where(kind == _SIGN, word, (kind * 8 + case).astype(np.uint64))
    linked = np.zeros(len(word), bool)
    linked[1:] = owner[1:] == owner[:-1]
    again = linked.copy()
    again[1:] &= word[1:] == word[:-1]
    shape = mixed(shape + again.astype(np.uint64) * np.uint64(64))
    i = np.flatnonzero(linked)
    j = i[linked[i - 1]]
    made = []
    for item in (word, shape):
        made += [item, chained(item[i - 1], item[i]), chained(item[j - 2], item[j - 1], item[j])]
    numbers = np.concatenate(made) >> np.uint64(64 - BITS)
    return numbers.astype(np.int64), np.concatenate([owner, owner[i], owner[j]] * 2)


def train(
    texts: list[str],
    labels: np.ndarray,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.5,
) -> np.ndarray:
    """Weights, the bias last, by follow-the-regularised-leader updates, one text at a time.

    Without texts all weights are 0, and every score 0.5.
    """
    bias = 1 << BITS
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    for _ in range(epochs):
        # Features are made anew each time, as those of all texts would need several times their room.
        for at in range(0, len(texts), CHUNK):
            _learn(z, n, texts[at : at + CHUNK], labels[at : at + CHUNK], alpha, beta, l1, l2)
    return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)


def _learn(z, n, texts, labels, alpha, beta, l1, l2) -> None:
    bias = len(z) - 1
    numbers, owners = features(pa.array(texts, pa.large_string()))
    numbers = numbers[np.argsort(owners, kind="stable")]
    starts = np.r_[0, np.cumsum(np.bincount(owners, minlength=len(texts)))]
    for a, b, label in zip(starts[:-1], starts[1:], labels):
        found, counts = np.unique(numbers[a:b], return_counts=True)
        at, x = np.append(found, bias), np.append(counts * (SCALE / max(1, b - a)), 1.0)
        zi, ni = z[at], n[at]
        rate = (beta + np.sqrt(ni)) / alpha + l2
        wi = np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / rate, 0.0)
        gradient = (1 / (1 + np.exp(-np.clip(wi @ x, -30, 30))) - label) * x
        grown = ni + gradient * gradient
        z[at] = zi + gradient - (np.sqrt(grown) - np.sqrt(ni)) / alpha * wi
        n[at] = grown


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Per text the share-weighted sum of its features' weights, as a probability."""
    numbers, owners = features(texts)
    total = np.bincount(owners, weights[numbers], len(texts))
    value = weights[-1] + SCALE * total / np.maximum(1, np.bincount(owners, minlength=len(texts)))
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = 5000,
    max_chars: int = 100_000,
) -> np.ndarray:
    """Weights learned in one task from a bounded sample (see ``learning_sample``); runs at once."""
    ship(docs.sparkSession)
    sample = learning_sample(docs, labels, label, sample_rows, max_chars)

    def learn(frames):
        rows = pd.concat([*frames] or [pd.DataFrame({"label": [], "text": []})])
        weights = train(rows["text"].tolist(), rows["label"].to_numpy(np.float64))
        yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()]})
        release()

    found = sample.select("label", "text").mapInPandas(learn, "weights binary").collect()
    if not found:
        return train([], np.zeros(0)).astype(np.float32)
    return np.frombuffer(found[0]["weights"], np.float32)


def _scored(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    return np.concatenate([scores(part, weights) for part in pieces(texts)])


def score_quality(
    docs: DataFrame, weights: np.ndarray, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Only the text is an input of the score. NULL counts as empty, and an empty text gets
    the score of the bias alone. Repeated rows get equal scores, a NULL id stays NULL and is
    not held out, an empty table gives no rows, and other columns are not read.
    """
    ship(docs.sparkSession)

    def score(batch):
        return {"doc_id": batch.column(0), "score": _scored(batch.column(1), weights)}

    return map_batches(identified(docs, id_col, text_col), score, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, weights: np.ndarray, threshold: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns.

    A NULL text is judged like an empty one, by the bias alone, and stays NULL; repeated rows stay or go
    together; an empty table gives no rows, and columns may have any names.
    """
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            texts = batch.column(at)
            if not pa.types.is_string(texts.type) and not pa.types.is_large_string(texts.type):
                texts = texts.cast(pa.string())
            first = 0
            for part in pieces(texts.fill_null("")):
                good = scores(part, weights) >= threshold
                yield batch.slice(first, len(part)).filter(pa.array(good))
                first += len(part)
        release()

    return docs.mapInArrow(keep, docs.schema)
