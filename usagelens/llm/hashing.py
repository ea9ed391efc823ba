"""Hashes of the words of many texts at once, as numpy arrays."""

from functools import lru_cache

import numpy as np

WINDOW = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_codes(seed: int, same: dict[int, int] | None = None) -> np.ndarray:
    """A number per byte value; ``same`` maps byte values to those they count as."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * _FACTOR + np.uint64(seed))
    for byte, other in (same or {}).items():
        codes[byte] = codes[other]
    return codes


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _FACTOR), np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def token_hashes(
    raw: np.ndarray, starts: np.ndarray, classes: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and 64-bit hash of every token of texts that lie in ``raw`` one after another.

    A token is a longest run of bytes of one class within a text; class 0 separates
    tokens and is none itself. ``starts`` has where each text begins, and the end. Work goes
    in windows that end at a separator, so that the arrays stay small beside the texts.
    """
    begins, ends, hashes = [], [], []
    size, at = len(raw), 0
    while at < size:
        stop = min(size, at + WINDOW)
        while stop < size and classes[raw[stop - 1]]:
            ahead = np.flatnonzero(classes[raw[stop : stop + WINDOW]] == 0)
            stop = stop + int(ahead[0]) + 1 if len(ahead) else min(size, stop + WINDOW)
        part = raw[at:stop]
        kinds = classes[part]
        new = np.empty(len(part), bool)
        new[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=new[1:])
        inside = starts[np.searchsorted(starts, at) : np.searchsorted(starts, stop)]
        new[inside - at] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(part))
        words = kinds[begin] > 0
        begin, end = begin[words], end[words]
        up, down = _powers(max(WINDOW, 1 << (len(part) - 1).bit_length()))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(codes[part] * up[: len(part)], out=sums[1:])
        found = (sums[end] - sums[begin]) * down[begin]
        begins.append(begin + at)
        ends.append(end + at)
        hashes.append(mixed(found + (end - begin).astype(np.uint64)))
        at = stop
    if not begins:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(begins), np.concatenate(ends), np.concatenate(hashes)


def chained(*parts: np.ndarray) -> np.ndarray:
    """One hash for hashes that follow each other; the order counts."""
    made = parts[0]
    for part in parts[1:]:
        made = mixed(made * _FACTOR + part)
    return made
