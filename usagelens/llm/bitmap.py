"""A Bloom filter of 64-bit tokens, built by Spark and looked up in tasks."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits per token, and bits of the largest filter: 8 MB.
PER_TOKEN, MOST_BITS = 256, 1 << 26
SEGMENT = 1 << 15


class Bitmap:
    """Holds every token it was built from, and now and then another one."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.mask = np.uint64(len(packed) * 8 - 1)

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return self.packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1

    def holds(self, tokens: np.ndarray) -> np.ndarray:
        """For an array of uint64: False where the token is certainly not in it."""
        found = self._bit(tokens & self.mask).astype(bool)
        at = np.flatnonzero(found)
        found[at] = self._bit((tokens[at] >> np.uint64(37)) & self.mask).astype(bool)
        return found


def build(tokens: DataFrame, most_bits: int = MOST_BITS, per_token: int = PER_TOKEN) -> Bitmap:
    """The filter of the column ``token`` of hashed longs.

    It has ``per_token`` bits per token, or ``most_bits`` in all; the fuller it is, the more other
    tokens pass. The driver gets its filled segments, at most 8 MB by default.
    """
    tokens = tokens.select("token")
    bits = SEGMENT
    wanted = min(per_token * tokens.count(), most_bits)
    while bits < wanted:
        bits *= 2
    token, mask = F.col("token"), F.lit(bits - 1)
    place = F.explode(F.array(token.bitwiseAND(mask), F.shiftrightunsigned(token, 37).bitwiseAND(mask)))
    segments = (
        tokens.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / SEGMENT).alias("segment"))
        .agg(F.bitmap_construct_agg(F.col("place") % SEGMENT).alias("bits"))
        .collect()
    )
    packed = np.zeros((bits // SEGMENT, SEGMENT // 8), np.uint8)
    for row in segments:
        packed[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return Bitmap(packed.ravel())
