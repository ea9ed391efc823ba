"""Exact order statistics by counting bit prefixes, without sorting values.

The bits of a double, read as a whole number, are in the order of the doubles. Counting how many
values begin with each 16-bit prefix tells which prefix the wanted value has; only values with
that prefix are counted by their next 16 bits, and so on. Counts are map-side sums of at
most 65,536 rows per column and prefix, so neither values nor rows are sorted or moved.
"""

import struct
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.storage import materialize

BITS = (48, 32, 16, 0)
# Values left with the wanted prefixes at which all their bits are counted at once.
FEW = 100_000


def _power_of_two(exponent: Column) -> Column:
    """2 to a whole number, which Java computes exactly."""
    return F.pow(F.lit(2.0), exponent)


def with_bits(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``name``: the bits of a double as a long in the order of the doubles.

    Negative numbers count down from 0, which both zeros get; NaN comes last.
    """
    x, a = F.col(column), F.abs(F.col(column))
    # The logarithm can miss the exponent by one; the scaled number then is not in [1, 2).
    guess = df.withColumn("guess of exponent", F.floor(F.log2(a)).cast("double"))
    scaled = guess.withColumn("scaled", a * _power_of_two(-F.col("guess of exponent")))
    low, high = F.col("scaled") < 1, F.col("scaled") >= 2
    exponent = F.col("guess of exponent") + F.when(high, 1).when(low, -1).otherwise(0)
    fraction = F.when(high, F.col("scaled") / 2).when(low, F.col("scaled") * 2).otherwise(F.col("scaled")) - 1
    normal = ((exponent + 1023) * float(1 << 52)).cast("long") + (fraction * float(1 << 52)).cast("long")
    step = float(2**537)
    bits = (
        F.when(a == 0, F.lit(0).cast("long"))
        .when(a == float("inf"), F.lit(2047 << 52))
        .when(a < 2.0**-1022, (a * step * step).cast("long"))
        .otherwise(normal)
    )
    signed = F.when(F.isnan(column), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)
    return scaled.select(*df.columns, signed.alias(name))


def from_bits(bits: int) -> float:
    """The double that ``with_bits`` made this number from."""
    if bits == (1 << 63) - 1:
        return float("nan")
    value = struct.unpack(">d", abs(bits).to_bytes(8, "big"))[0]
    return -value if bits < 0 else value


def values_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place, x, bits): every value of ``columns`` but NULL, written once."""
    values = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("place", "x"))
    return materialize(with_bits(values.where("x is not null"), "x", "bits"), "values")


def at_ranks(values: DataFrame, ranks: dict[int, list[int]]) -> dict[tuple[int, int], float]:
    """Per (place, rank) the value with that 0-based rank among those of ``place``.

    ``values`` is a frame of ``values_of``. The driver gets one row per rank and round.
    """
    spark = values.sparkSession
    # Per wanted value the bits known so far and its rank among the values that begin with them.
    known = {(p, r): (0, r) for p, own in ranks.items() for r in own}
    left, before = values.select("place", "bits", F.lit(0).cast("long").alias("prefix")), None
    rounds = list(BITS)
    while known and rounds:
        shift = rounds.pop(0)
        if before is not None:
            chosen = sorted({(p, prefix) for (p, _), (prefix, _) in known.items()})
            chosen = spark.createDataFrame(chosen, "place int, prefix long")
            own = values.select("place", "bits", F.shiftright("bits", before).alias("prefix"))
            left = own.join(F.broadcast(chosen), ["place", "prefix"])
        counts = left.groupBy("place", "prefix", F.shiftright("bits", shift).alias("next")).agg(
            F.count(F.lit(1)).alias("n")
        )
        # At most 65,536 rows of counts per prefix, or few in all.
        so_far = Window.partitionBy("place", "prefix").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("smaller", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        wanted = [(p, r, prefix, rest) for (p, r), (prefix, rest) in known.items()]
        wanted = spark.createDataFrame(wanted, "place int, rank long, prefix long, rest long")
        here = (F.col("smaller") <= F.col("rest")) & (F.col("rest") < F.col("smaller") + F.col("n"))
        found = placed.join(F.broadcast(wanted), ["place", "prefix"]).where(here).collect()
        known = {(r["place"], r["rank"]): (r["next"], r["rest"] - r["smaller"]) for r in found}
        if sum({(r["place"], r["next"]): r["n"] for r in found}.values()) <= FEW:
            rounds = rounds[-1:]
        before = shift
    return {key: from_bits(bits) for key, (bits, _) in known.items()}


def quantiles_of(values: DataFrame, sizes: dict[int, int], shares: dict[str, float]) -> list[tuple]:
    """(place, quantile, ...) for every place with values: exact, with linear interpolation.

    ``sizes`` has the number of values per place.
    """
    points = {(p, name): (n - 1) * share for p, n in sizes.items() if n for name, share in shares.items()}
    ranks: dict[int, list[int]] = {}
    for (p, _), point in points.items():
        ranks[p] = sorted({*ranks.get(p, []), floor(point), ceil(point)})
    found = at_ranks(values, ranks)
    made = []
    for p in sorted(ranks):
        row = [p]
        for name in shares:
            point = points[p, name]
            low, high = found[p, floor(point)], found[p, ceil(point)]
            # Two infinite neighbours have no difference.
            row.append(low if low == high else low + (high - low) * (point - floor(point)))
        made.append(tuple(row))
    return made
