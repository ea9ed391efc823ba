"""Row samples, class balancing and train/test splits."""

from math import exp, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.storage import materialize


def sample_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement; an error when there are fewer.

    Rows whose random number is below a share that holds ``n`` of them all but surely are
    written, and the ``n`` smallest kept; so about ``n`` rows move in all, however many
    tasks read the table. Should fewer be below, the share grows. Runs at once.
    """
    total = df.count()
    if total < n:
        raise ValueError(f"cannot take {n} rows from {total}")
    draw = next(name for name in ("draw", "draw_", "draw__") if name not in df.columns)
    share = (n + 5 * sqrt(n) + 10) / max(1, total)
    while True:
        drawn = materialize(df.withColumn(draw, F.rand(seed)).where(F.col(draw) < share), "drawn")
        if drawn.count() >= n:
            return drawn.orderBy(draw).limit(n).drop(draw)
        share *= 2


def poisson_copies(key: list[str], mean: float, seed: int = 42) -> Column:
    """A Poisson number that follows from the MD5 digest of ``seed`` and the key's texts.

    The first 52 bits of the digest are a share of 1, looked up in the cumulated probabilities.
    Rows with the same key get the same number.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))
    share = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)
    steps = F.array(*[F.lit(x) for x in poisson_steps(mean)])
    return F.size(F.filter(steps, lambda step: step <= share))


def poisson_steps(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson number, until next to nothing is left."""
    steps, chance, total, k = [], exp(-mean), 0.0, 0
    while k <= mean + 12 * sqrt(mean) + 20:
        total += chance
        steps.append(min(total, 1.0))
        k += 1
        chance *= mean / k
    return steps


def oversample(
    df: DataFrame, label: str = "label", factor: float = 20.0, seed: int = 42, key: list[str] | None = None
):
    """Class 0 as it is, plus class 1 drawn with replacement ``factor`` times on average.

    With ``key``, the number of copies of a row follows from a digest of its key, so it is the
    same however the rows are read and whatever tasks run again.
    """
    none = df.where(F.col(label) == 0)
    if key is None:
        return none.unionByName(df.where(F.col(label) == 1).sample(True, float(factor), seed))
    # A sequence from 1 to 0 would count down.
    copies = F.array_repeat(F.lit(1), poisson_copies(key, float(factor), seed))
    ones = df.where(F.col(label) == 1).select(*df.columns, F.explode(copies).alias("copy of the row"))
    return none.unionByName(ones.select(*df.columns))


def oversample_exact(df: DataFrame, label: str = "label", factor: int = 20) -> DataFrame:
    """Class 0 once and every row of class 1 exactly ``factor`` times; other rows go."""
    copies = F.when(F.col(label) == 1, factor).when(F.col(label) == 0, 1)
    repeated = F.explode(F.sequence(F.lit(1), copies)).alias("copy")
    return df.where(F.col(label).isin(0, 1)).select("*", repeated)


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42):
    """Two disjoint random parts that together hold every row.

    The rows are written once with their random numbers, so any input will do, and no task has
    to sort its rows to find the same numbers again. Runs at once.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    draw, taken = "draw", {c.lower() for c in df.columns}
    while draw in taken:
        draw += "_"
    drawn = materialize(df.withColumn(draw, F.rand(seed)), "split")
    return drawn.where(F.col(draw) < share).drop(draw), drawn.where(F.col(draw) >= share).drop(draw)


def split_by_key(df: DataFrame, key: str = "id", buckets: int = 10, train_buckets: int = 8):
    """Two parts by the remainder of an integer key; copies of a key stay together."""
    inside = F.pmod(F.col(key), F.lit(buckets)) < train_buckets
    return df.where(inside), df.where(~inside)
