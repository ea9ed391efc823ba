"""Labelled samples to learn from, and which rows labels may be learned from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import identified


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 1 when divided by 3.

    A NULL id is not held out, as it has no label either.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    sample_rows: int,
    max_chars: int,
    balanced: bool = False,
    id_col: str = "doc_id",
) -> DataFrame:
    """(label, text) of about ``sample_rows`` labelled rows, in one partition.

    The sample is drawn by hashes of ids among the labelled rows that are not held out,
    half of it from each label when ``balanced``. Its size is bounded by ``sample_rows``
    (plus chance) and ``max_chars``, the longest text to learn from. Labels other than 0
    and 1, NULL ids, and ids with contradicting labels are left out. Of rows repeated under
    one id, one is learned from, chosen by a hash of its text. Runs one count of the labels.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("labelled_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("labelled_id").isNotNull() & F.col("label").isin(0, 1))
        .where(~held_out(F.col("labelled_id")))
        .groupBy("labelled_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 30)) / float(1 << 30)
    total = max(1, sum(sizes.values()))
    shares = {k: (sample_rows / 2 / n if balanced else sample_rows / total) for k, n in sizes.items()}
    share = F.when(F.col("label") == 0, shares.get(0, 0.0)).otherwise(shares.get(1, 0.0))
    # About ``sample_rows`` rows of two numbers, whatever the tables' sizes.
    chosen = F.broadcast(known.where(draw < share))
    rows = identified(docs, id_col).where(F.length("text") <= max_chars)
    found = rows.join(chosen, F.col("doc_id") == F.col("labelled_id"))
    return (
        found.groupBy("doc_id")
        # Partial sums leave one row of an id in a task, however many there are.
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label")).alias("row"))
        .select("row.label", "row.text", F.xxhash64("doc_id").alias("at"))
        .repartition(1)
        .sortWithinPartitions("at", "text", "label")
    )
