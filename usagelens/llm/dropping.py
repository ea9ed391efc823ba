"""Rows left out by key without moving the others."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm import bitmap
from usagelens.llm.common import fresh, ship

# Keys that are broadcast as rows, of up to about 100 bytes.
FEW = 200_000


def hinted(df: DataFrame, hashed: Column, known: bitmap.Bitmap) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose 64-bit hash is surely not in a filter, and the others."""
    ship(df.sparkSession)
    name = fresh(df, "hash_of_row")
    rows, shared = df.withColumn(name, hashed), df.sparkSession.sparkContext.broadcast(known)

    def pick(wanted):
        def run(batches):
            for batch in batches:
                at = batch.schema.get_field_index(name)
                held = shared.value.holds(batch.column(at).to_numpy(zero_copy_only=False).view("uint64"))
                yield batch.remove_column(at).filter(pa.array(held == wanted))

        return rows.mapInArrow(run, df.schema)

    return pick(False), pick(True)


def hint_of(keys: DataFrame, most_bits: int = bitmap.MOST_BITS) -> bitmap.Bitmap:
    """The filter of the hashes of all columns of ``keys``."""
    return bitmap.build(keys.select(F.xxhash64(*keys.columns).alias("token")), most_bits, 32)


def among(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the one column of ``keys``, a written table, and maybe some others.

    Up to ``FEW`` keys are broadcast to a join; of more, a filter of bounded size lets some rows
    too many through. Rows do not move either way.
    """
    (column,) = keys.columns
    if keys.count() <= FEW:
        name = fresh(df, f"wanted_{column}")
        return df.join(F.broadcast(keys.select(F.col(column).alias(name))), key == F.col(name), "left_semi")
    return hinted(df, F.xxhash64(key), hint_of(keys))[1]


def without(docs: DataFrame, key: dict[str, Column], lost: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``lost``, a written table; NULL is a value like any other.

    ``key`` gives the columns of ``lost`` as expressions on ``docs``. Up to ``FEW`` lost keys are broadcast.
    Of more, rows that a filter of bounded size tells to be kept stay where they are, and
    only the others move to meet ``lost``.
    """
    named = {name: fresh(docs, f"lost_{name}") for name in key}
    gone = lost.select(*[F.col(name).alias(new) for name, new in named.items()])
    same = F.lit(True)
    for name, value in key.items():
        same = same & value.eqNullSafe(F.col(named[name]))
    if lost.count() <= FEW:
        return docs.join(F.broadcast(gone), same, "left_anti")
    others, perhaps = hinted(docs, F.xxhash64(*key.values()), hint_of(lost.select(*key)))
    return others.unionByName(perhaps.join(gone, same, "left_anti"))
