"""Helpers shared by the operators of this package."""

import contextlib
import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import usagelens

WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers; once per application.

    What travels is the code, as with ``--py-files``; data never does.
    """
    context = spark.sparkContext
    if not getattr(context, "_usagelens_shipped", False):
        package = os.path.dirname(os.path.abspath(usagelens.__file__))
        if os.path.isdir(package):
            archive = shutil.make_archive(
                os.path.join(tempfile.mkdtemp(), "usagelens"),
                "zip",
                os.path.dirname(package),
                os.path.basename(package),
            )
            context.addPyFile(archive)
        context._usagelens_shipped = True
    return spark


def text_of(column: str = "text") -> Column:
    """The text as a string; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text), so that no other column of the input can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release() -> None:
    """Give memory that a task has freed back to the system.

    Python workers stay for later tasks, beside the executor's heap, and allocators keep what was freed.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from a batch to named columns; empty batches give no rows."""

    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(make(batch), schema=types)
        release()

    return df.mapInArrow(run, schema)


# Keys with more than one in SHARE of all rows are dealt over PARTS parts of a join. There are fewer than
# SHARE of them, so they can be broadcast.
SHARE, PARTS = 1000, 64


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """``left`` joined with ``right``, which has each of ``keys`` once and the number of rows of ``left``
    with it in the column ``rows``.

    A frequent key's rows are dealt over several tasks by their values, and its row of ``right`` goes to
    all of these, so that no task gets all rows of one key. The plan is the same at every
    size. ``right`` should be a written table, as it is read several times.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    parts, part = fresh(left, "parts"), fresh(left, "part_of_key")
    hot = right.where(F.col(rows) > max(SHARE, total / SHARE)).select(*keys, F.lit(PARTS).alias(parts))
    n = F.coalesce(parts, F.lit(1))
    left = left.withColumn(part, F.pmod(F.xxhash64(*left.columns), F.lit(PARTS)).cast("int"))
    left = left.join(F.broadcast(hot), keys, "left").withColumn(part, F.when(n > 1, F.col(part)).otherwise(0))
    right = right.join(F.broadcast(hot), keys, "left").withColumn(part, F.explode(F.sequence(F.lit(0), n - 1)))
    return left.drop(parts).join(right.drop(parts), [*keys, part]).drop(part)


def byte_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each value begins in them (one more at the end)."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    size = int(starts[-1])
    raw = np.frombuffer(data, np.uint8, size) if data is not None and size else np.zeros(0, np.uint8)
    return raw[starts[0] :], starts - starts[0]


def pieces(texts: pa.Array, size: int = 1 << 18) -> Iterator[pa.Array]:
    """Parts of a column of about ``size`` bytes of text, or one longer text."""
    _, starts = byte_spans(texts)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + size, "right")) - 1)
        yield texts.slice(at, stop - at)
        at = stop
