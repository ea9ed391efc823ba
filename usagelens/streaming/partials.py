"""Additive sums per batch of a stream, put together when they are needed.

A batch adds up only its own rows and writes one folder, ``batch=<id>``; run again after a failure
it writes the same folder anew. What is known of a key is the merge of the rows of all batches,
so records of earlier batches are never read again. The folders lie below the checkpoint
of the stream, whose batch numbers they carry.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Folders beyond which those of finished batches are merged into one.
MOST_FOLDERS = 64


class Partials:
    """Rows of ``keys`` and mergeable values, one folder per batch.

    ``merges`` names the values and the aggregate that merges each, such as a sum or a minimum.
    ``day`` is the key that batches are looked up by.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: list[str],
        merges: dict[str, Column],
        day: str,
        most_folders: int = MOST_FOLDERS,
    ):
        self.spark, self.folder, self.keys, self.day = spark, folder.rstrip("/"), keys, day
        self.merges = [value.alias(name) for name, value in merges.items()]
        self.most_folders = most_folders

    def put(self, partial: DataFrame, batch_id: int) -> DataFrame:
        """Write the sums of one batch, in place of what an earlier try of it left."""
        path = f"{self.folder}/batch={batch_id}"
        # Sorted by day, so that later reads skip what lies outside their range of days.
        partial.sortWithinPartitions(self.day).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(partial.schema).parquet(path)

    def of_same_days(self, written: DataFrame) -> DataFrame:
        """All that is known of the days that occur in the sums of a batch."""
        days = written.select(F.col(self.day).alias("touched_day")).distinct()
        ends = days.agg(F.min("touched_day").alias("low"), F.max("touched_day").alias("high"), F.count(F.lit(1)).alias("n"))
        low, high, n = ends.first()
        known = self._read(written.schema)
        if n == 0:
            return self._merged(known.limit(0))
        # A plain range, which reaches the scan; a missing day has no place in it.
        inside = F.col(self.day).isNull()
        if low is not None:
            inside = inside | F.col(self.day).between(F.lit(low), F.lit(high))
        same = F.col(self.day).eqNullSafe(F.col("touched_day"))
        return self._merged(known.where(inside).join(days, same, "left_semi"))

    def merged(self, schema: T.StructType) -> DataFrame:
        """All that is known."""
        return self._merged(self._read(schema))

    def compact(self, batch_id: int, schema: T.StructType) -> None:
        """Merge the folders of batches before ``batch_id``, if there are many.

        Only the latest batch of a stream can run again, so earlier ones are final. The merged folder
        counts once it is complete; what it stands for is removed then.
        """
        upto, batches = self._folders()
        final = [b for b in batches if b < batch_id]
        if len(final) < self.most_folders:
            return
        paths = [f"{self.folder}/batch={b}" for b in final]
        paths += [f"{self.folder}/upto={upto}"] if upto is not None else []
        rows = self._merged(self.spark.read.schema(schema).parquet(*paths))
        target = f"{self.folder}/upto={max(final)}"
        rows.sortWithinPartitions(self.day).write.mode("overwrite").parquet(target)
        for path in paths:
            found, system = self._path(path)
            system.delete(found, True)

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*self.merges)

    def _read(self, schema: T.StructType) -> DataFrame:
        upto, batches = self._folders()
        paths = [f"{self.folder}/batch={b}" for b in batches]
        paths += [f"{self.folder}/upto={upto}"] if upto is not None else []
        return self.spark.read.schema(schema).parquet(*paths)

    def _path(self, path: str):
        context = self.spark.sparkContext
        found = context._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(context._jsc.hadoopConfiguration())

    def _folders(self) -> tuple[int | None, list[int]]:
        """The last batch of the complete merged folder, if any, and the batches after it."""
        root, system = self._path(self.folder)
        names = [s.getPath().getName() for s in system.listStatus(root)] if system.exists(root) else []
        numbers = {kind: [int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=")] for kind in ("batch", "upto")}
        complete = [
            n for n in numbers["upto"] if system.exists(self._path(f"{self.folder}/upto={n}/_SUCCESS")[0])
        ]
        upto = max(complete, default=None)
        return upto, sorted(n for n in numbers["batch"] if upto is None or n > upto)
