"""CSV loading, plain or gzipped."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader takes as missing.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def load_csv_untyped(
    spark: SparkSession,
    path: str,
    add_id: bool = True,
    partitions: int | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """Header CSV with every column as text, missing texts as NULL, and a surrogate ``id``.

    Quotes inside quoted values are doubled. The id is unique but has gaps. Gzip files
    cannot be split, so a few big ones bind all rows to a few tasks; ``partitions`` spreads
    the rows after the read. With ``line_breaks`` quoted values may hold line breaks; as
    plain files cannot be split then either, it is off by default.
    """
    raw = _reader(spark, line_breaks).csv(path)
    if partitions:
        raw = raw.repartition(partitions)
    columns = [
        F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in raw.columns
    ]
    if add_id:
        if "id" in [c.lower() for c in raw.columns]:
            raise ValueError("the file has an id column already; pass add_id=False")
        columns.insert(0, F.monotonically_increasing_id().alias("id"))
    return raw.select(*columns)


def _reader(spark: SparkSession, line_breaks: bool):
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
    )


def load_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False
) -> DataFrame:
    """Header CSV read with a fixed schema.

    Fields that do not parse become NULL and the whole line is kept in
    ``_corrupt_record``. Quotes and line breaks are read as by ``load_csv_untyped``.
    """
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        _reader(spark, line_breaks)
        .schema(with_bad)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
