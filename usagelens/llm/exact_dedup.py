"""Exact deduplication by 128-bit content hashes, checked byte by byte."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import fresh, identified, text_of
from usagelens.llm.dropping import among, without
from usagelens.storage import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Groups above one in SHARE of all rows are dealt over PARTS parts when texts are
# compared. There are fewer than SHARE such groups, so their keys can be broadcast.
SHARE, PARTS = 1000, 64


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def exact_duplicates(
    docs: DataFrame,
    keep: str = "smallest",
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=lower_ascii,
    hashed=content_hash,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Rows are equal when their normalised texts have equal bytes; NULL counts as empty. Of
    equal rows the one with the ``smallest`` or ``largest`` id is kept. A NULL id is
    kept only in a group without any other id, and of rows repeated with the same id
    and text exactly one is kept. An empty table gives no rows; other columns are not read.

    Rows are grouped by ``hashed``, 128 bits by default, on narrow rows and with partial
    sums. Texts of groups with copies are then compared: their smallest and largest text
    must be equal, which needs one text per task and group, not all of them in one
    place. Groups that hold different texts are grouped by the text itself. Runs at once.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    rows = identified(docs, id_col, text_col).select(
        "doc_id", normalise(F.col("text")).alias("text")
    )
    hashes = materialize(
        rows.select(
            "doc_id",
            hashed(F.col("text")).alias("key"),
            F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "hashes",
    )
    groups = materialize(_groups(hashes, ["key"], keep), "groups")
    keyed = rows.select("doc_id", hashed(F.col("text")).alias("key"), "text")
    mixed = materialize(_mixed(keyed, groups, hashes.count()), "mixed")
    if mixed.isEmpty():
        return _decisions(hashes, groups, ["key"])
    # Different texts under one hash are grouped by the texts themselves.
    texts = materialize(
        keyed.join(mixed, "key", "left_semi").select(
            "doc_id",
            "key",
            "text",
            F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mixed-texts",
    )
    apart = _decisions(texts, _groups(texts, ["key", "text"], keep), ["key", "text"])
    return _decisions(hashes.join(mixed, "key", "left_anti"), groups, ["key"]).unionByName(apart)


def _groups(rows: DataFrame, by: list[str], keep: str) -> DataFrame:
    """Per group its size, and which row of it is kept."""
    ids = F.col("doc_id") if keep == "largest" else -F.col("doc_id")
    return (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct(ids.alias("id"), "row")).alias("best"))
        .select(
            *by,
            "group_size",
            (F.col("best.id") if keep == "largest" else -F.col("best.id")).alias("keep_id"),
            F.col("best.row").alias("keep_row"),
        )
    )


def _mixed(keyed: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Keys of groups whose rows do not all have the same text.

    Most texts without copies stay where they are.
    """
    copied = materialize(groups.where("group_size > 1").select("key", "group_size"), "copied")
    keyed = among(keyed, F.col("key"), copied.select("key"))
    hot = copied.where(F.col("group_size") > max(SHARE, total / SHARE)).select(
        "key", F.lit(PARTS).alias("parts")
    )

    def dealt(rows, part):
        found = rows.join(F.broadcast(hot), "key", "left")
        return found.withColumn("part", part(F.coalesce("parts", F.lit(1)))).drop("parts")

    compared = dealt(keyed, lambda n: F.pmod(F.xxhash64("doc_id"), n))
    own = dealt(copied, lambda n: F.explode(F.sequence(F.lit(0), n - 1)))
    own = own.select("key", F.col("part").cast("long").alias("part"))
    texts = (
        compared.join(own, ["key", "part"], "left_semi")
        .groupBy("key", "part")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .groupBy("key")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    return texts.where("low != high").select("key")


def _decisions(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    found = rows.join(groups, by)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(
    docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    A decision reaches its row by id and text; of rows repeated with both, one stays. NULL counts as
    empty and stays NULL; an empty table gives no rows, and other columns come along
    whatever their names. Only rows that may go are moved.
    """
    found = exact_duplicates(docs, keep, id_col, text_col)
    lost = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("again"), F.min("kept").alias("whole"))
    lost = materialize(lost.where("not whole").drop("whole"), "lost")
    digest = F.sha2(F.encode(lower_ascii(text_of(text_col)), "UTF-8"), 256)
    key = {"doc_id": F.col(id_col).cast("long"), "text_sha256": digest}
    left = without(docs, key, lost)
    again = lost.where("again").select("doc_id", "text_sha256")
    if again.isEmpty():
        return left
    # Rows repeated with one id and text, of which one is kept.
    own, name = fresh(docs, "own"), fresh(docs, "key")
    again = materialize(again.select(F.col("doc_id").alias(own), F.col("text_sha256").alias(name)), "again")
    perhaps = among(docs, digest, again.select(name).distinct())
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own)) & (digest == F.col(name))
    return left.unionByName(perhaps.join(again, same).dropDuplicates([id_col, name]).select(*docs.columns))
