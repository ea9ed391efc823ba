"""Product codes of vectors, by Lloyd rounds that compare only what moved.

Vectors of whole numbers are cut into equal parts, and each part position has a codebook. A round
assigns every part to its nearest entry and moves each entry to the mean of its parts. In the next
round, a part whose entry did not move keeps its stored exact distance and is compared with moved
entries alone, as no other can have come nearer; a part whose entry moved is compared with all.

A round is one pass over the rows: each task writes its rows with their codes and distances,
and its partial sums per entry beside them. Only the sums meet, one row per task and entry;
the driver holds the codebooks, whose size does not depend on the number of vectors.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship
from usagelens.llm.vectors import EXACT, MOST, big, by_length, largest, lists, nearest, scaled, usable
from usagelens.operators.features import BROADCAST_ROWS, attach_stats
from usagelens.storage import materialize

_STATE = "vec_id long, label_key string, v array<double>, code array<int>, distance array<long>"
_SUMS = "part int, entry int, n long, sums array<long>, more array<string>"
_TYPES = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("label_key", pa.string()),
        ("v", pa.list_(pa.float64())),
        ("code", pa.list_(pa.int32())),
        ("distance", pa.list_(pa.int64())),
        ("part", pa.int32()),
        ("entry", pa.int32()),
        ("n", pa.int64()),
        ("sums", pa.list_(pa.int64())),
        ("more", pa.list_(pa.string())),
    ]
)
STATE = ["vec_id", "label_key", "v", "code", "distance"]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label_key, v) of the usable vectors, with floor(scale * x) for every component."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label_key"), x.alias("v")
    ).where(usable(F.col("v")))

    def floor(batches):
        for batch in batches:
            values = batch.column(2)
            made = scaled(values.flatten().to_numpy(zero_copy_only=False), scale)
            offsets = np.concatenate([[0], np.cumsum(np.asarray(values.value_lengths()))]).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), whole], ["vec_id", "label_key", "v"])

    return rows.mapInArrow(floor, "vec_id long, label_key string, v array<double>")


def assign(
    points: np.ndarray, code: np.ndarray, distance: np.ndarray, entries: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """New codes and distances of parts, and how many distances were computed.

    ``code`` and ``distance`` are those of the last round, -1 where there are none. ``moved``
    says which entries differ from those that the last round compared with.
    """
    kept = (distance >= 0) & (code >= 0)
    kept[kept] = ~moved[code[kept]]
    new_code, new_distance = code.astype(np.int64), distance.astype(np.int64)
    compared = 0
    if not kept.all():
        rows = np.flatnonzero(~kept)
        new_code[rows], found = nearest(points[rows], entries)
        new_distance[rows] = _stored(found)
        compared += len(rows) * len(entries)
    active = np.flatnonzero(moved)
    if kept.any() and len(active):
        rows = np.flatnonzero(kept)
        at, found = nearest(points[rows], entries[active])
        other, own = active[at], distance[rows]
        nearer = np.array((found < own) | ((found == own) & (other < code[rows])), bool)
        new_code[rows[nearer]], new_distance[rows[nearer]] = other[nearer], _stored(found[nearer])
        compared += len(rows) * len(active)
    return new_code, new_distance, compared


def _stored(distances: np.ndarray) -> np.ndarray:
    """Distances as longs, -1 for those beyond."""
    if distances.dtype != object:
        return distances.astype(np.int64)
    return np.array([int(d) if d <= MOST else -1 for d in distances], np.int64)


class Sums:
    """Partial sums of the parts of each entry, exact at every size."""

    def __init__(self, parts: int, entries: int, width: int):
        self.n = np.zeros((parts, entries), np.int64)
        self.sums = np.zeros((parts, entries, width), np.int64)
        self.more: dict[tuple[int, int], list[int]] = {}

    def add(self, part: int, code: np.ndarray, points: np.ndarray) -> None:
        self.n[part] += np.bincount(code, minlength=self.n.shape[1])
        wide = np.abs(points).max(axis=1) >= 1 << 24
        for row in np.flatnonzero(wide):
            held = self.more.setdefault((part, int(code[row])), [0] * points.shape[1])
            for i, x in enumerate(points[row].tolist()):
                held[i] += int(x)
        plain = ~wide
        order = np.argsort(code[plain], kind="stable")
        sorted_code, sorted_points = code[plain][order], points[plain][order].astype(np.int64)
        if len(order):
            own, first = np.unique(sorted_code, return_index=True)
            self.sums[part, own] += np.add.reduceat(sorted_points, first, axis=0)

    def rows(self) -> dict:
        made = {"part": [], "entry": [], "n": [], "sums": [], "more": []}
        for part, entry in zip(*np.nonzero(self.n)):
            more = self.more.get((int(part), int(entry)))
            made["part"].append(int(part))
            made["entry"].append(int(entry))
            made["n"].append(int(self.n[part, entry]))
            made["sums"].append(self.sums[part, entry].tolist())
            made["more"].append(None if more is None else [str(x) for x in more])
        return made


def one_round(state: DataFrame, books: list[np.ndarray], moved: list[np.ndarray]) -> DataFrame:
    """The rows with new codes and distances, and every task's partial sums as further rows.

    Rows of another length than the codebooks' have no code. A distance that a long cannot hold
    is -1, and its part is compared with all entries again.
    """
    shared = state.sparkSession.sparkContext.broadcast((books, moved))
    parts, width = len(books), books[0].shape[1]

    def run(batches):
        books, moved = shared.value
        sums = Sums(parts, len(books[0]), width)
        for batch in batches:
            code = np.full((batch.num_rows, parts), -1, np.int32)
            distance = np.full((batch.num_rows, parts), -1, np.int64)
            for rows, matrix in by_length(batch.column(2)):
                if matrix.shape[1] != parts * width:
                    continue
                if batch.column(3).null_count == 0:
                    old_code = np.stack(batch.column(3).take(pa.array(rows)).to_numpy(zero_copy_only=False))
                    old_distance = np.stack(batch.column(4).take(pa.array(rows)).to_numpy(zero_copy_only=False))
                else:
                    old_code, old_distance = code[rows], distance[rows]
                for p in range(parts):
                    points = np.ascontiguousarray(matrix[:, p * width : (p + 1) * width])
                    new, far, _ = assign(points, old_code[:, p], old_distance[:, p], books[p], moved[p])
                    sums.add(p, new, points)
                    code[rows, p], distance[rows, p] = new, far
            empty = {n: pa.nulls(batch.num_rows, _TYPES.field(n).type) for n in _TYPES.names[5:]}
            made = {"code": lists(code), "distance": lists(distance), **empty}
            for name in STATE[:3]:
                made[name] = batch.column(batch.schema.get_field_index(name))
            yield pa.RecordBatch.from_pydict(made, schema=_TYPES)
        own = sums.rows()
        empty = {n: pa.nulls(len(own["n"]), _TYPES.field(n).type) for n in STATE}
        yield pa.RecordBatch.from_pydict({**empty, **own}, schema=_TYPES)

    return state.select(*STATE).mapInArrow(run, f"{_STATE}, {_SUMS}")


def totals(written: DataFrame) -> list[tuple[int, int, int, list[int]]]:
    """(part, entry, rows, sum of each component) from the tasks' partial sums."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(rows["sums"].iloc[0]), object)
        for sums, more in zip(rows["sums"], rows["more"]):
            total = total + np.array([int(x) for x in sums], object)
            if more is not None:
                total = total + np.array([int(x) for x in more], object)
        first = rows.iloc[0]
        row = (first["part"], first["entry"], rows["n"].sum(), [str(x) for x in total])
        return pd.DataFrame([row], columns=["part", "entry", "n", "total"])

    sums = written.where("entry is not null").select("part", "entry", "n", "sums", "more")
    added = sums.groupBy("part", "entry").applyInPandas(add, "part int, entry int, n long, total array<string>")
    return [(r["part"], r["entry"], r["n"], [int(x) for x in r["total"]]) for r in added.collect()]


def moved_books(books: list[np.ndarray], sums: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The codebooks with each entry at the floor of its parts' mean, and which entries changed."""
    new = [big(b) for b in books]
    for part, entry, n, total in sums:
        new[part][entry] = [x // n for x in total]
    moved = [np.array((a != big(b)).any(axis=1), bool) for a, b in zip(new, books)]
    return [b.astype(np.float64) if largest(b) < EXACT else b for b in new], moved


def compress(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label_key, code, distance) for every usable vector, and the codebooks, one per part.

    Codebooks start as the parts of the vectors with the ``entries`` smallest ids, fewer if there
    are fewer; equal ids are ordered by the vectors, rows without an id come last. After ``rounds``
    rounds parts are assigned once more. Entries without parts stay. ``code`` has an index for
    each part and ``distance`` its squared distance, -1 where a long cannot hold it.

    Vectors that are NULL or hold NULL or non-finite components are dropped; repeated rows count
    as often as they occur. The smallest id among vectors that can be cut into ``parts``
    equal parts sets the length; vectors of other lengths come out with -1 in all places
    and move nothing. An empty table gives no rows and empty codebooks. Other columns are not
    read. Runs at once, with one table per round in the shared folder.
    """
    ship(vectors.sparkSession)
    state = materialize(whole_vectors(vectors, id_col, vector_col, label_col, scale), "vectors")
    cut = state.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = cut.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    none = F.array().cast("array<int>")
    if not first:
        coded = state.select("vec_id", "label_key", none.alias("code"), none.cast("array<long>").alias("distance"))
        return coded, [np.zeros((0, 0)) for _ in range(parts)]
    own = cut.where(F.size("v") == len(first[0]["v"]))
    start = own.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.split(np.array([r["v"] for r in start]), parts, axis=1)
    moved = [np.ones(len(b), bool) for b in books]
    state = state.withColumn("code", F.lit(None).cast("array<int>"))
    state = state.withColumn("distance", F.lit(None).cast("array<long>"))
    for _ in range(rounds):
        written = materialize(one_round(state, books, moved), "round")
        books, moved = moved_books(books, totals(written))
        state = written.where("code is not null")
    last = one_round(state, books, moved).where("code is not null")
    return last.select("vec_id", "label_key", "code", "distance"), books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers and commas."""
    numbers = ",".join(str(int(x)) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def code_report(vectors: DataFrame, broadcast_rows: int = BROADCAST_ROWS, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per usable vector.

    ``code`` has two hexadecimal digits per part, ``error`` sums its distances and ``label_error``
    the errors of all rows with the same label, as text; rows without a label count together. Vectors
    without a code have NULL in both. Sums that a long cannot hold are cut to the
    largest one. Arguments and odd rows are those of ``compress``.
    """
    coded, books = compress(vectors, **options)
    far = F.aggregate("distance", F.lit(0).cast("decimal(38,0)"), lambda a, d: (a + d).cast("decimal(38,0)"))
    far = F.when(F.exists("distance", lambda d: d < 0), F.lit(MOST).cast("decimal(38,0)")).otherwise(far)
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    known = F.exists("code", lambda c: c >= 0)
    rows = coded.select(
        "vec_id",
        "label_key",
        F.when(known, F.array_join(digits, "")).alias("code"),
        F.when(known, F.least(far, F.lit(MOST).cast("decimal(38,0)"))).cast("long").alias("error"),
    )
    rows = materialize(rows, "codes")
    stats = rows.groupBy(F.col("label_key").alias("stat_key")).agg(
        F.count(F.lit(1)).alias("stat_rows"), F.sum(F.col("error").cast("decimal(38,0)")).alias("total")
    )
    joined = attach_stats(rows, materialize(stats, "label-errors"), "label_key", broadcast_rows)
    most = F.lit(MOST).cast("decimal(38,0)")
    return joined.select(
        "vec_id",
        "code",
        "error",
        F.least("total", most).cast("long").alias("label_error"),
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
