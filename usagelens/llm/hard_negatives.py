"""Hard-negative mining with angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. Angles obey the triangle
inequality, so with angles t and u of two rows to one reference, the angle between the rows is at
least |t - u| and at most min(t + u, 2 pi - t - u); all references together give an interval
of the cosine, and times the norms an interval of the score, widened for rounding. Rows lie in
runs ordered by label and angle. A run's interval is compared with the window of scores that an
anchor still needs, and only overlapping ones get their scores computed, exactly.

Rows are packed into blocks of bounded size. Blocks of anchors meet blocks of rows in streams: a
task holds one block of each and the best rows found so far, and blocks whose interval cannot
meet the window of any anchor are not sent at all.
"""

import json
from math import ceil, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from usagelens.llm.common import ship
from usagelens.llm.vectors import LEAST, MOST, by_length, lists, products, scaled, usable
from usagelens.storage import materialize

REFERENCES, SAMPLE = 16, 512
BLOCK_ROWS, ANCHOR_ROWS, RUN = 8192, 4096, 128
# Stored angles are floats; this covers their rounding and that of the arc cosine.
SLACK = 2e-6

_MEASURED = "vec_id long, label long, size int, cell int, near float, norm double, angles array<float>, v array<double>"
_PACKED = (
    "part long, size int, n int, ids binary, labels binary, norms binary, angles binary, points binary, "
    "low array<float>, high array<float>, norm_low double, norm_high double, label_low long, label_high long, "
    "keys binary, positives string"
)


def directions(sample: list[np.ndarray], count: int) -> dict[int, np.ndarray]:
    """Per vector length up to ``count`` unit vectors of the sample, picked farthest first."""
    found = {}
    for length in {len(v) for v in sample}:
        own = np.array([v for v in sample if len(v) == length])
        own = _units(own)[0]
        own = own[(own != 0).any(axis=1)]
        picked: list[int] = []
        closest = np.full(len(own), -2.0)
        while len(picked) < min(count, len(own)):
            at = int(closest.argmin())
            if picked and closest[at] > 1 - 1e-9:
                break
            picked.append(at)
            closest = np.maximum(closest, own @ own[at])
        found[length] = own[picked]
    return found


def _units(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their norms, and the norms; a row of zeros stays."""
    most = np.abs(matrix).max(axis=1, initial=0)
    most[most == 0] = 1
    part = matrix / most[:, None]
    length = np.sqrt((part * part).sum(1))
    with np.errstate(over="ignore"):
        norms = length * most
    length[length == 0] = 1
    return part / length[:, None], norms


def measured(rows: DataFrame, scale: int, references: int) -> DataFrame:
    """(vec_id, label, size, cell, near, norm, angles, v): whole vectors with their angles.

    ``cell`` is the nearest reference and ``near`` the angle to it. References come from a sample
    of ``SAMPLE`` rows, a number that does not grow; lengths it does not hold have one of zeros.
    """
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    known = directions([scaled(np.array(r["v"]), scale) for r in sample], references)

    def measure(batches):
        for batch in batches:
            for at, matrix in by_length(batch.column(2)):
                whole = scaled(matrix, scale)
                unit, norms = _units(whole)
                refs = known.get(matrix.shape[1], np.zeros((0, matrix.shape[1])))
                if not len(refs):
                    refs = np.zeros((1, matrix.shape[1]))
                angles = np.arccos(np.clip(unit @ refs.T, -1, 1)).astype(np.float32)
                own = batch.take(pa.array(at))
                made = [own.column(0), own.column(1), pa.array(np.full(len(at), matrix.shape[1], np.int32))]
                made += [pa.array(angles.argmin(axis=1).astype(np.int32)), pa.array(angles.min(axis=1))]
                made += [pa.array(norms), lists(angles), lists(whole)]
                yield pa.RecordBatch.from_arrays(made, names)

    names = [c.split()[0] for c in _MEASURED.split(", ")]
    return rows.mapInArrow(measure, _MEASURED)


def packed(rows: DataFrame, block_rows: int, cells: bool) -> DataFrame:
    """Rows in blocks of about ``block_rows``, one row of packed arrays per block.

    With ``cells`` a block has rows of one cell; else neighbouring cells share a block while
    they are few. Rows lie by label and angle. Columns ``key`` and ``positives`` of anchors come along.
    """
    total = max(1, rows.count())
    shares = REFERENCES if cells else min(REFERENCES, ceil(total / block_rows))
    share = F.floor(F.col("cell") * shares / REFERENCES).cast("int")
    rows = rows.withColumn("share", F.least(share, F.lit(shares - 1)))
    most = rows.groupBy("size", "share").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    chunks = max(1, ceil(most / block_rows))
    rows = rows.withColumn("chunk", F.pmod(F.monotonically_increasing_id(), F.lit(chunks)))
    anchors = "key" in rows.columns

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["label", "near"], kind="stable")
        angles = np.stack(own["angles"].to_list())
        norms, labels = own["norm"].to_numpy(), own["label"].to_numpy(np.int64)
        first = own.iloc[0]
        row = {
            "part": int(first["share"]) * chunks + int(first["chunk"]),
            "size": int(first["size"]),
            "n": len(own),
            "ids": own["vec_id"].to_numpy(np.int64).tobytes(),
            "labels": labels.tobytes(),
            "norms": norms.tobytes(),
            "angles": angles.astype(np.float32).tobytes(),
            "points": np.concatenate(own["v"].to_list()).astype(np.float64).tobytes(),
            "low": angles.min(axis=0),
            "high": angles.max(axis=0),
            "norm_low": float(norms.min()),
            "norm_high": float(norms.max()),
            "label_low": int(labels[0]),
            "label_high": int(labels[-1]),
            "keys": own["key"].to_numpy(np.int64).tobytes() if anchors else b"",
            "positives": "[" + ",".join(own["positives"]) + "]" if anchors else "",
        }
        return pd.DataFrame([row])

    return rows.groupBy("size", "share", "chunk").applyInPandas(pack, _PACKED)


class Block:
    """The rows of one packed block."""

    def __init__(self, row: dict):
        n = row["n"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.norms = np.frombuffer(row["norms"], np.float64)
        self.angles = np.frombuffer(row["angles"], np.float32).reshape(n, -1).astype(np.float64)
        self.points = np.frombuffer(row["points"], np.float64).reshape(n, row["size"])
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.positives = json.loads(row["positives"]) if row["positives"] else []
        self.first = np.arange(0, n, RUN)

    def runs(self) -> tuple[np.ndarray, ...]:
        """Per run the least and largest angles, norms and labels."""
        last = np.append(self.first[1:], len(self.ids)) - 1
        ends = [(np.minimum.reduceat(a, self.first), np.maximum.reduceat(a, self.first)) for a in (self.angles, self.norms)]
        return (*ends[0], *ends[1], self.labels[self.first], self.labels[last])


def interval(low_a, high_a, low_b, high_b, norm_low, norm_high):
    """Bounds of the scores of rows whose angles and products of norms lie within these.

    Angles have the references on the last axis. Where a norm leaves the range of doubles a bound
    may be NaN, which excludes nothing.
    """
    near = np.maximum(np.maximum(low_a - high_b, low_b - high_a).max(axis=-1), 0)
    far = np.minimum(high_a + high_b, 2 * pi - low_a - low_b).min(axis=-1)
    top, bottom = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.clip(far + SLACK, 0, pi))
    with np.errstate(over="ignore", invalid="ignore"):
        upper = np.where(top > 0, top * norm_high, top * norm_low)
        lower = np.where(bottom > 0, bottom * norm_low, bottom * norm_high)
        return lower - 1e-9 * np.abs(lower) - 1, upper + 1e-9 * np.abs(upper) + 1


def merged(scores, ids, more_scores, more_ids, k):
    """The k best per row of two sets of (score, id): higher scores first, then smaller ids."""
    scores = np.concatenate([scores, more_scores], axis=1)
    ids = np.concatenate([ids, np.broadcast_to(more_ids, more_scores.shape)], axis=1)
    order = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


class Search:
    """The best rows for each window of scores of a block of anchors, as blocks of rows pass by.

    Without windows, an anchor looks for the ``k`` best rows of its own label; with windows (pairs of a
    least and a largest score), for the ``k`` best rows of other labels inside each.
    """

    def __init__(self, anchors: Block, k: int, windows: list[list[tuple[int, int]]] | None):
        self.anchors, self.k, self.same = anchors, k, windows is None
        n = len(anchors.ids)
        if windows is None:
            windows = [[(-(10**400), 10**400)]] * n
        self.width = max((len(w) for w in windows), default=0)
        self.low = np.full((n, self.width), np.inf, object)
        self.high = np.full((n, self.width), -np.inf, object)
        for a, own in enumerate(windows):
            for j, (low, high) in enumerate(own):
                self.low[a, j], self.high[a, j] = low, high
        if self.same:
            self.low[:], self.high[:] = -np.inf, np.inf
        exact = [x for x in (*self.low.ravel(), *self.high.ravel()) if abs(x) != np.inf]
        if all(abs(x) < 1 << 53 for x in exact):
            self.low, self.high = self.low.astype(np.float64), self.high.astype(np.float64)
        self.scores = np.full((n, self.width, k), -np.inf, self.low.dtype)
        self.ids = np.full((n, self.width, k), MOST, np.int64)
        self.scored = self.possible = 0

    def needed(self) -> np.ndarray:
        return np.maximum(self.low, self.scores[:, :, -1])

    def run(self, rows: Block) -> None:
        own = self.anchors
        low, high, norm_low, norm_high, label_low, label_high = rows.runs()
        own_angles = own.angles[:, None, :]
        with np.errstate(over="ignore"):
            norms = own.norms[:, None] * norm_low, own.norms[:, None] * norm_high
        lower, upper = interval(own_angles, own_angles, low[None], high[None], *norms)
        label = own.labels[:, None]
        if self.same:
            fits = (label_low <= label) & (label <= label_high)
        else:
            fits = (label_low != label) | (label_high != label)
        self.possible += len(own.ids) * len(rows.ids)
        for at in np.argsort(-np.nan_to_num(upper.max(axis=0)), kind="stable"):
            with np.errstate(invalid="ignore"):
                misses = (upper[:, at, None] < self.needed()) | (lower[:, at, None] > self.high)
            asked = np.flatnonzero(fits[:, at] & ~misses.astype(bool).all(axis=1))
            if len(asked):
                self._score(asked, rows, slice(rows.first[at], rows.first[at] + RUN))

    def _score(self, asked: np.ndarray, rows: Block, run: slice) -> None:
        ids = rows.ids[run]
        scores = products(self.anchors.points[asked], rows.points[run])
        self.scored += scores.size
        same = self.anchors.labels[asked, None] == rows.labels[None, run]
        takes_part = (same if self.same else ~same) & (self.anchors.ids[asked, None] != ids[None, :])
        if scores.dtype == object and self.scores.dtype != object:
            self.scores, self.low, self.high = (a.astype(object) for a in (self.scores, self.low, self.high))
        for j in range(self.width):
            inside = takes_part & (scores >= self.low[asked, j, None]) & (scores <= self.high[asked, j, None])
            inside &= np.asarray(scores >= self.scores[asked, j, -1, None], bool)
            better = np.flatnonzero(inside.any(axis=1))
            if len(better):
                new = np.where(inside[better], scores[better], -np.inf)
                at = asked[better]
                self.scores[at, j], self.ids[at, j] = merged(
                    self.scores[at, j], self.ids[at, j], new, ids[None, :], self.k
                )

    def found(self) -> pa.RecordBatch:
        """(key, place, vec_id, score) of what was found; scores as text, which holds any size."""
        a, j, i = np.nonzero(np.asarray(self.scores > -np.inf, bool))
        columns = [
            pa.array(self.anchors.keys[a]),
            pa.array(j.astype(np.int32)),
            pa.array(self.ids[a, j, i]),
            pa.array([str(int(s)) for s in self.scores[a, j, i]], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "place", "vec_id", "score"])


def _paired(anchors: DataFrame, blocks: DataFrame, windows) -> DataFrame:
    """(anchor_part, size, part, upper): blocks of rows to be sent to each block of anchors."""
    near = ["size", "part", "low", "high", "norm_low", "norm_high", "label_low", "label_high"]
    asked = anchors.select("size", "positives", *[F.col(c).alias(f"a_{c}") for c in near[1:]])
    met = asked.join(blocks.select(*near), "size")
    if windows is None:
        met = met.where((F.col("label_low") <= F.col("a_label_high")) & (F.col("a_label_low") <= F.col("label_high")))

    def bound(batches):
        for batch in batches:
            made = {"anchor_part": [], "size": [], "part": [], "upper": []}
            spans: dict[int, tuple] = {}
            for row in batch.to_pylist():
                a, b = ([np.array(row[p + c], np.float64) for c in ("low", "high")] for p in ("a_", ""))
                with np.errstate(over="ignore"):
                    norms = [np.float64(row[f"a_norm_{e}"]) * row[f"norm_{e}"] for e in ("low", "high")]
                lower, upper = map(float, interval(*a, *b, *norms))
                if windows is not None:
                    key = row["size"], row["a_part"]
                    if key not in spans:
                        flat = [w for own in json.loads(row["positives"]) for w in windows(own)]
                        spans[key] = (min((w[0] for w in flat), default=1), max((w[1] for w in flat), default=0))
                    low, high = spans[key]
                    alike = row["label_low"] == row["label_high"] == row["a_label_low"] == row["a_label_high"]
                    if alike or upper < low or lower > high or low > high:
                        continue
                for name, value in zip(made, (row["a_part"], row["size"], row["part"], float(np.nan_to_num(upper)))):
                    made[name].append(value)
            yield pa.RecordBatch.from_pydict(made, schema=types)

    types = pa.schema(
        [("anchor_part", pa.int64()), ("size", pa.int32()), ("part", pa.int64()), ("upper", pa.float64())]
    )
    return met.mapInArrow(bound, "anchor_part long, size int, part long, upper double")


def _searched(anchors: DataFrame, blocks: DataFrame, k: int, windows, parallel: int) -> DataFrame:
    """(key, place, vec_id, score): the best rows for each anchor, or each of its windows.

    A stream holds one block of anchors, first, and then the blocks of rows paired with it, those with
    the largest bound first. One block of anchors has several streams where there are few.
    """
    stripes = max(1, ceil(parallel / max(1, anchors.count())))
    pairs = _paired(anchors, blocks, windows)
    stripe = F.pmod(F.xxhash64("part"), F.lit(stripes)).cast("int")
    columns = ["size", "n", "ids", "labels", "norms", "angles", "points", "keys", "positives"]
    passing = pairs.join(blocks, ["size", "part"]).select(
        "anchor_part", stripe.alias("stripe"), (-F.col("upper")).alias("place"), *columns
    )
    first = anchors.select(
        F.col("part").alias("anchor_part"),
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
        F.lit(float("-inf")).alias("place"),
        *columns,
    )
    by = ["size", "anchor_part", "stripe"]
    dealt = first.unionByName(passing).repartition(*by).sortWithinPartitions(*by, "place")

    def stream(batches):
        search, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                key = tuple(row[c] for c in by)
                if key != held:
                    if search is not None:
                        yield search.found()
                    own = Block(row)
                    wanted = None if windows is None else [windows(p) for p in own.positives]
                    search, held = Search(own, k, wanted), key
                else:
                    search.run(Block(row))
        if search is not None:
            yield search.found()

    return dealt.mapInArrow(stream, "key long, place int, vec_id long, score string")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first rows per key and place; of whole numbers as text, longer ones are larger."""
    score, below = F.col("score"), F.col("score").startswith("-")
    length = F.when(below, -F.length(score)).otherwise(F.length(score))
    first = [length.desc(), F.when(~below, score).desc(), F.when(below, score).asc(), F.col("vec_id").asc()]
    order = Window.partitionBy("key", "place").orderBy(*first)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _as_long(score: Column) -> Column:
    """The nearest number that a long can hold."""
    end = F.when(score.startswith("-"), F.lit(LEAST)).otherwise(F.lit(MOST))
    return F.coalesce(score.try_cast("long"), end)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
    references: int = REFERENCES,
    parallel: int = 12,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(scale * x) over the components; of two rows the one with the
    higher score comes first, then the smaller id. An anchor's positives are its first rows with the
    same ``label`` (the column of that name by default; whole numbers, or else compared as 64-bit
    hashes). For each, the first rows of other labels are returned whose score is from
    ``least`` to ``most`` percent of the positive's score.

    Rows without id or label, and vectors that are NULL or hold NULL or non-finite
    components, take no part. Only vectors of one length are compared. An anchor's
    candidates are all rows with another id, repeated ones as often as they occur; equal anchor rows
    count once. Scores are exact for whole numbers of any size; a returned score that a long
    cannot hold is cut to the nearest one. Empty tables give no rows; other columns are not read. Runs at once.
    """
    if not (0 < references <= REFERENCES and positives > 0 and negatives > 0):
        raise ValueError(f"references is from 1 to {REFERENCES}; positives and negatives are at least 1")
    ship(vectors.sparkSession)
    label = F.col("label") if label is None else label
    x = F.col(vector_col).cast("array<double>")

    def kept(rows):
        typed = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), x.alias("v"))
        whole = isinstance(typed.schema["label"].dataType, IntegralType)
        known = F.when(F.col("label").isNotNull(), F.col("label").cast("long") if whole else F.xxhash64("label"))
        return typed.select("vec_id", known.alias("label"), "v").where(
            F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
        )

    rows = materialize(measured(kept(vectors), scale, references), "measured")
    asked = kept(vectors.where(is_anchor)).select("vec_id").distinct()
    anchors = rows.join(asked, "vec_id", "left_semi").distinct()
    anchors = materialize(anchors.withColumn("key", F.monotonically_increasing_id()), "anchors")
    blocks = materialize(packed(rows, block_rows, True), "blocks")

    plain = materialize(packed(anchors.withColumn("positives", F.lit("[]")), anchor_rows, False), "anchor-blocks")
    near = materialize(_best(_searched(plain, blocks, positives, None, parallel), positives), "positives")

    def windows(scores: list[int]) -> list[tuple[int, int]]:
        return [(-(-least * s // 100), most * s // 100) for s in scores]

    listed = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    text = F.concat(F.lit("["), F.array_join(F.transform("p", lambda p: p["score"]), ","), F.lit("]"))
    # Positives are known by their place, from 0, in this list.
    wanted = anchors.join(listed.select("key", text.alias("positives")), "key")
    wanted = materialize(packed(wanted, anchor_rows, False), "anchor-blocks")
    found = _best(_searched(wanted, blocks, negatives, windows, parallel), negatives)
    named = near.select(
        "key", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("p_score")
    )
    found = found.select("key", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("n_score"))
    owners = anchors.select("key", F.col("vec_id").alias("anchor_id"))

    return (
        found.join(named, ["key", "place"])
        .join(owners, "key")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            _as_long(F.col("p_score")).alias("positive_score"),
            _as_long(F.col("n_score")).alias("negative_score"),
        )
    )
