"""Benchmark passages in documents, by a prefix-filtered set join.

Every benchmark item is cut into windows of some consecutive words; an item of fewer words
is one window. A window is the set of its word shingles, ordered by how often they occur in
all documents, rare ones first. A stretch of a document that holds a share t of the n shingles
of a window holds one of its first ``n - ceil(t n) + 1``, the prefix. Only these are joined with
the documents' shingles. A joined pair must leave room for the window before and after
the shingle; what remains is verified on the words around it.

Documents are never shuffled. They are read twice, once to count the benchmark's shingles in them
and once to emit the places of prefix shingles, which a Bloom filter of bounded size finds.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm import bitmap
from usagelens.llm.common import byte_spans, identified, map_batches, pieces, ship
from usagelens.llm.hashing import byte_codes, chained, token_hashes
from usagelens.storage import materialize

# Words are runs of 0-9, A-Z, a-z and of what is not ASCII; A-Z count as a-z.
CLASSES = np.zeros(256, np.uint8)
CLASSES[ord("0") : ord("9") + 1] = 1
CLASSES[ord("A") : ord("Z") + 1] = 1
CLASSES[ord("a") : ord("z") + 1] = 1
CLASSES[128:] = 1
CODES = byte_codes(11, {ord("A") + i: ord("a") + i for i in range(26)})

# Tokens with more than one in SHARE of all places are dealt over PARTS parts of the join. There
# are fewer than SHARE of them, so they can be broadcast.
SHARE, PARTS = 1000, 64

_HITS = "array<struct<token: long, pos: int, before: int, around: binary>>"


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A token for each ``size`` consecutive words; sizes are told apart."""
    last = len(words) - size + 1
    if last <= 0:
        return words[:0]
    return chained(*[words[i : last + i] for i in range(size)], np.full(last, size, np.uint64))


def window_tokens(words: np.ndarray, shingle: int) -> tuple[int, list[int], list[int]]:
    """Words in a shingle of this window, its distinct shingles and where each comes first."""
    size = min(shingle, len(words))
    tokens, at = np.unique(shingles(words, size), return_index=True)
    return size, tokens.view(np.int64).tolist(), at.tolist()


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and which is the first of each text (one more at the end)."""
    raw, starts = byte_spans(texts)
    begin, _, words = token_hashes(raw, starts, CLASSES, CODES)
    return words, np.searchsorted(begin, starts)


def windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, words, size, tokens, at): the windows of every item, repeated ones as well."""

    def cut(batches):
        for batch in batches:
            made = {"item_id": [], "words": [], "size": [], "tokens": [], "at": []}
            texts, ids = batch.column(1), batch.column(0)
            done = 0
            for part in pieces(texts):
                words, first = _words(part)
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for start in range(a, max(a + 1, b - window + 1)) if b > a else ():
                        own = words[start : min(b, start + window)]
                        size, tokens, at = window_tokens(own, shingle)
                        row = (ids[done + i].as_py(), own.tobytes(), size, tokens, at)
                        for name, value in zip(made, row):
                            made[name].append(value)
                    if len(made["size"]) >= 10_000:
                        yield pa.RecordBatch.from_pydict(made, schema=types)
                        made = {name: [] for name in made}
                done += len(part)
            if made["size"]:
                yield pa.RecordBatch.from_pydict(made, schema=types)

    types = pa.schema(
        [
            ("item_id", pa.string()),
            ("words", pa.binary()),
            ("size", pa.int32()),
            ("tokens", pa.list_(pa.int64())),
            ("at", pa.list_(pa.int32())),
        ]
    )
    schema = "item_id string, words binary, size int, tokens array<long>, at array<int>"
    return items.mapInArrow(cut, schema)


def token_counts(docs: DataFrame, tokens: bitmap.Bitmap, sizes: list[int]) -> DataFrame:
    """(token, n): how often tokens that the filter passes occur in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def count(batch):
        found = []
        for part in pieces(batch.column(2)):
            words, first = _words(part)
            for size in sizes:
                made = shingles(words, size)
                at = np.flatnonzero(shared.value.holds(made))
                found.append(made[at[_inside(at, size, first)]])
        values, n = np.unique(np.concatenate(found), return_counts=True)
        return {"token": values.view(np.int64), "n": n}

    return map_batches(docs, count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _inside(at: np.ndarray, size: int, first: np.ndarray) -> np.ndarray:
    """Whether shingles that begin at these words end in the same text."""
    return at + size <= first[np.searchsorted(first, at, "right")]


def places(docs: DataFrame, tokens: bitmap.Bitmap, sizes: list[int], window: int, shingle: int) -> DataFrame:
    """(row, doc_id, n_words, hits): where tokens that the filter passes stand in each document.

    A hit carries hashes of as many words around it as any window with that shingle can reach.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def find(batch):
        n_words, counts, columns = [], [], [[], [], [], []]
        for part in pieces(batch.column(2)):
            words, first = _words(part)
            n_words.append(np.diff(first))
            found = []
            for size in sizes:
                made = shingles(words, size)
                at = np.flatnonzero(shared.value.holds(made))
                at = at[_inside(at, size, first)]
                reach = window if size == shingle else size
                found.append((at, made[at], np.full(len(at), reach - size), np.full(len(at), reach)))
            at, token, back, ahead = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(at, kind="stable")
            at, token, back, ahead = at[order], token[order], back[order], ahead[order]
            doc = np.searchsorted(first, at, "right") - 1
            begin = np.maximum(first[doc], at - back)
            end = np.minimum(first[doc + 1], at + ahead)
            counts.append(np.bincount(doc, minlength=len(part)))
            columns[0].append(token.view(np.int64))
            columns[1].append((at - first[doc]).astype(np.int32))
            columns[2].append((at - begin).astype(np.int32))
            columns[3] += [words[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())]
        hits = pa.StructArray.from_arrays(
            [*(pa.array(np.concatenate(c)) for c in columns[:3]), pa.array(columns[3], pa.binary())],
            ["token", "pos", "before", "around"],
        )
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return {
            "row": batch.column(0),
            "doc_id": batch.column(1),
            "n_words": np.concatenate(n_words),
            "hits": pa.ListArray.from_arrays(pa.array(offsets), hits),
        }

    return map_batches(docs, find, f"row long, doc_id long, n_words long, hits {_HITS}")


def prefixes(distinct: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """(token, window_id, words, size, at): the rarest shingles of each window that are necessary."""
    tokens = distinct.select("window_id", F.explode(F.arrays_zip("tokens", "at")).alias("t"))
    tokens = tokens.select("window_id", F.col("t.tokens").alias("token"), F.col("t.at").alias("at"))
    ordered = (
        tokens.join(counts, "token", "left")
        .groupBy("window_id")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at"))).alias("t"))
    )
    n = F.size("t")
    needed = F.ceil(n * percent / 100).cast("int")
    first = ordered.select("window_id", F.explode(F.slice("t", F.lit(1), n - needed + 1)).alias("t"))
    # What no document holds joins with nothing.
    first = first.where("t.n > 0").select("window_id", "t.n", "t.token", "t.at")
    return first.join(distinct.select("window_id", "words", "size"), "window_id")


def matches(words: np.ndarray, around: np.ndarray, before: int, at: int, size: int, percent: int) -> Iterator[int]:
    """Where in ``around`` the window of these words begins, such that it holds the shared shingle.

    The shingle stands at ``before`` in ``around`` and at ``at`` in the window. With 100 percent the
    words must be the same in order, below that the share of the window's shingles counts.
    """
    length = len(words)
    if percent == 100:
        start = before - at
        if start >= 0 and np.array_equal(around[start : start + length], words):
            yield start
        return
    own = np.unique(shingles(words, size))
    made = shingles(around, size)
    known = np.isin(made, own)
    last = len(around) - length
    for start in range(max(0, before - length + size), min(before, last) + 1):
        stop = start + length - size + 1
        held = len(np.unique(made[start:stop][known[start:stop]]))
        if 100 * held >= percent * len(own):
            yield start


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """(row, start, length, window_id) of the pairs whose words match."""

    def check(batches):
        for batch in batches:
            made = {"row": [], "start": [], "length": [], "window_id": []}
            for p in batch.to_pylist():
                words = np.frombuffer(p["words"], np.uint64)
                around = np.frombuffer(p["around"], np.uint64)
                for start in matches(words, around, p["before"], p["at"], p["size"], percent):
                    made["row"].append(p["row"])
                    made["start"].append(p["pos"] - p["before"] + start)
                    made["length"].append(len(words))
                    made["window_id"].append(p["window_id"])
            yield pa.RecordBatch.from_pydict(made, schema=types)

    types = pa.schema(
        [("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("window_id", pa.binary())]
    )
    columns = ["row", "pos", "before", "around", "window_id", "words", "size", "at"]
    schema = "row long, start long, length long, window_id binary"
    return pairs.select(*columns).mapInArrow(check, schema)


def _joined(places: DataFrame, first: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Hits with the windows whose prefix they are in, as far as lengths and positions allow."""
    hits = places.select("row", "n_words", F.explode("hits").alias("hit")).select("row", "n_words", "hit.*")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(SHARE, total / SHARE)).select("token", F.lit(PARTS).alias("parts"))

    def dealt(rows, part):
        found = rows.join(F.broadcast(hot), "token", "left")
        return found.withColumn("part", part(F.coalesce("parts", F.lit(1)).cast("long"))).drop("parts")

    hits = dealt(hits, lambda n: F.pmod(F.xxhash64("row", "pos"), n))
    first = dealt(first, lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    length = F.octet_length("words") / 8
    start = F.col("pos") - F.col("at")
    fits = F.col("n_words") >= length
    if percent == 100:
        fits = (start >= 0) & (start + length <= F.col("n_words"))
    return hits.join(first, ["token", "part"]).where(fits)


def find(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    percent: int = 100,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_bits: int = bitmap.MOST_BITS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (row, doc_id, n_words), occurrences (row, start, length, window_id), and items of
    windows (window_id, item_ids).

    An occurrence says that ``length`` words of a document from word ``start`` on hold at least
    ``percent`` of the shingles of a window; at 100 they are its words in the same order. ``shingle``
    is the number of words in a shingle; a window with fewer is one shingle. Every row of
    ``docs`` counts for itself, also where ids or rows repeat. NULL and empty texts have no words.
    Items repeated with one id count once; rows of items without id mark words but are no item.
    Empty tables give no occurrences; other columns are not read. Words are compared by
    64-bit hashes, so that a false match needs all words of a window to collide.

    Runs at once; what is found is written to the shared folder. ``most_bits`` bounds the filter
    that is sent to every task; a fuller filter lets more places through to the join.
    """
    if not (0 < percent <= 100 and 0 < shingle <= window):
        raise ValueError("percent is from 1 to 100, shingle from 1 to window")
    ship(docs.sparkSession)
    rows = identified(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text"
    )
    bench = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("t"))
    bench = bench.select("item_id", F.coalesce("t", F.lit("")).alias("text"))
    cut = windows(bench, window, shingle).withColumn("window_id", F.unhex(F.md5("words")))
    cut = materialize(cut, "windows")
    distinct = materialize(cut.dropDuplicates(["window_id"]).drop("item_id"), "distinct-windows")
    sizes = sorted(r["size"] for r in distinct.select("size").distinct().collect())
    if not sizes:
        sizes = [shingle]
    tokens = distinct.select(F.explode("tokens").alias("token")).distinct()
    counts = materialize(token_counts(rows, bitmap.build(tokens, most_bits), sizes), "token-counts")
    first = materialize(prefixes(distinct, counts, percent), "prefixes")
    wanted = bitmap.build(first.select("token").distinct(), most_bits)
    seen = materialize(places(rows, wanted, sizes, window, shingle), "places")
    used = counts.join(first.select("token").distinct(), "token", "left_semi")
    found = _verified(_joined(seen, first, used, percent), percent)
    if percent < 100:
        found = found.distinct()  # a window can be found by several shingles
    found = materialize(found, "occurrences")
    named = cut.groupBy("window_id").agg(F.collect_set("item_id").alias("item_ids"))
    return seen.select("row", "doc_id", "n_words"), found, named


def covered() -> Column:
    """Words an occurrence adds to those that occurrences before it in its document cover."""
    before = Window.partitionBy("row").orderBy("start", "length", "window_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    return F.greatest(F.lit(0), end - F.greatest("start", reached))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids), one row per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence; ``item_ids`` are the items whose windows
    occur, as sorted strings. Arguments, odd rows and empty tables are those of ``find``.
    """
    rows, found, named = find(docs, items, **options)
    words = found.select("row", covered().alias("more")).groupBy("row").agg(F.sum("more").alias("n_hit"))
    own = (
        found.select("row", "window_id")
        .distinct()
        .join(named, "window_id")
        .groupBy("row")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    )
    joined = rows.join(words.join(own, "row"), "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def passages(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, start, end): the longest stretches of words that occurrences cover without a gap.

    Words are counted from 0, ``end`` is the first word behind. Arguments are those of ``find``.
    """
    rows, found, _ = find(docs, items, **options)
    by_start = Window.partitionBy("row").orderBy("start", "length", "window_id")
    end = F.col("start") + F.col("length")
    reached = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reached >= F.col("start"), 0).otherwise(1)
    runs = found.select("row", "start", "length", "window_id", new.alias("new"))
    runs = runs.select("row", "start", end.alias("end"), F.sum("new").over(by_start).alias("run"))
    merged = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.join(rows, "row").select("doc_id", "start", "end")


def digests(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``contamination`` with the items as their number and the SHA-256 of the joined ids."""
    return contamination(docs, items, **options).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
