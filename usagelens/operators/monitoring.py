"""Quality of predictions over time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import day_of, f1_score, hard_auc
from usagelens.operators.ranking import numbered, rows_at, sums_before
from usagelens.storage import materialize

METRICS = ["roc_auc", "f1", "accuracy"]


def auc_hard(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Area under the ROC curve of the 0/1 prediction, that is balanced accuracy."""
    return df.agg(hard_auc(F.col(label), F.col(prediction)).alias("auc_hard"))


def label_range(label: str = "label"):
    """Aggregates that tell how many labels there are; ranges of parts can be put together."""
    return F.min(label).alias("label_low"), F.max(label).alias("label_high")


def two_classes():
    """Whether a label range holds at least two labels."""
    return F.coalesce(F.col("label_low") != F.col("label_high"), F.lit(False))


def has_both_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """One row telling whether at least two distinct labels occur.

    A missing label is no class of its own: with one class and NULL no metric is defined.
    """
    return df.agg(*label_range(label)).select(two_classes().alias("both_classes"))


def new_since(df: DataFrame, last=None, column: str = "Date") -> DataFrame:
    """One row: whether ``column`` has grown past ``last``, and its largest value.

    Without an earlier mark the answer is always yes.
    """
    grown = F.lit(True) if last is None else F.max(column) > F.lit(last)
    return df.agg(grown.alias("has_new"), F.max(column).alias("high_watermark"))


def rows_since(df: DataFrame, last=None, column: str = "Date") -> DataFrame:
    """Rows with ``column`` strictly past ``last``; all rows without an earlier mark."""
    return df if last is None else df.where(F.col(column) > F.lit(last))


def assign_chunks(
    df: DataFrame, by="day", date: str = "Date", tiebreak: tuple[str, ...] = ("User",)
) -> DataFrame:
    """Adds ``chunk``: the calendar day, or 1..n for ``by=n`` near-equal parts in time order.

    Parts differ in size by at most one row, the larger ones first. The at most n - 1
    keys a part ends on are looked up first, which ranks only the days they fall on. Rows
    are then labelled without a shuffle, but for rows equal to a key in whose midst a part
    ends: they are numbered and dealt over the parts, and as they are equal in ``date`` and
    ``tiebreak`` it does not matter which goes where.
    """
    if by == "day":
        return df.withColumn("chunk", day_of(df, date))
    order = [date, *tiebreak]

    def ends(rows):
        size, larger = divmod(rows, by)
        return sorted({i * size + min(i, larger) for i in range(1, by)} - {0, rows})

    found = _keys_by_day(df, order, ends)
    if not found:
        return df.withColumn("chunk", F.lit(1))
    keys = list(dict.fromkeys(key for key, _, _ in found))
    ends_at = {key: [inside for k, inside, _ in found if k == key] for key in keys}
    sizes = {key: size for key, _, size in found}
    # Parts that end on an earlier key, by place in the sorted keys.
    ended, so_far = [0], 0
    for key in keys:
        so_far += len(ends_at[key])
        ended.append(so_far)
    label = _place(df, order, keys, 0, len(keys), ended)
    cut = [key for key in keys if min(ends_at[key]) < sizes[key]]
    if not cut:
        return df.withColumn("chunk", label + 1)
    is_cut = F.lit(False)
    for key in cut:
        is_cut = is_cut | _equal(df, order, key)
    passed = F.lit(0)
    for key in cut:
        for inside in ends_at[key]:
            passed = passed + F.when(_equal(df, order, key) & (F.col("place") > inside), 1).otherwise(0)
    whole = df.where(~is_cut).withColumn("chunk", label + 1)
    dealt = numbered(df.where(is_cut), order).withColumn("chunk", label + 1 + passed).drop("place")
    return whole.unionByName(dealt)


def _keys_by_day(df: DataFrame, order: list[str], positions) -> list[tuple[tuple, int, int]]:
    """Per position, sorted, the key there, which of the rows equal to it stands there, and how many are.

    Ranks only the rows of the days the positions fall on. Days are counted in a frame;
    the driver gets those with a position.
    """
    day = F.col(order[0])
    if isinstance(df.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType)):
        day = day.cast("date")
    days = rows_at(df.select(day.alias("day")), ["day"], positions)
    if not days:
        return []
    chosen = {values[0]: (before, n) for values, before, n in days.values()}
    kept, moved = 0, {}
    for value in sorted(chosen, key=lambda d: (d is not None, d)):
        before, n = chosen[value]
        moved.update({p: kept + p - before for p, (v, _, _) in days.items() if v[0] == value})
        kept += n
    inside = day.isin([d for d in chosen if d is not None])
    rows = df.where(inside | day.isNull() if None in chosen else inside)
    found = rows_at(rows, order, lambda _: list(moved.values()))
    return [
        (found[moved[p]][0], moved[p] - found[moved[p]][1], found[moved[p]][2]) for p in sorted(moved)
    ]


def _place(df: DataFrame, order: list[str], keys: list[tuple], low: int, high: int, value: list[int]):
    """``value`` at the number of sorted ``keys`` a row sorts after, by halving the keys."""
    if low == high:
        return F.lit(value[low])
    middle = (low + high) // 2
    return F.when(
        _after(df, order, keys[middle]), _place(df, order, keys, middle + 1, high, value)
    ).otherwise(_place(df, order, keys, low, middle, value))


def _bound(df: DataFrame, name: str, value):
    return F.lit(value).cast(df.schema[name].dataType)


def _equal(df: DataFrame, order: list[str], key: tuple):
    same = F.lit(True)
    for name, value in zip(order, key):
        same = same & F.col(name).eqNullSafe(_bound(df, name, value))
    return same


def _after(df: DataFrame, order: list[str], key: tuple):
    """True for rows that sort after ``key``; NULL sorts first."""
    name, value = order[0], key[0]
    later = F.col(name).isNotNull()
    if value is not None:
        later = F.coalesce(F.col(name) > _bound(df, name, value), F.lit(False))
    if len(order) == 1:
        return later
    return later | (F.col(name).eqNullSafe(_bound(df, name, value)) & _after(df, order[1:], key[1:]))


def cell_merges() -> dict[str, Column]:
    """How the counts of ``score_cells`` of several parts are merged."""
    return {
        "start_date": F.min("start_date"),
        "end_date": F.max("end_date"),
        **{c: F.sum(c) for c in ("n", "judged", "correct", "tp", "fp", "fn", "pos", "neg")},
        "label_low": F.min("label_low"),
        "label_high": F.max("label_high"),
    }


def score_cells(
    df: DataFrame,
    chunk: str = "chunk",
    label: str = "label",
    prediction: str = "prediction",
    score: str = "probability_1",
    date: str = "Date",
) -> DataFrame:
    """Counts per (chunk, score), from which all metrics follow; ``cell_merges`` merges those of parts."""
    truth, guess = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(F.col(chunk).alias("chunk"), F.col(score).alias("score")).agg(
        F.min(day_of(df, date)).alias("start_date"),
        F.max(day_of(df, date)).alias("end_date"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(truth.isNotNull() & guess.isNotNull()).alias("judged"),
        F.count_if(truth == guess).alias("correct"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 1) & F.col(score).isNotNull()).alias("pos"),
        F.count_if((truth == 0) & F.col(score).isNotNull()).alias("neg"),
        *label_range(label),
    )


def cell_metrics(cells: DataFrame) -> DataFrame:
    """``chunk_metrics`` from the counts of ``score_cells``, with the range of labels per chunk."""
    placed = sums_before(cells, ["chunk"], ["score"], ["neg"])
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    merges = [value.alias(name) for name, value in cell_merges().items()]
    totals = placed.groupBy("chunk").agg(*merges, F.sum(won).alias("won"))
    pairs = F.col("pos").cast("double") * F.col("neg")
    return totals.select(
        "chunk",
        "start_date",
        "end_date",
        "n",
        F.try_divide(F.col("won"), pairs).alias("roc_auc"),
        f1_score(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"),
        F.try_divide(F.col("correct"), F.col("judged")).alias("accuracy"),
        "label_low",
        "label_high",
    )


def chunk_metrics(
    df: DataFrame,
    chunk: str = "chunk",
    label: str = "label",
    prediction: str = "prediction",
    score: str = "probability_1",
    date: str = "Date",
) -> DataFrame:
    """Size, date span, ROC-AUC, F1 and accuracy per chunk.

    Rows are counted per chunk and score with map-side partial sums; everything
    else works on these counts. Tied scores count one half, and ROC-AUC is NULL
    for a chunk with one class. Rows without label, prediction or score count
    towards the size but not the metrics they lack.
    """
    cells = score_cells(df, chunk, label, prediction, score, date)
    return cell_metrics(cells).drop("label_low", "label_high")


def thresholds(metrics: DataFrame) -> DataFrame:
    """One row with the lower and upper alert bound of each metric.

    Bounds are mean minus and plus 3 population deviations over the chunks, cut
    to [0, 1].
    """
    bounds = []
    for m in METRICS:
        mean, band = F.avg(m), 3 * F.stddev_pop(m)
        bounds.append(F.greatest(mean - band, F.lit(0.0)).alias(f"{m}_lower"))
        bounds.append(F.least(mean + band, F.lit(1.0)).alias(f"{m}_upper"))
    return metrics.agg(*bounds)


def with_alerts(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """Adds bounds and an alert flag per metric; a NULL metric raises no alert."""
    limits = bounds.select(*[F.col(c).alias(f"limit_{c}") for c in bounds.columns])
    added = []
    for m in METRICS:
        low, high = F.col(f"limit_{m}_lower"), F.col(f"limit_{m}_upper")
        outside = (F.col(m) < low) | (F.col(m) > high)
        added += [
            low.alias(f"{m}_lower"),
            high.alias(f"{m}_upper"),
            F.coalesce(outside, F.lit(False)).alias(f"{m}_alert"),
        ]
    return metrics.crossJoin(F.broadcast(limits)).select(*metrics.columns, *added)


def monitor(
    reference: DataFrame,
    analysis: DataFrame | None = None,
    by="day",
    date: str = "Date",
    tiebreak: tuple[str, ...] = ("User",),
) -> DataFrame:
    """One row per chunk of ``analysis`` with metrics, bounds and alerts.

    The bounds come from the chunks of ``reference``; without ``analysis`` the
    reference is judged by its own bounds. The report is empty when the judged
    frame has a single class.
    """
    def measured(df):
        # One row per chunk, used by the bounds, the report and the test for two classes.
        cells = score_cells(assign_chunks(df, by, date, tiebreak), date=date)
        return materialize(cell_metrics(cells), "chunks")

    known = measured(reference if analysis is None else analysis)
    metrics = known.drop("label_low", "label_high")
    bounds = thresholds(metrics if analysis is None else measured(reference))
    ranges = known.agg(F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high"))
    usable = ranges.select(two_classes().alias("usable")).scalar()
    return with_alerts(metrics, bounds).where(usable)
