import datetime
import pathlib
import time

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from usagelens import plans, sinks, sources
from usagelens.operators import features, model, profile, sampling, summary
from usagelens.operators.monitoring import monitor
from usagelens.operators.transform import augment
from usagelens.registry import inputs, queries
from usagelens.schemas import PROCESSED_SCHEMA, SUMMARY_SCHEMA, TARGET
from usagelens.storage import materialize, scratch_path
from usagelens.streaming import ingest_stream, monitor_stream, stream_daily_summary
from usagelens.streaming.jobs import add_to_summary, daily_partials

SMALL = {"trees": (3,), "depths": (3,), "folds": 2}


def test_sample_n(spark):
    df = spark.range(1000)
    got = [r["id"] for r in sampling.sample_n(df, 50, 7).collect()]
    assert len(set(got)) == 50
    assert got != [r["id"] for r in sampling.sample_n(df, 50, 8).collect()]
    with pytest.raises(ValueError):
        sampling.sample_n(df, 1001)


def test_oversampling(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    drawn = {r["label"]: r["count"] for r in summary.class_counts(sampling.oversample(df), "label").collect()}
    assert drawn[0] == 1800 and 18 * 200 < drawn[1] < 22 * 200
    exact = sampling.oversample_exact(df, "label", 20).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in exact} == {0: 1800, 1: 4000}


def test_copies_follow_from_the_key(spark):
    df = spark.range(3000).withColumn("label", (F.col("id") % 3 == 0).cast("int")).withColumn("copy", F.lit("x"))
    first, second = (
        sampling.oversample(rows, factor=4, key=["id"]).groupBy("id").count().collect()
        for rows in (df.repartition(3), df.orderBy(F.desc("id")).repartition(7, "label"))
    )
    assert sorted(first) == sorted(second)
    copies = [r["count"] for r in first if r["id"] % 3 == 0]
    assert {r["count"] for r in first if r["id"] % 3} == {1} and len(first) - len(copies) == 2000
    # Mean and variance of Poisson(4) over 1000 keys, within five standard errors; none for 1 key in 55.
    counts = copies + [0] * (1000 - len(copies))
    mean = sum(counts) / 1000
    assert abs(mean - 4) < 5 * (4 / 1000) ** 0.5 and 3 < sum((c - mean) ** 2 for c in counts) / 999 < 5
    assert sampling.oversample(df, factor=4, key=["id"]).columns == df.columns
    other = sampling.oversample(df, factor=4, seed=7, key=["id"]).groupBy("id").count().collect()
    assert sorted(other) != sorted(first)


def test_poisson_steps():
    steps = sampling.poisson_steps(20.0)
    assert steps[0] == pytest.approx(2.0611536e-09) and steps[20] == pytest.approx(0.559093, abs=1e-6)
    assert all(a <= b for a, b in zip(steps, steps[1:])) and 1 - steps[-1] < 1e-12


def test_no_key_crosses_folds(spark, monkeypatch):
    seen = []

    def fit(search, df):
        seen.append((search.getFoldCol(), search.getNumFolds(), df))

    monkeypatch.setattr(model.CrossValidator, "fit", fit)
    rows = spark.range(600).select(
        (F.col("id") % 200).alias("key"), (F.col("id") % 2).alias("label"), F.col("id").cast("double").alias("x")
    )
    assembled = model.assemble(rows, ["x"])
    model.train(assembled, fold_by=["key"])
    ((column, folds, df),) = seen
    assert (column, folds) == ("fold", 3)
    # Rows with one key differ by 200 in x.
    by_key = df.select(vector_to_array("features")[0].cast("long").alias("x"), "fold").collect()
    of = {}
    for r in by_key:
        assert of.setdefault(r["x"] % 200, r["fold"]) == r["fold"]
    assert set(of.values()) == {0, 1, 2}


def test_splits_are_disjoint_and_complete(spark):
    df = materialize(spark.range(3000), "range")
    for train, test in (sampling.random_split(df), sampling.split_by_key(df)):
        a, b = ({r["id"] for r in part.collect()} for part in (train, test))
        assert not a & b and len(a | b) == 3000 and 0.75 < len(a) / 3000 < 0.85


def test_split_sorts_nothing_and_keeps_every_row(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 500).alias("key"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("Draw")
    )
    shuffled = rows.repartition(5, "key")
    train, test = sampling.random_split(shuffled)
    for part in (train, test):
        assert "Sort" not in part._jdf.queryExecution().executedPlan().toString()
        assert part.columns == ["key", "Draw"]
    assert 0.75 < train.count() / 4000 < 0.85
    assert train.unionByName(test).exceptAll(rows).isEmpty() and rows.exceptAll(train.unionByName(test)).isEmpty()
    assert [part.count() for part in sampling.random_split(rows, 1.0)] == [4000, 0]
    with pytest.raises(ValueError):
        sampling.random_split(rows, 1.5)


def test_augment(spark):
    now = datetime.datetime(2024, 5, 1, 12)
    df = spark.range(5000).select(
        "id", F.lit("old").alias("DP_DATE"), F.lit(100).alias("n"), F.lit("t").alias("text"),
        F.lit(float("nan")).alias("hole"),
    )
    got = augment(df, 4000, now).toPandas()
    assert list(got.columns) == ["DP_DATE", "n", "text", "hole"] and len(got) == 4000
    away = (got["DP_DATE"] - now).dt.total_seconds()
    assert away.min() >= -300 and away.max() <= 300 and away.nunique() > 500
    assert abs(got["n"].mean() - 100) < 1 and 9 < got["n"].std() < 11
    assert got["hole"].isna().all() and set(got["text"]) == {"t"}


def test_flat_predictions_have_the_declared_columns(spark, sf):
    made = features.build_features(inputs.labelled(spark, sf))
    fitted, scored = model.train_and_score(made, split_first=True, **SMALL)
    flat = model.flatten_predictions(scored)
    assert len(flat.columns) == 43
    assert fitted.bestModel.getNumTrees == 3
    bad = flat.where(F.abs(F.col("probability_0") + F.col("probability_1") - 1) > 1e-9)
    assert flat.count() > 0 and bad.isEmpty()
    assert len(flat.first()["features_str"].split(",")) == 32


def test_prepare_train_monitor(spark, sf, tmp_path):
    config = tmp_path / "config.json"
    config.write_text(
        '{"start_date": "2024-01-02", "end_date": "2024-01-25",'
        ' "processed_start": "2024-01-03", "processed_end": "2024-01-24"}'
    )
    ranges = plans.DateRanges.from_json(str(config))
    table, found = scratch_path(spark, "processed"), scratch_path(spark, "predictions")
    auc, flat = plans.run(spark, ranges, inputs.cdr(spark, sf), table, found, **SMALL)
    assert 0 <= auc <= 1
    assert spark.read.parquet(found).count() == flat.count()
    assert flat.agg(F.min("Date"), F.max("Date")).first()[0] >= "2024-01-03"
    path = scratch_path(spark, "report")
    report = plans.monitoring_report(spark, found, path, by=4)
    assert report.count() == 4
    assert spark.read.option("header", True).csv(path).count() == 4
    empty = plans.DateRanges("2030-01-01", "2030-01-02", "2030-01-01", "2030-01-02")
    with pytest.raises(ValueError):
        plans.run(spark, empty, inputs.cdr(spark, sf), scratch_path(spark, "none"))


def test_explore(spark, sf):
    rows = materialize(inputs.labelled(spark, sf), "labelled")
    began = time.perf_counter()
    found = plans.explore(rows)
    assert len(found) == 12 and time.perf_counter() - began < 2
    assert found["density"] is found["density"]
    assert found["histogram"].agg(F.sum("count")).first()[0] > 0
    assert {name for name, df in found.items() if df.isEmpty()} == set()
    raw = plans.explore_raw(inputs.cdr_text(spark, sf), "2024-01-01", "2024-01-25")
    assert {name: df.count() for name, df in raw.items()} == {"r2": 10, "regression": 10, "describe": 11}


def test_exploration_report_agrees_with_the_parts(spark, sf):
    """With NULLs left in, merged statistics are those of the operators; parts share three aggregates."""
    rows = materialize(inputs.labelled(spark, sf), "labelled")
    found = plans.explore(rows)
    report = plans.exploration_report(rows)
    assert {r.part for r in report.select("part").distinct().collect()} == set(found)
    value = {(r.part, r.key): r.text if r.value is None else r.value for r in report.collect()}
    top = found["log_profile"].first()
    assert value["log_profile", f"{profile.top_correlated(rows).first()['feature']}/n"] == top["n"]
    for row in found["correlations"].collect():
        assert value["correlations", row["feature"]] == pytest.approx(row["correlation"], abs=1e-9)
    for part in ("moments", "scaled_moments"):
        for name, want in found[part].first().asDict().items():
            assert value[part, name] == pytest.approx(want, rel=1e-9)
    for name, want in found["null_counts"].first().asDict().items():
        assert value["null_counts", name] == want
    for row in found["class_summary"].collect():
        for name, want in row.asDict().items():
            if name != TARGET:
                key = f"{float(row[TARGET])}/" + "/".join(name.rsplit("_", 1))
                got = value["class_summary", key]
                assert got == want if want is None or isinstance(want, str) else got == pytest.approx(want, rel=1e-9)
    for part, key, columns in (("histogram", "bin", ["left_edge", "count"]), ("density", "point", ["x", "density"])):
        for row in found[part].collect():
            for c in columns:
                assert value[part, f"{row[key]}/{c}"] == pytest.approx(row[c], rel=1e-9)


@pytest.mark.parametrize("rows", [0, 1])
def test_exploration_of_hardly_any_rows(spark, sf, rows):
    df = materialize(inputs.labelled(spark, sf).limit(rows), "few")
    report = plans.exploration_report(df)
    sizes = {r.key: r.value for r in report.where("part = 'profile'").collect()}
    assert sizes.get("record_count", 0) == sizes.get("distinct_subscribers", 0) == rows


def stream_dirs(spark):
    return [scratch_path(spark, name) for name in ("in", "out", "state")]


def test_ingest_takes_each_file_once(spark):
    rows = spark.createDataFrame([("2024-01-01", "u", 1, 1.0, 1.0, 1, 1, 1.0, 0)], PROCESSED_SCHEMA)
    folder, out, state = stream_dirs(spark)
    for n in range(1, 4):
        rows.write.mode("append").parquet(folder)
        ingest_stream(spark, folder, out, state, PROCESSED_SCHEMA, files_per_trigger=1).awaitTermination()
        assert spark.read.parquet(out).count() == n


def usage(spark, rows):
    names = "DP_TS string, DP_MOC_COUNT int, DP_MOC_DURATION double, DP_DATA_COUNT int, DP_DATA_VOLUME double"
    return spark.createDataFrame([(t, n, 1.0, 1, 0.5) for t, n in rows], names).withColumn(
        "DP_TS", F.col("DP_TS").cast("timestamp")
    )


@pytest.mark.parametrize("watermark,first", [(None, 111), ("10 minutes", 11)])
def test_late_records(spark, watermark, first):
    """All records count; with a watermark those of a day closed by it do not."""
    folder, out, state = stream_dirs(spark)
    arrivals = [
        [("2024-01-01 23:50:00", 1), ("2024-01-02 00:05:00", 1)],
        [("2024-01-01 23:55:00", 10)],
        [("2024-01-02 00:30:00", 1)],
        [("2024-01-01 23:59:00", 100), ("2024-01-02 00:01:00", 1)],
    ]
    for rows in arrivals:
        batch = usage(spark, rows)
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream_daily_summary(
            spark, folder, out, state, batch.schema, "DP_TS", watermark
        ).awaitTermination()
    got = {
        str(r["Date"]): r["Total_Outgoing_Calls"]
        for r in sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()
    }
    assert got == {"2024-01-01": first, "2024-01-02": 3}


def files_of(folder):
    return {p for p in pathlib.Path(folder).glob("*.parquet")}


def test_no_record_is_read_twice(spark):
    """Records of earlier batches are gone when later ones arrive, and still count."""
    folder, out, state = stream_dirs(spark)
    for calls in (1, 10, 100):
        batch = usage(spark, [("2024-01-01 12:00:00", calls), (f"2024-01-0{len(str(calls)) + 1} 12:00:00", calls)])
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream_daily_summary(spark, folder, out, state, batch.schema, "DP_TS").awaitTermination()
        for path in files_of(folder):
            path.write_bytes(b"")
    found = sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()
    assert {str(r["Date"])[-2:]: r["Total_Outgoing_Calls"] for r in found} == {"01": 111, "02": 1, "03": 10, "04": 100}


def test_replayed_batches_count_once(spark):
    _, out, state = stream_dirs(spark)
    partials = daily_partials(spark, state)
    for batch_id, calls in ((0, 1), (1, 10), (1, 10), (2, 5), (2, 7)):
        batch = usage(spark, [("2024-01-01 12:00:00", calls)])
        add_to_summary(partials, batch, batch_id, out, "DP_TS")
    (row,) = sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()
    assert row["Total_Outgoing_Calls"] == 18  # the last try of each batch


def test_many_batches_are_merged(spark):
    _, out, state = stream_dirs(spark)
    partials = daily_partials(spark, state)
    partials.most_folders = 3
    for batch_id in range(9):
        batch = usage(spark, [("2024-01-01 12:00:00", 1), (f"2024-01-{batch_id + 2:02} 12:00:00", batch_id), (None, 1)])
        add_to_summary(partials, batch.coalesce(1), batch_id, out, "DP_TS")
    names = sorted(p.name for p in pathlib.Path(f"{state}/partials").iterdir())
    assert names[-1].startswith("upto=") and len(names) <= 5
    found = {r["Date"]: r["Total_Outgoing_Calls"] for r in sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()}
    assert found[None] == 9 and found[datetime.date(2024, 1, 1)] == 9
    assert [found[datetime.date(2024, 1, i + 2)] for i in range(9)] == list(range(9))


def test_an_unfinished_merge_does_not_count(spark):
    _, out, state = stream_dirs(spark)
    partials = daily_partials(spark, state)
    for batch_id in range(2):
        add_to_summary(partials, usage(spark, [("2024-01-01 12:00:00", 1)]), batch_id, out, "DP_TS")
    broken = pathlib.Path(f"{state}/partials/upto=0")
    broken.mkdir()
    add_to_summary(partials, usage(spark, [("2024-01-01 12:00:00", 1)]), 2, out, "DP_TS")
    (row,) = sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()
    assert row["Total_Outgoing_Calls"] == 3


def test_an_empty_batch_changes_nothing(spark):
    _, out, state = stream_dirs(spark)
    partials = daily_partials(spark, state)
    batch = usage(spark, [("2024-01-01 12:00:00", 1)])
    add_to_summary(partials, batch, 0, out, "DP_TS")
    add_to_summary(partials, batch.limit(0), 1, out, "DP_TS")
    (row,) = sinks.read_if_present(spark, out, SUMMARY_SCHEMA).collect()
    assert row["Total_Outgoing_Calls"] == 1


def test_predictions_are_not_read_twice(spark, sf):
    """Halves of every day arrive one after the other; the first is gone when the second comes."""
    rows = materialize(inputs.predictions(spark, sf), "predictions")
    folder, out, state = stream_dirs(spark)
    half = F.xxhash64("User") % 2 == 0
    for part in (rows.where(half), rows.where(~half)):
        part.write.mode("append").parquet(folder)
        monitor_stream(spark, folder, out, state, rows.schema).awaitTermination()
        for path in files_of(folder):
            path.write_bytes(b"")
    read = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/report")
    want = {str(r["chunk"]): r for r in monitor(rows).collect()}
    got = {str(r["chunk"]): r for r in read.collect()}
    assert set(got) == set(want)
    for day, row in want.items():
        for name in ("n", "roc_auc", "f1", "accuracy", "roc_auc_lower", "f1_upper"):
            assert got[day][name] == (None if row[name] is None else pytest.approx(row[name]))


def test_prepare_answers_for_its_own_run(spark, sf):
    ranges = plans.DateRanges("2024-01-02", "2024-01-10", "2024-01-02", "2024-01-10")
    rows = inputs.cdr(spark, sf)
    target = scratch_path(spark, "processed")
    first = plans.prepare(spark, ranges, rows, target).count()
    assert first > 0
    assert plans.prepare(spark, ranges, rows.limit(0), target).isEmpty()
    with pytest.raises(ValueError):
        plans.run(spark, ranges, rows.limit(0), target)
    left = rows.where("DP_DATE <> date'2024-01-05'")
    again = plans.prepare(spark, ranges, left, target)
    assert again.where("Date = '2024-01-05'").isEmpty()
    assert spark.read.parquet(target).count() == again.count() < first


def test_monitoring_follows_new_rows_of_an_old_day(spark, sf):
    rows = materialize(inputs.predictions(spark, sf), "predictions")
    folder, out, state = stream_dirs(spark)
    half = F.xxhash64("User") % 2 == 0
    for part in (rows.where(half), rows.where(~half)):
        part.write.mode("append").parquet(folder)
        monitor_stream(spark, folder, out, state, rows.schema).awaitTermination()
    read = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/report")
    got = {str(r["chunk"]): (r["n"], r["f1"], r["f1_alert"]) for r in read.collect()}
    want = {str(r["chunk"]): (r["n"], r["f1"], r["f1_alert"]) for r in monitor(rows).collect()}
    assert set(got) == set(want)
    for day, (n, f1, alert) in want.items():
        assert got[day][0] == n and got[day][2] == alert
        assert got[day][1] == (None if f1 is None else pytest.approx(f1))


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert named is None or path.startswith(named)


def test_union_all_keeps_copies(spark):
    assert sources.union_all(spark.range(3), spark.range(2), spark.range(1)).count() == 6


@pytest.mark.parametrize("name", ["run_job", "train_job"])
def test_job_queries_search_the_whole_grid_on_all_days(spark, sf, monkeypatch, name):
    searched = []

    def search(df, **options):
        searched.append((options, df.count()))
        return train(df, **{**options, "trees": (2,), "depths": (2,), "folds": 2})

    train, build, made = model.train, features.build_features, []
    monkeypatch.setattr(queries, "TRAIN_ROWS", 300)
    monkeypatch.setattr(model, "train", search)
    monkeypatch.setattr(features, "build_features", lambda df, *a: made.append(df) or build(df, *a))
    assert queries.QUERIES[name](spark, sf).first()["rows_known"]
    ((options, n),) = searched
    # The defaults of the grid and the number of folds.
    assert options == {"seed": 42, "fold_by": ["Date", "User"]}
    assert 200 < n < 400
    days = inputs.processed(spark, sf).select("Date").distinct().count()
    assert made[0].select("Date").distinct().count() == days == 30


@pytest.mark.parametrize("name", ["run_job", "train_job", "churn_predictions"])
def test_job_queries_learn_from_the_whole_training_part(spark, tmp_path, monkeypatch, name):
    day = F.pmod(F.col("id"), F.lit(20)).cast("int")
    events = spark.range(6000).select(
        F.col("id").alias("event_id"),
        (F.col("id") / 20).cast("long").alias("user_id"),
        F.date_add(F.lit("2024-01-01"), day).cast("timestamp").alias("ts"),
        F.element_at(F.array(*map(F.lit, ["click", "view", "purchase"])), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 17).cast("double").alias("value"),
    )
    # Every seventh day of a subscriber is missing, so the day before it is labelled 1.
    events.where(F.pmod(F.xxhash64("user_id") + day, F.lit(7)) > 0).write.parquet(f"{tmp_path}/events.parquet")
    learned, parts = [], []

    def search(df, **options):
        learned.append(df.count())
        return train(df, **{**options, "trees": (2,), "depths": (2,), "folds": 2})

    def split(*args):
        parts.append(divide(*args))
        return parts[-1]

    train, divide = model.train, model.random_split
    monkeypatch.setattr(model, "train", search)
    monkeypatch.setattr(model, "random_split", split)
    queries.QUERIES[name](spark, str(tmp_path)).collect()
    if name == "churn_predictions":
        key = F.col("User").cast("long") * 31 + F.dayofmonth(F.col("Date").cast("date"))
        rows = inputs.labelled(spark, str(tmp_path)).where(F.pmod(key, F.lit(10)) < 8)
        counted = dict(rows.groupBy(TARGET).count().collect())
        whole = counted[0] + 20 * counted[1]
    else:
        whole = parts[0][0].count()
    assert learned == [whole] and whole > 5000
