import datetime

import pytest
from pyspark.sql import functions as F

from usagelens import sinks, sources
from usagelens.schemas import PROCESSED_SCHEMA, RAW_SCHEMA
from usagelens.storage import scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def edges(spark):
    times = [
        "2024-01-01 23:59:59.999999",
        "2024-01-02 00:00:00",
        "2024-01-03 00:00:00",
        "2024-01-03 00:00:01",
        "2024-01-03 23:59:59.999999",
        "2024-01-04 00:00:00",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, DP_DATE string")
    return rows


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_date_scan_includes_the_end_day(spark, edges, kind):
    df = edges.withColumn("DP_DATE", F.col("DP_DATE").cast(kind))
    assert ids(sources.scan_cdr(spark, df, "2024-01-02", "2024-01-03")) == [1, 2, 3, 4]


def test_text_scan_leaves_out_times_on_the_end_day(edges):
    assert ids(sources.scan_string_range(edges, "DP_DATE", "2024-01-02", "2024-01-03")) == [1]
    assert ids(sources.scan_string_range(edges, "DP_DATE", "2024-01-02", "2024-25-26")) == [1, 2, 3, 4, 5]


def test_date_scan_reaches_parquet(spark, sf):
    plan = plan_of(sources.scan_cdr(spark, f"{sf}/events.parquet", "2024-01-02", "2024-01-03", "ts"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_processed_scan_prunes_partitions(spark):
    rows = [(f"2024-01-0{i}", "u", 1, 1.0, 1.0, 1, 1, 1.0, 0) for i in range(1, 6)]
    target = scratch_path(spark, "pruned")
    sinks.replace_dates(spark.createDataFrame(rows, PROCESSED_SCHEMA), target)
    scan = sources.scan_processed(spark, target, "2024-01-02", "2024-01-03")
    assert "PartitionFilters: [isnotnull(Date" in plan_of(scan)
    assert scan.count() == 2 and dict(scan.dtypes)["Date"] == "string"


def test_prediction_scan_reads_five_columns(spark):
    target = scratch_path(spark, "predictions")
    spark.createDataFrame(
        [(0, 1.0, 0.4, 0.6, "2024-01-01", "extra")],
        "label int, prediction double, probability_0 double, probability_1 double, Date string, x string",
    ).write.parquet(target)
    plan = plan_of(sources.scan_predictions(spark, target))
    assert "ReadSchema: struct<label:int,prediction:double" in plan and "x:string" not in plan


def test_replace_dates_is_idempotent_and_local(spark):
    target = scratch_path(spark, "replaced")
    make = lambda rows: spark.createDataFrame(rows, "Date string, v int")
    sinks.replace_dates(make([("2024-01-01", 1), ("2024-01-02", 2)]), target)
    for _ in range(2):
        sinks.replace_dates(make([("2024-01-02", 3)]), target)
    got = spark.read.schema("Date string, v int").parquet(target).select("Date", "v").collect()
    assert sorted(map(tuple, got)) == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_load_once(spark):
    target = scratch_path(spark, "once")
    calls = []

    def loader(n):
        def load():
            calls.append(n)
            return spark.range(n)

        return load

    assert sinks.load_once(spark, target, loader(0)).count() == 0
    assert sinks.load_once(spark, target, loader(3)).count() == 3
    assert sinks.load_once(spark, target, loader(5)).count() == 3
    assert calls == [0, 3]


def test_snapshot_name(spark):
    path = sinks.write_snapshot(
        spark.range(1), scratch_path(spark, "snap"), datetime.datetime(2024, 10, 10, 13, 5, 21)
    )
    assert path.endswith("/processed_data_2024-10-10_130521.parquet")


def test_csv_missing_texts_and_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,NaN\n,2\nNA,3.5\n")
    got = sources.load_csv_untyped(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["x"], r["y"]) for r in got] == [("1", None), (None, "2"), (None, "3.5")]
    assert len({r["id"] for r in got}) == 3
    (tmp_path / "a.csv").write_text("id,y\n1,2\n")
    with pytest.raises(ValueError):
        sources.load_csv_untyped(spark, str(tmp_path))


def test_typed_csv_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        ",".join(RAW_SCHEMA.fieldNames())
        + "\n1,2024-01-01 10:00:00,77,1,2.5,3,4.5,5,6,7,8.5,1\n2,2024-01-01,78,many,2.5,3,4.5,5,6,7,8.5,0\n"
    )
    good, bad = sources.load_csv_typed(spark, str(tmp_path), RAW_SCHEMA).orderBy("id").collect()
    assert good["_corrupt_record"] is None and good["DP_DATA_VOLUME"] == 8.5
    assert bad["DP_MOC_COUNT"] is None and bad["_corrupt_record"].startswith("2,2024-01-01")


def test_seed_rows_parse_dates(spark, edges):
    got = sources.seed_rows(edges, 4)
    assert got.count() == 4 and dict(got.dtypes)["DP_DATE"] == "timestamp"


def test_jdbc_reads_one_partition_per_day():
    source = sources.JdbcSource("jdbc:mysql://host/db", "DP_CDR_Data")
    assert source.day_predicates("2024-02-28", "2024-03-01") == [
        "DP_DATE >= '2024-02-28' AND DP_DATE < '2024-02-29'",
        "DP_DATE >= '2024-02-29' AND DP_DATE < '2024-03-01'",
        "DP_DATE >= '2024-03-01' AND DP_DATE < '2024-03-02'",
    ]


def test_jdbc_splits_days_and_whole_tables():
    source = sources.JdbcSource("url", "t", split="id", parts=3, delay=0)
    parts = ["(ABS(id % 3) = 0 OR id IS NULL)", "ABS(id % 3) = 1", "ABS(id % 3) = 2"]
    day = "DP_DATE >= '2024-02-28' AND DP_DATE < '2024-02-29'"
    assert source.day_predicates("2024-02-28", "2024-02-28") == [f"{day} AND {p}" for p in parts]
    session = FakeSession(0)
    source.read(session)
    assert session.calls[0][2] == parts


def test_jdbc_raises_other_errors_at_once():
    session = FakeSession(1, RuntimeError("no such table"))
    with pytest.raises(RuntimeError):
        sources.JdbcSource("url", "t", retries=3, delay=0).read(session)
    assert len(session.calls) == 1


class FakeSession:
    """Stands for a session whose database answers only after some failures."""

    def __init__(self, failures, error=OSError("refused")):
        self.failures, self.error, self.calls = failures, error, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((url, table, predicates, properties))
        if len(self.calls) <= self.failures:
            raise self.error
        return "frame"


def test_jdbc_retries():
    source = sources.JdbcSource("url", "t", properties={"user": "u"}, retries=3, delay=0)
    session = FakeSession(2)
    assert source.read(session) == "frame" and len(session.calls) == 3
    assert session.calls[0] == ("url", "t", None, {"user": "u"})
    with pytest.raises(ConnectionError):
        source.read(FakeSession(3))
    session = FakeSession(0)
    sources.scan_cdr(session, source, "2024-01-01", "2024-01-02")
    assert len(session.calls[0][2]) == 2


def test_json_records(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b double, c string")
    assert sinks.to_json_records(df).first()[0] == '{"a":1,"b":null,"c":"x"}'


def test_seed_rows_move_no_rows(spark):
    rows = spark.range(0, 1000, 1, 7).select("id", F.lit("2024-01-01").alias("DP_DATE"))
    for n in (0, 1, 143, 500, 1000, 5000):
        found = sources.seed_rows(rows, n)
        assert found.count() == min(n, 1000) and found.columns == rows.columns
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_seed_scan_reads_the_first_files_only(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(0, 100, 1, 1).select(
        "id", F.lit("2024-01-01").alias("DP_DATE"), (F.col("id") >= 80).cast("int").alias("part 1")
    )
    for i in range(8):
        rows.where(F.col("id") % 8 == i).write.mode("append").partitionBy("part 1").parquet(path)
    schema = spark.read.parquet(path).schema
    files = sorted((tmp_path / "table").rglob("*.parquet"))
    assert len(files) == 16
    for file in files[4:]:
        file.write_bytes(b"no table")
    for n in (1, 10, 11, 25):
        found = sources.scan_seed(spark, path, n, schema)
        got = found.collect()
        assert len({r["id"] for r in got}) == len(got) == n
        assert found.columns == schema.names and {r["part 1"] for r in got} == {0}


def test_seed_scan_of_small_and_empty_tables(spark, tmp_path):
    rows = spark.range(0, 30, 1, 3).select("id", F.lit("2024-01-01").alias("DP_DATE"))
    for name, df in (("small", rows), ("empty", rows.limit(0))):
        path = str(tmp_path / name)
        df.write.parquet(path)
        assert sources.scan_seed(spark, path, 50).count() == df.count()
        assert sources.scan_seed(spark, path, 0).count() == 0
