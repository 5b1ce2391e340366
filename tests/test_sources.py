"""Tables with fixed schemas, JSON lines, status contracts and default windows."""

import datetime as dt

from pyspark.sql import functions as F

from sightline.operators import coverage as cov
from sightline.schemas import ARCHIVE_DATASETS, TABLES
from sightline.session import scratch_path
from sightline.sources import scans
from sightline.sources import tables as tb

START = dt.datetime(2026, 5, 26, 10, 0, 0, 123456)


def test_all_schemas_parse_and_scans_deliver_their_columns(spark):
    assert len(TABLES) == 14
    empty = {name: spark.createDataFrame([], ddl) for name, ddl in TABLES.items()}
    assert set(scans.SCANS) == set(ARCHIVE_DATASETS)
    for key in scans.SCANS:
        assert scans.dataset_rows(empty, key).columns == scans.dataset_columns(key)


def test_table_round_trip_with_fixed_schema(spark, rows):
    root = scratch_path(spark, "t-tables")
    ddl = TABLES["vacancy_seen_event"]
    data = [(1, "v", "r", "p", START, 0, "h", None)]
    spark.createDataFrame(data, ddl).write.parquet(f"{root}/vacancy_seen_event")
    out = tb.read_table(spark, root, "vacancy_seen_event")
    assert out.schema == spark.createDataFrame([], ddl).schema
    assert out.count() == 1


def test_json_lines_keep_microseconds(spark):
    path = scratch_path(spark, "t-lines")
    df = spark.createDataFrame([(1, START)], "i long, t timestamp_ntz")
    tb.append_json_lines(df, path)
    tb.append_json_lines(df, path)
    back = spark.read.schema(df.schema).json(path).collect()
    assert [tuple(r) for r in back] == [(1, START), (1, START)]


def test_status_contract(spark, rows):
    df = spark.createDataFrame([(1, "done", "covered"), (2, "lost", "covered"), (3, None, "half")], "id long, status string, coverage_status string")
    assert rows(tb.contract_violations(df, "crawl_partition"), "id") == [(2,), (3,)]


def test_flatten_names_nested_fields_with_dots(spark):
    df = spark.range(1).select("id", F.struct(F.struct(F.lit(1).alias("c")).alias("b"), F.array(F.lit(2)).alias("d")).alias("a"))
    assert tb.flatten(df).columns == ["id", "a.b.c", "a.d"]


def test_window_defaults_to_the_run_start(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, 10, 20)], "id long, window_from long, window_to long")
    started = F.lit(dt.datetime(2000, 1, 1, 0, 0, 7)).cast("timestamp_ntz")
    windows = cov.with_default_window(df, started)
    halves = rows(cov.bisected(windows), "id", "window_from", "window_to")
    base = 946684800
    assert halves == [(1, base, base + 3), (1, base + 3, base + 7), (2, 10, 15), (2, 15, 20)]
