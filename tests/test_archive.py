"""Exports in steps, verification, audits and failure cases on a small archive."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from sightline.sources import archive as ar
from sightline.sources import audit as au
from sightline.sources import scans as sc

SPEC = ar.DatasetSpec("silver/vacancy_seen_event", "seen_event_id", "seen_at")
START = dt.datetime(2026, 5, 26, 10)
LATE = dt.datetime(2027, 1, 1)


def source(spark, count=60):
    data = [(i, f"v{i % 7}", START + dt.timedelta(hours=i)) for i in range(1, count + 1)]
    return spark.createDataFrame(data, "seen_event_id long, vacancy_id string, seen_at timestamp_ntz")


def stored(spark, root, df):
    return ar.read_dataset(spark, root, SPEC, ar.enveloped(df, SPEC).schema)


def references(spark, root):
    inventory = ar.read_inventory(spark, root)
    return inventory.select(
        F.col("export_id").alias("checkpoint_id"), "dataset_key", "manifest_file", "row_count", "source_min_id", "source_max_id",
        F.lit(None).cast("string").alias("receipt_issue"),
    )


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="sightline-archive-")


def test_steps_equal_one_export(spark, root):
    df = source(spark)
    assert ar.export_until_done(df, root, SPEC, LATE, 25) == 60
    ids = [x["seen_event_id"] for x in stored(spark, root, df).select("seen_event_id").collect()]
    assert sorted(ids) == list(range(1, 61))
    points = ar.read_checkpoints(spark, root).orderBy("source_id_before", "source_id_after").collect()
    assert [(p["source_id_before"], p["source_id_after"]) for p in points] == [(0, 25), (25, 50), (50, 60), (60, 60)]
    summary = au.coverage(au.chain_audit(ar.read_checkpoints(spark, root), references(spark, root))).first()
    assert (summary["status"], summary["source_id_covered"], summary["verified_row_count"]) == ("complete", 60, 60)


def test_unsettled_low_id_blocks_higher_ones(spark):
    df = spark.createDataFrame(
        [(1, START), (2, START), (3, None), (4, START), (5, START)], "i long, t timestamp_ntz"
    )
    out = ar.settled_prefix(df, "i", "t", 0, F.lit(LATE).cast("timestamp_ntz"))
    assert sorted(x["i"] for x in out.collect()) == [1, 2]


def test_ids_are_compared_as_numbers(spark, root):
    df = source(spark, 12)
    ar.export_incremental(df, root, SPEC, LATE)
    row = ar.read_inventory(spark, root).agg(F.min("source_min_id"), F.max("source_max_id")).first()
    assert tuple(row) == (1, 12)


def test_partial_export_without_checkpoint_is_ignored(spark, root):
    df = source(spark, 10)
    ar.write_dataset(df, root, SPEC, "torn", F.lit(START).cast("timestamp_ntz"))
    assert ar.cursors(ar.read_checkpoints(spark, root), "incremental").count() == 0
    assert ar.export_incremental(df, root, SPEC, LATE).first()["row_count"] == 10


def test_damage_is_found(spark, root):
    df = source(spark, 40)
    ar.export_incremental(df, root, SPEC, LATE)
    inventory = ar.read_inventory(spark, root)
    counts = stored(spark, root, df).groupBy("data_file").agg(F.count(F.lit(1)).alias("row_count"))
    digests = ar.file_digests(spark, f"{root}/data")
    names = [x["data_file"] for x in inventory.select("data_file").orderBy("data_file").collect()]
    assert len(names) > 1

    def issues(manifests, files=digests, listed=inventory):
        return {x["data_file"]: x["issue"] for x in au.verify_files(manifests, files, counts, listed, root).collect()}

    assert set(issues(inventory).values()) == {None}
    first = F.col("data_file") == names[0]

    def wrong(column, value):
        return inventory.withColumn(column, F.when(first, F.lit(value)).otherwise(F.col(column)))

    cases = {
        "data size mismatch": wrong("data_size_bytes", 1),
        "data checksum mismatch": wrong("data_sha256", "0"),
        "row count mismatch": wrong("row_count", 1000),
        "unsupported format": wrong("format", "avro"),
    }
    for issue, manifests in cases.items():
        found = issues(manifests)
        assert found[names[0]] == issue
        assert found[names[1]] is None
    lost = digests.filter(~F.col("data_file").endswith(names[0].split("/")[-1]))
    assert issues(inventory, lost)[names[0]] == "data file missing"
    assert issues(inventory, digests, inventory.filter(~first))[names[0]] == "manifest not in inventory"


def test_chain_break_stops_the_prefix(spark):
    at = dt.datetime(2026, 1, 1)
    points = spark.createDataFrame(
        [("c1", "d", at, 0, 5, 1, 5), ("c2", "d", at + dt.timedelta(days=1), 6, 9, 1, 3), ("c3", "d", at + dt.timedelta(days=2), 9, 12, 1, 3)],
        "checkpoint_id string, dataset_key string, created_at timestamp, source_id_before long, source_id_after long, chunk_count long, row_count long",
    )
    refs = spark.createDataFrame(
        [("c1", "d", "m1", 5, 1, 5, None), ("c2", "d", "m2", 3, 7, 9, None), ("c3", "d", "m1", 3, 10, 12, None)],
        "checkpoint_id string, dataset_key string, manifest_file string, row_count long, source_min_id long, source_max_id long, receipt_issue string",
    )
    summary = au.coverage(au.chain_audit(points, refs)).first()
    assert (summary["status"], summary["verified_checkpoint_count"], summary["source_id_covered"], summary["issue"]) == ("incomplete", 1, 5, "chain break")
    assert au.overall_status(au.coverage(au.chain_audit(points, refs))).first()["status"] == "incomplete"


def test_dispatch_rejects_bad_requests(spark):
    with pytest.raises(ValueError):
        sc.dataset_rows({}, "gold/none")
    with pytest.raises(ValueError):
        sc.dataset_rows({}, "silver/vacancy", 0)
    with pytest.raises(ValueError):
        ar.export_incremental(source(spark, 1), "/nowhere", ar.spec_of("silver/vacancy"), LATE)


def test_full_export_of_a_point_in_time_dataset(spark, root):
    df = spark.createDataFrame([("1", START), ("2", START)], "vacancy_id string, updated_at timestamp_ntz")
    listed = ar.export_full(df, root, ar.spec_of("silver/vacancy"), START)
    assert {(x["partition"], x["source_max_id"]) for x in listed.collect()} <= {("snapshot_date=2026-05-26", 1), ("snapshot_date=2026-05-26", 2)}
    assert listed.agg(F.sum("row_count")).first()[0] == 2


def test_nth_id_is_found_by_counting(spark):
    ids = sorted({(k * k * 7919) % 50_000_003 for k in range(3000)} | {-5, 2**40, 2**40 + 1})
    df = spark.createDataFrame([(i,) for i in ids + ids[:50]], "id long")
    for n in (1, 1500, len(ids)):
        assert ar.nth_smallest(df, "id", n) == ids[n - 1]
    assert ar.nth_smallest(df, "id", len(ids) + 1) is None and ar.nth_smallest(df, "id", 0) == -6
    assert ar.nth_smallest(df.limit(0), "id", 3) is None and ar.nth_smallest(df.filter("id = -5"), "id", 1) == -5


def test_replicas_are_compared_below_their_own_roots(spark):
    """Both roots hold a folder named data; one file more, one fewer, two that were swapped inside a folder."""
    kind = "data_file string, data_size_bytes long, data_sha256 string"
    names = [f"data/{layer}/day={k % 3}/f{k}" for layer in ("bronze", "silver") for k in range(9)]
    local = [(f"file:/data/a/{n}", 5, n) for n in names]
    kept = [(f"s3a://data/b/data/{n}", 5, n) for n in names]
    same = au.replica_check(spark.createDataFrame(local, kind), spark.createDataFrame(kept, kind), "file:///data/a/", "s3a://data/b/data")
    assert sorted(map(tuple, same.collect())) == [(n, None) for n in sorted(names)]
    swapped = [(f"s3a://data/b/data/{n}", 5, {names[0]: names[3], names[3]: names[0]}.get(n, n)) for n in names if n != names[8]]
    found = au.replica_check(spark.createDataFrame(local, kind), spark.createDataFrame([*swapped, ("s3a://data/b/data/data/x", 1, "x")], kind), "/data/a", "s3a://data/b/data")
    issues = {r["data_file"]: r["issue"] for r in found.collect() if r["issue"]}
    assert issues == {names[0]: "content differs", names[3]: "content differs", names[8]: "missing in replica", "data/x": "unknown file in replica"}
    assert found.count() == len(names) + 1


def test_files_are_cut_by_bytes_and_rows(spark, root):
    """Rows of very unequal size: no file passes either limit, but for one that is a single large row."""
    text = F.repeat(F.lit("x"), F.when(F.col("seen_event_id") % 10 == 3, 900).when(F.col("seen_event_id") == 57, 5000).otherwise(20).cast("int"))
    df = source(spark, 120).withColumn("note", text)
    stored_rows = ar.write_dataset(df, root, SPEC, "e1", F.lit(LATE), 25, 3000).withColumn("size", F.octet_length(F.to_json(F.struct("archive_schema_version", "dataset", *df.columns))) + 1)
    files = stored_rows.groupBy("data_file").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("size").alias("largest")).collect()
    assert sum(f["n"] for f in files) == 120 and max(f["n"] for f in files) <= 25
    assert all(f["size"] <= 3000 or f["n"] == 1 for f in files) and max(f["largest"] for f in files) > 5000
    assert sum(f["n"] == 25 for f in files) + sum(f["size"] > 1900 for f in files) > 3


def test_small_files_share_tasks_and_folders(spark, root):
    """A file for every 10 rows: neither a folder nor a task for each."""
    from sightline.session import fine_splits

    df = source(spark, 60).withColumn("seen_at", F.lit(START).cast("timestamp_ntz"))
    before = {k: spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes")}
    try:
        fine_splits(spark)
        stored_rows = ar.write_dataset(df.coalesce(1), root, SPEC, "e1", F.lit(LATE), 10)
        files = stored_rows.groupBy("data_file").agg(F.count("*").alias("n"), F.min("seen_event_id").alias("low"), F.max("seen_event_id").alias("high")).collect()
        digests = ar.file_digests(spark, root)
        assert sum(f["n"] for f in files) == 60 and max(f["n"] for f in files) <= 10 and len(files) >= 6
        assert all(f["high"] - f["low"] == f["n"] - 1 for f in files)
        assert {f["data_file"].split("/")[-2] for f in files} == {"file_chunk=0"}
        parallel = spark.sparkContext.defaultParallelism
        many = spark.range(40 * parallel).repartition(40 * parallel).select(F.lit(0).alias("x"))
        many.write.json(f"{root}/many")
        assert spark.read.schema("x int").json(f"{root}/many").rdd.getNumPartitions() <= 4 * parallel
        assert digests.count() == len(files)
    finally:
        for key, value in before.items():
            spark.conf.set(f"spark.sql.files.{key}", value)
