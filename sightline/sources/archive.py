"""Archive export: settled prefix, partitioned files, manifests, inventory and checkpoints.

Layout below an archive root::

    data/<layer>/<dataset>/export_id=<id>/<type=..>/<year=..>/<month=..>/<day=..>/part-*.json.gz
    inventory/export_id=<id>/        manifest rows, one per data file
    checkpoints/export_id=<id>/      one row per dataset, written last: the commit marker
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import datetime as dt
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.functions.scalars import safe_path_component
from sightline.schemas import ARCHIVE_DATASETS, ARCHIVE_SCHEMA_VERSION, CHECKPOINT, MANIFEST
from sightline.session import JSON_TIMES, cut_lineage

ROWS_PER_FILE = 1_000_000
BYTES_PER_FILE = 256 * 1024 * 1024  # of JSON text, before compression
INCREMENTAL = tuple(k for k, s in ARCHIVE_DATASETS.items() if not s["point_in_time"])


@dataclass(frozen=True)
class DatasetSpec:
    key: str
    id_field: str
    observed_field: str
    type_field: str | None = None
    point_in_time: bool = False

    @property
    def layer(self) -> str:
        return self.key.split("/")[0]

    @property
    def name(self) -> str:
        return self.key.split("/")[1]


def spec_of(key: str) -> DatasetSpec:
    if key not in ARCHIVE_DATASETS:
        raise ValueError(f"unknown archive dataset: {key}")
    s = ARCHIVE_DATASETS[key]
    return DatasetSpec(key, s["id_field"], s["observed_field"], s["type_field"], s["point_in_time"])


def settled_prefix(
    df: DataFrame, row_id: str, observed: str, after: int, settled_before: Column, limit: int | None = None
) -> DataFrame:
    """Rows above ``after`` and below the first row that is not settled yet.

    One unsettled low id holds back all higher ids, so a later row never overtakes it. With a
    limit, the first n ids of that prefix, found by counting.
    """
    beyond = df.filter(F.col(row_id) > after)
    open_rows = beyond.filter(F.col(observed).isNull() | (F.col(observed) > settled_before))
    if limit is None:
        stop = open_rows.agg(F.min(row_id)).scalar()
        return beyond.filter(stop.isNull() | (F.col(row_id) < stop))
    stop = open_rows.agg(F.min(row_id)).first()[0]
    ready = beyond if stop is None else beyond.filter(F.col(row_id) < stop)
    cut = nth_smallest(ready, row_id, limit)
    return ready if cut is None else ready.filter(F.col(row_id) <= cut)


CLASSES = 1024  # into which a stretch of ids is counted


def nth_smallest(df: DataFrame, row_id: str, n: int) -> int | None:
    """The ``n``-th distinct id in ascending order, null if there are not as many; for ``n`` below 1, one below the least.

    A stretch of ids is cut into equal classes, the ids of each are counted, and the class that holds the n-th is cut again.
    No task sorts ids, and from the second round on a scan can skip what lies outside the stretch.
    """
    low, high = df.agg(F.min(row_id), F.max(row_id)).first()
    if low is None:
        return None
    if n < 1:
        return low - 1
    ids = df.select(F.col(row_id).alias("id")).distinct()
    while low < high:
        width = -(-(high - low + 1) // CLASSES)
        inside = ids.filter(F.col("id").between(low, high))
        class_ = F.floor((F.col("id") - F.lit(low)) / F.lit(width)) if width > 1 else F.col("id") - F.lit(low)
        counts = sorted(map(tuple, inside.groupBy(class_.cast("long")).agg(F.count("*")).collect()))
        for k, count in counts:
            if n <= count:
                low, high = low + k * width, min(high, low + (k + 1) * width - 1)
                break
            n -= count
        else:
            return None
    return low if n <= 1 else None


def partition_columns(spec: DatasetSpec, exported_at: Column) -> dict[str, Column]:
    """Hive partition columns of a dataset; a missing time falls back to the export time."""
    if spec.point_in_time:
        return {"snapshot_date": F.date_format(exported_at, "yyyy-MM-dd")}
    out: dict[str, Column] = {}
    if spec.type_field:
        kind = F.coalesce(F.nullif(F.col(spec.type_field), F.lit("")), F.lit("unknown"))
        out[f"p_{spec.type_field}"] = safe_path_component(kind)
    time = F.coalesce(F.col(spec.observed_field), exported_at)
    out.update(year=F.date_format(time, "yyyy"), month=F.date_format(time, "MM"), day=F.date_format(time, "dd"))
    return out


def enveloped(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows with the archive schema version and the dataset name."""
    return df.select(
        F.lit(ARCHIVE_SCHEMA_VERSION).alias("archive_schema_version"), F.lit(spec.name).alias("dataset"), *df.columns
    )


def below(path: Column, root: str) -> Column:
    """``path`` relative to ``root``, whatever scheme and authority either is written with; a relative path stays."""
    bare = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    base = re.sub(bare, "", root).rstrip("/") + "/"
    plain = F.regexp_replace(path, bare, "")
    return F.when(F.startswith(plain, F.lit(base)), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def data_path(root: str, spec: DatasetSpec, export_id: str) -> str:
    return f"{root}/data/{spec.layer}/{spec.name}/export_id={export_id}"


def chunk_numbers(rows_per_file: int, bytes_per_file: int):
    """Number of the folder a row goes to, from (folder, size) of the rows of a task in order: a new one where the open file
    would pass the bytes. Files of a folder follow each other after ``rows_per_file`` rows, as the writer cuts them, so folders
    do not grow in number with the rows. Only a single row that is larger than the limit makes a larger file."""

    @F.pandas_udf("int")
    def number(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        folder, rows, held, chunk = None, 0, 0, 0
        for folders, sizes in batches:
            out = []
            for name, size in zip(folders, sizes):
                if name != folder:
                    folder, rows, held, chunk = name, 0, 0, 0
                elif rows >= rows_per_file:
                    rows, held = 0, 0
                elif held + size > bytes_per_file:
                    rows, held, chunk = 0, 0, chunk + 1
                rows, held = rows + 1, held + size
                out.append(chunk)
            yield pd.Series(out, dtype="int32")

    return number.asNondeterministic()  # it depends on the order of the rows, so the sort below it has to stay


def write_dataset(
    df: DataFrame, root: str, spec: DatasetSpec, export_id: str, exported_at: Column,
    rows_per_file: int = ROWS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE, fmt: str = "json",
) -> DataFrame:
    """Write the rows of one export and read them back with their file names.

    Rows are range-partitioned by (partition columns, id): a day holding a third of all rows is
    spread over many tasks, and every file covers one narrow id range. Files are cut where rows (by the writer) or bytes (of
    the JSON lines, before compression; a new folder ``file_chunk``) run full.
    """
    parts = partition_columns(spec, exported_at)
    rows = enveloped(df, spec)
    size = F.octet_length(F.to_json(F.struct(*rows.columns))) + 1
    path = data_path(root, spec, export_id)
    sized = rows.withColumn("_size", size).withColumns(parts)
    placed = sized.repartitionByRange(*parts, spec.id_field).sortWithinPartitions(*parts, spec.id_field)
    cut = placed.withColumn("file_chunk", chunk_numbers(rows_per_file, bytes_per_file)(F.concat_ws("/", *parts), "_size")).drop("_size")
    writer = cut.sortWithinPartitions(*parts, "file_chunk", spec.id_field).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*parts, "file_chunk")
    if fmt == "json":
        writer.options(compression="gzip", **JSON_TIMES).json(path)
    else:
        writer.format(fmt).save(path)
    return read_files(df.sparkSession, path, enveloped(df, spec).schema, fmt)


def read_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.options(**JSON_TIMES)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("data_file"))


def read_dataset(
    spark: SparkSession, root: str, spec: DatasetSpec, schema: StructType, limit: int | None = None
) -> DataFrame:
    """Archive rows tagged with dataset key and file, over all exports."""
    path = f"{root}/data/{spec.layer}/{spec.name}"
    rows = read_files(spark, path, schema).withColumn("dataset_key", F.lit(spec.key))
    return rows if limit is None else rows.limit(limit)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of every data file below a path. Files are bounded by the rows per file."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    )
    return files.select(
        F.col("path").alias("data_file"), F.col("length").alias("data_size_bytes"),
        F.sha2("content", 256).alias("data_sha256"), F.col("modificationTime").alias("modified_at"),
    )


def manifests(
    rows: DataFrame, digests: DataFrame, spec: DatasetSpec, export_id: str, kind: str, created_at: Column, root: str,
    fmt: str = "jsonl",
) -> DataFrame:
    """One manifest per data file: rows, numeric id range, time range, size and digest."""
    number = F.col(spec.id_field).cast("long")
    stats = rows.groupBy("data_file").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(number).alias("source_min_id"),
        F.max(number).alias("source_max_id"),
        F.min(spec.observed_field).cast("timestamp").alias("source_min_observed_at"),
        F.max(spec.observed_field).cast("timestamp").alias("source_max_observed_at"),
    )
    joined = stats.join(digests, "data_file", "left")
    relative = below(F.col("data_file"), root)
    partition = F.regexp_extract("data_file", r"export_id=[^/]*/(.*)/file_chunk=[^/]*/[^/]*$", 1)
    chunk = F.coalesce(F.try_element_at(F.split(F.regexp_extract("data_file", r"part-(\d+)", 1), "x"), F.lit(1)), F.lit("0"))
    names = StructType.fromDDL(MANIFEST).fieldNames()
    return joined.withColumns(
        {
            "export_id": F.lit(export_id), "dataset": F.lit(spec.name), "dataset_key": F.lit(spec.key),
            "layer": F.lit(spec.layer), "archive_schema_version": F.lit(ARCHIVE_SCHEMA_VERSION),
            "archive_kind": F.lit(kind), "partition": partition, "chunk_index": chunk.cast("int"),
            "manifest_file": F.concat(relative, F.lit(".manifest")), "data_file": relative,
            "compression": F.lit("gzip"), "format": F.lit(fmt), "created_at": created_at.cast("timestamp"),
        }
    ).select(*names)


def checkpoint_rows(
    manifest_rows: DataFrame, spec: DatasetSpec, export_id: str, kind: str, before: int, created_at: Column,
    settled_before: Column,
) -> DataFrame:
    """The commit row of one dataset of one export; without rows the cursor stays.

    Its manifests are the inventory rows with the same export id, not a list inside the row.
    """
    done = manifest_rows.agg(
        F.greatest(F.coalesce(F.max("source_max_id"), F.lit(before)), F.lit(before)).cast("long").alias("source_id_after"),
        F.count(F.lit(1)).alias("chunk_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("row_count"),
    )
    names = StructType.fromDDL(CHECKPOINT).fieldNames()
    return done.withColumns(
        {
            "checkpoint_id": F.lit(export_id), "archive_kind": F.lit(kind), "dataset_key": F.lit(spec.key),
            "created_at": created_at.cast("timestamp"), "settled_before": settled_before.cast("timestamp"),
            "source_id_before": F.lit(before).cast("long"),
        }
    ).select(*names)


def _read_json_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON table, or an empty one while the folder does not exist."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).options(**JSON_TIMES).json(path)


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    return _read_json_table(spark, f"{root}/inventory", MANIFEST)


def read_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    return _read_json_table(spark, f"{root}/checkpoints", CHECKPOINT)


def cursors(checkpoints: DataFrame, kind: str) -> DataFrame:
    """Highest exported id per dataset. Files without a checkpoint do not count."""
    return checkpoints.filter(F.col("archive_kind") == kind).groupBy("dataset_key").agg(
        F.max("source_id_after").alias("source_id")
    )


def export_incremental(
    df: DataFrame, root: str, spec: DatasetSpec, settled_before: dt.datetime, kind: str = "incremental",
    limit: int | None = None, rows_per_file: int = ROWS_PER_FILE, exported_at: dt.datetime | None = None,
) -> DataFrame:
    """Export what settled since the last checkpoint; returns the checkpoint row."""
    if spec.point_in_time:
        raise ValueError(f"{spec.key} is a full copy and cannot be exported incrementally")
    spark = df.sparkSession
    known = cursors(read_checkpoints(spark, root), kind).filter(F.col("dataset_key") == spec.key).first()
    before = int(known["source_id"]) if known else 0
    now = exported_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    export_id = f"{spec.name}-{before + 1:020d}-{uuid.uuid4().hex[:8]}"
    created, settled = F.lit(now).cast("timestamp_ntz"), F.lit(settled_before).cast("timestamp_ntz")
    chosen = settled_prefix(df, spec.id_field, spec.observed_field, before, settled, limit)
    return _commit(chosen, root, spec, export_id, kind, before, created, settled, rows_per_file)


def export_full(
    df: DataFrame, root: str, spec: DatasetSpec, exported_at: dt.datetime, kind: str = "full",
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Export a whole dataset as of a day; returns its manifest rows."""
    export_id = f"{spec.name}-{exported_at:%Y%m%d}-{uuid.uuid4().hex[:8]}"
    created = F.lit(exported_at).cast("timestamp_ntz")
    rows = write_dataset(df, root, spec, export_id, created, rows_per_file)
    digests = file_digests(df.sparkSession, data_path(root, spec, export_id))
    out = cut_lineage(manifests(rows, digests, spec, export_id, kind, created, root))
    out.write.mode("overwrite").options(**JSON_TIMES).json(f"{root}/inventory/export_id={export_id}")
    return out


def _commit(
    chosen: DataFrame, root: str, spec: DatasetSpec, export_id: str, kind: str, before: int, created: Column,
    settled: Column, rows_per_file: int,
) -> DataFrame:
    rows = write_dataset(chosen, root, spec, export_id, created, rows_per_file)
    digests = file_digests(chosen.sparkSession, data_path(root, spec, export_id))
    listed = cut_lineage(manifests(rows, digests, spec, export_id, kind, created, root))
    listed.write.mode("overwrite").options(**JSON_TIMES).json(f"{root}/inventory/export_id={export_id}")
    point = cut_lineage(checkpoint_rows(listed, spec, export_id, kind, before, created, settled))
    point.write.mode("overwrite").options(**JSON_TIMES).json(f"{root}/checkpoints/export_id={export_id}")
    return point


def export_until_done(df: DataFrame, root: str, spec: DatasetSpec, settled_before: dt.datetime, step: int) -> int:
    """Repeat bounded exports until one brings no row; returns the number of rows exported."""
    total = 0
    while True:
        count = export_incremental(df, root, spec, settled_before, limit=step).first()["row_count"]
        if not count:
            return total
        total += count
