"""Readers and writers for tables, JSON lines, flat exports and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.schemas import ENUMERATIONS, PROBE, TABLES
from sightline.session import JSON_TIMES


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table of the data model with its fixed schema."""
    return spark.read.schema(TABLES[name]).format(fmt).load(f"{root}/{name}")


def read_jdbc(
    spark: SparkSession, url: str, name: str, id_column: str, lower: int, upper: int, partitions: int = 64,
    fetch_size: int = 10_000, **options: str,
) -> DataFrame:
    """A table from a database, read in id ranges in parallel. Needs the driver jar on the classpath."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=name, partitionColumn=id_column, lowerBound=str(lower), upperBound=str(upper),
        numPartitions=str(partitions), fetchsize=str(fetch_size), **options,
    )
    return reader.load()


def read_probe_log(spark: SparkSession, path: str) -> DataFrame:
    """Probe records from JSON lines; blank lines do not count."""
    return spark.read.schema(PROBE).json(path).filter("timestamp_utc is not null or endpoint_kind is not null")


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(**JSON_TIMES).json(path)


def _leaf_columns(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out = []
    for field in schema.fields:
        here = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            out += _leaf_columns(field.dataType, here)
        else:
            out.append(here)
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects to columns with dotted names; lists and maps become JSON text."""

    def column(path: tuple[str, ...]) -> Column:
        value = F.col(".".join(f"`{p}`" for p in path))
        kind = df.schema
        for p in path:
            kind = kind[p].dataType if isinstance(kind, T.StructType) else kind
        if isinstance(kind, (T.ArrayType, T.MapType)):
            value = F.to_json(value)
        return value.alias(".".join(path))

    return df.select(*[column(p) for p in _leaf_columns(df.schema)])


def write_csv(df: DataFrame, path: str) -> None:
    flatten(df).write.mode("errorifexists").options(**JSON_TIMES).csv(path, header=True)


def report_rows(df: DataFrame) -> DataFrame:
    """A one-row report as (metric, value) text rows."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in df.columns])
    return text.unpivot([], df.columns, "metric", "value")


def contract_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows whose status columns hold a value outside the enumerations."""
    bad = F.lit(False)
    for name, allowed in ENUMERATIONS.items():
        owner, column = name.split(".")
        if owner == table and column in df.columns:
            bad = bad | (F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return df.filter(bad)
