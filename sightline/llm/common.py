"""Small helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import cut_lineage, prepare

# Long texts make heavy rows: batches to Python are kept small in rows and bytes.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
}


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on."""
    for key, value in ARROW.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def wide(df: DataFrame) -> int:
    """Partitions for work on shuffled blobs: what the session is set to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b), root being its smallest node.

    Alternating large-star and small-star: every round hangs neighbours on the smallest one seen, so
    the rounds grow with the logarithm of the longest path. A node with very many neighbours is
    only ever aggregated (min) and joined, never listed. Empty edges give an empty frame. ``max_rounds`` drops
    nothing: components that have not settled by then raise an error.
    """
    ready(edges.sparkSession)
    current = cut_lineage(edges.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("m AS a", "b").where("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        current = cut_lineage(small)
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.groupBy("b").agg(F.min("a").alias("root")).selectExpr("b AS node", "root").union(
        current.selectExpr("a AS node", "a AS root").distinct()
    )


def labelled_ids(labels: DataFrame, label: str, modulus: int, held_out: int, most: int, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, y) of at most ``most`` labelled documents outside the held-out fold, the least by a hash of the id.

    Labels that are null are left out; a document labelled twice counts once, with its least label.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, modulus) != held_out))
    known = known.groupBy(id_col).agg(F.min(label).cast("double").alias("y"))
    return known.orderBy(F.xxhash64(id_col), id_col).limit(most)
