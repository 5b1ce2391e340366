"""Joins are broadcast by the bytes found, not by an estimate of a small file; tasks grow in number, not in size."""

from pyspark.sql import functions as F

from sightline.operators.backfill import with_payload
from sightline.plans.bindings import table
from sightline.session import SPREAD_BYTES, prepare, scratch_path, spread


def broadcasts(df):
    """Broadcast joins of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0].count("BroadcastHashJoin")


def test_texts_built_from_a_small_file_are_not_broadcast(spark):
    root = scratch_path(spark, "t-joins")
    spark.range(60000).withColumnRenamed("id", "k").repartition(1).write.parquet(f"{root}/orders.parquet")
    spark.range(10).withColumnRenamed("id", "k").write.parquet(f"{root}/nation.parquet")
    text = F.concat(*[F.col("k").cast("string")] * 60)
    rows = table(spark, root, "orders").select(F.col("k").alias("ref"))
    payloads = table(spark, root, "orders").select(F.col("k").alias("payload_id"), text.alias("payload_json"))
    joined = with_payload(rows, payloads, "ref").agg(F.sum(F.length("payload_json")).alias("n"))
    assert broadcasts(joined) == 0
    small = rows.join(table(spark, root, "nation").select(F.col("k").alias("ref")), "ref")
    assert broadcasts(small.agg(F.count("*"))) == 1


def test_the_threshold_of_the_session_holds(spark):
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    prepare(prepare(fresh))
    assert fresh.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "256k"
    assert fresh.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    off = spark.newSession()
    off.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert prepare(off).conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def test_tasks_grow_in_number_with_the_input(spark):
    root = scratch_path(spark, "t-splits")
    spark.range(4_000_000).select(F.xxhash64("id").alias("k")).repartition(1).write.option("parquet.block.size", 1 << 20).parquet(f"{root}/orders.parquet")
    read = table(spark, root, "orders")  # 32 MB in one file
    assert read.rdd.getNumPartitions() >= 8
    assert spread(read).rdd.getNumPartitions() >= 30 * (1 << 20) // SPREAD_BYTES


def test_drift_shuffles_documents_not_their_leaves(spark, rows):
    """The paths of two rounds meet without a shuffle of single leaves, and differ as a full join of them does."""
    from sightline.operators import normalize as n
    from sightline.operators import study as st

    body = F.concat(F.lit('{"a":'), F.pmod(F.col("id") * F.col("round"), F.lit(3)).cast("string"), F.lit(',"b":[{"c":1},{"c":2}],"d":{"e":null'), F.when(F.col("round") == 1, ',"f":1}}').otherwise("}}"))
    docs = spark.range(40).selectExpr("id", "explode(array(0, 1, 2, 3)) AS round").withColumn("ok", F.pmod(F.col("id") + F.col("round"), F.lit(5)) != 0).withColumn("body", body)
    pairs = st.consecutive_pairs(docs, "id", "round", "ok")
    leaves = n.leaf_values(docs.where("ok"), ["id", "round"], "body", together=True)
    got = st.changed_paths(pairs, leaves, "id", "round")
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert exchanges and not any("path" in line.split("hashpartitioning(")[1] for line in exchanges)

    held = {(r["id"], r["round"], r["path"]): r["leaf_values"] for r in n.leaf_values(docs.where("ok"), ["id", "round"], "body").collect()}
    assert held == {(r["id"], r["round"], r["path"]): r["leaf_values"] for r in leaves.collect()}
    paths = ("a", "b[].c", "d.e", "d.f")
    want = [(i, a, b, p) for i, a, b, ok in map(tuple, pairs.collect()) if ok for p in paths if held.get((i, a, p)) != held.get((i, b, p))]
    assert rows(got) == sorted(want, key=repr) and len(want) > 40
