"""Winners by a packed (time, id) against the plain window, and the plan they run as."""

import itertools

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sightline.operators import normalize as n
from sightline.operators.latest import dedupe_last_wins, earliest_per_key, latest_per_key, latest_value, packed_order, superseded

TIMES = [None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-01-01 00:00:00.000001", "9999-12-31 23:59:59"]
IDS = [None, -(2**63), -1, 0, 1, 2**63 - 1]


@pytest.fixture(scope="module")
def rows(spark):
    pairs = list(itertools.product(TIMES, IDS))
    data = [(k, t, i, (7 * k + j) % 5 or None) for k in range(6) for j, (t, i) in enumerate(pairs) if (j * 5 + k * 3) % (k + 1) == 0]
    return spark.createDataFrame(data, "k int, t string, id long, v int").withColumn("t", F.col("t").cast("timestamp")).repartition(3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def picked(df, descending):
    order = [F.desc_nulls_last("t"), F.desc_nulls_last("id")] if descending else [F.asc_nulls_first("t"), F.asc_nulls_first("id")]
    first = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))).filter("rn = 1")
    return sorted(map(repr, first.select("k", F.col("t").cast("string"), "id", "v").collect()))


def shown(df):
    return sorted(map(repr, df.select("k", F.col("t").cast("string"), "id", "v").collect()))


def test_packed_order_sorts_as_the_pair(rows):
    pairs = rows.select("t", "id").distinct().withColumn("p", packed_order(rows, ["t", "id"]))
    by_pair = pairs.orderBy(F.asc_nulls_first("t"), F.asc_nulls_first("id")).select("p").collect()
    packed = [r["p"] for r in by_pair]
    assert None not in packed and packed == sorted(set(packed))


def test_winners_equal_the_window_without_a_sort(rows):
    for found, descending in ((latest_per_key(rows, ["k"], ["t", "id"]), True), (earliest_per_key(rows, ["k"], ["t", "id"]), False)):
        assert "SortAggregate" not in plan(found) and "HashAggregate" in plan(found)
        assert shown(found) == picked(rows, descending)


def test_repeated_rows_null_keys_and_empty_tables(spark, rows):
    twice = rows.unionByName(rows).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    assert shown(latest_per_key(twice, ["k"], ["t", "id"])) == picked(twice, True)
    none = rows.limit(0)
    assert latest_per_key(none, ["k"], ["t", "id"]).count() == 0
    assert dedupe_last_wins(none, ["k"], ["t", "id"]).columns == rows.columns


def test_rows_equal_in_order_stay_whole(spark):
    tied = spark.range(0, 200, 1, 8).select(F.lit(1).alias("k"), F.lit(0).cast("timestamp").alias("t"), F.lit(1).cast("long").alias("id"), "id", (F.col("id") * 2).alias("b")).toDF("k", "t", "i", "a", "b")
    got = latest_per_key(tied, ["k"], ["t", "i"]).first()
    assert got["b"] == 2 * got["a"]


def test_texts_and_other_orders_keep_the_struct(rows):
    named = rows.withColumn("v", F.col("v").cast("string"))
    assert shown(latest_per_key(named, ["k"], ["t", "id"])) == shown(latest_per_key(rows, ["k"], ["t", "id"]).withColumn("v", F.col("v").cast("string")))
    assert packed_order(named, ["t", "v"]) is None and packed_order(named, ["id", "id"]) is None and packed_order(named, ["id"]) is None


def test_superseded_and_single_values(rows):
    dated = rows.where("t is not null and id is not null").dropDuplicates(["k", "t", "id"]).withColumn("rid", F.hash("k", "t", "id"))
    old = superseded(dated, ["k"], ["t", "id"], "rid")
    best = Window.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))
    expected = dated.withColumn("rn", F.row_number().over(best)).filter("rn > 1")
    assert shown(old) == shown(expected) and "SortAggregate" not in plan(old)
    one = dated.groupBy("k").agg(latest_value(dated, "v", ["t", "id"]).alias("v"))
    assert "SortAggregate" not in plan(one)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, latest_per_key(dated, ["k"], ["t", "id"]).select("k", "v").collect()))


def test_a_page_is_parsed_once(spark):
    """A filter on the page's error must not be pushed down with one more parse for each of its uses."""
    pages = spark.createDataFrame(
        [(1, '{"page":1,"per_page":2,"items":[{"id":"a"},null]}'), (2, '{"page":"x","items":[]}'), (3, "["), (4, None), (5, '{"items":[]}')], "page_id int, payload_json string"
    )
    items = n.page_items(pages)
    assert items._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1
    assert [tuple(r) for r in items.select("page_id", "list_position", F.to_json("item")).orderBy("list_position").collect()] == [(1, 2, '{"id":"a"}'), (1, 3, "null")]
    bad = n.bad_pages(pages)
    assert bad._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1
    assert {r["page_id"]: r["_error"] for r in bad.collect()} == {2: "page.page must be an integer", 3: "page must be an object", 4: "page must be an object"}
    assert bad.columns == ["page_id", "payload_json", "_error"]
