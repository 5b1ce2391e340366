"""Depth of a document never matters to the others, nor to the number of jobs."""

import json

from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.operators.normalize import detail_records, leaf_values, page_items, short_records, tree_nodes


def nested(depth):
    value = 1
    for k in range(depth):
        value = {"a": value} if k % 2 else [value]
    return json.dumps({"x": value, "y": [], "z": {"b": "t"}})


def test_deep_documents_are_flattened_beside_flat_ones(spark):
    rows = [(k, nested(d)) for k, d in enumerate((0, 3, 200, 90))] + [(9, "no json"), (10, None), (11, "5"), (12, "[]")]
    got = leaf_values(spark.createDataFrame(rows, "id int, body string"), ["id"], "body").collect()
    found = {(r["id"], r["path"]): r["leaf_values"] for r in got}
    for k, depth in enumerate((0, 3, 200, 90)):
        path = "x" + "".join(".a" if n % 2 else "[]" for n in reversed(range(depth)))
        assert found[k, path] == ["1"] and found[k, "z.b"] == ['"t"']
    assert {k for k, _ in found} == {0, 1, 2, 3}


def test_flattening_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([(1, nested(5))], "id int, body string").write.parquet(f"{tmp_path}/d")
    plan = leaf_values(spark.read.parquet(f"{tmp_path}/d"), ["id"], "body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_deep_area_trees(spark):
    area = {"id": "leaf", "name": "leaf", "areas": []}
    for k in range(120):
        area = {"id": f"n{k}", "name": f"n{k}", "areas": [area]}
    got = tree_nodes(spark.createDataFrame([(1, json.dumps([area]))], "id int, body string"), ["id"], "body").collect()
    assert len(got) == 121 and max(r["level"] for r in got) == 120


def test_normalised_documents_are_canonical_as_written(spark):
    """Equal to their text parsed and written again, on odd texts and numbers, without doing so for each row."""
    odd = 'a"\\\n\t\u0001/<é \U0001f600'
    docs = [
        {"id": "1", "name": odd, "salary": {"to": 1.50, "from": 1.5e3, "b": {"z": -0.0, "a": [1e30, 12345678901234567890123, odd]}}, "archived": True},
        {"id": " 2 ", "name": "n", "area": {"name": odd, "id": "5"}, "employer": {"trusted": False, "name": "e", "id": "7", "area": {"id": "3"}}, "key_skills": [{"name": odd}, {"name": " "}]},
        {"id": "3", "name": "n", "area": {}, "employer": {"id": " "}, "salary": {}, "salary_range": {"": None}, "created_at": "2024-01-02T03:04:05+0300"},
        {"id": 4}, {}, [],
    ]
    rows = [(k, json.dumps(d, ensure_ascii=bool(k % 2))) for k, d in enumerate(docs)] + [(10, "no json"), (11, None), (12, '{"id":"1","salary":{"x":1e5,"y":-0e0,"z":1.23456789e7}}')]
    out = detail_records(spark.createDataFrame(rows, "k int, payload_json string"))
    found = out.select("k", "normalized_json", j.canonical_json(F.col("normalized_json")).alias("again"), F.sha2("normalized_json", 256).alias("sha"), "normalized_hash").collect()
    assert len(found) == len(rows) and all(r["normalized_json"] == r["again"] and r["sha"] == r["normalized_hash"] for r in found)
    by_key = {r["k"]: json.loads(r["normalized_json"]) for r in found}
    assert by_key[0]["name_current"] == odd and by_key[0]["salary"]["b"]["a"][2] == odd and by_key[1]["area"] == {"id": "5", "name": odd}
    assert by_key[1]["employer"]["area_hh_id"] == "3" and by_key[2]["employer"] is None and by_key[2]["area"] == {"id": None, "name": None} and by_key[2]["salary_range"] == {"": None}
    plan = out.select("normalized_json")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("\n+- ")[0].count("StructsToJsonEvaluator") == 1


def test_the_json_of_an_item_is_written_once_for_document_and_hash(spark):
    body = '{"items":[{"name":"A","id":"1","x":[1.0,{"b":"\\u00e9\\"","a":null}]},{"id":2},7]}'
    items = page_items(spark.createDataFrame([(1, body), (2, "damaged")], "payload_id long, payload_json string")).drop("payload_json")
    context = F.struct("list_position")
    twice = short_records(items.withColumn("document", j.short_document(F.col("item"), context)))
    written = items.withColumn("_json", F.to_json("item"))
    once = short_records(written.withColumn("document", j.short_document(F.col("item"), context, F.col("_json"))), text="_json")
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (twice, once)]
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert [p.count("StructsToJsonEvaluator") for p in plans] == [3, 2]  # one is the context
    assert once.columns == twice.columns and once.collect() == twice.collect() and once.count() == 3
