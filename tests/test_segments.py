"""Hot keys run over several ranges; the result must equal the plain window."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sightline.operators.history import missing_run_counts
from sightline.operators.ordering import with_position
from sightline.operators.segments import exact_percentiles, with_lag, with_ordered, with_running
from sightline.session import is_local


def skewed(n=6000, seed=7):
    """One key holds two thirds of the rows; some values are null; times repeat."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.66, 1, rng.integers(2, 40, n))
    return pd.DataFrame(
        {
            "k": key,
            "t": rng.integers(0, 900, n),
            "id": rng.permutation(n),
            "v": rng.integers(0, 50, n),
            "x": np.round(rng.random(n) * 100, 3),
        }
    )


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("v") > 4, F.col("v")))
    return pdf, df.repartition(4).cache()


def test_lag_equals_plain_window(data, rows):
    pdf, df = data
    got = rows(with_lag(df, ["k"], ["t", "id"], {"p": "id"}), "id", "p")
    ordered = pdf.sort_values(["k", "t", "id"])
    want = ordered.assign(p=ordered.groupby("k")["id"].shift(1))
    expect = sorted(((int(i), None if np.isnan(p) else int(p)) for i, p in zip(want.id, want.p)), key=repr)
    assert got == expect


def test_lag_of_a_null_is_null(data, rows):
    _pdf, df = data
    plain = rows(df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id"))), "id", "p")
    assert rows(with_lag(df, ["k"], ["t", "id"], {"p": "v"}), "id", "p") == plain


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_equals_plain_window(data, rows, keys):
    _pdf, df = data
    low = F.when(F.col("v") > 30, F.col("t"))
    wanted = {"n": ("rows", F.lit(1)), "s": ("sum", F.col("v")), "c": ("count", F.col("v")), "lo": ("min", low), "hi": ("max", F.col("v"))}
    w = Window.partitionBy(*keys).orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = {"n": F.count(F.lit(1)), "s": F.sum("v"), "c": F.count("v"), "lo": F.min(low), "hi": F.max("v")}
    want = rows(df.withColumns({n: c.over(w) for n, c in plain.items()}), "id", *wanted)
    assert rows(with_running(df, keys, ["t", "id"], wanted), "id", *wanted) == want


@pytest.fixture()
def ranges(spark):
    """Ranges stay apart, as on a large table."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_key_runs_over_many_ranges(spark, data, rows, ranges):
    """With ranges kept apart one key of two thirds of the rows lies in several, and nulls and lone keys too."""
    _pdf, df = data
    df = df.withColumn("k", F.when(F.col("k") != 3, F.col("k")))
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows(df.withColumns({"p": F.lag("t").over(w), "n": F.row_number().over(w)}), "id", "p", "n")
    got = with_ordered(df, ["k"], ["t", "id"], {"p": "t"}, {"n": ("rows", F.lit(1))})
    assert rows(got, "id", "p", "n") == want


def test_equal_keys_and_orders_are_cut(spark, rows, ranges):
    """Rows that differ only outside of key and order still spread, and are numbered without gaps."""
    df = spark.range(4000).selectExpr("1 AS k", "5 AS t", "id").repartition(4)
    got = with_running(df, ["k"], ["t"], {"n": ("rows", F.lit(1))})
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 4001))


def test_positions_are_a_total_order(spark, ranges):
    df = spark.range(5000).selectExpr("id", "id % 7 AS a").repartition(5)
    got = with_position(df, ["a", "id"]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(5000)) and [(r["a"], r["id"]) for r in got] == sorted((i % 7, i) for i in range(5000))


def test_percentiles_equal_numpy(data):
    pdf, df = data
    out = exact_percentiles(df, ["k"], "x", {"a": 0.5, "b": 0.95}, None)
    got = {r["k"]: (r["a"], r["b"]) for r in out.collect()}
    for k, group in pdf.groupby("k"):
        assert got[k] == pytest.approx((np.percentile(group.x, 50), np.percentile(group.x, 95)))


def test_percentile_of_one_group_with_ties(spark):
    df = spark.createDataFrame([(0.0,)] * 500 + [(float(i),) for i in range(1, 501)], "x double")
    out = exact_percentiles(df, [], "x", {"p": 0.5, "q": 0.75}, None).first()
    values = [0.0] * 500 + [float(i) for i in range(1, 501)]
    assert (out["p"], out["q"]) == pytest.approx((np.percentile(values, 50), np.percentile(values, 75)))


def test_a_cluster_has_to_name_a_shared_folder():
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_runs_follow_each_other_by_time(spark):
    events = spark.createDataFrame(
        [("a", "zz", 1), ("b", "zz", 1), ("b", "aa", 8), ("c", "aa", 9)], "vacancy_id string, crawl_run_id string, seen_at int"
    )
    got = {r["vacancy_id"]: r["consecutive_missing_runs"] for r in missing_run_counts(events).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}
