"""Small inputs with known results."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sightline.operators import backlog as bk
from sightline.operators import coverage as cov
from sightline.operators import hierarchy as hy
from sightline.operators import history as h
from sightline.operators import normalize as n
from sightline.operators import requestlog as rl
from sightline.operators import retention as r
from sightline.operators import study as st
from sightline.operators import upsert as up

UTC = "timestamp_ntz"


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_page_with_two_items(spark, rows):
    page = """{"items":[
      {"id":"v-1","name":"A","published_at":"2026-03-01T10:00:00+0300","professional_roles":[{"id":"7"}]},
      {"id":"v-2","name":"B","professional_roles":[{"id":"7"},{"id":"9"}]}],"page":0,"per_page":2,"found":11,"pages":6}"""
    df = spark.createDataFrame([(1, page)], "page_id long, payload_json string")
    out = n.short_records(n.page_items(df))
    assert rows(out, "hh_vacancy_id", "list_position", F.array_join("professional_role_hh_ids", ",")) == [
        ("v-1", 0, "7"), ("v-2", 1, "7,9"),
    ]
    assert out.filter("_error is not null").count() == 0


def test_bad_items_go_to_quarantine(spark):
    page = '{"items":[{"id":5,"name":"A"},{"id":"1","name":"A","area":"x"},{"id":"2","name":"B","published_at":"soon"},{"id":"3","name":"C"},7]}'
    df = spark.createDataFrame([(1, page)], "page_id long, payload_json string")
    good, bad = n.split_quarantine(n.short_records(n.page_items(df)))
    assert [x["hh_vacancy_id"] for x in good.collect()] == ["3"]
    assert {x["_error"] for x in bad.collect()} == {
        "id must be a non-empty string", "area must be object", "published_at is not a supported time", "record must be an object",
    }


def test_back_off_order(spark):
    now = ts("2000-01-02 12:00:00")
    states = spark.createDataFrame(
        [
            ("no_attempt", now - dt.timedelta(days=3), now, None, None),
            ("recent_failed", now - dt.timedelta(days=2), now, 1, now - dt.timedelta(minutes=30)),
            ("old_failed", now - dt.timedelta(days=1), now, 2, now - dt.timedelta(hours=3)),
        ],
        "vacancy_id string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, attempt int, attempted_at timestamp_ntz",
    ).withColumns(
        {
            "detail_fetch_status": F.lit("failed"), "last_detail_fetched_at": F.lit(None).cast(UTC),
            "is_probably_inactive": F.lit(False), "first_detail_lease_expires_at": F.lit(None).cast(UTC),
        }
    )
    ready = bk.ready_backlog(states, F.lit(now).cast(UTC), 3600, 86400).orderBy(*bk.backlog_order())
    assert [x["vacancy_id"] for x in ready.collect()] == ["no_attempt", "old_failed"]


def test_reconcile_counts_missing_runs(spark, rows):
    states = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "vacancy_id long, consecutive_missing_runs int")
    events = spark.createDataFrame([(1, "r")], "vacancy_id long, crawl_run_id string")
    out = h.reconcile(h.seen_in_run(states, events, "r"))
    assert rows(out, "vacancy_id", "consecutive_missing_runs", "is_probably_inactive") == [
        (1, 0, False), (2, 2, True), (3, 1, False),
    ]


def test_refetch_reasons(spark, rows):
    old, new = ts("2026-01-01"), ts("2026-03-01")
    data = [
        ("never", None, "not_requested", "a", "a"),
        ("failed", new, "failed", "a", "b"),
        ("changed", new, "succeeded", "a", "b"),
        ("no_hash", new, "succeeded", None, "b"),
        ("stale", old, "succeeded", "a", "a"),
        ("fresh", new, "succeeded", "a", "a"),
        ("gone_changed", new, "terminal_404", "a", "b"),
        ("gone_never", None, "terminal_404", "a", "a"),
    ]
    df = spark.createDataFrame(
        data, "vacancy_id string, last_detail_fetched_at timestamp_ntz, detail_fetch_status string, previous_short_hash string, last_short_hash string"
    )
    out = df.select("vacancy_id", h.refetch_reason(F.lit(ts("2026-02-01")).cast(UTC)).alias("reason"))
    assert dict(rows(out)) == {
        "never": "first_seen", "failed": "first_seen", "changed": "short_changed", "no_hash": None, "stale": "ttl_refresh",
        "fresh": None, "gone_changed": "short_changed", "gone_never": None,
    }


def test_two_probe_records(spark):
    log = spark.createDataFrame(
        [(1, "s", "/vacancies", 200, None, 120.0, ts("2026-03-01 10:00:00")),
         (2, "s", "/vacancies", 403, "captcha_required", 250.0, ts("2026-03-01 10:00:02"))],
        "id long, s string, endpoint string, status_code int, error_type string, latency_ms double, at timestamp_ntz",
    )
    a = {x["id"]: x for x in rl.annotate(log, ["s"], "at", "id").collect()}
    assert (a[1]["request_index"], a[1]["seconds_since_previous"], a[1]["minutes_since_first_captcha"]) == (1, None, None)
    assert (a[2]["request_index"], a[2]["seconds_since_previous"], a[2]["minutes_since_first_captcha"]) == (2, 2.0, 0.0)
    s = rl.session_summary(log, ["s"], "at", "id").first()
    assert (s["requests_until_first_403"], s["requests_until_first_captcha"], s["seconds_until_first_403"]) == (2, 2, 2.0)
    assert (s["last_success_id"], s["first_403_id"], s["ok_before_first_403"]) == (1, 2, 1)
    p = rl.exact_percentiles(log, ["s"], "latency_ms", {"p50": 0.5}).first()
    assert p["p50"] == 185.0


def test_session_without_a_block(spark):
    log = spark.createDataFrame(
        [(1, "s", 200, None, ts("2026-03-01 10:00:00")), (2, "s", 200, None, ts("2026-03-01 10:00:02"))],
        "id long, s string, status_code int, error_type string, at timestamp_ntz",
    )
    s = rl.session_summary(log, ["s"], "at", "id").first()
    assert (s["requests_until_first_403"], s["seconds_until_first_403"], s["last_success_id"], s["ok_before_first_403"]) == (None, None, None, 2)


def test_first_seen_ids(spark):
    pages = spark.createDataFrame([(1, ["10", "20", "10"]), (2, ["30", "20"])], "n int, items array<string>")
    assert [x["item_id"] for x in rl.first_seen_ids(pages, ["n"], "items", 10).collect()] == ["10", "20", "30"]


def test_retention_candidates(spark, rows):
    cut = F.lit(ts("2026-02-01")).cast(UTC)
    old, new = ts("2025-12-01 10:00:00"), ts("2026-03-21 10:00:00")
    runs = spark.createDataFrame([("old", "succeeded", old), ("active", "created", None)], "id string, status string, finished_at timestamp_ntz")
    payloads = spark.createDataFrame(
        [(201, "old", old), (202, "old", old), (203, "active", new), (204, None, old)],
        "id long, crawl_run_id string, received_at timestamp_ntz",
    )
    full, legacy = '{"schema_version":2}', '{"schema_version":1}'
    snaps = spark.createDataFrame(
        [(301, "v1", "short", old, "old", 201, None, full), (302, "v1", "short", ts("2025-12-02"), "old", 202, None, legacy),
         (303, "v2", "detail", new, "active", None, 203, full), (304, "v2", "detail", old, None, None, 204, full)],
        "id long, vacancy_id string, snapshot_type string, captured_at timestamp_ntz, crawl_run_id string, "
        "short_payload_ref_id long, detail_payload_ref_id long, normalized_json string",
    )
    assert rows(r.payload_candidates(payloads, runs, snaps, cut), "id") == [(201,), (204,)]
    assert rows(r.snapshot_candidates(snaps, runs, cut), "id") == [(301,), (304,)]
    tries = spark.createDataFrame(
        [(401, "v1", "old", old, old), (402, "v1", "old", old, old), (403, "v2", "active", new, None)],
        "id long, vacancy_id string, crawl_run_id string, requested_at timestamp_ntz, finished_at timestamp_ntz",
    )
    assert rows(r.attempt_candidates(tries, runs, cut), "id") == [(401,)]
    assert rows(r.finished_runs(runs, cut), "id") == [("old",)]


def test_weekly_slots_are_used_by_latest(spark, rows):
    days = ["2026-03-02", "2026-03-09", "2026-03-16", "2026-03-17", "2026-03-18"]
    g = spark.createDataFrame([(i, ts(x), False, True) for i, x in enumerate(days)], "id long, at timestamp_ntz, protected boolean, verified boolean")
    plan = r.generation_plan(g, "id", "at", 1, 2)
    # The week of 16 March is used up by generation 4, so only one older week is kept.
    assert dict(rows(plan, "id", "action")) == {0: "delete_candidate", 1: "retained", 2: "delete_candidate", 3: "delete_candidate", 4: "retained"}


def test_coverage_tree_is_preorder_and_cycles_are_reported(spark):
    p = spark.createDataFrame(
        [(1, None, "b"), (2, None, "a"), (3, 1, "z"), (4, 1, "y"), (5, 99, "c"), (6, 7, "q"), (7, 6, "r")], "id long, parent long, k string"
    )
    walked = hy.walk(p, "id", "parent", ["k", "id"])
    assert [x["id"] for x in walked.orderBy("tree_position").collect()] == [2, 1, 4, 3, 5]
    assert sorted(x["id"] for x in hy.unreachable(p, walked, "id").collect()) == [6, 7]


def test_trees_of_any_shape_and_depth(spark, rows):
    """A chain 120 deep, a bush and a cycle, in two scopes with the same ids, against a plain walk."""
    rng = random.Random(3)
    data = []
    for run in ("r", "s"):
        ids = rng.sample(range(10_000), 300)
        for k, i in enumerate(ids):
            parent = None if k in (0, 5) else ids[k - 1] if k < 120 else rng.choice(ids[:k])
            data.append((run, i, parent, rng.choice("abc")))
        data += [(run, 20_001, 20_002, "a"), (run, 20_002, 20_001, "a"), (run, 20_003, 20_001, "a"), (run, 20_004, 20_004, "b"), (run, 20_005, -1, "b")]
    want = []
    for run in ("r", "s"):
        known = {i: (p, k) for r, i, p, k in data if r == run}
        kids = {}
        for i, (p, k) in known.items():
            kids.setdefault(p if p in known else None, []).append((k, i))
        stack, place = [(k, i, 0, i) for k, i in sorted(kids[None], reverse=True)], 0
        while stack:
            _, i, level, root = stack.pop()
            place += 1
            want.append((run, i, level, root, place))
            stack += [(k, c, level + 1, root) for k, c in sorted(kids.get(i, []), reverse=True)]
    df = spark.createDataFrame(data, "run string, id long, parent long, k string")
    walked = hy.walk(df, "id", "parent", ["k", "id"], ["run"])
    assert rows(walked, "run", "id", "tree_level", "root_id", "tree_position") == sorted(want, key=repr)


def test_bisecting(spark, rows):
    w = spark.createDataFrame([(1, 0, 7), (2, 5, 6)], "id long, window_from long, window_to long")
    assert rows(cov.bisected(w), "id", "window_from", "window_to", "unresolved") == [(1, 0, 3, False), (1, 3, 7, False), (2, 5, 6, True)]


def test_fixpoint_ends_on_one_hot_second(spark, rows):
    cells = spark.createDataFrame([("a", 5)] * 40 + [("a", 1)], "area string, s long")
    roots = spark.createDataFrame([("a", 0, 8)], "area string, window_from long, window_to long")
    out = cov.split_to_fixpoint(cells, roots, "area", "s", 10)
    leaves = rows(out.filter("status <> 'split'"), "window_from", "window_to", "row_count", "status")
    assert (5, 6, 40, "unresolved") in leaves
    assert sum(x[2] for x in leaves) == 41
    assert sum(x[1] - x[0] for x in leaves) == 8


def test_fixpoint_equals_halving_step_by_step(spark, rows):
    rng = random.Random(4)
    roots = [("a", 0, 1000), ("a", 1000, 1003), ("b", -7, 90), ("c", 5, 6), ("d", 0, 64), (None, 0, 9)]
    cells = [(rng.choice("abce"), int(rng.gauss(40, 30)), None) for _ in range(600)] + [("a", 1001, None)] * 50 + [("c", 5, None)] * 12 + [("a", None, None), (None, 3, None)]
    want = []
    for area, a, b in roots:
        seconds = [s for x, s, _ in cells if x == area and area is not None and s is not None and a <= s < b]
        open_ = [(a, b, 0, seconds)]
        while open_:
            f, t, depth, held = open_.pop()
            state = "covered" if len(held) <= 10 else "unresolved" if t - f < 2 else "split"
            want.append((area, f, t, depth, len(held), state))
            if state == "split":
                m = f + (t - f) // 2
                open_ += [(f, m, depth + 1, [s for s in held if s < m]), (m, t, depth + 1, [s for s in held if s >= m])]
    density = spark.createDataFrame(cells, "area string, s long, window_from string")
    out = cov.split_to_fixpoint(density, spark.createDataFrame(roots, "area string, window_from long, window_to long"), "area", "s", 10)
    assert rows(out, "area", "window_from", "window_to", "depth", "row_count", "status") == sorted(want, key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Checkpoint" not in plan and "ExistingRDD[" not in plan.replace("Scan ExistingRDD[area", "")
    wide = spark.createDataFrame([("w", (1 << 62) - 5)] * 3, "area string, s long")
    deep = cov.split_to_fixpoint(wide, spark.createDataFrame([("w", 0, 1 << 62)], "area string, window_from long, window_to long"), "area", "s", 2)
    assert rows(deep.filter("status = 'unresolved'"), "window_from", "row_count", "depth") == [((1 << 62) - 5, 3, 62)]


def test_search_and_detail_study(spark, rows):
    search = n.leaf_values(spark.createDataFrame([(1, '{"id":"1","name":"A"}')], "id long, b string"), ["id"], "b")
    body = '{"id":"1","name":"A","description":"d","key_skills":[{"name":"x"}]}'
    rounds = spark.createDataFrame([(1, 0, body), (1, 1, body)], "id long, round int, b string")
    leaves = n.leaf_values(rounds, ["id", "round"], "b")
    compared = st.compare_paths(search, leaves.filter("round = 0").drop("round"), "id")
    assert rows(compared.filter("detail_only and important"), "path") == [("description",), ("key_skills[].name",)]
    pairs = st.consecutive_pairs(rounds.select("id", "round", F.lit(True).alias("ok")), "id", "round", "ok")
    rate = st.drift_rate(pairs, st.changed_paths(pairs, leaves, "id", "round"), "id", "raw").first()
    assert (rate["comparable_pairs"], rate["changed_pairs"], rate["changed_pair_rate"]) == (1, 0, 0.0)
    policy = spark.range(1).select(st.recommendation(F.lit(2), F.lit(0.0)).alias("p")).first()["p"]
    assert policy == "selective_detail"


def test_empty_dictionary_delivery_changes_nothing(spark, rows):
    old = spark.createDataFrame([("1", "A", True), ("2", "B", False)], "k string, name string, is_active boolean")
    same = up.sync_dictionary(old, old.select("k", "name").limit(0), "k", ["name"])
    assert rows(same, "k", "name", "is_active") == [("1", "A", True), ("2", "B", False)]
    gone = up.sync_dictionary(old, spark.createDataFrame([("2", "C")], "k string, name string"), "k", ["name"])
    assert rows(gone, "k", "name", "is_active") == [("1", "A", False), ("2", "C", True)]


def test_retention_never_removes_the_newest(spark):
    df = spark.createDataFrame([(i, f"v{i % 5}", "short", ts("2025-01-01") + dt.timedelta(days=i % 7), None) for i in range(100)],
                               "id long, vacancy_id string, snapshot_type string, captured_at timestamp_ntz, crawl_run_id string")
    runs = spark.createDataFrame([], "id string, status string, finished_at timestamp_ntz")
    gone = r.snapshot_candidates(df, runs, F.lit(ts("2030-01-01")).cast(UTC))
    assert gone.count() == 95
    newest = {x["id"] for x in df.groupBy("vacancy_id").agg(F.max_by("id", F.struct("captured_at", "id")).alias("id")).collect()}
    assert not newest & {x["id"] for x in gone.collect()}


def test_held_for_needs_consecutive_windows(spark, rows):
    at = [ts("2026-01-01 00:00:00") + dt.timedelta(minutes=5 * i) for i in (0, 1, 2, 5, 6)]
    df = spark.createDataFrame([("a", x) for x in at], "s string, at timestamp_ntz")
    assert [x[0] for x in rows(rl.held_for(df, ["s"], "at", 300, 900), "held_seconds")] == [900]


def test_finished_tree_nodes_do_not_meet_in_one_task(spark):
    """Roots have no pointer to join by; they stay where they are."""
    names = {"spark.sql.shuffle.partitions": "4", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        parent = F.when(F.col("id") % 10 == 0, F.struct((F.col("id") + 1).alias("id")))
        nodes = spark.range(4000).repartition(4).select(F.struct("id").alias("node"), parent.alias("jump"), F.lit(1).alias("levels"))
        done = hy._doubled(nodes, ["levels"], None, 4000)
        held = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 4000 and max(held) < 2000
        assert done.agg(F.sum("levels")).first()[0] == 4400
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
