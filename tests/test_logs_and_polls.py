"""Boot segmentation, snapshot documents, state events, merges and checks on small hand-made inputs."""

import json
from datetime import datetime

from pyspark.sql import functions as F
from tephra.operators import history, logs, parity, polls, quality
from tephra.streaming import poll_load

BOOT = [(0, "Starting vLLM: vllm serve --host h"), (45, "Initializing a V1 LLM engine (v0.28.0) with config"), (90, "Loading weights took 18.12 seconds"),
        (150, "Graph capturing finished in 6 secs, took 0.58 GiB"), (160, "Graph capturing finished in 7 secs, took 0.58 GiB"),
        (165, "init engine (profile, warmup model) took 56.34 s (compilation: 37.27 s)"), (170, "Application startup complete.")]


def boot(file, worker, line0, minute0, lines=BOOT, skip_start=False):
    return [(file, worker, line0 + i, datetime(2026, 9, 23, 18, minute0 + off // 60, off % 60), "pipe", "vllm", msg)
            for i, (off, msg) in enumerate(lines) if not (skip_start and msg.startswith("Starting"))]


EVENT = "source_file string, worker_id string, line_no int, ts_utc timestamp, ts_format string, event_kind string, message string"


def test_boots(spark):
    rows = (boot("a", "w1", 1, 0) + boot("a", "w1", 100, 10, skip_start=True) + boot("a", "w2", 200, 20, skip_start=True) + boot("b", None, 1, 30, lines=BOOT[2:])
            + boot("c", None, 1, 40) + boot("c", None, 50, 50)
            + [("d", None, 1, datetime(2026, 9, 23), "pipe", "other", "Registered model loader")] + boot("d", None, 3, 1)
            + [("d", None, 20, datetime(2026, 9, 23, 18, 5), "pipe", "vllm", "init engine (no compile part) took 9.00 s")])
    out = {(r.source_file, r.worker_id, r.boot_index): r for r in logs.boot_phases(spark.createDataFrame(rows, EVENT), chunk=60).collect()}
    assert set(out) == {("a", "w1", 1), ("a", "w1", 2), ("a", "w2", 1), ("b", None, 0), ("c", None, 1), ("c", None, 2), ("d", None, 1)}
    first, orphan = out[("a", "w1", 1)], out[("a", "w1", 2)]
    assert first.segmented_by.startswith("Starting") and first.start_to_api_ready_s == 170.0
    assert orphan.segmented_by.startswith("Initializing") and orphan.t_start_vllm is None and orphan.start_to_api_ready_s is None
    assert out[("b", None, 0)].segmented_by.startswith("none") and out[("b", None, 0)].init_engine_s == 56.34
    assert all(r.graph_capture_s == 13.0 and r.n_graph_passes == 2 for r in out.values())
    assert quality.segmentation_violations(spark.createDataFrame(list(out.values()), logs.boot_phases(spark.createDataFrame(rows, EVENT)).schema)).count() == 0


def endpoint(eid, image="img", **more):
    return {"id": eid, "name": eid, "type": "QUEUE", "flashboot": "OFF", "gpu": {"pools": ["B", "A"], "count": 1, "excludedTypes": ["z"], "minCudaVersion": "", "allowedCudaVersions": []},
            "workers": {"min": 0, "max": 1, "idleTimeout": 5}, "scaling": {"type": "Q", "queueDelay": 4}, "timeout": 600, "image": image, "dataCenterIds": None, "networkVolumes": [], "disk": 20,
            "createdAt": "2026-09-01T00:00:00Z", **more}


def document(hour, eps, workers=(), complete=True, amount=1.0, status="COMPLETED", diff=None):
    return json.dumps({
        "polled_at": f"2026-09-02T{hour:02d}:00:00+00:00", "endpoints": eps, **({} if complete is None else {"endpoints_complete": complete}),
        "workers": {"e1": {"endpointVersion": 3, "workers": [{"id": w, "status": s, "gpuTypeId": "g", "startedAt": "2026-09-01T00:00:00Z", "isStale": False} for w, s in workers]}},
        "health": {"e1": {"jobs": {"completed": hour, "failed": 0, "inProgress": 1, "inQueue": 0, "retried": 0}, "workers": {"idle": 1, "ready": 2, "running": 3}}, "e2": {"_error": "down"}},
        "releases": {"e1": {"pagination": {"hasNextPage": False}, "releases": [
            {"version": 1, "createdAt": "2026-09-01T00:00:00Z", "source": "x", "diff": []},
            {"version": 2, "createdAt": "2026-09-01T06:00:00Z", "source": "x", "diff": diff or [{"field": "gpuIds", "old": "B,A", "new": "A,-z,B"}, {"field": "env", "old": "s", "new": {"a": 1}},
                                                                                             {"field": "minCudaVersion", "old": None, "new": "12.8"}]}]}},
        "billing": {"metadata": {"recordCount": 1}, "records": [{"serverlessId": "e1", "startTime": "2026-09-02T00:00:00Z", "endTime": "2026-09-02T01:00:00Z", "totalAmount": amount}]},
        "jobs": [{"endpoint_id": "e1", "job_id": "j", "submitted_at": "2026-09-02T00:00:00Z", "status": {"status": status, "delayTime": hour}}]})


def test_poll_documents(spark, tmp_path):
    folder, table, chk = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    folder.mkdir()
    (folder / "p0.json").write_text(document(0, [endpoint("e1"), endpoint("e2")], [("w1", "IDLE")], complete=None))
    (folder / "p1.json").write_text(document(1, [endpoint("e1", "new"), endpoint("e2")], [("w1", "RUNNING"), ("w2", "IDLE")], amount=2.0))
    assert poll_load.load_polls(spark, str(folder), table, chk, "r1") == 2
    (folder / "p2.json").write_text(document(2, [endpoint("e1")], [("w2", "IDLE")], complete=False, amount=3.0, status="IN_PROGRESS"))
    (folder / "p3.json").write_text(document(3, [endpoint("e1")], [], amount=4.0, status="IN_PROGRESS"))
    assert poll_load.load_polls(spark, str(folder), table, chk, "r2") == 2
    assert poll_load.load_polls(spark, str(folder), table, chk, "r3") == 0
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")      # of many batches a query remembers the last
    try:
        again = table + "-again"
        assert poll_load.load_polls(spark, str(folder), again, chk + "-again", "r4", files_per_batch=1) == poll_load.raw_polls(spark, again).count() == 4
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    raw = poll_load.raw_polls(spark, table)
    docs = polls.documents(raw.unionByName(raw.withColumn("run_label", F.lit("again"))))    # every document loaded twice
    head = {r.poll_seq: r for r in polls.polls(docs).collect()}
    assert sorted(head) == [1, 2, 3, 4] and [head[i].endpoints_complete for i in (1, 2, 3, 4)] == [True, True, False, True] and head[1].n_endpoints == 2
    eps = polls.endpoints(docs)
    cfg = history.endpoint_config(eps)
    c = cfg.where("endpoint_id = 'e1'").orderBy("polled_at_utc").first()
    assert (c.gpu_ids, c.min_cuda, c.allowed_cuda, c.locations, c.disk_gb, c.network_volumes, c.scaling_value) == ("A,B,-z", "ALL", "ALL", "ALL", "20", "[]", 4.0)
    hist = history.versions_from_observations(cfg, polls.polls(docs).where("endpoints_complete"), "endpoint_id", history.TRACKED, current={"current_name": "name"}).withColumn(
        "vf", F.date_format("valid_from", "HH")).withColumn("vt", F.date_format("valid_to", "HH"))
    got = {(r.endpoint_id, r.version_no): (r.vf, r.vt, r.is_current, r.is_deleted, r.n_polls) for r in hist.collect()}
    assert got == {("e1", 1): ("00", "01", False, False, 1), ("e1", 2): ("01", "02", False, False, 1), ("e1", 3): ("02", None, True, False, 2), ("e2", 1): ("00", "03", False, True, 2)}
    w = polls.workers(docs)
    ev = history.state_events(w.select("endpoint_id", "worker_id", "poll_id", "polled_at_utc", "status"), eps.where("endpoint_id = 'e1'").select("endpoint_id", "poll_id", "polled_at_utc"))
    assert {(r.worker_id, r.h, r.event) for r in ev.withColumn("h", F.hour("polled_at_utc")).collect()} == {
        ("w1", 0, "first_seen"), ("w1", 1, "status_changed"), ("w2", 1, "appeared"), ("w1", 2, "disappeared"), ("w2", 3, "disappeared")}
    assert polls.billing_hourly(docs).first().total_usd == 4.0
    j = polls.jobs(docs).first()
    assert (j.status, j.delay_ms) == ("COMPLETED", 1)               # terminal beats later non-terminal
    rel = {(r.release_version, r.field): r for r in polls.releases(docs).collect()}
    assert rel[(1, None)].column_name is None and rel[(2, "gpuIds")].new_value == "A,B,-z" and rel[(2, "env")].column_name is None
    assert rel[(2, "minCudaVersion")].old_value == "ALL" and rel[(2, "minCudaVersion")].new_value == "12.8"
    h = polls.health(docs)
    assert h.where("endpoint_id = 'e2'").first().api_error == "down"
    day = polls.daily_rollup(eps, w, ev, h, polls.billing_hourly(docs)).where("endpoint_id = 'e1'").first()
    assert (day.n_polls, day.max_active_workers, day.jobs_completed_delta, day.max_workers_by_health, day.n_worker_disappearances) == (4, 2, 3, 6, 2)
    log = history.versions_from_changes(polls.releases(docs), cfg.where("endpoint_id = 'e1'").orderBy(F.desc("polled_at_utc")).limit(1), history.deleted_entities(hist, "endpoint_id"), "endpoint_id",
                                        history.LOGGED, chunk=1)
    assert [(r.version_no, r.gpu_ids, r.min_cuda, r.disk_gb) for r in log.orderBy("version_no").collect()] == [(1, "A,B", "ALL", "20"), (2, "A,B,-z", "12.8", "20")]


def test_snapshot_merge_leaves_a_gap_for_a_returning_key(spark):
    t = lambda d: datetime(2026, 9, d)
    hist = spark.createDataFrame([("gone", "x", t(1), None), ("back", "x", t(1), t(2)), ("same", "x", t(1), None), ("new value", "x", t(1), None)],
                                 "k string, c string, valid_from timestamp, valid_to timestamp")
    now = spark.createDataFrame([("back", "x", t(5)), ("same", "x", t(5)), ("new value", None, t(5)), ("first", "y", t(5))], "k string, c string, polled_at_utc timestamp")
    out = history.merge_snapshot(hist, now, "k", ["c"], run_at=F.lit(t(6)).cast("timestamp"))
    got = {(r.k, r.c, r.valid_from.day, r.valid_to and r.valid_to.day) for r in out.collect()}
    assert got == {("gone", "x", 1, 6), ("back", "x", 1, 2), ("back", "x", 5, None), ("same", "x", 1, None), ("new value", "x", 1, 5), ("new value", None, 5, None), ("first", "y", 5, None)}
    assert quality.window_violations(out, "k", allow_gaps=True).count() == 0
    assert [r.k for r in quality.window_violations(out, "k").collect()] == ["back"]


def test_parity_pairs_rows_within_a_key(spark):
    s = "k string, a double, b string"
    left = spark.createDataFrame([("x", 1.0, "p"), ("x", 2.0, "q"), ("x", 2.0, "q"), ("y", float("nan"), None), ("z", float("inf"), "i"), (None, 1.0, "n")], s)
    right = spark.createDataFrame([("x", 2.0, "q"), ("x", 1.0 + 1e-9, "p"), ("x", 2.0, "q"), ("y", None, None), ("z", float("inf"), "i"), (None, 1.0, "n")], s)
    assert parity.table_parity(left, right, ["k"]).count() == 0
    worse = right.withColumn("a", F.when(F.col("k") == "z", F.lit(1.0)).otherwise(F.col("a"))).where("k is not null")
    assert {(r.key, r.problem) for r in parity.table_parity(left, worse, ["k"]).collect()} == {('{"k":"z"}', "a"), ('{"k":null}', "only left")}


def test_seed_shape(spark):
    pins = spark.createDataFrame([("A", "P", "P,-a,-b", "s"), ("B", "Q", "Q,-z,-b", "s"), ("B", "Q", "Q", "")], "gpu_model string, pool string, gpu_ids string, source string")
    bad = quality.seed_shape(pins, "pins", key=["gpu_model"], required=["source"], enums={"pool": ["P", "Q"]}, rules={"order": ~quality.selection_is_canonical("gpu_ids", "pool")})
    assert {(r.rule, r.n) for r in bad.collect()} == {("order", 1), ("blank source", 1), ("duplicate key", 1)}


def test_parity_spreads_one_key(spark):
    row = F.concat(F.lit("p" * 70), F.lpad(F.col("id").cast("string"), 6, "0"))
    left = spark.range(4_000).select(F.lit("k").alias("k"), row.alias("a"))
    right = spark.range(4_001).select(F.lit("k").alias("k"), row.alias("a"))
    assert [tuple(r) for r in parity.table_parity(left, right, ["k"]).collect()] == [('{"k":"k"}', "only right")]
    parts = parity.in_ranges(left.select(F.col("k").alias("_key"), F.col("a").alias("_sort"))).groupBy("_range").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3_500


def test_point_in_time_joins_take_the_chunk_unit(spark):
    facts = spark.range(50).select(F.lit("e").alias("e"), (F.lit("2024-01-01 10:00:00").cast("timestamp") + F.make_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("t"), F.lit("v1").alias("x"))
    history = spark.sql("select 'e' as e, 1L as version_no, timestamp'2024-01-01 10:00:00' as valid_from, cast(null as timestamp) as valid_to, 'v1' as x")
    for unit in ("day", "hour", "minute"):
        assert quality.rebuild_mismatches(facts, history, "e", "t", ["x"], unit=unit).count() == 0
        assert quality.uncovered_observations(facts.withColumn("id", F.col("t").cast("string")), history, "e", "t", ["id", "e"], unit=unit).count() == 0


def test_parity_pairs_numbers_by_value(spark):
    left = spark.createDataFrame([("k", 999.9999999), ("k", 250.0)], "k string, a double")
    right = spark.createDataFrame([("k", 1000.0), ("k", 250.0)], "k string, a double")
    assert parity.table_parity(left, right, ["k"]).count() == 0          # as text, 1000 comes before 250
    assert [r.problem for r in parity.table_parity(left, right.withColumn("a", F.nullif("a", F.lit(250.0))), ["k"]).collect()] == ["a"]


def test_rows_of_few_versions_are_not_dealt_out_by_version(spark):
    from tephra.operators import snapshot
    rows = spark.range(3_000_000).select("id", F.concat(F.lit("f"), F.col("id") % 3).alias("source_file"), F.lit("v").alias("source_sha256"), F.lit("2024-01-01").alias("ingested_at"), F.lit("r").alias("run_label"))
    plan = snapshot.current_rows(rows, rows.where("id % 3 < 2"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
