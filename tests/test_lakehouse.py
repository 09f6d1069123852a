"""The layered build end to end, and the scenarios a raw layer must survive."""

import json
import shutil

import pytest

from fixtures import RULES, landing_folder, seeds_folder, series, sweep, write
from pyspark.sql import functions as F
from tephra.plans import lakehouse
from tephra.plans.lakehouse import Lake
from tephra.sources import landing


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("lake")
    return Lake(spark, str(landing_folder(tmp / "land")), str(tmp / "lake"), str(seeds_folder(tmp / "seeds")))


def land(lake):
    lakehouse.build_manifest(lake, RULES, ["alpha", "beta"])


def count(lake, layer, table, where="true"):
    return lake.table(layer, table).where(where).count()


def put(lake, name, text):
    from pathlib import Path
    return write(Path(lake.landing), name, text)


def test_first_build(lake):
    land(lake)
    names = {r.landed_relpath for r in lake.manifest().select("landed_relpath").collect()}
    assert names == {"alpha/results/series_a.json", "alpha/results/sweep_s.json", "alpha/results/x_worker_log.txt", "beta/requests_old.csv",
                     "beta/requests.csv", "beta/items.csv", "beta/batches.csv", "beta/logs/run1.log"}
    done = lakehouse.ingest(lake, "r1")
    assert done == {"series_docs": 1, "series_runs": 2, "sweep_runs": 1, "sweep_records": 3, "log_lines": 7, "request_rows": 4,
                    "scored_item_rows": 2, "scored_batch_rows": 1, "ledger": 10}
    assert lakehouse.verify(lake).collect() == []
    assert lakehouse.completeness(lake).collect() == []
    lakehouse.build_typed(lake)
    lakehouse.build_gold(lake)
    assert lakehouse.ingest(lake, "r1b") == {}                      # nothing new


def test_requests(lake):
    rows = {(r.source, r.kind, r.run_index): r for r in lake.table("typed", "requests").collect()}
    assert len(rows) == 6                                           # 2 runs x cold + warm, 2 deduplicated CSV rows
    cold = rows[("series_json", "cold", 0)]
    assert cold.is_flashboot_hit and cold.host_state == "fresh_host" and cold.price_per_hr_usd == 1.1
    assert cold.request_duration_s == 5.499 and abs(cold.est_cost_usd - 5.499 / 3600 * 1.1) < 1e-12
    assert not rows[("series_json", "cold", 1)].is_flashboot_hit    # 5001 ms
    assert rows[("series_json", "warm", 0)].is_flashboot_hit is None
    csv = rows[("request_csv", "cold", 1)]
    assert csv.gpu_label == "48GB" and csv.gpu_label_raw == "24GB" and csv.gpu_model == "A40" and csv.model == "Qwen3-8B"
    assert csv.job_status == "COMPLETED" and csv.http_status is None and csv.workers_before_json == '{"idle": 1}'
    lost = rows[("request_csv", "warm", 1)]
    assert lost.http_status == 403 and lost.job_status is None and lost.ok is False and lost.delay_ms is None
    assert lost.error == 'line one\nline "two"' and lost.est_cost_usd is None


def test_phases_sweeps_and_scores(lake):
    ph = {(r.run_index, r.kind, r.name): (r.seconds, r.mark_ts_utc) for r in lake.table("typed", "startup_phases").collect()}
    assert ph[(0, "phase", "brand_new_phase")][0] == 2.0 and ph[(1, "mark", "worker_start")][0] is None and len(ph) == 6
    s = lake.table("typed", "sweep_summaries").first()
    assert s.is_unbounded and s.request_rate == float("inf") and s.endpoint_id == "abc123" and s.endpoint_mode == "load_balancer"
    assert s.ttft_ms_p50 != s.ttft_ms_p50 and s.ttft_ms_p90 is None and s.max_concurrency == 8 and s.n_records == 3
    r = {x.request_id: x for x in lake.table("typed", "sweep_requests").collect()}
    assert r["a"].tpot_ms == 500.0 and r["b"].tpot_ms is None and r["c"].ttft_ms is None and r["b"].arrival_offset_s == 0.25
    assert json.loads(r["c"].error) == {"code": 1}
    g = lake.table("gold", "scoring_cost_per_batch").first()
    assert (g.mean_score, g.parse_ok_rate, g.article_wall_ms_p50, g.article_wall_ms_p90) == (7.0, 0.5, 100, 300)
    assert (g.wall_s_per_article, g.est_cost_usd_per_1k_articles, g.prompt_tokens) == (0.25, 10.0, 20)
    w = lake.table("gold", "sweep_latency").first()
    assert w.rec_n_ok == 2 and w.rec_ttft_ms_p50 == 500.0 and w.rec_ttft_ms_p99 == 750.0


def test_log_events(lake):
    rows = {r.line_no: r for r in lake.table("typed", "log_events").withColumn("t", F.date_format("ts_utc", "yyyy-MM-dd HH:mm:ss.SSS"))
            .where("source_file like '%x_worker_log.txt'").collect()}
    assert [rows[i].ts_format for i in range(1, 7)] == ["none", "none", "console", "iso", "pipe", "pipe"]
    assert rows[3].t == "2026-09-23 19:53:07.000" and rows[4].t == "2026-09-30 02:56:18.120" and rows[5].t == "2026-09-23 18:50:51.989"
    assert [rows[i].event_kind for i in range(1, 7)] == ["other", "blank", "other", "runpod_sdk", "vllm", "blank"]
    assert rows[4].request_id == "r1" and rows[4].message == "Started." and rows[4].level == "INFO"
    assert (rows[5].process_role, rows[5].pid, rows[5].worker_id, rows[5].message) == ("EngineCore", 12, "wk7", "Loading weights took 18.12 seconds")


def test_revert_rename_and_emptied_records(lake):
    import os
    name = "alpha/results/series_a.json"
    put(lake, name, series("series_a", 1))
    with pytest.raises(lakehouse.BuildError, match="differ from the manifest"):
        lakehouse.ingest(lake, "early")                             # bytes changed since the manifest
    land(lake)
    assert lakehouse.ingest(lake, "r2")["series_runs"] == 1
    lakehouse.build_typed(lake)
    assert count(lake, "typed", "requests", "source = 'series_json'") == 2
    put(lake, name, series("series_a", 2))
    land(lake)
    assert lakehouse.ingest(lake, "r3") == {}                       # this version is already there
    lakehouse.build_typed(lake)
    assert count(lake, "typed", "requests", "source = 'series_json'") == 4   # reverted, not "newest"
    os.rename(f"{lake.landing}/{name}", f"{lake.landing}/alpha/results/series_renamed.json")
    put(lake, "alpha/results/sweep_s.json", sweep(False))
    land(lake)
    lakehouse.ingest(lake, "r4")
    lakehouse.build_typed(lake)
    assert count(lake, "typed", "requests", f"source_file = '{name}'") == 0
    assert count(lake, "typed", "requests", "source = 'series_json'") == 4
    assert count(lake, "typed", "sweep_requests") == 0 and count(lake, "typed", "sweep_summaries") == 1


def test_lost_ledger_is_repaired(lake):
    shutil.rmtree(lake.path("raw", "ledger"))
    done = lakehouse.ingest(lake, "r5")
    assert done["reconciled"] > 0 and set(done) == {"reconciled"}
    assert lake.ledger().where("not reconciled").count() == 0


def test_missing_version_and_partial_ingest_are_refused(lake):
    put(lake, "alpha/results/sweep_s.json", sweep(True))
    put(lake, "alpha/results/series_new.json", series("series_new", 1))
    land(lake)
    with pytest.raises(lakehouse.BuildError, match="not in the raw layer"):
        lakehouse.build_typed(lake)
    shutil.rmtree(lake.path("raw", "sweep_records"))
    shutil.rmtree(lake.path("raw", "ledger"))
    with pytest.raises(lakehouse.BuildError, match="sweep_records"):
        lakehouse.build_typed(lake)
    assert lakehouse.ingest(lake, "r6")["sweep_records"] == 3
    lakehouse.build_typed(lake)
    assert count(lake, "typed", "sweep_requests") == 3


def test_empty_file_is_a_complete_ingest(lake):
    put(lake, "alpha/results/empty_worker_log.txt", "")
    land(lake)
    done = lakehouse.ingest(lake, "r7")
    assert done["log_lines"] == 0 and lake.ledger().where("source_file like '%empty_worker_log.txt' and rows = 0").count() == 1
    lakehouse.build_typed(lake)
    assert lakehouse.ingest(lake, "r7b") == {}


def test_landing_one_root_keeps_the_others(lake):
    before = {(r.landed_relpath, r.sha256_landed) for r in lake.manifest().collect()}
    assert lakehouse.build_manifest(lake, RULES, ["alpha"]) < len(before)
    assert {(r.landed_relpath, r.sha256_landed) for r in lake.manifest().collect()} == before


def test_progress_bars_are_counted_as_they_are_read(lake):
    put(lake, "alpha/results/bar_worker_log.txt", "start\n 10%|\r 20%|\r\nend")
    land(lake)
    assert lakehouse.ingest(lake, "r7c")["log_lines"] == 4
    assert lakehouse.verify(lake).collect() == []


def test_csv_without_a_line_and_with_a_quoted_header(lake):
    put(lake, "beta/requests_old.csv", "")
    land(lake)
    assert lakehouse.ingest(lake, "r7d") == {"request_rows": 0, "ledger": 1}
    lakehouse.build_typed(lake)
    assert lakehouse.verify(lake).collect() == []
    from tephra.sources import readers
    folder = f"{lake.root}/quoted"
    (path := __import__("pathlib").Path(folder)).mkdir(parents=True)
    (path / "b.csv").write_text(",".join(f'"{c}"' for c in readers.CSV_KEYS["scored_batch_rows"]) + ',"one, two"\n' + "1," * 8 + "x\n")
    rows = readers.csv_table(lake.spark, [folder], folder, "scored_batch_rows")
    assert rows.first()["one, two"] == "x"


def test_forced_ingest_does_not_double_typed_rows(lake):
    before = count(lake, "typed", "requests"), count(lake, "typed", "log_events")
    done = lakehouse.ingest(lake, "r8", force=True)
    assert done["series_runs"] > 0
    lakehouse.build_typed(lake)
    assert before == (count(lake, "typed", "requests"), count(lake, "typed", "log_events"))
    assert {r.note for r in lakehouse.verify(lake).collect()} == {"appended 2x"}


def test_manifest_agrees_with_files(lake, spark):
    files = landing.scan(spark, lake.landing)
    listed = landing.manifest_problems(lake.manifest(), files, list(lakehouse.FEEDS))
    assert {(r.source_file, r.problem) for r in listed.collect()} == {
        ("alpha/results/ignored.txt", "not listed"), ("alpha/results/host.pem", "not listed"), ("alpha/results/host.pem", "forbidden name"), ("beta/logs/stdout_1.log", "not listed")}
    broken = lake.manifest().withColumn("sha256_landed", F.when(F.col("dataset") != "sweep", F.col("sha256_landed")).otherwise("x")).withColumn(
        "landed_relpath", F.when(F.col("dataset") == "scored_items_csv", "gone.csv").otherwise(F.col("landed_relpath")))
    found = {(r.source_file, r.problem) for r in landing.manifest_problems(broken, files, ["sweep"]).collect()}
    assert ("gone.csv", "listed but missing") in found and ("beta/items.csv", "not listed") in found
    assert ("alpha/results/sweep_s.json", "checksum differs") in found and ("gone.csv", "no reader for dataset") in found


def test_misrouted_csv_is_refused(lake, spark):
    from tephra.sources import readers
    with pytest.raises(ValueError, match="lacks the key columns"):
        readers.csv_table(spark, [f"{lake.landing}/beta/items.csv"], lake.landing, "request_rows")


def test_unredacted_landing_is_refused(lake):
    put(lake, "beta/logs/leak.log", "token hf_" + "A" * 34 + "\n")
    with pytest.raises(lakehouse.BuildError, match="unredacted"):
        land(lake)


def test_nothing_is_read_twice(lake, monkeypatch):
    import os
    from pathlib import Path
    (Path(lake.landing) / "beta/logs/leak.log").unlink(missing_ok=True)
    land(lake)
    lakehouse.ingest(lake, "all")
    opened = []
    plain = landing.opened
    monkeypatch.setattr(landing, "opened", lambda spark, folder, files: opened.append(files.count()) or plain(spark, folder, files))
    name = f"{lake.landing}/beta/items.csv"
    before, stamp = open(name, "rb").read(), os.stat(name)
    with open(name, "wb") as f:
        f.write(b"x" * len(before))
    os.utime(name, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    land(lake)
    assert lakehouse.ingest(lake, "again") == {} and lakehouse.verify(lake).collect() == []
    assert set(opened) == {0}                                       # size and time are as recorded: nobody has looked inside
    lakehouse.build_typed(lake)
    os.utime(name, ns=(stamp.st_atime_ns, stamp.st_mtime_ns + 10**9))
    with pytest.raises(lakehouse.BuildError, match="differ from the manifest"):
        lakehouse.ingest(lake, "touched")
    assert max(opened) == 1
    with open(name, "wb") as f:
        f.write(before)
    land(lake)
    assert lakehouse.ingest(lake, "restored") == {}                 # this version is already there
    with pytest.raises(lakehouse.BuildError):
        with open(name, "wb") as f:
            f.write(b"x" * len(before))
        os.utime(name, ns=(stamp.st_atime_ns, os.stat(name).st_mtime_ns + 2 * 10**9))
        lakehouse.ingest(lake, "deep")
    with open(name, "wb") as f:
        f.write(before)
    assert lakehouse.build_manifest(lake, RULES, ["alpha", "beta"], reread=True) == lake.manifest().count() and max(opened) >= 3


def test_a_broken_check_stops_the_build(lake):
    from pathlib import Path
    (Path(lake.landing) / "beta/logs/leak.log").unlink(missing_ok=True)
    put(lake, "beta/logs/bad.log", "2026-13-45 14:50:51.989 | info | wk7 | hello\n")
    land(lake)
    lakehouse.ingest(lake, "bad")
    with pytest.raises(lakehouse.BuildError, match="checks of the typed layer failed"):
        lakehouse.build_typed(lake)
    with pytest.raises(lakehouse.BuildError, match="checks of the typed layer failed"):
        lakehouse.build_gold(lake)                                  # the next layer is not built on it
    kept = [json.loads(r.row) for r in lake.table("checks", "violations").where("rule = 'recognised lines have a time'").collect()]
    assert [(r["source_file"], r["line_no"]) for r in kept] == [("beta/logs/bad.log", 1)]
    (Path(lake.landing) / "beta/logs/bad.log").unlink()
    land(lake)
    lakehouse.build_typed(lake)
    assert set(lakehouse.build_gold(lake)) == set(lakehouse.GOLD_TABLES)
    last = lake.table("checks", "results").groupBy("layer", "rule", "severity").agg(F.max_by("violations", "checked_at").alias("n")).collect()
    assert {r.layer for r in last} == {"typed", "gold"} and all(r.n == 0 for r in last if r.severity == "error")
