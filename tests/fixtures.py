"""A small landing folder with invented files, and the rules that route them."""

import json
from pathlib import Path

from tephra.sources.landing import Rule

RULES = [
    Rule("alpha", r"results/series_.*\.json", "coldstart_series"),
    Rule("alpha", r"results/.*_worker_log\.txt", "worker_log"),
    Rule("alpha", r"results/sweep_.*\.json", "sweep"),
    Rule("beta", r"requests.*\.csv", "request_csv"),
    Rule("beta", r"throughput\.csv", "throughput_csv"),
    Rule("beta", r"items\.csv", "scored_items_csv"),
    Rule("beta", r"batches\.csv", "scored_batches_csv"),
    Rule("beta", r"logs/.*\.log", "worker_log", exclude=r"stdout_.*\.log"),
]


def request(delay=9000, ok=True, **more):
    return {"status": 200, "total_s": delay / 1000 + 1, "ok": ok, "job_status": "COMPLETED", "delay_ms": delay, "execution_ms": 500,
            "worker_id": "wk1", **more}


def series(label, n, **more):
    runs = [{"health_before": {"jobs": {"completed": i}}, "cold": request(4999 if i == 0 else 5000 + i, submit_wall=1790000000.25 + i,
                                                                       phases_s={"engine_boot": 1.5, "brand_new_phase": 2.0},
                                                                       timeline={"marks": {"worker_start": 1790000001.5}, "notes": {"a": "b"}}),
             "warm": request(20)} for i in range(n)]
    return json.dumps({"kind": "serverless_coldstart", "mode": "queue", "endpoint": "ep1", "label": label, "image": "img", "note": "",
                       "max_tokens": 16, "idle_s": 60.0, "runs": runs, "summary": {"failures": 0}, **more}, indent=1)


def sweep(with_records=True):
    rec = [{"request_id": "a", "arrival_s": 10.0, "first_token_s": 10.5, "finish_s": 12.5, "prompt_tokens": 5, "output_tokens": 5, "success": True, "error": None},
           {"request_id": "b", "arrival_s": 10.25, "first_token_s": 11.0, "finish_s": 11.0, "prompt_tokens": 5, "output_tokens": 1, "success": True, "error": None},
           {"request_id": "c", "arrival_s": 10.5, "first_token_s": 11.0, "finish_s": 11.0, "prompt_tokens": 5, "output_tokens": 0, "success": False, "error": {"code": 1}}]
    run = {"request_rate": None, "wall_s": 3.0, "summary": {"num_requests": 3, "completed": 2, "failed": 1, "duration_s": 3.0, "ttft_ms": {"mean": 1.0, "p50": float("nan")}},
           "trace": {"n": 3, "source": "t"}, "server_counters": None, "server_latency": {"ttft_ms_mean": 2.0}}
    if with_records:
        run["records"] = rec
    return json.dumps({"kind": "sweep", "system": "s1", "server": "srv", "base_url": "https://abc123.api.runpod.ai/v1", "model": "m", "args": {"max_concurrency": 8},
                       "runs": [run]})


LOG = "\n".join([
    "# header", "",
    "Wed Sep 23 2026 15:53:07 GMT-0400 (Eastern Daylight Time) model ready",
    "2026-09-30T02:56:18.120314576Z {\"requestId\":\"r1\",\"message\":\"Started.\",\"level\":\"INFO\"}",
    "2026-09-23 14:50:51.989 | info | wk7 | (EngineCore pid=12) INFO 09-23 18:00:00 [mod:1] Loading weights took 18.12 seconds",
    "2026-09-23 14:50:52.000 | info | wk7 | ",
]) + "\n"

REQ_OLD = "ts_utc,endpoint_id,gpu,model,kind,cycle,req,wall_ms,delay_ms,exec_ms,status,prompt_tokens,completion_tokens,workers_before,error\n"
REQ_ROWS = ['2026-09-23T19:53:07+00:00,ep9,24GB,qwen/qwen3-8b,cold,1,0,9000,8000,500,COMPLETED,5,7,"{""idle"": 1}",\n',
            '2026-09-23T19:54:07+00:00,ep9,24GB,Other,warm,1,1,90,,50,403,,,,"line one\nline ""two"""\n']
REQ_NEW = REQ_OLD.replace("workers_before", "finish_reason,text,workers_before")
ITEMS = ("ts_utc,backend,model,label,host,gpu,batch_id,concurrency,article_id,domain,wall_ms,prompt_tokens,completion_tokens,finish_reason,score,reason,parse_ok,text,error,"
         "price_unit,rate_in,rate_out,rate_hr,rate_source,est_cost_usd,fixture_sha,extra\n"
         "2026-09-24T00:00:00+00:00,b,m,,h,,b1,4,1,d,100,10,5,stop,7,why,1,t,,tok,0.1,0.2,,src,0.01,sha,\n"
         "2026-09-24T00:00:01+00:00,b,m,,h,,b1,4,2,d,300,10,5,stop,,,0,t,bad,tok,0.1,0.2,,src,0.01,sha,\n")
BATCHES = ("batch_id,ts_utc,backend,model,label,host,gpu,worker_id,concurrency,n,ok,parse_ok,wall_ms,served_model,workers_before,price_unit,rate_in,rate_out,rate_hr,"
           "rate_source,est_cost_usd,fixture_sha,note\nb1,2026-09-24T00:00:02+00:00,b,m,,h,,,4,2,2,1,500,m,,tok,0.1,0.2,,src,0.02,sha,\n")
SEEDS = {
    "coldstart_series": "series_label,engine,engine_build,model,gpu_model,flashboot,flashboot_source,weights_mode,image_gb,notes\n"
                        "series_a,worker-vllm,b1,Qwen3-8B,RTX 4090,on,file,baked,10.5,campaign cell x\n",
    "gpu_labels": "gpu_label,tier,gpu_model,price_per_hr_usd,evidence,source,notes\nRTX 4090,24GB,RTX 4090,1.1,observed,s,\n24GB,24GB,RTX 4090,1.1,observed,s,\n48GB,48GB,A40,1.22,observed,s,\n",
    "coldstart_run_notes": "series_label,run_index,host_state,evidence,note,source\nseries_a,0,fresh_host,e,first,s\n",
    "coldstart_request_overrides": "endpoint_id,ts_utc,gpu_label,evidence,note,source\nep9,2026-09-23T19:53:07Z,48GB,observed,really an A40,s\n",
}


def write(folder: Path, name: str, text: str) -> Path:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return path


def landing_folder(folder: Path) -> Path:
    a, b = folder / "alpha", folder / "beta"
    write(a, "results/series_a.json", series("series_a", 2))
    write(a, "results/sweep_s.json", sweep())
    write(a, "results/x_worker_log.txt", LOG)
    write(a, "results/ignored.txt", "x")
    write(a, "results/host.pem", "x")
    write(b, "requests_old.csv", REQ_OLD + "".join(REQ_ROWS))
    write(b, "requests.csv", REQ_NEW + "".join(r.replace('COMPLETED,5,7,', 'COMPLETED,5,7,stop,hi,').replace("403,,,,", "403,,,,,,") for r in REQ_ROWS))
    write(b, "items.csv", ITEMS)
    write(b, "batches.csv", BATCHES)
    write(b, "logs/run1.log", "2026-09-30T02:56:18.120314576Z Jobs in queue: 1\n")
    write(b, "logs/stdout_1.log", "not a worker log\n")
    return folder


def seeds_folder(folder: Path) -> Path:
    for name, text in SEEDS.items():
        write(folder, f"{name}.csv", text)
    return folder
