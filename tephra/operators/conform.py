"""Typed, conformed tables from the raw layer: requests, phases, sweeps, scored items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (blank_to_null, canonical_name, endpoint_mode, endpoint_of_url, split_status,
                              unbounded_if_null)
from .snapshot import keep_preferred

# A cold request answered faster than this met a resumed or still-warm worker.
FAST_MS = 5_000

# Shapes of the JSON text kept in the raw tables.
REQUEST_JSON = ("status int, total_s double, ok boolean, job_status string, delay_ms bigint, execution_ms bigint, "
                "worker_id string, submit_wall double, cold boolean, error string, flashboot_resume boolean, "
                "phases_s map<string,double>, timeline struct<marks:map<string,double>,notes:map<string,string>>")
_STATS = "struct<mean:double,p50:double,p90:double,p99:double>"
SUMMARY_JSON = ("num_requests bigint, completed bigint, failed bigint, duration_s double, requests_per_s double, "
                "throughput_tok_s double, total_throughput_tok_s double, "
                f"ttft_ms {_STATS}, tpot_ms {_STATS}, e2e_ms {_STATS}, prompt_tokens bigint, output_tokens bigint")
TRACE_JSON = "n bigint, prompt_mean double, prompt_p50 double, output_mean double, output_p50 double, span_s double, source string"
ARGS_JSON = ("client_procs int, max_concurrency int, trace_n int, max_prompt_len int, max_output_len int, "
             "shared_prefix_len int, seed int, warmup boolean")
SERVER_JSON = "ttft_ms_mean double, tpot_ms_mean double, e2e_ms_mean double"

# The request table, name -> type, in output order.
REQUEST_FIELDS = {
    "source": "string", "engine": "string", "engine_build": "string", "series_label": "string",
    "endpoint_id": "string", "run_index": "int", "request_index": "int", "kind": "string",
    "request_ts_utc": "timestamp", "model": "string", "gpu_label": "string", "gpu_label_raw": "string",
    "gpu_label_override_note": "string", "gpu_model": "string", "gpu_tier": "string", "price_per_hr_usd": "double",
    "flashboot": "string", "weights_mode": "string", "http_status": "int", "job_status": "string", "ok": "boolean",
    "wall_ms": "double", "delay_ms": "bigint", "exec_ms": "bigint", "worker_id": "string", "prompt_tokens": "bigint",
    "completion_tokens": "bigint", "is_flashboot_hit": "boolean", "flashboot_resume_recorded": "boolean",
    "request_duration_s": "double", "est_cost_usd": "double", "host_state": "string", "run_note": "string",
    "workers_before_json": "string", "error": "string", "source_file": "string", "source_sha256": "string",
    "bronze_run_label": "string",
}


def conformed(df: DataFrame, **columns: Column) -> DataFrame:
    """Every request column in order and type; a source names only the ones it has."""
    return df.select(*[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in REQUEST_FIELDS.items()])


def _lineage() -> dict[str, Column]:
    return {"source_file": F.col("source_file"), "source_sha256": F.col("source_sha256"),
            "bronze_run_label": F.col("run_label")}


def unpivot_pair(df: DataFrame, cold: str = "cold_json", warm: str = "warm_json") -> DataFrame:
    """One row per run -> two rows, `kind` cold / warm (in place of any document kind) with the request in `body`."""
    both = F.array(F.struct(F.lit("cold").alias("kind"), F.col(cold).alias("body")),
                   F.struct(F.lit("warm").alias("kind"), F.col(warm).alias("body")))
    return df.withColumn("_pair", F.explode(both)).select(*[c for c in df.columns if c != "kind"], "_pair.kind", "_pair.body")


def enrich(runs: DataFrame, series: DataFrame, gpus: DataFrame, notes: DataFrame) -> DataFrame:
    """Series facts, then the price of the series' GPU, then notes on the single run; all left joins.

    The three sides are curated files. No join is hinted: Spark broadcasts a side only when its size is
    under the session's threshold and shuffles (splitting skewed keys) otherwise.
    """
    s = series.select("series_label", "engine", "engine_build", F.col("model").alias("series_model"),
                      "gpu_model", "flashboot", "weights_mode")
    g = gpus.select(F.col("gpu_label").alias("gpu_model"), F.col("tier").alias("gpu_tier"), "price_per_hr_usd")
    n = notes.select("series_label", "run_index", "host_state", F.col("note").alias("run_note"))
    return (runs.join(s, "series_label", "left").join(g, "gpu_model", "left")
            .join(n, ["series_label", "run_index"], "left"))


def override_labels(df: DataFrame, overrides: DataFrame, *, key: str = "endpoint_id", at: str = "ts_utc",
                    label: str = "gpu") -> DataFrame:
    """Replace a recorded label by the curated one for single (key, instant) pairs; adds `gpu_label` and note.

    Instants are compared, not their text, so `Z` and `+00:00` match.
    """
    o = overrides.select(F.col(key).alias("_ok"), F.try_to_timestamp(F.col("ts_utc")).alias("_oat"),
                         F.col("gpu_label").alias("_olabel"), F.col("note").alias("gpu_label_override_note"))
    met = (F.col(key) == F.col("_ok")) & (F.try_to_timestamp(F.col(at)) == F.col("_oat"))
    return (df.join(o, met, "left").withColumn("gpu_label", F.coalesce("_olabel", F.col(label)))
            .drop("_ok", "_oat", "_olabel"))


def series_requests(runs: DataFrame, series: DataFrame, gpus: DataFrame, notes: DataFrame, *,
                    source: str = "series_json", default_engine: str | None = None) -> DataFrame:
    """Requests from series documents (source A)."""
    rows = (enrich(runs.withColumnRenamed("label", "series_label"), series, gpus, notes)
            .transform(unpivot_pair).withColumn("j", F.from_json("body", REQUEST_JSON)))
    j = lambda name: F.col(f"j.{name}")
    unknown = F.lit("unknown")
    return conformed(
        rows, source=F.lit(source), engine=F.coalesce("engine", F.lit(default_engine)),
        engine_build=F.col("engine_build"), series_label=F.col("series_label"), endpoint_id=F.col("endpoint"),
        run_index=F.col("run_index"), kind=F.col("kind"), request_ts_utc=F.to_timestamp(j("submit_wall")),
        model=F.col("series_model"), gpu_label=F.col("gpu_model"), gpu_label_raw=F.col("gpu_model"),
        gpu_model=F.col("gpu_model"), gpu_tier=F.col("gpu_tier"), price_per_hr_usd=F.col("price_per_hr_usd"),
        flashboot=F.coalesce("flashboot", unknown), weights_mode=F.col("weights_mode"),
        http_status=j("status"), job_status=j("job_status"), ok=F.coalesce(j("ok"), F.lit(False)),
        wall_ms=j("total_s") * 1000, delay_ms=j("delay_ms"), exec_ms=j("execution_ms"), worker_id=j("worker_id"),
        flashboot_resume_recorded=j("flashboot_resume"), host_state=F.coalesce("host_state", unknown),
        run_note=F.col("run_note"), workers_before_json=F.col("health_before_json"), error=j("error"), **_lineage())


def csv_requests(rows: DataFrame, gpus: DataFrame, overrides: DataFrame, *, preferred_file: str | None = None,
                 source: str = "request_csv", engine: str = "worker-vllm") -> DataFrame:
    """Requests from all-string CSV rows (source B), deduplicated across overlapping files."""
    key = ["ts_utc", "endpoint_id", "kind", "cycle", "req", "delay_ms", "exec_ms"]
    single = keep_preferred(rows, key, F.when(F.col("source_file") == F.lit(preferred_file), 0).otherwise(1), "source_file")
    g = gpus.select("gpu_label", F.col("tier").alias("gpu_tier"), "gpu_model", "price_per_hr_usd")
    rows = override_labels(single, overrides).join(g, "gpu_label", "left")
    num = lambda name, t: F.col(name).try_cast(t)
    unknown = F.lit("unknown")
    return conformed(
        rows, source=F.lit(source), engine=F.lit(engine), endpoint_id=F.col("endpoint_id"),
        run_index=num("cycle", "int"), request_index=num("req", "int"), kind=F.col("kind"),
        request_ts_utc=F.try_to_timestamp(F.col("ts_utc")), model=canonical_name(F.col("model")),
        gpu_label=F.col("gpu_label"), gpu_label_raw=F.col("gpu"),
        gpu_label_override_note=F.col("gpu_label_override_note"), gpu_model=F.col("gpu_model"),
        gpu_tier=F.col("gpu_tier"), price_per_hr_usd=F.col("price_per_hr_usd"), flashboot=unknown,
        weights_mode=F.when(F.col("gpu_label").contains("vol"), "volume").otherwise("fetched"),
        **split_status(F.col("status")), ok=F.col("status") == "COMPLETED", wall_ms=num("wall_ms", "double"),
        delay_ms=num("delay_ms", "bigint"), exec_ms=num("exec_ms", "bigint"),
        prompt_tokens=num("prompt_tokens", "bigint"), completion_tokens=num("completion_tokens", "bigint"),
        host_state=unknown, workers_before_json=blank_to_null(F.col("workers_before")),
        error=blank_to_null(F.col("error")), **_lineage())


def request_metrics(df: DataFrame, fast_ms: int = FAST_MS) -> DataFrame:
    """Fast-hit flag (cold rows only), request duration (ok rows only) and estimated cost (priced rows only)."""
    busy = F.coalesce("delay_ms", F.lit(0)) + F.coalesce("exec_ms", F.lit(0))
    duration = F.when(F.col("ok"), busy / 1000.0)
    return df.withColumns({
        "is_flashboot_hit": F.when(F.col("kind") == "cold", F.col("ok") & (F.col("delay_ms") < fast_ms)),
        "request_duration_s": duration,
        "est_cost_usd": duration / 3600.0 * F.col("price_per_hr_usd"),
    })


def requests(sources: Sequence[DataFrame], fast_ms: int = FAST_MS) -> DataFrame:
    """Conformed union of the sources with the derived metrics, columns in contract order."""
    both = sources[0]
    for other in sources[1:]:
        both = both.unionByName(other)
    return request_metrics(both, fast_ms).select(*REQUEST_FIELDS)


def startup_phases(runs: DataFrame) -> DataFrame:
    """(series, run, name) rows out of two JSON maps: phase durations and mark instants."""
    j = runs.withColumn("j", F.from_json("cold_json", REQUEST_JSON))
    def entries(kind: str, m: Column) -> Column:
        rows = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:double>>"))
        return F.transform(rows, lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("name"), e["value"].alias("value")))

    both = F.concat(entries("phase", F.col("j.phases_s")), entries("mark", F.col("j.timeline.marks")))
    x = j.select("*", F.explode(both).alias("e"))
    value = F.col("e.value")
    return x.select(F.col("label").alias("series_label"), F.col("endpoint").alias("endpoint_id"),
                    F.col("run_index").cast("int").alias("run_index"), F.col("j.worker_id").alias("worker_id"),
                    "e.kind", "e.name", "source_file", "source_sha256", F.col("run_label").alias("bronze_run_label"),
                    F.when(F.col("e.kind") == "phase", value).alias("seconds"),
                    F.when(F.col("e.kind") == "mark", F.to_timestamp(value)).alias("mark_ts_utc"))


def sweep_summaries(runs: DataFrame) -> DataFrame:
    """One typed row per request-rate run; a null rate is the unbounded run and becomes inf plus a flag."""
    j = runs.withColumns({"s": F.from_json("summary_json", SUMMARY_JSON), "t": F.from_json("trace_json", TRACE_JSON),
                          "a": F.from_json("args_json", ARGS_JSON), "sl": F.from_json("server_latency_json", SERVER_JSON)})
    renamed = {"served_model": "model", "max_concurrency": "a.max_concurrency", "client_procs": "a.client_procs",
               "num_requests": "s.num_requests", "completed": "s.completed", "failed": "s.failed",
               "duration_s": "s.duration_s", "requests_per_s": "s.requests_per_s", "output_tok_s": "s.throughput_tok_s",
               "total_tok_s": "s.total_throughput_tok_s"}
    stats = {f"{m}_{k}": f"s.{m}.{k}" for m in ("ttft_ms", "tpot_ms", "e2e_ms") for k in ("mean", "p50", "p90", "p99")}
    tail = {"prompt_tokens": "s.prompt_tokens", "output_tokens": "s.output_tokens", "trace_n": "t.n",
            "trace_prompt_mean": "t.prompt_mean", "trace_output_mean": "t.output_mean", "trace_source": "t.source",
            "server_ttft_ms_mean": "sl.ttft_ms_mean", "server_tpot_ms_mean": "sl.tpot_ms_mean",
            "server_e2e_ms_mean": "sl.e2e_ms_mean", "n_records": "n_records", "source_file": "source_file",
            "source_sha256": "source_sha256", "bronze_run_label": "run_label"}
    pick = lambda names: [F.col(path).alias(n) for n, path in names.items()]
    url = F.col("base_url")
    return j.select("system", endpoint_of_url(url).alias("endpoint_id"), endpoint_mode(url).alias("endpoint_mode"),
                    F.col("run_index").cast("int").alias("run_index"),
                    unbounded_if_null(F.col("request_rate")).alias("request_rate"),
                    F.col("request_rate").isNull().alias("is_unbounded"), "wall_s",
                    *pick(renamed), *pick(stats), *pick(tail))


def request_latencies(records: DataFrame, run: Sequence[str] = ("source_file", "run_index")) -> DataFrame:
    """Arrival offset from the run's first arrival; first-token, end-to-end and per-token times of successes.

    The first arrival is a map-side combined minimum joined back, so a run of any length spreads over tasks.
    """
    first = records.groupBy(*run).agg(F.min("arrival_s").alias("_first"))
    good = F.col("success")
    ms = lambda a, b: (F.col(b) - F.col(a)) * 1000
    return (records.join(first, list(run), "left").withColumns({
        "arrival_offset_s": F.col("arrival_s") - F.col("_first"),
        "ttft_ms": F.when(good, ms("arrival_s", "first_token_s")),
        "e2e_ms": F.when(good, ms("arrival_s", "finish_s")),
        "tpot_ms": F.when(good & (F.col("output_tokens") > 1),
                          ms("first_token_s", "finish_s") / (F.col("output_tokens") - 1)),
    }).drop("_first"))


def sweep_requests(records: DataFrame) -> DataFrame:
    timed = request_latencies(records.withColumn("request_rate", unbounded_if_null(F.col("request_rate"))))
    return timed.select("system", F.col("run_index").cast("int").alias("run_index"), "request_rate", "request_id",
                        "arrival_offset_s", "prompt_tokens", "output_tokens", "success", "error", "ttft_ms", "e2e_ms",
                        "tpot_ms", "source_file", "source_sha256", F.col("run_label").alias("bronze_run_label"))


# Scored tables, output -> (input, how). "raw" keeps the text, "nz" turns '' into null, a type parses it.
SCORED_ITEMS = {
    "request_ts_utc": ("ts_utc", "timestamp"), "backend": ("backend", "raw"), "model": ("model", "name"),
    "model_raw": ("model", "raw"), "label": ("label", "nz"), "host": ("host", "raw"), "gpu_model": ("gpu", "nz"),
    "batch_id": ("batch_id", "raw"), "concurrency": ("concurrency", "int"), "article_id": ("article_id", "bigint"),
    "domain": ("domain", "raw"), "wall_ms": ("wall_ms", "bigint"), "prompt_tokens": ("prompt_tokens", "bigint"),
    "completion_tokens": ("completion_tokens", "bigint"), "finish_reason": ("finish_reason", "nz"),
    "score": ("score", "int"), "reason": ("reason", "nz"), "parse_ok": ("parse_ok", "flag"), "error": ("error", "nz"),
    "price_unit": ("price_unit", "raw"), "rate_in_usd_per_m": ("rate_in", "double"),
    "rate_out_usd_per_m": ("rate_out", "double"), "rate_usd_per_hr": ("rate_hr", "double"),
    "rate_source": ("rate_source", "raw"), "est_cost_usd": ("est_cost_usd", "double"),
    "fixture_sha": ("fixture_sha", "raw"), "extra_json": ("extra", "raw"),
}
SCORED_BATCHES = {
    "batch_id": ("batch_id", "raw"), "batch_ts_utc": ("ts_utc", "timestamp"), "backend": ("backend", "raw"),
    "model": ("model", "name"), "model_raw": ("model", "raw"), "label": ("label", "nz"), "host": ("host", "raw"),
    "gpu_model": ("gpu", "nz"), "worker_id": ("worker_id", "nz"), "concurrency": ("concurrency", "int"),
    "n": ("n", "int"), "n_ok": ("ok", "int"), "n_parse_ok": ("parse_ok", "int"), "wall_ms": ("wall_ms", "bigint"),
    "served_model": ("served_model", "nz"), "workers_before_json": ("workers_before", "nz"),
    "price_unit": ("price_unit", "raw"), "rate_in_usd_per_m": ("rate_in", "double"),
    "rate_out_usd_per_m": ("rate_out", "double"), "rate_usd_per_hr": ("rate_hr", "double"),
    "rate_source": ("rate_source", "raw"), "est_cost_usd": ("est_cost_usd", "double"),
    "fixture_sha": ("fixture_sha", "raw"), "note": ("note", "nz"),
}


def typed(rows: DataFrame, spec: dict[str, tuple[str, str]], lineage: bool = True) -> DataFrame:
    """All-string rows -> typed columns; text that is no number becomes null instead of failing the job."""
    how = {"raw": lambda c: c, "nz": blank_to_null, "name": canonical_name, "flag": lambda c: c == "1",
           "timestamp": lambda c: F.try_to_timestamp(c)}
    cols = [(how[kind](F.col(src)) if kind in how else F.col(src).try_cast(kind)).alias(out)
            for out, (src, kind) in spec.items()]
    tail = ["source_file", "source_sha256", F.col("run_label").alias("bronze_run_label")] if lineage else []
    return rows.select(*cols, *tail)


def scored_items(rows: DataFrame) -> DataFrame:
    return typed(rows, SCORED_ITEMS)


def scored_batches(rows: DataFrame) -> DataFrame:
    return typed(rows, SCORED_BATCHES)


def unmatched_seeds(seed: DataFrame, facts: DataFrame, key: Sequence[str], entity: str, name: str) -> DataFrame:
    """Curated rows whose full key matched no fact: `error` if their entity is in the facts, else `note`."""
    hit = facts.select(*key).distinct()
    there = facts.select(F.col(entity).alias("_entity")).where("_entity is not null").distinct().withColumn("_there", F.lit(True))
    return (seed.select(*key).join(hit, list(key), "left_anti")
            .join(there, F.col(entity) == F.col("_entity"), "left")
            .select(F.lit(name).alias("seed"), *key,
                    F.when(F.col("_there"), "error").otherwise("note").alias("severity")))


def unmatched_labels(facts: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Distinct fact labels without a dimension row (a null label never matches)."""
    labels = facts.select(fact_col).distinct()
    return labels.join(dim.select(F.col(dim_col).alias("_d")).distinct(), F.col(fact_col) == F.col("_d"), "left_anti")
