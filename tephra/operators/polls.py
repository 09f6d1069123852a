"""Flat tables out of API snapshot documents, and the daily roll-up over them.

A raw poll row is one JSON document as text. Sub-objects are read as text first (`from_json` with string
leaves), so an unknown or malformed part cannot fail the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import by_time, ordered_scan
from ..functions.text import blank_to_null, selection_of_csv, sorted_csv
from .snapshot import latest_wins, pick_max, terminal_wins

# The parts of a document and of its sub-objects.
DOC = ("polled_at string, endpoints array<string>, endpoints_complete boolean, workers map<string,string>, "
       "health map<string,string>, releases map<string,string>, jobs array<string>, "
       "billing struct<metadata:struct<recordCount:bigint>,records:array<string>>")
ENDPOINT = ("id string, name string, type string, flashboot string, "
            "gpu struct<pools:array<string>,count:int,excludedTypes:array<string>,allowedCudaVersions:array<string>>, "
            "workers struct<min:int,max:int,idleTimeout:int>, scaling struct<type:string,queueDelay:double,requestCount:double>, "
            "timeout bigint, image string, dataCenterIds array<string>, networkVolumes string, createdAt string")
WORKERS = "endpointVersion int, workers array<string>"
WORKER = ("id string, status string, gpuTypeId string, dataCenterId string, startedAt string, uptimeSeconds bigint, "
          "image string, version int, isStale boolean, gpuCount int")
HEALTH = ("jobs struct<completed:bigint,failed:bigint,inProgress:bigint,inQueue:bigint,retried:bigint>, "
          "workers struct<idle:bigint,initializing:bigint,ready:bigint,running:bigint,throttled:bigint,unhealthy:bigint>, _error string")
RELEASES = ("pagination struct<hasNextPage:boolean>, "
            "releases array<struct<version:int,createdAt:string,source:string,diff:array<struct<field:string,old:string,new:string>>>>")
BILL = "serverlessId string, startTime string, endTime string, totalAmount double, gpuAmount double, cpuAmount double, diskAmount double"
JOB = ("endpoint_id string, job_id string, submitted_at string, "
       "status struct<status:string,delayTime:bigint,executionTime:bigint,workerId:string,_error:string>")
# Change-log field -> tracked column.
LOG_FIELDS = {"gpuIds": "gpu_ids", "minCudaVersion": "min_cuda", "allowedCudaVersions": "allowed_cuda",
              "template.imageName": "image", "locations": "locations", "template.containerDiskInGb": "disk_gb"}


def instant(text: Column) -> Column:
    return F.try_to_timestamp(text)


def exploded(df: DataFrame, keep: list, array: str, schema: str, out: str) -> DataFrame:
    """One row per JSON text of `array`, parsed as `out`; `keep` columns (or aliased expressions) stay."""
    rows = df.select(*keep, F.explode(array).alias("_json"))
    return rows.select(*[c for c in rows.columns if c != "_json"], F.from_json("_json", schema).alias(out))


def documents(raw: DataFrame) -> DataFrame:
    """One parsed row per distinct document; a document loaded twice counts once (its latest load)."""
    single = pick_max(raw.select("doc", "source_sha256", "source_file", "ingested_at", "run_label"), ["source_sha256"],
                      [F.col("ingested_at"), F.col("run_label")])
    return (single.withColumn("d", F.from_json("doc", DOC)).drop("doc")
            .withColumns({"poll_id": F.col("source_sha256"), "polled_at_utc": instant(F.col("d.polled_at"))}))


def polls(docs: DataFrame, unit: str = "day") -> DataFrame:
    """Poll header, numbered in chunks of one `unit`. Documents older than the completeness flag were complete when they listed anything."""
    n = F.greatest(F.size("d.endpoints"), F.lit(0))
    head = docs.select("poll_id", "polled_at_utc", F.when(F.col("d.endpoints").isNotNull(), n).alias("n_endpoints"),
                       F.coalesce("d.endpoints_complete", F.when(F.col("d.endpoints").isNotNull(), n > 0)).alias("endpoints_complete"),
                       F.col("d.billing.metadata.recordCount").alias("n_billing_records"),
                       F.when(F.col("d.jobs").isNotNull(), F.size("d.jobs")).alias("n_job_lookups"),
                       "source_file", "ingested_at", F.col("run_label").alias("bronze_run_label"))
    return ordered_scan(head, [], ["polled_at_utc", "poll_id"], by_time("polled_at_utc", unit), running_sum={"poll_seq": F.lit(1)})


def endpoints(docs: DataFrame) -> DataFrame:
    rows = docs.select("poll_id", "polled_at_utc", F.explode("d.endpoints").alias("config_json")).withColumn("e", F.from_json("config_json", ENDPOINT))
    e = lambda path: F.col(f"e.{path}")
    return rows.select(
        "poll_id", "polled_at_utc", e("id").alias("endpoint_id"), e("name").alias("name"), e("type").alias("endpoint_type"),
        e("flashboot").alias("flashboot"), e("gpu.pools").alias("gpu_pools"), e("gpu.count").alias("gpu_count"),
        e("gpu.excludedTypes").alias("gpu_excluded_types"), e("gpu.allowedCudaVersions").alias("allowed_cuda_versions"),
        e("workers.min").alias("workers_min"), e("workers.max").alias("workers_max"), e("workers.idleTimeout").alias("idle_timeout_s"),
        e("scaling.type").alias("scaling_type"), F.coalesce(e("scaling.queueDelay"), e("scaling.requestCount")).alias("scaling_value"),
        e("timeout").alias("request_timeout_ms"), e("image").alias("image"), e("dataCenterIds").alias("data_center_ids"),
        e("networkVolumes").alias("network_volumes"), instant(e("createdAt")).alias("created_at_utc"), "config_json")


def workers(docs: DataFrame) -> DataFrame:
    """Poll x endpoint x active worker."""
    per = docs.select("poll_id", "polled_at_utc", F.explode("d.workers").alias("endpoint_id", "resp")).withColumn("r", F.from_json("resp", WORKERS))
    one = exploded(per, ["poll_id", "polled_at_utc", "endpoint_id", F.col("r.endpointVersion").alias("endpoint_version")], "r.workers", WORKER, "w")
    w = lambda path: F.col(f"w.{path}")
    return one.select("poll_id", "polled_at_utc", "endpoint_id", w("id").alias("worker_id"), w("status").alias("status"),
                      w("gpuTypeId").alias("gpu_type_id"), w("dataCenterId").alias("data_center_id"),
                      instant(w("startedAt")).alias("started_at_utc"), w("uptimeSeconds").alias("uptime_s"), w("image").alias("image"),
                      w("version").alias("config_version"), "endpoint_version", w("isStale").alias("is_stale"), w("gpuCount").alias("gpu_count"))


def health(docs: DataFrame) -> DataFrame:
    per = docs.select("poll_id", "polled_at_utc", F.explode("d.health").alias("endpoint_id", "resp")).withColumn("h", F.from_json("resp", HEALTH))
    names = {"jobs": {"completed": "completed", "failed": "failed", "inProgress": "in_progress", "inQueue": "in_queue", "retried": "retried"},
             "workers": {k: k for k in ("idle", "initializing", "ready", "running", "throttled", "unhealthy")}}
    return per.select("poll_id", "polled_at_utc", "endpoint_id",
                      *[F.col(f"h.{part}.{src}").alias(f"{part}_{dst}") for part, cols in names.items() for src, dst in cols.items()],
                      F.col("h._error").alias("api_error"))


def billing_hourly(docs: DataFrame) -> DataFrame:
    """Each poll re-reads recent buckets; the newest reading of a bucket wins."""
    rows = exploded(docs, ["poll_id", "polled_at_utc"], "d.billing.records", BILL, "b")
    b = lambda path: F.col(f"b.{path}")
    typed = rows.select("poll_id", "polled_at_utc", b("serverlessId").alias("endpoint_id"), instant(b("startTime")).alias("bucket_start_utc"),
                        instant(b("endTime")).alias("bucket_end_utc"), b("totalAmount").alias("total_usd"), b("gpuAmount").alias("gpu_usd"),
                        b("cpuAmount").alias("cpu_usd"), b("diskAmount").alias("disk_usd"))
    return latest_wins(typed, ["endpoint_id", "bucket_start_utc"])


def jobs(docs: DataFrame) -> DataFrame:
    rows = exploded(docs, ["poll_id", "polled_at_utc"], "d.jobs", JOB, "j")
    j = lambda path: F.col(f"j.{path}")
    typed = rows.select("poll_id", "polled_at_utc", j("endpoint_id").alias("endpoint_id"), j("job_id").alias("job_id"),
                        instant(j("submitted_at")).alias("submitted_at_utc"), j("status.status").alias("status"),
                        j("status.delayTime").alias("delay_ms"), j("status.executionTime").alias("exec_ms"),
                        j("status.workerId").alias("worker_id"), j("status._error").alias("api_error"))
    return terminal_wins(typed, ["endpoint_id", "job_id"])


def canonical_log_value(column: Column, raw: Column) -> Column:
    """One spelling per tracked column, the same one the configuration table uses; null for untracked fields."""
    or_all = F.coalesce(blank_to_null(raw), F.lit("ALL"))
    return (F.when(column == "gpu_ids", selection_of_csv(raw))
            .when(column.isin("allowed_cuda", "locations"), sorted_csv(or_all))
            .when(column == "min_cuda", or_all)
            .when(column.isNotNull(), blank_to_null(raw)))


def releases(docs: DataFrame) -> DataFrame:
    """Endpoint x release x changed field, from the newest poll that carried the release; empty diffs keep a row."""
    per = docs.select("poll_id", "polled_at_utc", "ingested_at", F.explode("d.releases").alias("endpoint_id", "resp")).withColumn("r", F.from_json("resp", RELEASES))
    each = per.select("poll_id", "polled_at_utc", "ingested_at", "endpoint_id", F.col("r.pagination.hasNextPage").alias("history_truncated"),
                      F.explode("r.releases").alias("rel")).withColumn("release_version", F.col("rel.version"))
    newest = pick_max(each, ["endpoint_id", "release_version"], [F.col("polled_at_utc"), F.col("ingested_at"), F.col("poll_id")])
    diffs = newest.select("*", F.explode_outer("rel.diff").alias("f"))
    column = F.try_element_at(F.create_map(*[F.lit(x) for kv in LOG_FIELDS.items() for x in kv]), F.col("f.field"))
    return diffs.withColumn("column_name", column).select(
        "endpoint_id", "release_version", instant(F.col("rel.createdAt")).alias("created_at_utc"), F.col("rel.source").alias("release_source"),
        F.col("f.field").alias("field"), "column_name", canonical_log_value(F.col("column_name"), F.col("f.old")).alias("old_value"),
        canonical_log_value(F.col("column_name"), F.col("f.new")).alias("new_value"), "history_truncated", F.col("poll_id").alias("seen_in_poll_id"))


def daily_rollup(endpoint_rows: DataFrame, worker_rows: DataFrame, events: DataFrame, health_rows: DataFrame, billing: DataFrame) -> DataFrame:
    """Endpoint x UTC day: polls, last configuration, workers seen, events, counter deltas and cost.

    Every input shrinks to one row per (endpoint, day) before it is joined.
    """
    key = ["endpoint_id", "day"]
    on_day = lambda df, at="polled_at_utc": df.withColumn("day", F.to_date(at))
    eps = on_day(endpoint_rows)
    days = eps.groupBy(*key).agg(F.countDistinct("poll_id").alias("n_polls"), F.max("polled_at_utc").alias("last_poll_utc"))
    cfg = pick_max(eps.select(*key, "polled_at_utc", "poll_id", "name", "flashboot", "workers_min", "workers_max", "idle_timeout_s", "gpu_pools"),
                   key, [F.col("polled_at_utc"), F.col("poll_id")]).drop("polled_at_utc", "poll_id")
    wk = on_day(worker_rows)
    active = wk.groupBy(*key, "poll_id").agg(F.count("*").alias("n")).groupBy(*key).agg(F.max("n").alias("max_active_workers"))
    seen = wk.groupBy(*key).agg(F.countDistinct("worker_id").alias("n_workers_seen"))
    types = wk.groupBy(*key).agg(F.array_sort(F.collect_set("gpu_type_id")).alias("gpu_types_seen"),
                                 F.array_sort(F.collect_set("data_center_id")).alias("data_centers_seen"))
    names = {"appeared": "n_worker_appearances", "disappeared": "n_worker_disappearances", "status_changed": "n_status_changes"}
    ev = on_day(events).groupBy(*key).agg(*[F.count_if(F.col("event") == e).alias(n) for e, n in names.items()])
    delta = lambda c: (F.max(c) - F.min(c)).alias(f"{c}_delta")
    hl = on_day(health_rows).groupBy(*key).agg(delta("jobs_completed"), delta("jobs_failed"), delta("jobs_retried"),
                                               F.max(F.col("workers_running") + F.col("workers_idle") + F.col("workers_ready")).alias("max_workers_by_health"))
    bl = on_day(billing, "bucket_start_utc").groupBy(*key).agg(
        F.round(F.sum("total_usd"), 4).alias("total_usd"), F.round(F.sum("gpu_usd"), 4).alias("gpu_usd"), F.count("*").alias("n_billing_hours"))
    out = days
    for part in (cfg, seen, active, types, ev, hl, bl):
        out = out.join(part, key, "left")
    return out.fillna(0, ["n_workers_seen", "max_active_workers", *names.values()])
