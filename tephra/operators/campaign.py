"""A measurement campaign over serverless cells: relabelled requests, idle gaps, waits, costs and plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import by_time, ordered_scan
from ..functions.quantiles import Quantile, aggregate
from ..functions.text import ticks_between
from .conform import FAST_MS
from .marts import flag_sum, is_hit

# Error words of a request lost on the client side.
CLIENT_ERRORS = ("%ENDPOINT_PAUSED%", "%IN_QUEUE%")
# Phases carried as columns, output -> phase name.
PHASE_COLUMNS = {"placement_pull_create_s": "schedule_pull_create", "engine_boot_s": "engine_boot",
                 "download_after_spawn_s": "download_after_spawn", "submit_to_first_job_s": "submit_to_first_job"}


def gap_bucket(gap: Column) -> Column:
    return (F.when(gap.isNull(), "first").when(gap < 120, "<2 min").when(gap < 600, "2-10 min").when(gap < 3600, "10-60 min").otherwise(">60 min"))


def time_slot(at: Column) -> Column:
    h = F.hour(at)
    return F.when(h < 6, "00-06").when(h < 12, "06-12").when(h < 18, "12-18").when(h.isNotNull(), "18-24").otherwise("18-24")


def with_gap(df: DataFrame, key: str, at: str, tie: str, *, unit: str = "day") -> DataFrame:
    """Adds `gap_since_prev_request_s`; rows without a time come last, so they neither have nor make a gap."""
    timed = ordered_scan(df.where(F.col(at).isNotNull() & F.col(key).isNotNull()), [key], [at, tie], by_time(at, unit), lag={"_prev": F.col(at)})
    timed = timed.withColumn("gap_since_prev_request_s", ticks_between(F.col("_prev"), F.col(at), 1)).drop("_prev")
    return timed.unionByName(df.where(F.col(at).isNull() | F.col(key).isNull()), allowMissingColumns=True)


def relabel(df: DataFrame, fast_ms: int = FAST_MS) -> DataFrame:
    """A warm request that met a fresh worker because the cold one was lost is the run's cold start.

    Needs kind, ok, error, delay_ms and the run's `cold_ok`, `warm_was_cold`; the hit flag is recomputed afterwards.
    """
    lost = F.col("warm_was_cold") & ~F.coalesce("cold_ok", F.lit(False))
    kind = F.when((F.col("kind") == "warm") & F.coalesce(lost, F.lit(False)), "cold").otherwise(F.col("kind"))
    words = F.coalesce("error", F.lit(""))
    client = words.ilike(CLIENT_ERRORS[0]) | words.ilike(CLIENT_ERRORS[1])
    out = df.withColumns({"client_error": (F.col("kind") == "cold") & ~F.col("ok") & client, "phase_recorded": F.col("kind"), "_kind": kind})
    return (out.withColumn("kind", F.col("_kind")).drop("_kind", "cold_ok", "warm_was_cold")
            .withColumn("is_flashboot_hit", F.when(F.col("kind") == "cold", F.col("ok") & (F.col("delay_ms") < fast_ms))))


def run_flags(runs: DataFrame) -> DataFrame:
    """Per recorded run: did the cold request succeed, and did the warm one call itself cold."""
    flag = lambda col, path: F.coalesce(F.get_json_object(col, path) == "true", F.lit(False))
    return runs.select("source_file", "source_sha256", F.col("run_index").cast("int").alias("run_index"),
                       flag("cold_json", "$.ok").alias("cold_ok"), flag("warm_json", "$.cold").alias("warm_was_cold"))


def phase_columns(phases: DataFrame, key: Sequence[str]) -> DataFrame:
    return phases.where("kind = 'phase'").groupBy(*key).agg(
        *[F.max(F.when(F.col("name") == phase, F.col("seconds"))).alias(out) for out, phase in PHASE_COLUMNS.items()])


def campaign_requests(requests: DataFrame, series: DataFrame, runs: DataFrame, phases: DataFrame) -> DataFrame:
    """Requests of campaign cells and the load generator with design notes, phases, idle gap and UTC slot."""
    s = series.select("series_label", F.col("notes").alias("series_notes"))
    load = F.col("series_label").like("loadgen%")
    chosen = requests.join(s, "series_label").where(F.col("series_notes").like("campaign cell%") | load)
    labelled = relabel(chosen.join(run_flags(runs), ["source_file", "source_sha256", "run_index"], "left"))
    wide = labelled.join(phase_columns(phases, ["series_label", "run_index", "source_file"]), ["series_label", "run_index", "source_file"], "left")
    wide = wide.withColumns({"campaign_kind": F.when(load, "loadgen").otherwise("campaign"), "hour_utc": F.hour("request_ts_utc"),
                             "slot_utc": time_slot(F.col("request_ts_utc"))})
    tie = F.concat_ws("|", "source_file", "run_index", "phase_recorded")
    return with_gap(wide.withColumn("_tie", tie), "endpoint_id", "request_ts_utc", "_tie").drop("_tie")


def hit_rate_by_gap(req: DataFrame) -> DataFrame:
    """Share of fast answers among successful cold requests, by the idle gap before them."""
    cold = req.where("kind = 'cold' and ok").withColumn("gap_bucket", gap_bucket(F.col("gap_since_prev_request_s")))
    hit = is_hit()
    q = [Quantile("hit_delay_ms_p50", F.when(hit, F.col("delay_ms")), .5, "bigint"), Quantile("miss_delay_ms_p50", F.when(~hit, F.col("delay_ms")), .5, "bigint"),
         Quantile("gap_s_p50", F.col("gap_since_prev_request_s"), .5, "bigint")]
    keys = ["gpu_model", "flashboot", "weights_mode", "engine", "campaign_kind", "gap_bucket"]
    return aggregate(cold, keys, [F.count("*").alias("n_cold"), flag_sum(hit).alias("n_hits")], q).withColumn(
        "hit_rate", F.round(F.col("n_hits") / F.col("n_cold"), 3))


def placement_wait(req: DataFrame) -> DataFrame:
    """Cold-request waits per tier and UTC slot, with failures and client errors counted apart."""
    cold = req.where("kind = 'cold' and campaign_kind = 'campaign'")
    ok, client, place = F.col("ok"), F.col("client_error"), F.col("placement_pull_create_s")
    n = [F.count_if(ok).alias("n_cold_ok"), F.count_if(~ok & ~client).alias("n_failed"), F.count_if(client).alias("n_client_errors"),
         F.min("delay_ms").alias("delay_ms_min"), F.max("delay_ms").alias("delay_ms_max"), F.max(place).alias("placement_pull_create_s_max"),
         F.countDistinct("endpoint_id").alias("n_endpoints"), F.countDistinct("worker_id").alias("n_workers_seen")]
    q = [Quantile("delay_ms_p50", F.col("delay_ms"), .5, "bigint"), Quantile("placement_pull_create_s_p50", place, .5),
         Quantile("engine_boot_s_p50", F.col("engine_boot_s"), .5)]
    return aggregate(cold, ["gpu_tier", "gpu_model", "flashboot", "weights_mode", "engine", "slot_utc"], n, q)


CELL = ["series_label", "gpu_model", "gpu_tier", "flashboot", "weights_mode", "engine", "endpoint_id"]


def cost_vs_billed(req: DataFrame, billing: DataFrame) -> DataFrame:
    """Estimated cost per cell beside what its endpoint was billed in the distinct hours the cell ran."""
    cold = req.where("kind = 'cold' and ok and campaign_kind = 'campaign'")
    n = [F.count("*").alias("n_cold_ok"), F.sum(is_hit().cast("int")).alias("n_hits"), F.min("delay_ms").alias("delay_ms_min"), F.max("delay_ms").alias("delay_ms_max"),
         F.round(F.sum("est_cost_usd"), 4).alias("est_cost_usd_total_proxy"), F.min("request_ts_utc").alias("first_request_utc"), F.max("request_ts_utc").alias("last_request_utc")]
    q = [Quantile("delay_ms_p50", F.col("delay_ms"), .5, "bigint"), Quantile("placement_pull_create_s_p50", F.col("placement_pull_create_s"), .5),
         Quantile("engine_boot_s_p50", F.col("engine_boot_s"), .5), Quantile("request_duration_s_p50", F.col("request_duration_s"), .5),
         Quantile("est_cost_usd_p50_proxy", F.col("est_cost_usd"), .5)]
    cells = aggregate(cold, CELL, n, q)
    # bills meet the labels of their endpoint, and stay where the label ran in their hour: hours and endpoints of a label never meet each other
    hours = req.where("ok and request_ts_utc is not null").select("series_label", F.date_trunc("hour", "request_ts_utc").alias("bucket_start_utc")).distinct()
    homes = cold.select("series_label", "endpoint_id").distinct()
    billed = (billing.select("endpoint_id", "bucket_start_utc", "total_usd").join(homes, "endpoint_id").join(hours, ["series_label", "bucket_start_utc"], "left_semi")
              .groupBy("series_label").agg(F.round(F.sum("total_usd"), 4).alias("billed_usd_endpoint_hours"), F.count("*").alias("n_billed_hours")))
    return cells.join(billed, "series_label", "left").withColumnRenamed("series_label", "cell")


# What a run of the load generator is estimated to cost, and how its runs are named.
LOADGEN_USD, LOADGEN_CELL = 0.013, "loadgen"


def spend_overrun(billing: DataFrame, acknowledged: DataFrame, runs: DataFrame, key: str = "endpoint_id", *, limit: float = 0.20,
                  loadgen: DataFrame | None = None, names: DataFrame | None = None, total_row: bool = False) -> DataFrame:
    """Actual, acknowledged and estimated spend per entity, their ratio, and whether it exceeds the estimate by more than `limit`.

    `loadgen` has one row for each run of the load generator: the entities that `runs` has under its cell are estimated LOADGEN_USD more
    for each. `names` (key, name) adds names, null where there is none. `total_row` adds the sums of all, with a null key.
    """
    total = lambda df, col, out: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(F.coalesce(F.col(col), F.lit(0.0))).alias(out))
    act, est = total(billing, "total_usd", "actual_usd"), total(runs, "est_usd", "est_usd")
    if loadgen is not None:
        each = loadgen.agg((F.count("*") * LOADGEN_USD).alias("_extra"))                  # one row
        users = runs.where((F.col("cell") == LOADGEN_CELL) & F.col(key).isNotNull()).select(F.col(key).alias("_user")).distinct().join(F.broadcast(each))
        est = est.join(users, F.col(key) == F.col("_user"), "left").select(key, (F.col("est_usd") + F.coalesce("_extra", F.lit(0.0))).alias("est_usd"))
    both = act.join(est, key, "full").join(total(acknowledged, "usd", "ack_usd"), key, "left").fillna(0.0, ["actual_usd", "est_usd", "ack_usd"])
    net, e = F.col("actual_usd") - F.col("ack_usd"), F.col("est_usd")
    out = both.withColumns({"ratio": F.when(e != 0, net / F.nullif(e, F.lit(0.0))),
                            "status": F.when(e == 0, "none").when(net > e * (1 + limit), "over").otherwise("ok")})
    if names is not None:
        out = out.join(names.select(key, "name"), key, "left")
    if total_row:
        out = out.unionByName(out.agg(*[F.sum(c).alias(c) for c in ("actual_usd", "est_usd", "ack_usd")]), allowMissingColumns=True)
    return out


def remaining_work(plan: DataFrame, runs: DataFrame, cell: str = "cell") -> DataFrame:
    """Planned cells with their successes so far and what is left; a finished cell has 0 left."""
    done = runs.where("ok and was_cold").groupBy(cell).agg(F.count("*").alias("n_done"))
    return plan.join(done, cell, "left").fillna(0, ["n_done"]).withColumn("n_left", F.greatest(F.col("n_cold") - F.col("n_done"), F.lit(0)))


def price_grid(images: DataFrame, gpus: DataFrame, settings: DataFrame, *, idle_s: float, n_cold: int, retries: float) -> DataFrame:
    """Every image x GPU x setting with its billed seconds and cost. The three sides are a hand-written plan grid."""
    cells = images.crossJoin(gpus).crossJoin(settings)
    cell = F.concat_ws("_", "gpu_slug", F.when(F.col("flashboot") == "FLASHBOOT", "fbon").otherwise("fboff"), "image_slug")
    billed = F.col("boot_s") + F.col("exec_s") + idle_s
    one = billed / 3600 * F.col("usd_per_hr")
    return cells.select(cell.alias("cell"), "gpu_slug", "image_slug", "flashboot", billed.alias("billed_s_per_cold"), one.alias("usd_per_cold"),
                        F.lit(n_cold).alias("n_cold"), (one * n_cold * retries).alias("usd_total"))
