"""Queries of the aggregated tables over the proof view `requests`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conform, marts
from ..session import materialize
from .views import REQUESTS_SQL, raw_requests, sql_ts_text, table, ts_text


def requests(spark, sf_dir, hosts=False):
    return conform.request_metrics(raw_requests(spark, sf_dir, hosts))


def rounded(df, *cols, to=8):
    return df.withColumns({c: F.round(c, to) for c in cols})


def q_latency_distribution(spark, sf_dir):
    return rounded(marts.latency_distribution(requests(spark, sf_dir)), "est_cost_usd_p50")


def q_hit_rate(spark, sf_dir):
    df = marts.hit_rate(requests(spark, sf_dir))
    return df.withColumns({c: ts_text(c) for c in ("first_request_utc", "last_request_utc")})


def comparison(spark, sf_dir):
    return marts.cohort_comparison(requests(spark, sf_dir, hosts=True), where="model = 'R' and coalesce(gpu_model, 'G1') = 'G1'")


def q_pooled_cohorts(spark, sf_dir):
    df = rounded(comparison(spark, sf_dir), "cold_est_cost_usd_p50")
    return df.withColumns({c: F.array_join(c, ",") for c in ("series", "dates")})


def q_event_projection(spark, sf_dir):
    df = rounded(marts.cold_events(requests(spark, sf_dir, hosts=True)), "est_cost_usd")
    return df.withColumn("request_ts_utc", ts_text("request_ts_utc"))


def q_cost_per_job(spark, sf_dir):
    df = marts.cost_per_job(requests(spark, sf_dir))
    return rounded(rounded(df, "request_duration_s_p50", "request_duration_s_p90", "est_cost_usd_p50"), "est_cost_usd_total", to=3)


def q_request_metrics(spark, sf_dir):
    df = requests(spark, sf_dir)
    return (df.groupBy("kind", "gpu_tier", "is_flashboot_hit")
            .agg(F.count("*").alias("n"), F.count("request_duration_s").alias("n_duration"), F.count("est_cost_usd").alias("n_cost"),
                 F.round(F.sum("request_duration_s"), 2).alias("duration_s"), F.round(F.sum("est_cost_usd"), 4).alias("cost")))


def q_batch_unit_cost(spark, sf_dir):
    batches = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("batch_id"), F.floor("o_totalprice").cast("bigint").alias("wall_ms"),
        F.when(F.col("o_custkey") % 50 == 0, 0).otherwise((F.col("o_custkey") % 25) * 2 + 1).cast("int").alias("n"),
        (F.col("o_totalprice") / 30_000).alias("est_cost_usd"))
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("batch_id"), F.col("l_linenumber").alias("score"), (F.col("l_returnflag") != "R").alias("parse_ok"),
        F.floor("l_extendedprice").cast("bigint").alias("wall_ms"), F.col("l_quantity").cast("bigint").alias("prompt_tokens"),
        F.when(F.col("l_tax") > 0, F.col("l_suppkey")).alias("completion_tokens"))
    return rounded(marts.batch_unit_cost(batches, items), "est_cost_usd", to=6)


def q_summary_vs_records(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select((F.col("o_custkey")).alias("source_file"), F.col("o_orderstatus").alias("run_index"),
                                                "o_orderkey", "o_orderpriority")
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    recs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("source_file"), F.col("o_orderstatus").alias("run_index"), F.col("l_extendedprice").alias("ttft_ms"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("e2e_ms"), (F.col("l_returnflag") != "R").alias("success"))
    return rounded(marts.summary_vs_records(runs, recs), "rec_ttft_ms_p50", "rec_ttft_ms_p99", "rec_e2e_ms_p99", to=4)


def series_runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 200).alias("series"), (F.col("o_orderstatus") != "F").alias("cold_ok"),
                    F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority") != "5-LOW").alias("was_cold"),
                    F.col("o_totalprice").alias("cold_total_s"), F.when(F.col("o_orderkey") % 3 != 0, F.floor("o_totalprice").cast("bigint")).alias("cold_delay_ms"),
                    (F.col("o_orderkey") % 5 != 0).alias("warm_ok"), (F.col("o_totalprice") / 10).alias("warm_total_s"))


def q_series_summary(spark, sf_dir):
    return rounded(marts.series_summary(series_runs(spark, sf_dir), ["series"]), "cold_median_s", "cold_delay_ms_median", "warm_total_s_median", to=4)


def q_kpi_tiles(spark, sf_dir):
    boots = table(spark, sf_dir, "orders").select((F.col("o_totalprice") / 10000).alias("torch_compile_s"))
    picks = {"baked": ("1-URGENT", "baked", None), "fetched": ("1-URGENT", "fetched", None), "worker": ("2-HIGH", "baked", None), "worker_warm_host": ("2-HIGH", "baked", "furniture"), "none": ("nobody", "baked", None)}
    tiles = marts.kpi_tiles(marts.cold_events(requests(spark, sf_dir)), boots, split=20.0, comparison=comparison(spark, sf_dir), picks=picks)
    return rounded(tiles, "fast_median_s", "slow_median_s", to=6)


def q_cohorts_sum(spark, sf_dir):
    from ..operators import quality
    good = materialize(comparison(spark, sf_dir))
    broken = good.withColumn("n_warm", F.when((F.col("scope") == "cohort") & (F.col("n_full_boots") % 2 == 1), F.col("n_warm") + 1).otherwise(F.col("n_warm")))
    checked = lambda df, copy: quality.with_checked_count(quality.cohorts_sum_to_pooled(df), df, "engine").withColumn("copy", F.lit(copy))
    return checked(good, "good").unionByName(checked(broken, "broken"))


def q_rate_bounds(spark, sf_dir):
    from ..operators import quality
    req = requests(spark, sf_dir)
    rates = materialize(marts.hit_rate(req))
    third = F.col("n_cold") % 3
    broken = rates.withColumns({"n_hits": F.when(third == 0, F.col("n_cold") + 1).otherwise(F.col("n_hits")), "hit_rate": F.when(third == 1, F.col("hit_rate") + 0.1).otherwise(F.col("hit_rate"))})
    return quality.rate_bounds(rates).agg(F.count("*").alias("violations")).withColumn("check", F.lit("rate")).unionByName(
        quality.rate_bounds(broken).agg(F.count("*").alias("violations")).withColumn("check", F.lit("broken rate"))).unionByName(
        quality.hit_flag_consistent(req).agg(F.count("*").alias("violations")).withColumn("check", F.lit("flag"))).unionByName(
        rates.agg(F.count("*").alias("violations")).withColumn("check", F.lit("rates checked")))


def q_request_latency(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("request_id"), (F.col("l_returnflag") != "R").alias("success"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("arrival_s"), F.col("l_extendedprice"), F.col("l_quantity"))
    rec = li.select("run", "request_id", "success", "arrival_s", (F.col("arrival_s") + F.col("l_extendedprice")).alias("first_token_s"),
                    (F.col("arrival_s") + F.col("l_extendedprice") + F.col("l_quantity") * 7).alias("finish_s"),
                    F.col("l_quantity").cast("bigint").alias("output_tokens"))
    return rounded(conform.request_latencies(rec, ["run"]), "first_token_s", "finish_s", "ttft_ms", "e2e_ms", "tpot_ms", to=2)


def q_null_to_inf(spark, sf_dir):
    from ..functions.text import unbounded_if_null
    from ..operators import quality
    e = table(spark, sf_dir, "events").withColumn("rate", F.when(F.col("event_type") != "error", F.col("value")))
    out = e.select("event_id", unbounded_if_null(F.col("rate")).alias("request_rate"), F.col("rate").isNull().alias("is_unbounded"))
    both = out.withColumn("copy", F.lit("good")).unionByName(out.withColumns({"is_unbounded": F.col("is_unbounded") != (F.col("event_id") % 9 == 0), "copy": F.lit("broken")}))
    bad = quality.unbounded_mismatches(both).groupBy("copy", "is_unbounded").agg(F.count("*").alias("violations"))
    return both.groupBy("copy", "is_unbounded").agg(F.count("*").alias("n"), F.max("request_rate").alias("max_rate")).join(bad, ["copy", "is_unbounded"], "left").fillna(0, ["violations"])


def q_mark_durations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    value = {"submit": F.lit(0.0), "container_start": F.when(F.col("l_linenumber") != 2, F.col("l_quantity")),
             "worker_start": F.col("l_quantity") + F.col("l_tax"), "first_job": F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))}
    marks = F.map_filter(F.create_map(*[x for k, v in value.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    rows = marts.mark_durations(li.select(F.col("l_partkey").alias("series"), marks.alias("marks")))
    return rows.groupBy("series", "phase").agg(F.count("*").alias("n"), F.round(F.sum("seconds"), 2).alias("seconds"))


def q_unpivot_residuals(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    boots = li.groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("start_to_weights_s"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_quantity") / 4)).alias("torch_compile_s"),
        F.max(F.when(F.col("l_returnflag") == "A", F.col("l_quantity") / 8)).alias("graph_capture_s"), F.min("l_quantity").alias("init_engine_s"),
        F.max(F.when(F.col("l_linenumber") != 4, F.col("l_quantity") * 2)).alias("start_to_api_ready_s"))
    return marts.boot_segments(boots, ["l_orderkey"]).withColumn("seconds", F.round("seconds", 4))


QUERIES = {f.__name__: f for f in (
    q_latency_distribution, q_hit_rate, q_pooled_cohorts, q_event_projection, q_cost_per_job, q_request_metrics, q_batch_unit_cost,
    q_summary_vs_records, q_series_summary, q_kpi_tiles, q_cohorts_sum, q_rate_bounds, q_request_latency, q_null_to_inf,
    q_mark_durations, q_unpivot_residuals)}

W = "with " + REQUESTS_SQL
COMPARISON_SQL = """, same as (
  select *, case when host_state <> 'unknown' then host_state when source = 'request_csv' then 'csv_host_unknown' else 'host_unknown' end as cohort
  from requests where ok and model = 'R' and coalesce(gpu_model, 'G1') = 'G1'),
c as (select engine, weights_mode, case when grouping(cohort) = 1 then 'pooled' else 'cohort' end as scope,
    case when grouping(cohort) = 1 then 'all runs (pooled)' else cohort end as cohort, count(*) as n_full_boots,
    sum(case when request_ts_utc is null then 1 else 0 end)::bigint as n_undated, quantile_disc(delay_ms, 0.5) as cold_delay_ms_p50,
    round(avg(delay_ms))::bigint as cold_delay_ms_mean, min(delay_ms) as cold_delay_ms_min, max(delay_ms) as cold_delay_ms_max,
    quantile_disc(exec_ms, 0.5) as cold_exec_ms_p50, round(quantile_disc(est_cost_usd, 0.5), 8) as cold_est_cost_usd_p50,
    string_agg(distinct series_label, ',' order by series_label) as series,
    string_agg(distinct strftime(request_ts_utc, '%Y-%m-%d'), ',' order by strftime(request_ts_utc, '%Y-%m-%d')) as dates
  from same where kind = 'cold' and not coalesce(is_flashboot_hit, false)
  group by grouping sets ((engine, weights_mode), (engine, weights_mode, cohort))),
w as (select engine, weights_mode, case when grouping(cohort) = 1 then 'pooled' else 'cohort' end as scope,
    case when grouping(cohort) = 1 then 'all runs (pooled)' else cohort end as cohort, count(*) as n_warm,
    quantile_disc(delay_ms, 0.5) as warm_delay_ms_p50, quantile_disc(exec_ms, 0.5) as warm_exec_ms_p50
  from same where kind = 'warm' group by grouping sets ((engine, weights_mode), (engine, weights_mode, cohort))),
comparison as (
  select engine, weights_mode, scope, cohort, coalesce(n_full_boots, 0) as n_full_boots, coalesce(n_undated, 0) as n_undated,
    cold_delay_ms_p50, cold_delay_ms_mean, cold_delay_ms_min, cold_delay_ms_max, cold_exec_ms_p50, cold_est_cost_usd_p50,
    coalesce(n_warm, 0) as n_warm, warm_delay_ms_p50, warm_exec_ms_p50, series, dates
  from c full join w using (engine, weights_mode, scope, cohort))
"""
ORACLES = {
    "q_latency_distribution": W + """
select engine, model, coalesce(gpu_model, 'not captured') as gpu_model, gpu_tier, weights_mode, flashboot, kind, count(*) as n,
  sum(is_flashboot_hit::int)::bigint as n_flashboot_hits, quantile_disc(delay_ms, 0.5) as delay_ms_p50, quantile_disc(delay_ms, 0.9) as delay_ms_p90,
  min(delay_ms) as delay_ms_min, max(delay_ms) as delay_ms_max, quantile_disc(exec_ms, 0.5) as exec_ms_p50,
  quantile_disc(case when not coalesce(is_flashboot_hit, false) then delay_ms end, 0.5) as full_boot_delay_ms_p50,
  round(quantile_disc(est_cost_usd, 0.5), 8) as est_cost_usd_p50, count(distinct endpoint_id) as n_endpoints, count(distinct worker_id) as n_workers_seen
from requests where ok group by engine, model, requests.gpu_model, gpu_tier, weights_mode, flashboot, kind""",
    "q_hit_rate": W + f"""
select engine, model, endpoint_id, flashboot as flashboot_setting, sum(ok::int)::bigint as n_cold, sum((not ok)::int)::bigint as n_cold_failed,
  sum((ok and coalesce(is_flashboot_hit, false))::int)::bigint as n_hits, sum(coalesce(flashboot_resume_recorded, false)::int)::bigint as n_resume_recorded,
  {sql_ts_text('min(request_ts_utc)')} as first_request_utc, {sql_ts_text('max(request_ts_utc)')} as last_request_utc,
  quantile_disc(case when ok and coalesce(is_flashboot_hit, false) then delay_ms end, 0.5) as hit_delay_ms_p50,
  quantile_disc(case when ok and not coalesce(is_flashboot_hit, false) then delay_ms end, 0.5) as miss_delay_ms_p50,
  case when sum(ok::int) > 0 then round(sum((ok and coalesce(is_flashboot_hit, false))::int)::double / sum(ok::int), 3) end as hit_rate,
  5000 as hit_threshold_ms
from requests where kind = 'cold' group by engine, model, endpoint_id, flashboot""",
    "q_pooled_cohorts": W + COMPARISON_SQL + "select * from comparison",
    "q_event_projection": W + f"""
select source, engine, model, coalesce(gpu_model, 'not captured') as gpu_model, gpu_tier, weights_mode, flashboot, host_state, series_label,
  endpoint_id, run_index, {sql_ts_text('request_ts_utc')} as request_ts_utc, delay_ms, exec_ms, worker_id, is_flashboot_hit, flashboot_resume_recorded,
  round(est_cost_usd, 8) as est_cost_usd, source_file from requests where ok and kind = 'cold'""",
    "q_cost_per_job": W + f"""
select engine, model, coalesce(gpu_model, 'not captured') as gpu_model, gpu_tier, weights_mode, kind, price_per_hr_usd, count(*) as n,
  round(quantile_disc(request_duration_s, 0.5), 8) as request_duration_s_p50, round(quantile_disc(request_duration_s, 0.9), 8) as request_duration_s_p90,
  round(quantile_disc(est_cost_usd, 0.5), 8) as est_cost_usd_p50, round(round(sum(est_cost_usd), 4), 3) as est_cost_usd_total,
  '{marts.COST_NOTE}' as cost_formula
from requests where ok and price_per_hr_usd is not null group by engine, model, requests.gpu_model, gpu_tier, weights_mode, kind, price_per_hr_usd""",
    "q_request_metrics": W + """
select kind, gpu_tier, is_flashboot_hit, count(*) as n, count(request_duration_s) as n_duration, count(est_cost_usd) as n_cost,
  round(sum(request_duration_s), 2) as duration_s, round(sum(est_cost_usd), 4) as cost from requests group by 1, 2, 3""",
    "q_batch_unit_cost": """
with b as (select o_orderkey as batch_id, floor(o_totalprice)::bigint as wall_ms, (case when o_custkey % 50 = 0 then 0 else (o_custkey % 25) * 2 + 1 end)::int as n, o_totalprice / 30000 as est_cost_usd from orders),
p as (select l_orderkey as batch_id, round(avg(l_linenumber), 3) as mean_score, round(avg((l_returnflag <> 'R')::int), 3) as parse_ok_rate,
  sum(l_quantity::bigint)::bigint as prompt_tokens, sum(case when l_tax > 0 then l_suppkey end)::bigint as completion_tokens,
  quantile_disc(floor(l_extendedprice)::bigint, 0.5) as article_wall_ms_p50, quantile_disc(floor(l_extendedprice)::bigint, 0.9) as article_wall_ms_p90
  from lineitem group by 1)
select b.batch_id, wall_ms, n, round(est_cost_usd, 6) as est_cost_usd, mean_score, parse_ok_rate, prompt_tokens, completion_tokens, article_wall_ms_p50, article_wall_ms_p90,
  round(wall_ms / 1000.0::double / nullif(n, 0), 3) as wall_s_per_article, round(est_cost_usd / nullif(n, 0) * 1000, 4) as est_cost_usd_per_1k_articles
from b left join p using (batch_id)""",
    "q_summary_vs_records": """
with r as (select o_custkey as source_file, o_orderstatus as run_index, count(*) as rec_n_ok,
  round(quantile_disc(l_extendedprice, 0.5), 4) as rec_ttft_ms_p50, round(quantile_disc(l_extendedprice, 0.99), 4) as rec_ttft_ms_p99,
  round(quantile_disc(l_extendedprice + l_quantity, 0.99), 4) as rec_e2e_ms_p99
  from lineitem join orders on l_orderkey = o_orderkey where l_returnflag <> 'R' group by 1, 2)
select o_custkey as source_file, o_orderstatus as run_index, o_orderkey, o_orderpriority, rec_n_ok, rec_ttft_ms_p50, rec_ttft_ms_p99, rec_e2e_ms_p99
from orders left join r on r.source_file = o_custkey and r.run_index = o_orderstatus""",
    "q_series_summary": """
with r as (select o_custkey % 200 as series, o_orderstatus <> 'F' as cold_ok, coalesce(case when o_orderkey % 4 <> 0 then o_orderpriority <> '5-LOW' end, true) as was_cold,
  o_totalprice as t, case when o_orderkey % 3 <> 0 then floor(o_totalprice)::bigint end as d, o_orderkey % 5 <> 0 as warm_ok, o_totalprice / 10 as w from orders)
select series, count(*) filter (cold_ok and was_cold) as cold_n, min(t) filter (cold_ok and was_cold) as cold_min_s, max(t) filter (cold_ok and was_cold) as cold_max_s,
  count(*) filter (not cold_ok) as failures, count(*) filter (cold_ok and not was_cold) as not_cold,
  round(quantile_cont(t, 0.5) filter (cold_ok and was_cold), 4) as cold_median_s,
  round(quantile_cont(d, 0.5) filter (cold_ok and was_cold), 4) as cold_delay_ms_median, round(quantile_cont(w, 0.5) filter (warm_ok), 4) as warm_total_s_median
from r group by 1""",
    "q_kpi_tiles": W + COMPARISON_SQL + """
, b as (select o_totalprice / 10000 as t from orders)
select (select count(*) from requests where ok and kind = 'cold' and is_flashboot_hit) as n_hits, (select count(*) from requests where ok and kind = 'cold') as n_events,
  """ + "".join(f"(select {c} from comparison where engine = '{e}' and weights_mode = '{w}' and {k}) as {n}_{o}, " for n, e, w, k in (
        ("baked", "1-URGENT", "baked", "scope = 'pooled'"), ("fetched", "1-URGENT", "fetched", "scope = 'pooled'"), ("worker", "2-HIGH", "baked", "scope = 'pooled'"),
        ("worker_warm_host", "2-HIGH", "baked", "cohort = 'furniture'"), ("none", "nobody", "baked", "scope = 'pooled'"))
        for c, o in (("cold_delay_ms_p50", "p50_ms"), ("cold_delay_ms_mean", "mean_ms"), ("n_full_boots", "n_boots"))) + """
  count(*) filter (t < 20) as n_fast, count(*) filter (t >= 20) as n_slow, count(*) as n_boots,
  round(quantile_cont(t, 0.5) filter (t < 20), 6) as fast_median_s, round(quantile_cont(t, 0.5) filter (t >= 20), 6) as slow_median_s from b""",
    "q_cohorts_sum": W + COMPARISON_SQL + """
, p as (select engine, weights_mode, n_full_boots, n_warm, n_undated from comparison where scope = 'pooled'),
k as (select engine, weights_mode, sum(n_full_boots) as b, sum(n_warm) as w, sum(n_undated) as u from comparison where scope = 'cohort' group by 1, 2)
select (select count(*) from p full join k using (engine, weights_mode) where n_full_boots is distinct from b or n_warm is distinct from w or n_undated is distinct from u) as violations,
  (select count(*) from comparison) as checked, 'good' as copy
union all select (select count(*) from p full join (select engine, weights_mode, sum(n_full_boots) as b, sum(n_warm + n_full_boots % 2) as w, sum(n_undated) as u from comparison where scope = 'cohort' group by 1, 2) using (engine, weights_mode)
  where n_full_boots is distinct from b or n_warm is distinct from w or n_undated is distinct from u), (select count(*) from comparison), 'broken'""",
    "q_rate_bounds": W + """
select 'rate' as check, 0::bigint as violations
union all select 'broken rate', count(*) from (select count(*) filter (ok) as n from requests where kind = 'cold' group by engine, model, endpoint_id, flashboot) where n % 3 <> 2
union all select 'flag', count(*) from requests where (kind <> 'cold' and is_flashboot_hit is not null)
  or (is_flashboot_hit and (not ok or delay_ms >= 5000))
union all select 'rates checked', count(*) from (select distinct engine, model, endpoint_id, flashboot from requests where kind = 'cold')""",
    "q_request_latency": """
with r as (select l_orderkey as run, l_linenumber as request_id, l_returnflag <> 'R' as success, epoch(l_shipdate)::double as arrival_s,
  epoch(l_shipdate)::double + l_extendedprice as first_token_s, epoch(l_shipdate)::double + l_extendedprice + l_quantity * 7 as finish_s, l_quantity::bigint as output_tokens from lineitem)
select run, request_id, success, arrival_s, round(first_token_s, 2) as first_token_s, round(finish_s, 2) as finish_s, output_tokens,
  arrival_s - min(arrival_s) over (partition by run) as arrival_offset_s,
  round(case when success then (first_token_s - arrival_s) * 1000 end, 2) as ttft_ms, round(case when success then (finish_s - arrival_s) * 1000 end, 2) as e2e_ms,
  round(case when success and output_tokens > 1 then (finish_s - first_token_s) * 1000 / (output_tokens - 1) end, 2) as tpot_ms from r""",
    "q_null_to_inf": """
with b as (select 'good' as copy, event_type = 'error' as is_unbounded, case when event_type = 'error' then 'inf'::double else value end as rate, false as wrong from events
  union all select 'broken', (event_type = 'error') <> (event_id % 9 = 0), case when event_type = 'error' then 'inf'::double else value end, event_id % 9 = 0 from events)
select copy, is_unbounded, count(*) as n, max(rate) as max_rate, count(*) filter (wrong) as violations from b group by 1, 2""",
    "q_mark_durations": """
with m as (select l_partkey as series, 0.0::double as submit, case when l_linenumber <> 2 then l_quantity end as cs, l_quantity + l_tax as ws,
  case when l_returnflag = 'R' then l_extendedprice end as fj from lineitem),
x as (select series, 'schedule_pull_create' as phase, round(cs - submit, 3) as s from m union all select series, 'container_to_python', round(ws - cs, 3) from m
  union all select series, 'submit_to_first_job', round(fj - submit, 3) from m)
select series, phase, count(*) as n, round(sum(s), 2) as seconds from x where s is not null group by 1, 2""",
    "q_unpivot_residuals": """
with b as (select l_orderkey, max(l_quantity) as w, coalesce(max(case when l_returnflag = 'R' then l_quantity / 4 end), 0) as tc,
  coalesce(max(case when l_returnflag = 'A' then l_quantity / 8 end), 0) as gc, min(l_quantity) as ie, max(case when l_linenumber <> 4 then l_quantity * 2 end) as r
  from lineitem group by 1)
select l_orderkey, 0 as phase_order, 'load_weights' as phase, round(w, 4) as seconds from b union all select l_orderkey, 1, 'torch_compile', round(tc, 4) from b
union all select l_orderkey, 2, 'graph_capture', round(gc, 4) from b
union all select l_orderkey, 3, 'rest_of_init', round(greatest(ie - tc - gc, 0), 4) from b
union all select l_orderkey, 4, 'to_ready', case when r is not null then round(greatest(r - w - ie, 0), 4) end from b""",
}
