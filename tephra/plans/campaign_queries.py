"""Queries of the campaign tables over events, and of the data checks over all tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaign, parity, quality
from ..session import materialize
from .views import sql_ts_text, table, ts_text

T = sql_ts_text


def requests(spark, sf_dir):
    """Events as campaign requests: clicks and errors are warm, others cold; errors carry a client-side word at times."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("click", "error"), "warm").otherwise("cold")
    df = e.select(
        "event_id", F.concat(F.lit("e"), F.col("user_id") % 20).alias("endpoint_id"), F.concat(F.lit("w"), F.col("user_id")).alias("worker_id"), kind.alias("kind"),
        (F.col("event_id") % 6 != 0).alias("ok"), F.when(F.col("event_id") % 12 == 0, "job IN_queue at start").when(F.col("event_id") % 18 == 0, "ENDPOINT_PAUSED").alias("error"),
        F.floor(F.col("value") * 100).cast("bigint").alias("delay_ms"), F.when(F.col("event_id") % 13 != 0, F.col("ts").cast("timestamp")).alias("request_ts_utc"),
        (F.col("event_id") % 5 == 0).alias("cold_ok"), (F.col("event_type") == "error").alias("warm_was_cold"), F.concat(F.lit("c"), F.col("user_id") % 4).alias("series_label"),
        F.concat(F.lit("G"), F.col("user_id") % 4).alias("gpu_model"), F.concat(F.lit("T"), F.col("user_id") % 2).alias("gpu_tier"), F.when(F.col("user_id") % 3 == 0, "on").otherwise("off").alias("flashboot"),
        F.lit("baked").alias("weights_mode"), F.lit("e").alias("engine"), F.when(F.col("user_id") % 20 == 19, "loadgen").otherwise("campaign").alias("campaign_kind"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("placement_pull_create_s"), F.when(F.col("event_id") % 3 == 1, F.col("value") / 2).alias("engine_boot_s"),
        (F.col("value") / 10).alias("request_duration_s"), (F.col("value") / 1000).alias("est_cost_usd"))
    out = campaign.relabel(df).withColumn("slot_utc", campaign.time_slot(F.col("request_ts_utc")))
    return materialize(campaign.with_gap(out, "endpoint_id", "request_ts_utc", "event_id"))


def q_relabel_gap_slot(spark, sf_dir):
    return requests(spark, sf_dir).select("event_id", "kind", "phase_recorded", "client_error", "is_flashboot_hit", "gap_since_prev_request_s", "slot_utc")


def q_gap_buckets(spark, sf_dir):
    return campaign.hit_rate_by_gap(requests(spark, sf_dir))


def q_slot_wait(spark, sf_dir):
    df = campaign.placement_wait(requests(spark, sf_dir))
    return df.withColumns({c: F.round(c, 6) for c in ("placement_pull_create_s_max", "placement_pull_create_s_p50", "engine_boot_s_p50")})


def q_cost_vs_billed(spark, sf_dir):
    bills = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("e"), F.col("user_id") % 20).alias("endpoint_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("bucket_start_utc")).agg(
        F.sum(F.floor("value")).cast("double").alias("total_usd"))
    df = campaign.cost_vs_billed(requests(spark, sf_dir), bills)
    real = ("placement_pull_create_s_p50", "engine_boot_s_p50", "request_duration_s_p50", "est_cost_usd_p50_proxy")
    return df.withColumns({**{c: F.round(c, 6) for c in real}, "est_cost_usd_total_proxy": F.round("est_cost_usd_total_proxy", 3),
                           **{c: ts_text(c) for c in ("first_request_utc", "last_request_utc")}})


def q_spend_overrun(spark, sf_dir):
    li, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    bills = li.where("l_suppkey % 10 <> 3").select(F.col("l_suppkey").alias("endpoint_id"), F.col("l_quantity").alias("total_usd"))
    runs = li.where("l_suppkey % 7 <> 0").select(F.col("l_suppkey").alias("endpoint_id"), F.when(F.col("l_linenumber") < 6, F.col("l_quantity") + (F.col("l_suppkey") % 3) * 4).alias("est_usd"),
                                                   F.when(F.col("l_linenumber") == 1, F.when(F.col("l_suppkey") % 5 == 0, "loadgen").otherwise("c1")).alias("cell"))
    acks = s.where("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("endpoint_id"), F.lit(500.0).alias("usd"))
    names = s.where("s_suppkey % 6 <> 1").select(F.col("s_suppkey").alias("endpoint_id"), F.col("s_name").alias("name"))
    return campaign.spend_overrun(bills, acks, runs, loadgen=table(spark, sf_dir, "nation"), names=names, total_row=True).withColumns({c: F.round(c, 4) for c in ("actual_usd", "est_usd", "ack_usd", "ratio")})


def q_remaining_work(spark, sf_dir):
    plan = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell"), F.lit(150).cast("bigint").alias("n_cold"))
    runs = table(spark, sf_dir, "lineitem").where("l_suppkey % 9 <> 0").select(F.col("l_suppkey").alias("cell"), (F.col("l_returnflag") != "R").alias("ok"), (F.col("l_linestatus") == "F").alias("was_cold"))
    return campaign.remaining_work(plan, runs)


def q_grid_pricing(spark, sf_dir):
    r, n, c = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    images = r.select(F.lower("r_name").alias("image_slug"), (F.col("r_regionkey") * 30.0).alias("boot_s"), F.lit(5.0).alias("exec_s"))
    gpus = n.select(F.lower("n_name").alias("gpu_slug"), (F.col("n_nationkey") * 0.5).alias("usd_per_hr"))
    settings = c.select(F.when(F.col("c_mktsegment") == "BUILDING", "FLASHBOOT").otherwise("OFF").alias("flashboot")).distinct()
    df = campaign.price_grid(images, gpus, settings, idle_s=60.0, n_cold=6, retries=1.25)
    return df.withColumns({c: F.round(c, 8) for c in ("usd_per_cold", "usd_total")})


def q_dq_generic(spark, sf_dir):
    o, e = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    a = quality.column_checks(o.withColumn("note", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority"))), "orders", not_null=["o_orderkey", "note"],
                              accepted={"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]})
    b = quality.column_checks(e, "events", not_null=["ts"], accepted={"event_type": ["view", "click", "purchase"]})
    twice = quality.duplicates(o, ["o_custkey"]).agg(F.count("*").alias("violations")).select(F.lit("orders").alias("table"), F.lit("o_custkey").alias("column"), F.lit("unique").alias("check"), "violations")
    return a.unionByName(b).unionByName(twice)


def q_dq_relationships(spark, sf_dir):
    li, p, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    a = quality.orphans(li, "l_partkey", p.where("p_partkey % 50 <> 0"), "p_partkey").withColumn("rule", F.lit("part"))
    b = quality.orphans(o, "o_custkey", table(spark, sf_dir, "customer").where("c_acctbal > 0"), "c_custkey", "warn").withColumn("rule", F.lit("customer"))
    return a.unionByName(b)


def q_no_duplicates(spark, sf_dir):
    o, e = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    a = quality.duplicates(o, ["o_custkey", "o_orderdate"]).select(F.lit("orders").alias("grain"), F.concat_ws("|", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("key"), "n")
    b = quality.duplicates(e, ["user_id", "value"]).select(F.lit("events").alias("grain"), F.concat_ws("|", "user_id", F.round(F.col("value") * 100).cast("bigint")).alias("key"), "n")
    return a.unionByName(b)


def q_table_parity(spark, sf_dir):
    """Two computed versions of one aggregate: noise under the tolerance, changed, missing and extra rows."""
    li = table(spark, sf_dir, "lineitem")
    base = li.groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("qty"), F.max("l_shipdate").alias("last"), F.count("*").alias("n"))
    k = F.col("l_partkey")
    other = base.where(k % 97 != 0).withColumns({"qty": F.when(k % 89 == 0, F.col("qty") + 1).otherwise(F.col("qty") * (1 + 1e-9)), "n": F.when(k % 83 == 0, F.lit(None)).otherwise(F.col("n"))})
    extra = base.where(k % 101 == 0).withColumn("l_partkey", k + 1_000_000)
    return parity.table_parity(base, other.unionByName(extra), ["l_partkey", "l_returnflag"], ignore=["built_at"])


QUERIES = {f.__name__: f for f in (q_relabel_gap_slot, q_gap_buckets, q_slot_wait, q_cost_vs_billed, q_spend_overrun, q_remaining_work, q_grid_pricing, q_dq_generic,
                                   q_dq_relationships, q_no_duplicates, q_table_parity)}

CAMP_SQL = """
r0 as (select event_id, 'e' || (user_id % 20)::varchar as endpoint_id, 'w' || user_id::varchar as worker_id, case when event_type in ('click', 'error') then 'warm' else 'cold' end as phase_recorded,
  event_id % 6 <> 0 as ok, case when event_id % 12 = 0 then 'job IN_queue at start' when event_id % 18 = 0 then 'ENDPOINT_PAUSED' end as error, floor(value * 100)::bigint as delay_ms,
  case when event_id % 13 <> 0 then ts end as request_ts_utc, event_id % 5 = 0 as cold_ok, event_type = 'error' as warm_was_cold, 'c' || (user_id % 4)::varchar as series_label,
  'G' || (user_id % 4)::varchar as gpu_model, 'T' || (user_id % 2)::varchar as gpu_tier, case when user_id % 3 = 0 then 'on' else 'off' end as flashboot, 'baked' as weights_mode, 'e' as engine,
  case when user_id % 20 = 19 then 'loadgen' else 'campaign' end as campaign_kind, case when event_id % 3 = 0 then value end as placement_pull_create_s, case when event_id % 3 = 1 then value / 2 end as engine_boot_s,
  value / 10 as request_duration_s, value / 1000 as est_cost_usd from events),
r1 as (select *, case when phase_recorded = 'warm' and warm_was_cold and not cold_ok then 'cold' else phase_recorded end as kind,
  phase_recorded = 'cold' and not ok and (coalesce(error, '') ilike '%ENDPOINT_PAUSED%' or coalesce(error, '') ilike '%IN_QUEUE%') as client_error,
  ['00-06', '06-12', '12-18', '18-24'][coalesce(hour(request_ts_utc) // 6, 3) + 1] as slot_utc, epoch_us(request_ts_utc)::hugeint * 1000000000 + event_id as place from r0),
req as (select a.* exclude (place), date_diff('second', b.request_ts_utc, a.request_ts_utc) as gap_since_prev_request_s, case when a.kind = 'cold' then a.ok and a.delay_ms < 5000 end as is_flashboot_hit
  from r1 a asof left join (select endpoint_id, place, request_ts_utc from r1 where place is not null) b on a.endpoint_id = b.endpoint_id and a.place > b.place)
"""
C = "with " + CAMP_SQL
ORACLES = {
    "q_relabel_gap_slot": C + "select event_id, kind, phase_recorded, client_error, is_flashboot_hit, gap_since_prev_request_s, slot_utc from req",
    "q_gap_buckets": C + """select gpu_model, flashboot, weights_mode, engine, campaign_kind, case when gap_since_prev_request_s is null then 'first' when gap_since_prev_request_s < 120 then '<2 min'
  when gap_since_prev_request_s < 600 then '2-10 min' when gap_since_prev_request_s < 3600 then '10-60 min' else '>60 min' end as gap_bucket, count(*) as n_cold, sum(coalesce(is_flashboot_hit, false)::int)::bigint as n_hits,
  round(sum(coalesce(is_flashboot_hit, false)::int)::double / count(*), 3) as hit_rate, quantile_disc(case when coalesce(is_flashboot_hit, false) then delay_ms end, 0.5) as hit_delay_ms_p50,
  quantile_disc(case when not coalesce(is_flashboot_hit, false) then delay_ms end, 0.5) as miss_delay_ms_p50, quantile_disc(gap_since_prev_request_s, 0.5) as gap_s_p50 from req where kind = 'cold' and ok group by 1, 2, 3, 4, 5, 6""",
    "q_slot_wait": C + """select gpu_tier, gpu_model, flashboot, weights_mode, engine, slot_utc, count(*) filter (ok) as n_cold_ok, count(*) filter (not ok and not client_error) as n_failed, count(*) filter (client_error) as n_client_errors,
  quantile_disc(delay_ms, 0.5) as delay_ms_p50, min(delay_ms) as delay_ms_min, max(delay_ms) as delay_ms_max, round(quantile_disc(placement_pull_create_s, 0.5), 6) as placement_pull_create_s_p50,
  round(max(placement_pull_create_s), 6) as placement_pull_create_s_max, round(quantile_disc(engine_boot_s, 0.5), 6) as engine_boot_s_p50, count(distinct endpoint_id) as n_endpoints, count(distinct worker_id) as n_workers_seen
from req where kind = 'cold' and campaign_kind = 'campaign' group by 1, 2, 3, 4, 5, 6""",
    "q_cost_vs_billed": C + f""", cells as (select series_label, gpu_model, gpu_tier, flashboot, weights_mode, engine, endpoint_id, count(*) as n_cold_ok, sum(coalesce(is_flashboot_hit, false)::int)::bigint as n_hits,
  quantile_disc(delay_ms, 0.5) as delay_ms_p50, min(delay_ms) as delay_ms_min, max(delay_ms) as delay_ms_max, round(quantile_disc(placement_pull_create_s, 0.5), 6) as placement_pull_create_s_p50,
  round(quantile_disc(engine_boot_s, 0.5), 6) as engine_boot_s_p50, round(quantile_disc(request_duration_s, 0.5), 6) as request_duration_s_p50, round(quantile_disc(est_cost_usd, 0.5), 6) as est_cost_usd_p50_proxy,
  round(round(sum(est_cost_usd), 4), 3) as est_cost_usd_total_proxy, min(request_ts_utc) as a, max(request_ts_utc) as z from req where kind = 'cold' and ok and campaign_kind = 'campaign' group by 1, 2, 3, 4, 5, 6, 7),
bills as (select 'e' || (user_id % 20)::varchar as endpoint_id, date_trunc('hour', ts) as b, sum(floor(value))::double as usd from events group by 1, 2),
charged as (select s.series_label, list({{'e': x.endpoint_id, 'usd': x.usd}}) as hours from (select distinct series_label from cells) s, bills x
  where x.endpoint_id in (select endpoint_id from cells c where c.series_label = s.series_label) and x.b in (select date_trunc('hour', request_ts_utc) from req r where r.series_label = s.series_label and r.ok) group by 1),
billed as (select series_label, round(list_sum(list_transform(hours, lambda x: x.usd)), 4) as billed_usd_endpoint_hours, len(hours) as n_billed_hours from charged)
select c.series_label as cell, c.* exclude (series_label, a, z), billed_usd_endpoint_hours, n_billed_hours, {T('a')} as first_request_utc, {T('z')} as last_request_utc from cells c left join billed using (series_label)""",
    "q_spend_overrun": """with a as (select l_suppkey as endpoint_id, sum(l_quantity) as act from lineitem where l_suppkey % 10 <> 3 group by 1),
e as (select l_suppkey as endpoint_id, sum(coalesce(case when l_linenumber < 6 then l_quantity + (l_suppkey % 3) * 4 end, 0)) + case when l_suppkey % 5 = 0 and count(*) filter (l_linenumber = 1) > 0 then 0.013::double * (select count(*) from nation) else 0 end as est from lineitem where l_suppkey % 7 <> 0 group by 1),
j as (select endpoint_id, coalesce(act, 0) as act, coalesce(est, 0) as est, case when endpoint_id % 4 = 0 then 500.0::double else 0 end as ack from a full join e using (endpoint_id)),
n as (select j.*, s_name as name from j left join supplier on s_suppkey = endpoint_id and s_suppkey % 6 <> 1)
select endpoint_id, round(act, 4) as actual_usd, round(est, 4) as est_usd, round(ack, 4) as ack_usd, case when est <> 0 then round((act - ack) / est, 4) end as ratio,
  case when est = 0 then 'none' when act - ack > est * 1.2 then 'over' else 'ok' end as status, name from n
union all select null, round(sum(act), 4), round(sum(est), 4), round(sum(ack), 4), null, null, null from j""",
    "q_remaining_work": """with d as (select l_suppkey as cell, count(*) as n from lineitem where l_suppkey % 9 <> 0 and l_returnflag <> 'R' and l_linestatus = 'F' group by 1)
select s_suppkey as cell, 150::bigint as n_cold, coalesce(n, 0) as n_done, greatest(150 - coalesce(n, 0), 0) as n_left from supplier left join d on cell = s_suppkey""",
    "q_grid_pricing": """select lower(n_name) || '_' || case when fb = 'FLASHBOOT' then 'fbon' else 'fboff' end || '_' || lower(r_name) as cell, lower(n_name) as gpu_slug, lower(r_name) as image_slug, fb as flashboot,
  r_regionkey * 30.0::double + 65 as billed_s_per_cold, round((r_regionkey * 30.0::double + 65) / 3600 * (n_nationkey * 0.5::double), 8) as usd_per_cold, 6 as n_cold,
  round((r_regionkey * 30.0::double + 65) / 3600 * (n_nationkey * 0.5::double) * 6 * 1.25::double, 8) as usd_total
from region, nation, (select distinct case when c_mktsegment = 'BUILDING' then 'FLASHBOOT' else 'OFF' end as fb from customer)""",
    "q_dq_generic": """select 'orders' as "table", 'o_orderkey' as "column", 'not_null' as check, count(*) filter (o_orderkey is null) as violations from orders union all select 'orders', 'note', 'not_null', count(*) filter (o_orderkey % 10 = 0) from orders
union all select 'orders', 'o_orderstatus', 'accepted_values', count(*) filter (o_orderstatus not in ('F', 'O')) from orders
union all select 'orders', 'o_orderpriority', 'accepted_values', count(*) filter (o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) from orders
union all select 'events', 'ts', 'not_null', count(*) filter (ts is null) from events union all select 'events', 'event_type', 'accepted_values', count(*) filter (event_type not in ('view', 'click', 'purchase')) from events
union all select 'orders', 'o_custkey', 'unique', count(*) from (select o_custkey from orders group by 1 having count(*) > 1)""",
    "q_dq_relationships": """select l_partkey as value, count(*) as n, 'error' as severity, 'part' as rule from lineitem where l_partkey not in (select p_partkey from part where p_partkey % 50 <> 0) group by 1
union all select o_custkey, count(*), 'warn', 'customer' from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1""",
    "q_no_duplicates": """select 'orders' as grain, o_custkey::varchar || '|' || strftime(o_orderdate, '%Y-%m-%d') as key, count(*) as n from orders group by o_custkey, o_orderdate having count(*) > 1
union all select 'events', user_id::varchar || '|' || round(value * 100)::bigint::varchar, count(*) from events group by user_id, value having count(*) > 1""",
    "q_table_parity": """with b as (select l_partkey as k, l_returnflag as f, sum(l_quantity) as qty, max(l_shipdate) as last, count(*)::double as n from lineitem group by 1, 2),
o as (select k, f, case when k % 89 = 0 then qty + 1 else qty * 1.000000001::double end as qty, last, case when k % 83 <> 0 then n end as n from b where k % 97 <> 0
  union all select k + 1000000, f, qty, last, n from b where k % 101 = 0),
l as (select *, row_number() over (partition by k, f order by qty nulls first, last nulls first, n nulls first) as i from b),
r as (select *, row_number() over (partition by k, f order by qty nulls first, last nulls first, n nulls first) as i from o),
p as (select coalesce(l.k, r.k) as k, coalesce(l.f, r.f) as f, case when r.i is null then 'only left' when l.i is null then 'only right' else nullif(concat_ws(',',
    case when not coalesce(abs(l.qty - r.qty) <= greatest(1e-6::double * greatest(abs(l.qty), abs(r.qty)), 1e-9::double), l.qty is null and r.qty is null) then 'qty' end, case when l.last is distinct from r.last then 'last' end,
    case when not coalesce(abs(l.n - r.n) <= greatest(1e-6::double * greatest(l.n, r.n), 1e-9::double), l.n is null and r.n is null) then 'n' end), '') end as problem
  from l full join r on l.k = r.k and l.f = r.f and l.i = r.i)
select '{"l_partkey":' || k::varchar || ',"l_returnflag":"' || f || '"}' as key, problem from p where problem is not null""",
}
