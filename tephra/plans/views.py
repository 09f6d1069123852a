"""The proof views: the library's input shapes derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts_text(col: str):
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_ts_text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def raw_requests(spark: SparkSession, sf_dir: str, hosts: bool = False) -> DataFrame:
    """Order lines as serverless requests; `hosts` adds the customer segment as host state."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    if hosts:
        c = table(spark, sf_dir, "customer")
        rows = rows.join(c, rows.o_custkey == c.c_custkey)
        host = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "unknown").otherwise(F.lower("c_mktsegment"))
    else:
        host = F.lit("unknown")
    return rows.select(
        F.when(F.col("l_partkey") % 2 == 0, "request_csv").otherwise("series_json").alias("source"),
        F.col("o_orderpriority").alias("engine"), F.col("l_returnflag").alias("model"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("G"), F.col("l_linenumber") % 3)).alias("gpu_model"),
        F.col("o_orderstatus").alias("gpu_tier"),
        F.when(F.col("l_partkey") % 3 == 0, "baked").otherwise("fetched").alias("weights_mode"),
        F.when(F.col("l_suppkey") % 3 == 0, "on").when(F.col("l_suppkey") % 3 == 1, "off").otherwise("unknown").alias("flashboot"),
        F.when(F.col("l_linestatus") == "F", "cold").otherwise("warm").alias("kind"),
        (F.col("l_linenumber") != 7).alias("ok"),
        F.concat(F.lit("e"), F.col("l_suppkey")).alias("endpoint_id"),
        F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("w"), F.col("l_partkey"))).alias("worker_id"),
        F.when(F.col("o_orderstatus") == "F", 1.1).when(F.col("o_orderstatus") == "O", 2.2).alias("price_per_hr_usd"),
        F.floor("l_extendedprice").cast("bigint").alias("delay_ms"),
        (F.col("l_quantity") * 100).cast("bigint").alias("exec_ms"),
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("request_ts_utc"),
        host.alias("host_state"), F.concat(F.lit("s"), F.col("l_linenumber")).alias("series_label"),
        F.col("l_orderkey").cast("int").alias("run_index"),
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity") < 10).alias("flashboot_resume_recorded"),
        F.concat(F.lit("f"), F.col("l_orderkey") % 7).alias("source_file"))


REQUESTS_SQL = """
raw_requests as (
  select case when l_partkey % 2 = 0 then 'request_csv' else 'series_json' end as source,
    o_orderpriority as engine, l_returnflag as model,
    case when o_orderstatus <> 'F' then 'G' || (l_linenumber % 3)::varchar end as gpu_model,
    o_orderstatus as gpu_tier, case when l_partkey % 3 = 0 then 'baked' else 'fetched' end as weights_mode,
    case l_suppkey % 3 when 0 then 'on' when 1 then 'off' else 'unknown' end as flashboot,
    case when l_linestatus = 'F' then 'cold' else 'warm' end as kind, l_linenumber <> 7 as ok,
    'e' || l_suppkey::varchar as endpoint_id,
    case when l_partkey % 5 <> 0 then 'w' || l_partkey::varchar end as worker_id,
    case o_orderstatus when 'F' then 1.1::double when 'O' then 2.2::double end as price_per_hr_usd,
    floor(l_extendedprice)::bigint as delay_ms, (l_quantity * 100)::bigint as exec_ms,
    case when l_linenumber <> 3 then l_shipdate end as request_ts_utc,
    case when c_mktsegment = 'HOUSEHOLD' then 'unknown' else lower(c_mktsegment) end as host_state,
    's' || l_linenumber::varchar as series_label, l_orderkey::int as run_index,
    case when l_linenumber = 1 then l_quantity < 10 end as flashboot_resume_recorded,
    'f' || (l_orderkey % 7)::varchar as source_file
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
requests as (
  select *, case when ok then (coalesce(delay_ms, 0) + coalesce(exec_ms, 0)) / 1000.0::double end as request_duration_s,
    case when kind = 'cold' then ok and delay_ms < 5000 end as is_flashboot_hit,
    case when ok then (coalesce(delay_ms, 0) + coalesce(exec_ms, 0)) / 1000.0::double end / 3600.0::double * price_per_hr_usd as est_cost_usd
  from raw_requests)
"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of a user's configuration; an error event is an incomplete listing."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias("endpoint_id"), F.col("ts").cast("timestamp").alias("polled_at_utc"),
        F.col("event_id").alias("poll_id"), F.col("event_type").alias("image"),
        F.floor(F.col("value") / 100).cast("int").alias("disk_gb"), F.col("props").alias("name"),
        (F.col("event_type") != "error").alias("endpoints_complete"))


OBS_SQL = """
obs as (
  select 'u' || user_id::varchar as endpoint_id, ts as polled_at_utc, event_id as poll_id, event_type as image,
    floor(value / 100)::int as disk_gb, props as name, event_type <> 'error' as endpoints_complete,
    md5(coalesce(event_type, '<null>') || '|' || coalesce(floor(value / 100)::int::varchar, '<null>')) as config_hash
  from events)
"""


def worker_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events as polls: each user a worker of one of ten parents, status = last event of the day."""
    e = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    return (e.groupBy((F.col("user_id") % 10).alias("endpoint_id"), F.col("user_id").alias("worker_id"), day.alias("day"))
            .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))
            .select("endpoint_id", "worker_id", F.to_timestamp("day").alias("polled_at_utc"),
                    F.col("day").alias("poll_id"), "status"))


POLLS_SQL = """
wpolls as (
  select user_id % 10 as endpoint_id, user_id as worker_id, date_trunc('day', ts)::timestamp as polled_at_utc,
    strftime(ts, '%Y-%m-%d') as poll_id, arg_max(event_type, (ts, event_id)) as status
  from events group by all)
"""


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text in the three recognised formats and one unrecognised, built from events."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id") % 7
    payload = (F.when(n == 0, F.concat(F.lit('{"requestId":"r'), F.col("event_id"), F.lit('","message":"did '), F.col("event_type"), F.lit('","level":"INFO"}')))
               .when(n == 1, F.concat(F.lit("(EngineCore pid="), F.col("user_id"), F.lit(") INFO 09-23 18:00:00 [core.py:1] "), F.col("event_type")))
               .when(n == 2, F.concat(F.lit("WARNING 09-23 18:00:00 [core.py:2] "), F.col("event_type")))
               .when(n == 3, F.concat(F.lit("Loading: 50%| "), F.col("event_type")))
               .when(n == 4, F.concat(F.lit("2026-09-23 18:00:00,1 INFO root: "), F.col("event_type")))
               .when(n == 5, F.concat(F.lit("Jobs in queue: "), F.col("user_id"))).otherwise(F.lit("")))
    kind = F.col("event_id") % 4
    ts = F.col("ts")
    line = (F.when(kind == 0, F.concat(F.date_format(ts, "EEE MMM dd yyyy HH:mm:ss"), F.lit(" GMT-0400 (Eastern Daylight Time) "), payload))
            .when(kind == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z "), payload))
            .when(kind == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" | info | wk"), F.col("user_id"), F.lit(" | "), payload))
            .otherwise(F.concat(F.lit("# "), payload)))
    return e.select(F.concat(F.lit("log"), F.col("user_id") % 5).alias("source_file"), F.lit("sha").alias("source_sha256"),
                    F.col("event_id").alias("line_no"), line.alias("raw_line"), F.lit("r1").alias("run_label"))


LINES_SQL = """
lines as (
  select 'log' || (user_id % 5)::varchar as source_file, event_id as line_no, event_id, user_id, event_type, ts, payload,
    case event_id % 4
      when 0 then strftime(ts, '%a %b %d %Y %H:%M:%S') || ' GMT-0400 (Eastern Daylight Time) ' || payload
      when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z ' || payload
      when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' | info | wk' || user_id::varchar || ' | ' || payload
      else '# ' || payload end as raw_line
  from (select *, case event_id % 7
      when 0 then '{"requestId":"r' || event_id::varchar || '","message":"did ' || event_type || '","level":"INFO"}'
      when 1 then '(EngineCore pid=' || user_id::varchar || ') INFO 09-23 18:00:00 [core.py:1] ' || event_type
      when 2 then 'WARNING 09-23 18:00:00 [core.py:2] ' || event_type
      when 3 then 'Loading: 50%| ' || event_type
      when 4 then '2026-09-23 18:00:00,1 INFO root: ' || event_type
      when 5 then 'Jobs in queue: ' || user_id::varchar else '' end as payload from events))
"""
