"""Queries of the raw layer: orders replicated under synthetic files, checksums and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conform, snapshot
from ..sources import bronze, landing
from .views import table, ts_text



def at(day: str):
    return F.lit(day).cast("timestamp")


T1, T2 = "2024-01-01", "2024-02-01"


def rows(spark, sf_dir):
    """Orders in nine files; file 3 and 4 have a second version, file 5 was ingested twice."""
    o = table(spark, sf_dir, "orders")
    base = o.select("o_orderkey", "o_custkey", "o_totalprice", F.concat(F.lit("f"), F.col("o_orderkey") % 9).alias("source_file"), (F.col("o_orderkey") % 9).alias("_f"))
    first = base.select("*", F.lit("v1").alias("source_sha256"), at(T1).alias("ingested_at"), F.lit("r1").alias("run_label"))
    second = base.where("_f in (3, 4)").select("*", F.lit("v2").alias("source_sha256"), at(T2).alias("ingested_at"), F.lit("r2").alias("run_label"))
    again = base.where("_f = 5").select("*", F.lit("v1").alias("source_sha256"), at(T2).alias("ingested_at"), F.lit("r2").alias("run_label"))
    return first.unionByName(second).unionByName(again).drop("_f")


ROWS_SQL = """
base as (select o_orderkey, o_custkey, o_totalprice, 'f' || (o_orderkey % 9)::varchar as source_file, o_orderkey % 9 as f from orders),
rws as (select o_orderkey, o_custkey, o_totalprice, source_file, 'v1' as source_sha256, timestamp '2024-01-01' as ingested_at, 'r1' as run_label from base
  union all select o_orderkey, o_custkey, o_totalprice, source_file, 'v2', timestamp '2024-02-01', 'r2' from base where f in (3, 4)
  union all select o_orderkey, o_custkey, o_totalprice, source_file, 'v1', timestamp '2024-02-01', 'r2' from base where f = 5),
man as (select distinct source_file, case when f = 3 then 'v2' else 'v1' end as source_sha256 from base where f <> 7 union all select 'f99', 'v1')
"""


def manifest(spark, sf_dir):
    """Current versions: file 3 is at v2, file 4 was reverted to v1, file 7 is gone, f99 has no rows yet."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 9).alias("f")).distinct().where("f <> 7")
    known = o.select(F.concat(F.lit("f"), "f").alias("source_file"), F.when(F.col("f") == 3, "v2").otherwise("v1").alias("source_sha256"))
    extra = table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit("f99").alias("source_file"), F.lit("v1").alias("source_sha256"))
    return known.unionByName(extra)


def q_snapshot_select(spark, sf_dir):
    return snapshot.current_rows(rows(spark, sf_dir), manifest(spark, sf_dir)).drop("ingested_at")


def ledger(spark, sf_dir):
    r = rows(spark, sf_dir)
    return r.where("source_file in ('f0', 'f1', 'f3', 'f5')").groupBy("run_label", "source_file", "source_sha256", "ingested_at").agg(
        F.count("*").alias("rows")).select("run_label", F.lit("orders").alias("table"), "source_file", "source_sha256", "rows", "ingested_at", F.lit(False).alias("reconciled"))


LEDGER_SQL = """
led as (select run_label, 'orders' as "table", source_file, source_sha256, count(*) as rows, ingested_at, false as reconciled from rws
  where source_file in ('f0', 'f1', 'f3', 'f5') group by 1, 2, 3, 4, 6)
"""


def expected(spark, sf_dir):
    return manifest(spark, sf_dir).withColumn("table", F.explode(F.array(F.lit("orders"), F.lit("order_notes"))))


def q_completeness_gate(spark, sf_dir):
    keys = rows(spark, sf_dir).select(F.lit("orders").alias("table"), "source_file", "source_sha256")
    return snapshot.missing_versions(expected(spark, sf_dir), keys, ledger(spark, sf_dir))


def q_idempotent_append(spark, sf_dir):
    held = rows(spark, sf_dir).where("source_file < 'f4'")
    known = bronze.known_versions(held, ledger(spark, sf_dir), "orders")
    fresh = bronze.new_versions(rows(spark, sf_dir).select("source_file", "source_sha256").distinct(), known)
    return rows(spark, sf_dir).join(fresh, ["source_file", "source_sha256"], "left_semi").groupBy("source_file", "source_sha256").agg(F.count("*").alias("n"))


def q_ledger_counts(spark, sf_dir):
    appended = rows(spark, sf_dir).where("run_label = 'r1'").withColumn("table", F.lit("orders"))
    return bronze.ledger_rows(expected(spark, sf_dir), appended, "r9", at(T2)).withColumn("ingested_at", ts_text("ingested_at"))


def q_ledger_reconcile(spark, sf_dir):
    data = rows(spark, sf_dir).withColumn("table", F.lit("orders"))
    return bronze.reconcile(data, ledger(spark, sf_dir), "r9").withColumn("ingested_at", ts_text("ingested_at"))


def entries(spark, sf_dir, root, price=1):
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == root).select(
        F.col("o_orderstatus").alias("source_root"), F.concat(F.lit("p"), F.col("o_orderkey")).alias("landed_relpath"), (F.col("o_totalprice") * price).alias("bytes_landed"))


def q_manifest_merge(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("source_root"), F.concat(F.lit("p"), F.col("o_orderkey")).alias("landed_relpath"),
                                               F.col("o_totalprice").alias("bytes_landed"))
    merged = landing.merge_manifest(old, entries(spark, sf_dir, "P", 2).where("length(landed_relpath) % 2 = 0"), "P")
    return merged.groupBy("source_root").agg(F.count("*").alias("n_files"), F.round(F.sum("bytes_landed"), 1).alias("bytes_landed"))


def q_manifest_prune(spark, sf_dir):
    listed = entries(spark, sf_dir, "F")
    all_ = table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey")).alias("landed_relpath"))
    gone = landing.stale(all_, listed, ["landed_relpath"]).select("landed_relpath", F.lit("pruned").alias("state"))
    return gone.unionByName(landing.current(all_, listed, ["landed_relpath"]).select("landed_relpath", F.lit("kept").alias("state")))


def q_lineage(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("f"), F.col("o_orderkey") % 9).alias("source_file"))
    return bronze.add_lineage(o, manifest(spark, sf_dir), "r1", at(T1)).withColumn("ingested_at", ts_text("ingested_at"))


def q_verify_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    want = o.groupBy(F.concat(F.lit("f"), F.col("o_orderkey") % 9).alias("source_file")).agg(F.count("*").alias("expected_rows")).select(
        F.lit("orders").alias("table"), "source_file", F.lit("v1").alias("source_sha256"), "expected_rows")
    have = rows(spark, sf_dir).where("not (source_file = 'f2' and o_orderkey % 4 = 0)").withColumn("table", F.lit("orders"))
    return bronze.verify_counts(want, have)


def q_table_inventory(spark, sf_dir):
    r = rows(spark, sf_dir)
    return bronze.inventory({"orders": r, "late": r.where("run_label = 'r2'"), "none": r.where("run_label = 'r3'")})


def q_run_history(spark, sf_dir):
    return bronze.run_history(ledger(spark, sf_dir)).withColumn("ingested_at", ts_text("ingested_at"))


def q_union_evolve(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return bronze.evolve([o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey")])


def q_priority_dedup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey")
    copies = o.withColumn("source_file", F.explode(F.array(F.lit("b.csv"), F.lit("a.csv"), F.lit("main.csv")))).where("source_file <> 'main.csv' or o_orderkey % 3 = 0")
    tie = copies.withColumn("_tie", F.concat_ws("|", "source_file", F.format_string("%012d", F.col("o_orderkey"))))
    return snapshot.keep_preferred(tie, ["o_custkey", "day"], F.when(F.col("source_file") == "main.csv", 0).otherwise(1), "_tie").drop("_tie")


def q_posexplode(spark, sf_dir):
    from ..sources import readers
    e = table(spark, sf_dir, "events")
    docs = e.select(F.concat(F.lit('{"label":"u'), F.col("user_id"), F.lit('","max_tokens":16,"runs":['), F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('{"cold":{"ok":true,"delay_ms":'), F.col("event_id"), F.lit("}}"))).otherwise(""),
                             F.when(F.col("event_id") % 3 == 2, F.concat(F.lit(',{"cold":null,"warm":'), F.col("props"), F.lit("}"))).otherwise(""), F.lit('],"summary":'), F.col("props"), F.lit("}")).alias("doc"),
                    F.concat(F.lit("d"), F.col("event_id")).alias("source_file"))
    return readers.series_runs(docs).select("source_file", "label", "max_tokens", "run_index", "cold_json", F.regexp_replace("warm_json", " ", "").alias("warm_json"))


def q_pair_unpivot(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    runs = e.select("event_id", F.concat(F.lit('{"ok":'), F.when(F.col("event_type") == "error", "false").otherwise("true"), F.lit(',"delay_ms":'), F.col("user_id"), F.lit("}")).alias("cold_json"),
                    F.when(F.col("event_id") % 5 != 0, F.concat(F.lit('{"ok":true,"total_s":'), F.col("value"), F.lit("}"))).alias("warm_json"))
    j = conform.unpivot_pair(runs).withColumn("j", F.from_json("body", conform.REQUEST_JSON))
    return j.select("event_id", "kind", "j.ok", "j.delay_ms", F.round("j.total_s", 2).alias("total_s"))


def q_map_explode(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 4 != 0, F.concat(F.lit('{"worker_id":"w'), F.col("user_id"), F.lit('","phases_s":{"boot":'), F.col("value"), F.lit(',"pull":'), F.col("user_id"), F.lit("},"),
                  F.lit('"timeline":{"marks":{"start":'), F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(".5}}}")))
    runs = e.select(F.col("event_type").alias("label"), F.lit("e1").alias("endpoint"), F.col("event_id").alias("run_index"), body.alias("cold_json"),
                    F.lit("f").alias("source_file"), F.lit("s").alias("source_sha256"), F.lit("r").alias("run_label"))
    out = conform.startup_phases(runs).drop("source_file", "source_sha256", "bronze_run_label", "endpoint_id")
    return out.withColumns({"seconds": F.round("seconds", 2), "mark_ts_utc": ts_text("mark_ts_utc")})


QUERIES = {f.__name__: f for f in (
    q_snapshot_select, q_completeness_gate, q_idempotent_append, q_ledger_counts, q_ledger_reconcile, q_manifest_merge, q_manifest_prune, q_lineage,
    q_verify_counts, q_table_inventory, q_run_history, q_union_evolve, q_priority_dedup, q_posexplode, q_pair_unpivot, q_map_explode)}

R = "with " + ROWS_SQL
TS = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f')"
ORACLES = {
    "q_snapshot_select": R + """select o_orderkey, o_custkey, o_totalprice, source_file, source_sha256, run_label from rws join man using (source_file, source_sha256)
qualify dense_rank() over (partition by source_file, source_sha256 order by ingested_at desc, run_label desc) = 1""",
    "q_completeness_gate": R + "," + LEDGER_SQL + """, want as (select *, unnest(['orders', 'order_notes']) as "table" from man),
have as (select 'orders' as "table", source_file, source_sha256 from rws union select "table", source_file, source_sha256 from led)
select "table", source_file, source_sha256 from want anti join have using ("table", source_file, source_sha256)""",
    "q_idempotent_append": R + "," + LEDGER_SQL + """, known as (select source_file, source_sha256 from rws where source_file < 'f4' union select source_file, source_sha256 from led)
select source_file, source_sha256, count(*) as n from rws anti join known using (source_file, source_sha256) group by 1, 2""",
    "q_ledger_counts": R + """, want as (select *, unnest(['orders', 'order_notes']) as "table" from man),
c as (select 'orders' as "table", source_file, source_sha256, count(*) as n from rws where run_label = 'r1' group by 1, 2, 3)
select 'r9' as run_label, "table", source_file, source_sha256, coalesce(n, 0) as rows, '2024-02-01 00:00:00.000000' as ingested_at, false as reconciled from want left join c using ("table", source_file, source_sha256)""",
    "q_ledger_reconcile": R + "," + LEDGER_SQL + """, h as (select 'orders' as "table", source_file, source_sha256, count(*) as rows, min(ingested_at) as ingested_at from rws group by 1, 2, 3)
select 'r9' as run_label, "table", source_file, source_sha256, rows, """ + TS + """ as ingested_at, true as reconciled from h anti join led using ("table", source_file, source_sha256)""",
    "q_manifest_merge": """select o_orderstatus as source_root, count(*) as n_files, round(sum(o_totalprice * case when o_orderstatus = 'P' then 2 else 1 end), 1) as bytes_landed from orders
where o_orderstatus <> 'P' or length('p' || o_orderkey::varchar) % 2 = 0 group by 1""",
    "q_manifest_prune": "select 'p' || o_orderkey::varchar as landed_relpath, case when o_orderstatus = 'F' then 'kept' else 'pruned' end as state from orders",
    "q_lineage": R + "select o_orderkey, source_file, source_sha256, '2024-01-01 00:00:00.000000' as ingested_at, 'r1' as run_label from base join man using (source_file)",
    "q_verify_counts": R + """, w as (select 'orders' as "table", source_file, 'v1' as source_sha256, count(*) as e from base group by 1, 2, 3),
a as (select 'orders' as "table", source_file, source_sha256, count(*) as n from rws where not (source_file = 'f2' and o_orderkey % 4 = 0) group by 1, 2, 3)
select "table", source_file, source_sha256, coalesce(e, 0) as expected_rows, coalesce(n, 0) as found_rows,
  case when coalesce(e, 0) > 0 and coalesce(n, 0) > e and n % e = 0 then 'appended ' || (n // e)::varchar || 'x' else 'MISMATCH' end as note
from w full join a using ("table", source_file, source_sha256) where coalesce(e, 0) <> coalesce(n, 0)""",
    "q_table_inventory": R + """, t as (select 'orders' as "table", * from rws union all select 'late', * from rws where run_label = 'r2')
select "table", count(*) as rows, count(distinct source_file) as files, count(distinct run_label) as labels, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') as latest from t group by 1
union all select 'none', 0, 0, 0, null""",
    "q_run_history": R + "," + LEDGER_SQL + "select run_label, " + TS + " as ingested_at, sum(rows)::bigint as rows, count(*) as appends from led group by 1, 2",
    "q_union_evolve": "select o_orderkey, o_custkey, case when o_orderkey % 2 = 1 then o_orderstatus end as o_orderstatus from orders",
    "q_priority_dedup": """with c as (select o_custkey, strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey, unnest(['b.csv', 'a.csv', 'main.csv']) as source_file from orders)
select o_custkey, day, o_orderkey, source_file from c where source_file <> 'main.csv' or o_orderkey % 3 = 0
qualify row_number() over (partition by o_custkey, day order by (source_file <> 'main.csv')::int, source_file, o_orderkey) = 1""",
    "q_posexplode": """select 'd' || event_id::varchar as source_file, 'u' || user_id::varchar as label, 16::bigint as max_tokens, i::int as run_index,
  case when i = 0 then '{"ok":true,"delay_ms":' || event_id::varchar || '}' end as cold_json, case when i = 1 then replace(props, ' ', '') end as warm_json
from events, unnest(range(event_id % 3)) as u(i)""",
    "q_pair_unpivot": """select event_id, 'cold' as kind, event_type <> 'error' as ok, user_id as delay_ms, null::double as total_s from events
union all select event_id, 'warm', case when event_id % 5 <> 0 then true end, null, case when event_id % 5 <> 0 then round(value, 2) end from events""",
    "q_map_explode": """with b as (select * from events where event_id % 4 <> 0)
select event_type as series_label, event_id::int as run_index, 'w' || user_id::varchar as worker_id, 'phase' as kind, 'boot' as name, round(value, 2) as seconds, null as mark_ts_utc from b
union all select event_type, event_id::int, 'w' || user_id::varchar, 'phase', 'pull', user_id::double, null from b
union all select event_type, event_id::int, 'w' || user_id::varchar, 'mark', 'start', null, strftime(date_trunc('second', ts) + interval 500 millisecond, '%Y-%m-%d %H:%M:%S.%f') from b""",
}
