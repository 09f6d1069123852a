"""The checks a build runs: on rows while a table is written, on whole tables after it, all kept as tables.

A row rule costs no scan: its violations are counted by the write itself. Only where some are found are the rows read again and
kept. A rule of severity `error` with violations ends the build, and the next layer is not built until it is mended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conform, history, marts, quality
from ..sources import bronze

ERROR, WARN = "error", "warn"
RESULTS = "layer string, table string, rule string, severity string, violations bigint, checked_at timestamp"


@dataclass(frozen=True)
class RowRule:
    table: str
    name: str
    broken: Callable[[], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class TableRule:
    """`rows` gives the violating rows from the tables of a layer and of the one below it, each a function from name to table."""

    table: str
    name: str
    rows: Callable[[Callable[[str], DataFrame], Callable[[str], DataFrame]], DataFrame]
    severity: str = ERROR


def _untrue(test: Column) -> Column:
    return ~F.coalesce(test, F.lit(False))


ROW_RULES = {
    "typed": [
        RowRule("requests", "a file and its version are known", lambda: F.col("source_file").isNull() | F.col("source_sha256").isNull()),
        RowRule("requests", "kind is cold or warm", lambda: _untrue(F.col("kind").isin("cold", "warm")), WARN),
        RowRule("requests", "hits are cold, successful and fast", lambda: ((F.col("kind") != "cold") & F.col("is_flashboot_hit").isNotNull())
                | (F.col("is_flashboot_hit") & (~F.col("ok") | (F.col("delay_ms") >= conform.FAST_MS)))),
        RowRule("log_events", "recognised lines have a time", lambda: (F.col("ts_format") != "none") & F.col("ts_utc").isNull()),
        RowRule("sweep_summaries", "unbounded means inf", lambda: F.col("is_unbounded") != (F.col("request_rate") == F.lit(float("inf")))),
    ],
    "gold": [
        RowRule("hit_rate", "hits are some of the cold starts", lambda: (F.col("n_hits") > F.col("n_cold")) | (F.col("hit_rate") < 0) | (F.col("hit_rate") > 1)),
        RowRule("latency_distribution", "quantiles lie between the extremes", lambda: (F.col("delay_ms_p50") < F.col("delay_ms_min")) | (F.col("delay_ms_p90") > F.col("delay_ms_max")) | (F.col("delay_ms_p50") > F.col("delay_ms_p90"))),
    ],
    "derived": [
        RowRule("polls", "a poll has a time", lambda: F.col("polled_at_utc").isNull()),
        RowRule("billing_hourly", "buckets have an endpoint and a start", lambda: F.col("endpoint_id").isNull() | F.col("bucket_start_utc").isNull()),
        RowRule("worker_events", "an event has a worker and a poll", lambda: F.col("worker_id").isNull() | F.col("poll_id").isNull()),
        RowRule("campaign_requests", "gaps are not negative", lambda: F.col("gap_since_prev_request_s") < 0),
        RowRule("campaign_config", "a cold start has a version in the change log", lambda: F.col("release_version_no").isNull(), WARN),
    ],
}
TABLE_RULES = {
    "typed": [
        TableRule("log_events", "one row for each line", lambda typed, raw: quality.duplicates(typed("log_events"), ["source_file", "source_sha256", "line_no"])),
        TableRule("log_events", "local times are converted", lambda typed, raw: quality.unconverted_local_times(typed("log_events"), raw("log_lines"))),
        TableRule("requests", "labels are known", lambda typed, raw: conform.unmatched_labels(typed("requests"), typed("dim_gpu_labels"), "gpu_label", "gpu_label"), WARN),
    ],
    "gold": [
        TableRule("cohort_comparison", "cohorts sum to pooled", lambda gold, typed: quality.cohorts_sum_to_pooled(gold("cohort_comparison"))),
        TableRule("hit_rate", "rates are exact", lambda gold, typed: quality.rate_bounds(gold("hit_rate"))),
        TableRule("boot_phases", "boots are as their opener says", lambda gold, typed: quality.segmentation_violations(gold("boot_phases"))),
        TableRule("boot_phases", "one row for each boot", lambda gold, typed: quality.duplicates(gold("boot_phases"), ["source_file", "worker_id", "boot_index"])),
        TableRule("latency_distribution", "one row for each group", lambda gold, typed: quality.duplicates(gold("latency_distribution"), marts.LATENCY_KEYS)),
    ],
    "derived": [
        TableRule("polls", "one row for each poll", lambda own, _: quality.duplicates(own("polls"), ["poll_id"])),
        TableRule("endpoints", "one row for each poll and endpoint", lambda own, _: quality.duplicates(own("endpoints"), ["poll_id", "endpoint_id"])),
        TableRule("endpoint_history", "windows follow one another", lambda own, _: quality.window_violations(own("endpoint_history"), "endpoint_id", allow_gaps=True)),
        TableRule("endpoint_history", "each observation lies in one version of its content",
                  lambda own, _: quality.uncovered_observations(own("endpoint_config"), own("endpoint_history"), "endpoint_id", "polled_at_utc", ["endpoint_id", "poll_id"], hash_col="config_hash", dim="endpoint_history")),
        TableRule("endpoint_history", "open versions are those the polls list", lambda own, _: quality.wrong_current_rows(own("endpoint_config"), own("polls"), own("endpoint_history"), "endpoint_id", "endpoint_history")),
        TableRule("release_history", "windows follow one another", lambda own, _: quality.window_violations(own("release_history"), "endpoint_id")),
        TableRule("release_history", "versions give the configuration that was seen",
                  lambda own, _: quality.rebuild_mismatches(own("endpoint_config"), own("release_history"), "endpoint_id", "polled_at_utc", history.LOGGED), WARN),
        TableRule("release_history", "what was seen has a change log", lambda own, _: quality.without_history(own("endpoint_config"), own("releases"), "endpoint_id"), WARN),
        TableRule("releases", "change logs are whole", lambda own, _: quality.truncated_history(own("releases"), "endpoint_id"), WARN),
        TableRule("campaign_requests", "one row for each request", lambda own, _: quality.duplicates(own("campaign_requests"), ["source_file", "series_label", "run_index", "phase_recorded"])),
    ],
}


def watched(layer: str, table: str) -> Mapping[str, Column]:
    """What a write of `table` counts for its row rules: {rule: condition of a violation}."""
    return {r.name: r.broken() for r in ROW_RULES[layer] if r.table == table}


def run(spark: SparkSession, layer: str, counted: Mapping[str, Mapping[str, int]], table: Callable[[str], DataFrame], below: Callable[[str], DataFrame],
        results: str, violations: str, at: datetime) -> DataFrame:
    """Append one result for each rule of the written tables to `results`, and the violating rows as JSON to `violations`; returns the rules of severity error that are broken.

    `counted` is {table: {row rule: violations}} as the writes gave them; rules of tables that it lacks are left out.
    """
    when = F.lit(at).cast("timestamp")
    said: list[tuple] = []
    kept: list[DataFrame] = []

    def keep(rule, rows: DataFrame) -> None:
        kept.append(rows.select(F.lit(layer).alias("layer"), F.lit(rule.table).alias("table"), F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), F.to_json(F.struct("*")).alias("row"), when.alias("checked_at")))
    for rule in ROW_RULES[layer]:
        if rule.table not in counted:
            continue
        n = counted[rule.table][rule.name]
        said.append((layer, rule.table, rule.name, rule.severity, n, at))
        if n:
            keep(rule, table(rule.table).where(rule.broken()))
    of_tables = [r for r in TABLE_RULES[layer] if r.table in counted]
    for rule in of_tables:
        keep(rule, rule.rows(table, below))
    if kept:
        bronze.append(bronze.evolve(kept), violations)
    found = bronze.load(spark, violations, "layer string, table string, rule string, severity string, row string, checked_at timestamp").where((F.col("checked_at") == when) & (F.col("layer") == layer))
    by_rule = {(r.table, r.rule): r["count"] for r in found.groupBy("table", "rule").count().collect()}          # as many rows as there are rules
    said += [(layer, r.table, r.name, r.severity, by_rule.get((r.table, r.name), 0), at) for r in of_tables]
    out = spark.createDataFrame(said, RESULTS)
    if said:
        bronze.append(out, results)
    return out.where((F.col("severity") == ERROR) & (F.col("violations") > 0))


def standing(results: DataFrame, layer: str) -> DataFrame:
    """Rules of severity error that the last run for `layer` found broken."""
    mine = results.where(F.col("layer") == layer)
    last = mine.agg(F.max("checked_at").alias("_last"))                                     # one row
    return mine.join(F.broadcast(last), F.col("checked_at") == F.col("_last")).where((F.col("severity") == ERROR) & (F.col("violations") > 0)).drop("_last")
