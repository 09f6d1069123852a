"""How well a version history places facts: point-in-time scores and their summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import asof_join, by_number, ordered_scan
from ..functions.text import row_hash, ticks_between

# How a recorded on/off setting reads in the API.
FAST_ON = ("FLASHBOOT", "PRIORITY_FLASHBOOT")
FAST_OFF = "OFF"


def agrees(found: Column, expected: Column) -> Column:
    """Equal and both known; a missing version or expectation scores false, not null."""
    return F.coalesce(found == expected, F.lit(False))


def setting_agrees(design: Column, found: Column, on=FAST_ON, off: str = FAST_OFF) -> Column:
    """on / off against the API's words; null only when the design says neither."""
    return (F.when(F.lower(design) == "on", F.coalesce(found.isin(*on), F.lit(False)))
            .when(F.lower(design) == "off", F.coalesce(found == off, F.lit(False))))


def config_asof(facts: DataFrame, releases: DataFrame, polls: DataFrame, pins: DataFrame, *, at: str = "request_ts_utc", unit: str = "day") -> DataFrame:
    """Each cold start with the configuration both histories give for its instant, scored against its design."""
    cold = facts.where("kind = 'cold' and ok and campaign_kind = 'campaign'").select(
        "series_label", "endpoint_id", "run_index", "source_file", at, F.col("gpu_model").alias("design_gpu_model"),
        F.col("flashboot").alias("design_flashboot"))
    p = asof_join(cold, [
        (releases, {"gpu_ids": "release_gpu_ids", "version_no": "release_version_no", "valid_from": "release_valid_from"}),
        (polls, {"gpu_ids": "poll_gpu_ids", "flashboot": "poll_flashboot", "version_no": "poll_version_no",
                 "valid_from": "poll_valid_from", "changed_after": "poll_changed_after"})], "endpoint_id", at, unit=unit)
    k = pins.select(F.col("gpu_model").alias("design_gpu_model"), F.col("gpu_ids").alias("expected_gpu_ids"))
    expected = F.col("expected_gpu_ids")
    return p.join(k, "design_gpu_model", "left").withColumns({
        "release_gpu_agrees": agrees(F.col("release_gpu_ids"), expected),
        "poll_gpu_agrees": agrees(F.col("poll_gpu_ids"), expected),
        "poll_flashboot_agrees": setting_agrees(F.col("design_flashboot"), F.col("poll_flashboot")),
        "s_since_release_version": ticks_between(F.col("release_valid_from"), F.col(at), 1)})


def agreement(scored: DataFrame, measures: Mapping[tuple[str, str], str]) -> DataFrame:
    """(history, attribute) -> share of facts placed right; `measures` maps the pair to a boolean column."""
    counted = scored.agg(F.count("*").alias("_n"), *[F.count_if(c).alias(f"_{i}") for i, c in enumerate(measures.values())])
    rows = F.array(*[F.struct(F.lit(h).alias("history"), F.lit(a).alias("attribute"), F.col("_n").alias("n_cold_starts"),
                              F.col(f"_{i}").alias("n_agree")) for i, (h, a) in enumerate(measures)])
    return counted.select(F.inline(rows)).withColumn(
        "pct_agree", F.round(F.lit(100.0) * F.col("n_agree") / F.nullif(F.col("n_cold_starts"), F.lit(0)), 1))


AGREEMENT = {("release log (timestamp strategy)", "gpu"): "release_gpu_agrees",
             ("polls (check strategy)", "gpu"): "poll_gpu_agrees",
             ("polls (check strategy)", "flashboot"): "poll_flashboot_agrees"}


def _detail(df: DataFrame, deleted: bool) -> Column:
    text = [F.col("endpoints"), F.lit(" endpoints, "), F.col("current"), F.lit(" current")]
    return F.concat(*text, F.lit(", "), F.col("deleted"), F.lit(" deleted")) if deleted else F.concat(*text)


def history_summary(polls: DataFrame, observations: DataFrame, poll_history: DataFrame, release_history: DataFrame,
                    merged_history: DataFrame, scored: DataFrame, key: str, logged: list[str], *, unit: str = "day") -> DataFrame:
    """Ten figures about the histories in long form: ord, metric, value, detail."""
    spread = polls.where("endpoints_complete").agg(F.min("polled_at_utc").alias("first"), F.max("polled_at_utc").alias("last"),
                                                   F.count("*").alias("n"))
    minute = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")

    def metric(df: DataFrame, order: int, name: str, value: Column, detail: Column | None = None) -> DataFrame:
        text = F.lit(None) if detail is None else detail
        return df.select(F.lit(order).alias("ord"), F.lit(name).alias("metric"), value.cast("bigint").alias("value"),
                         text.cast("string").alias("detail"))

    placed = asof_join(observations, [(release_history, {"version_no": "_v", **{c: f"_r_{c}" for c in logged}})], key, "polled_at_utc", unit=unit)
    equal = F.col("_v").isNotNull()
    for c in logged:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    rebuilt = placed.agg(F.count("*").alias("obs"), F.count_if(equal).alias("match"))

    changes = ordered_scan(poll_history.withColumn("_h", row_hash(logged)).select(key, "version_no", "_h"), [key], ["version_no"],
                           by_number("version_no", 100_000), lag={"_prev": F.col("_h")})
    seen = changes.agg(F.count_if(F.col("_prev").isNotNull() & (F.col("_h") != F.col("_prev"))).alias("n"))
    # the polled window is one aggregate row
    logged_changes = (release_history.crossJoin(F.broadcast(spread.select("first", "last")))
                      .agg(F.count_if((F.col("version_no") > 1) & (F.col("valid_from") > F.col("first"))
                                      & (F.col("valid_from") <= F.col("last"))).alias("n")))
    miss = ~F.col("poll_gpu_agrees")
    misses = scored.agg(F.count_if(miss).alias("n"), F.count_if(miss & (F.col("poll_valid_from") < F.col("release_valid_from"))).alias("early"))

    def counts(df: DataFrame, has_deleted: bool) -> DataFrame:
        cur = F.col("is_current") if has_deleted else F.col("valid_to").isNull()
        aggs = [F.count("*").alias("n"), F.countDistinct(key).alias("endpoints"), F.count_if(cur).alias("current")]
        return df.agg(*aggs, *([F.count_if("is_deleted").alias("deleted")] if has_deleted else []))

    parts = [
        metric(spread, 1, "polls in bronze", F.col("n"), F.concat(minute("first"), F.lit(" to "), minute("last"), F.lit(" UTC"))),
        metric(rebuilt, 2, "poll x endpoint observations", F.col("obs")),
        metric(rebuilt, 3, "observations the release rebuild matches on all six release columns", F.col("match")),
        metric(seen, 4, "changes to release-tracked columns the polls saw", F.col("n"), F.lit("in the polled window")),
        metric(logged_changes, 5, "changes to release-tracked columns in the release log", F.col("n"), F.lit("same window")),
        metric(counts(poll_history, True), 6, "polls: versions", F.col("n"), _detail(poll_history, True)),
        metric(counts(release_history, True), 7, "release log: versions", F.col("n"), _detail(release_history, True)),
        metric(counts(merged_history, False), 8, "merged snapshots: versions", F.col("n"), _detail(merged_history, False)),
        metric(misses, 9, "campaign cold starts the poll history puts on the wrong GPU", F.col("n")),
        metric(misses, 10, "of those, on a poll version that began before the cell's release version", F.col("early"),
               F.lit("the poll had not seen the change yet")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def setting_verdict(rates: DataFrame, latest: DataFrame, key: str = "endpoint_id") -> DataFrame:
    """The recorded on/off setting of each entity beside what its newest observation says."""
    api = latest.select(key, F.col("flashboot").alias("api_flashboot"), "name", F.col("polled_at_utc").alias("api_polled_at_utc"),
                        F.lit(True).alias("_known"))
    recorded = F.col("flashboot_setting")
    same = F.coalesce(setting_agrees(recorded, F.col("api_flashboot")), F.lit(False))
    verdict = (F.when(F.col("_known").isNull(), "endpoint no longer exists").when(recorded == "unknown", "api fills a gap")
               .when(same, "agree").otherwise("disagree"))
    return (rates.join(api, key, "left")
            .select("engine", "model", key, recorded.alias("benchmark_flashboot"), "api_flashboot", verdict.alias("verdict"),
                    "n_cold", "n_hits", "hit_rate", "name", "api_polled_at_utc"))
