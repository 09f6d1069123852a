"""Data checks. Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..functions.ordered import by_time, covering_versions, ordered_scan, asof_join


def column_checks(df: DataFrame, table: str, *, not_null: Sequence[str] = (),
                  accepted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(table, column, check, violations) for every not-null and accepted-values rule, in one pass.

    A null value is not an unaccepted value; pair the rule with not_null where it must not be null.
    """
    rules = [(c, "not_null", F.col(c).isNull()) for c in not_null]
    rules += [(c, "accepted_values", F.coalesce(~F.col(c).isin(*v), F.lit(False))) for c, v in (accepted or {}).items()]
    counted = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.lit(check).alias("check"),
                              F.col(f"_{i}").alias("violations")) for i, (c, check, _) in enumerate(rules)])
    return counted.select(F.inline(rows))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (unique / grain / one-ingest checks)."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> DataFrame:
    """Non-null child values without a parent, with how many rows carry them."""
    counts = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return counts.join(known, "value", "left_anti").withColumn("severity", F.lit(severity))


# What the checks of versions and of boots say.
EMPTY, SEVERAL_OPEN, OPEN_NOT_LAST = "empty or inverted window", "more than one open row", "open row is not the last"
OVERLAP, GAP = "overlaps the next version", "gap before the next version"
NO_PHASE, NO_START, HAS_START = "boot 0 without a phase", "wrapper-anchored boot without t_start_vllm", "init-anchored boot with a t_start_vllm"
PASSES_DISAGREE = "graph passes and graph_capture_s disagree"


def window_violations(history: DataFrame, key: str, *, valid_from: str = "valid_from", valid_to: str = "valid_to",
                      allow_gaps: bool = False, unit: str = "day") -> DataFrame:
    """Versions whose half-open windows are empty, overlap, leave a gap, or are open but not last; the first that holds, in that order.

    A sweep over each key's timeline counts how many versions have begun: by a version's own begin (its number), before its end, and by
    its end. Others that begin before a version ends overlap it; where none has begun by its end and more are to come, there is a gap.
    """
    never = F.lit("9999-12-31").cast("timestamp")
    rows = materialize(history.withColumn("_row", F.monotonically_increasing_id()))
    mark = lambda at, side: F.struct(at.alias("_at"), F.lit(side).alias("_side"))
    begin, end = F.col(valid_from), F.coalesce(F.col(valid_to), never)
    line = rows.select(key, "_row", end.alias("_tie"), F.explode(F.array(mark(end, 0), mark(begin, 1), mark(end, 2))).alias("_m")).select(key, "_row", "_tie", "_m.*")
    swept = ordered_scan(line, [key], ["_at", "_side", "_tie", "_row"], by_time("_at", unit), running_sum={"_begun": (F.col("_side") == 1).cast("int")})
    begun = lambda side: F.max(F.when(F.col("_side") == side, F.col("_begun")))
    counts = swept.groupBy("_row").agg(begun(0).alias("_before_end"), begun(1).alias("_number"), begun(2).alias("_by_end"))
    of_key = rows.groupBy(key).agg(F.count("*").alias("_n"), F.count_if(F.col(valid_to).isNull()).alias("_n_open"))
    more = F.col("_n") > F.col("_number")
    says = (F.when(F.col(valid_to) <= begin, EMPTY).when(F.col("_n_open") > 1, SEVERAL_OPEN).when(F.col(valid_to).isNull() & more, OPEN_NOT_LAST)
            .when(F.col("_before_end") > F.col("_number"), OVERLAP))
    if not allow_gaps:
        says = says.when(more & (F.col("_by_end") == F.col("_number")), GAP)
    found = rows.join(counts, "_row").join(of_key, key).withColumn("violation", says)
    return found.where(F.col("violation").isNotNull()).select(*history.columns, "violation")


def uncovered_observations(observations: DataFrame, history: DataFrame, key: str, at: str, ids: Sequence[str], *,
                           hash_col: str | None = None, dim: str = "history", unit: str = "day") -> DataFrame:
    """Observations that fall in other than exactly one version (and, with `hash_col`, one of equal content)."""
    n = covering_versions(observations, history, [key], at, [*ids], out="n_versions", unit=unit)
    if hash_col is None:
        return n.where("n_versions <> 1").select(
            F.lit(dim).alias("dim"), key, *[i for i in ids if i != key],
            F.concat(F.lit("observation in "), "n_versions", F.lit(" versions")).alias("problem"))
    same = covering_versions(observations, history, [key, hash_col], at, [*ids], out="n_same", unit=unit).select(*ids, "n_same")
    return (n.join(same, [*ids]).where("n_versions <> 1 or n_same <> 1")
            .select(F.lit(dim).alias("dim"), key, *[i for i in ids if i != key],
                    F.concat(F.lit("observation in "), "n_versions", F.lit(" versions, "), "n_same",
                             F.lit(" with its config")).alias("problem")))


def wrong_current_rows(observations: DataFrame, polls: DataFrame, history: DataFrame, key: str, dim: str = "history") -> DataFrame:
    """Entities whose open rows disagree with the polls: listed in the latest complete poll or seen after it = 1, else 0."""
    newest = (polls.where("endpoints_complete").agg(F.max(F.struct("polled_at_utc", "poll_id")).alias("_p"))
              .select(F.col("_p.polled_at_utc").alias("_t"), F.col("_p.poll_id").alias("_id")))
    # `newest` is one row by construction
    flags = (observations.crossJoin(F.broadcast(newest))
             .groupBy(key).agg(F.max(((F.col("poll_id") == F.col("_id")) | (F.col("polled_at_utc") > F.col("_t"))).cast("int")).alias("_should")))
    current = history.groupBy(key).agg(F.count_if("is_current").alias("_n"))
    says = F.when(F.col("_should") == 1, "it exists").otherwise("it is gone")
    return (current.join(flags, key).where("_n <> coalesce(_should, 0)")
            .select(F.lit(dim).alias("dim"), key, F.concat("_n", F.lit(" current rows; the polls say "), says).alias("problem")))


def rebuild_mismatches(observations: DataFrame, history: DataFrame, key: str, at: str, columns: Sequence[str], *, unit: str = "day") -> DataFrame:
    """Observations whose values differ from the version rebuilt for their time, or that have no version."""
    joined = asof_join(observations, [(history, {"version_no": "version_no", **{c: f"rebuilt_{c}" for c in columns}})], key, at, unit=unit)
    equal = F.lit(True)
    for c in columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"rebuilt_{c}"))
    return joined.where(F.col("version_no").isNull() | ~equal)


def without_history(observations: DataFrame, releases: DataFrame, key: str) -> DataFrame:
    """Entities seen but without any change-log entry."""
    seen = observations.groupBy(key).agg(F.count("*").alias("n_observations"), F.max("polled_at_utc").alias("last_seen_utc"))
    return seen.join(releases.select(key).distinct(), key, "left_anti")


def truncated_history(releases: DataFrame, key: str) -> DataFrame:
    """Entities whose change log has more pages than were fetched."""
    return releases.where("history_truncated").groupBy(key).agg(F.max("release_version").alias("latest_release_version"))


def cohorts_sum_to_pooled(comparison: DataFrame) -> DataFrame:
    """Pooled rows whose counts differ from the sum of their cohorts, or that stand alone."""
    counts = ["n_full_boots", "n_warm", "n_undated"]
    part = lambda scope: [F.sum(F.when(F.col("scope") == scope, F.col(c))).alias(f"{scope}_{c}") for c in counts]
    differ = F.lit(False)
    for c in counts:
        differ = differ | ~F.col(f"pooled_{c}").eqNullSafe(F.col(f"cohort_{c}"))
    return comparison.groupBy("engine", "weights_mode").agg(*part("pooled"), *part("cohort")).where(differ)


def rate_bounds(rates: DataFrame) -> DataFrame:
    n, hits, rate = F.col("n_cold"), F.col("n_hits"), F.col("hit_rate")
    exact = F.abs(rate - F.round(hits / F.nullif(n, F.lit(0)), 3)) > 1e-9
    return rates.where((hits > n) | (rate < 0) | (rate > 1) | ((n > 0) & exact) | ((n == 0) & rate.isNotNull()))


def hit_flag_consistent(req: DataFrame, fast_ms: int = 5_000) -> DataFrame:
    """The flag is null off cold rows and true only for successful fast ones."""
    flag = F.col("is_flashboot_hit")
    return req.where(((F.col("kind") != "cold") & flag.isNotNull()) | (flag & (~F.col("ok") | (F.col("delay_ms") >= fast_ms))))


def untimed_recognised_lines(events: DataFrame) -> DataFrame:
    """A line whose format was recognised but whose time did not parse."""
    return events.where("ts_format <> 'none' and ts_utc is null").select(
        "source_file", "line_no", "ts_format", F.left("payload", F.lit(60)).alias("raw_line_prefix"))


def unconverted_local_times(events: DataFrame, lines: DataFrame) -> DataFrame:
    """Local-time lines stored as if their wall clock were UTC."""
    key = ["source_file", "source_sha256", "line_no"]
    both = events.where("ts_format = 'pipe'").join(lines.select(*key, "raw_line"), key)
    return both.where(F.date_format("ts_utc", "yyyy-MM-dd HH:mm:ss.SSS") == F.left("raw_line", F.lit(23)))


def segmentation_violations(boots: DataFrame) -> DataFrame:
    """Boot rows that are not what their opener and their counts make them expect, one row per facet that differs; null expects nothing."""
    opener = F.col("segmented_by")
    phases = F.coalesce("weights_load_s", "start_to_api_ready_s", "init_engine_s", "graph_capture_s").isNotNull()
    expected = {"phase": F.when(F.col("boot_index") == 0, True), "start": F.when(opener.startswith("Starting vLLM"), True).when(opener.startswith("Initializing"), False), "capture": F.col("n_graph_passes") > 0}
    found = {"phase": phases, "start": F.col("t_start_vllm").isNotNull(), "capture": F.col("graph_capture_s").isNotNull()}
    says = {"phase": F.lit(NO_PHASE), "start": F.when(expected["start"], NO_START).otherwise(HAS_START), "capture": F.lit(PASSES_DISAGREE)}
    facets = F.array(*[F.struct(expected[k].alias("expected"), found[k].alias("found"), says[k].alias("problem")) for k in expected])
    each = boots.select("source_file", "worker_id", "boot_index", "segmented_by", F.inline(facets))
    return each.where(F.col("expected") != F.col("found")).drop("expected", "found")


def unbounded_mismatches(summaries: DataFrame) -> DataFrame:
    """is_unbounded must hold exactly when the rate is inf."""
    return summaries.where(F.col("is_unbounded") != (F.col("request_rate") == F.lit(float("inf"))))


def unknown_expected_values(scored: DataFrame, label: str, expected: str) -> DataFrame:
    return scored.where(F.col(expected).isNull()).groupBy(label).agg(F.count("*").alias("n"))


def seed_shape(seed: DataFrame, name: str, *, key: Sequence[str], enums: Mapping[str, Sequence[str]] | None = None,
               required: Sequence[str] = (), rules: Mapping[str, Column] | None = None) -> DataFrame:
    """(seed, rule, n) for curated files: duplicate keys, values outside an enum, blanks, and custom rules."""
    checks = {f"blank {c}": F.coalesce(F.col(c) == "", F.col(c).isNull()) for c in required}
    checks |= {f"{c} outside enum": F.coalesce(~F.col(c).isin(*v), F.lit(True)) for c, v in (enums or {}).items()}
    checks |= dict(rules or {})
    flags = F.array(*[F.struct(F.lit(r).alias("rule"), bad.alias("bad")) for r, bad in checks.items()])
    broken = (seed.select(F.explode(F.filter(flags, lambda x: x["bad"])).alias("b")).groupBy("b.rule").agg(F.count("*").alias("n"))
              .select(F.lit(name).alias("seed"), "rule", "n"))
    twice = duplicates(seed, key).agg(F.count("*").alias("n")).where("n > 0").select(
        F.lit(name).alias("seed"), F.lit("duplicate key").alias("rule"), "n")
    return broken.unionByName(twice)


def selection_is_canonical(selection: str, pool: str) -> Column:
    """A comma list is sorted pools then sorted exclusions, and its only pool is `pool`."""
    parts = F.split(F.col(selection), ",")
    keep = F.filter(parts, lambda x: ~x.startswith("-"))
    drop = F.filter(parts, lambda x: x.startswith("-"))
    return (parts == F.concat(F.array_sort(keep), F.array_sort(drop))) & (keep == F.array(F.col(pool)))


def with_checked_count(violations: DataFrame, checked: DataFrame, any_column: str) -> DataFrame:
    """One row: how many violations and how many rows were checked."""
    v = violations.agg(F.count("*").alias("violations")).withColumn("_one", F.lit(1))
    c = checked.select(any_column).agg(F.count("*").alias("checked")).withColumn("_one", F.lit(1))
    return v.join(c, "_one").drop("_one")
