"""Version histories (type 2) from snapshots and from change logs, and state changes between snapshots.

Every ordered step runs through `ordered_scan`, so an entity with a third of all observations is split by
time; entities of few rows keep them in one task from step to step. Polls are ordered by (polled_at_utc, poll_id) directly; there is no global sequence number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import MOST, by_number, by_size, by_time, ordered_scan
from ..functions.text import (blank_to_null, list_or_all, row_hash, selection_of_lists, ticks_between, version_key)
from ..session import materialize
from .snapshot import pick_max

# The configuration columns a new version starts on, and those the change log covers.
TRACKED = ["gpu_ids", "min_cuda", "allowed_cuda", "image", "locations", "disk_gb", "flashboot", "idle_timeout_s",
           "scaling_type", "scaling_value", "request_timeout_ms", "network_volumes"]
LOGGED = ["gpu_ids", "min_cuda", "allowed_cuda", "image", "locations", "disk_gb"]
UNSET = "<unset>"
OBSERVED_ORDER = ["polled_at_utc", "poll_id"]


def endpoint_config(endpoints: DataFrame) -> DataFrame:
    """The configuration each poll saw, in canonical text, with its hash."""
    json = lambda path: F.get_json_object("config_json", path)
    or_all = lambda c: F.coalesce(blank_to_null(c), F.lit("ALL"))
    cfg = endpoints.select(
        "poll_id", "polled_at_utc", "endpoint_id", "name",
        selection_of_lists(F.col("gpu_pools"), F.col("gpu_excluded_types")).alias("gpu_ids"),
        or_all(json("$.gpu.minCudaVersion")).alias("min_cuda"), list_or_all(F.col("allowed_cuda_versions")).alias("allowed_cuda"),
        blank_to_null(F.col("image")).alias("image"), list_or_all(F.col("data_center_ids")).alias("locations"),
        blank_to_null(json("$.disk")).alias("disk_gb"), "flashboot", "idle_timeout_s", "scaling_type", "scaling_value",
        "request_timeout_ms", F.coalesce("network_volumes", F.lit("[]")).alias("network_volumes"), "workers_min", "workers_max")
    return cfg.withColumn("config_hash", row_hash(TRACKED))


def versions_from_observations(obs: DataFrame, complete_polls: DataFrame, key: str, tracked: Sequence[str], *,
                               current: Mapping[str, str] | None = None, unit: str = "day", most: int = MOST) -> DataFrame:
    """Type 2 history out of periodic observations: one row per entity x run of equal `config_hash`.

    A version starts at the first observation that differs from the one before (A, B, A is three versions).
    It ends where the next starts, or, for the last one, at the first complete poll after the entity was
    last seen: an incomplete listing never proves a deletion. `current` columns carry the newest value on
    every version. `obs`: key, polled_at_utc, poll_id, config_hash and the tracked columns. Entities of more
    than `most` observations are cut into chunks of a `unit`.
    """
    return by_size(obs.where(F.col(key).isNotNull()), [key],
                   lambda rows, whole: _observed_versions(rows, complete_polls, key, tracked, dict(current or {}), unit, whole), most)


def _observed_versions(known: DataFrame, complete_polls: DataFrame, key: str, tracked: Sequence[str], newest: Mapping[str, str], unit: str,
                       whole: bool) -> DataFrame:
    day = by_time("polled_at_utc", unit)
    extra = [F.col(c).alias(f"_new_{o}") for o, c in newest.items()] if whole else []
    seen = ordered_scan(known.select(key, *OBSERVED_ORDER, *tracked, "config_hash", *extra), [key], OBSERVED_ORDER, day, whole=whole,
                        lag={"changed_after": F.col("polled_at_utc")}, running_sum={"_pos": F.lit(1)},
                        runs={"version_no": F.col("config_hash")})
    if whole:
        all_of_it = Window.partitionBy(key).orderBy(*OBSERVED_ORDER).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        seen = seen.select("*", F.last("_pos").over(all_of_it).alias("_n"), F.last("polled_at_utc").over(all_of_it).alias("_last"),
                           *[F.last(f"_new_{o}").over(all_of_it).alias(o) for o in newest])
    starts = seen.where("version_no_starts").drop("version_no_starts")
    versions = ordered_scan(starts if whole else materialize(starts), [key], OBSERVED_ORDER, day, whole=whole,
                            lead={"_next_from": F.col("polled_at_utc"), "_next_seen": F.col("changed_after"), "_next_pos": F.col("_pos")})
    totals = known.groupBy(key).agg(F.count("*").alias("_n"), F.max("polled_at_utc").alias("_last"))
    gone = deletions(totals.select(key, "_last"), complete_polls, key, unit)
    if whole:
        ended = versions.join(gone, key, "left")
    else:
        if newest:
            latest = pick_max(known.select(key, *OBSERVED_ORDER, *[F.col(c).alias(o) for o, c in newest.items()]),
                              [key], [F.col(c) for c in OBSERVED_ORDER]).drop(*OBSERVED_ORDER)
            totals = totals.join(latest, key)
        ended = versions.join(totals.join(gone, key, "left"), key)
    is_last = F.col("_next_from").isNull()
    return ended.select(
        version_key(F.col(key), F.col("polled_at_utc")).alias("version_key"), key, F.col("version_no").cast("bigint").alias("version_no"),
        F.col("polled_at_utc").alias("valid_from"), F.coalesce("_next_from", "deleted_at").alias("valid_to"),
        (is_last & F.col("deleted_at").isNull()).alias("is_current"), (is_last & F.col("deleted_at").isNotNull()).alias("is_deleted"),
        "changed_after", ticks_between(F.col("changed_after"), F.col("polled_at_utc"), 60).alias("change_window_min"),
        *tracked, "config_hash", (F.coalesce("_next_pos", F.col("_n") + 1) - F.col("_pos")).cast("bigint").alias("n_polls"),
        F.coalesce("_next_seen", "_last").alias("last_seen"), *newest)


def deletions(last_seen: DataFrame, complete_polls: DataFrame, key: str, unit: str = "day") -> DataFrame:
    """First complete poll strictly after each entity's last sighting (entities still listed have no row).

    Only the distinct instants of last sightings and of polls share a timeline, carried backward (at equal
    times the poll sorts first, so it does not count). Entities x polls are never paired, and many entities
    last seen together are one row of the timeline.
    """
    line = (last_seen.select(F.col("_last").alias("_at")).distinct().withColumn("_side", F.lit(1))
            .unionByName(complete_polls.select(F.col("polled_at_utc").alias("_at")).distinct().withColumn("_side", F.lit(0))))
    found = ordered_scan(materialize(line), [], ["_at", "_side"], by_time("_at", unit),
                         carry_backward={"deleted_at": F.when(F.col("_side") == 0, F.col("_at"))})
    ends = found.where("_side = 1 and deleted_at is not null").select(F.col("_at").alias("_last"), "deleted_at")
    return last_seen.join(ends, "_last").select(key, "deleted_at")


def releases_wide(changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per release with `new_C` / `old_C` per tracked column; a change to null is kept as <unset>.

    `changes`: key, release_version, created_at_utc, field, column_name (null = untracked), old_value, new_value.
    """
    side = lambda c, v: F.min(F.when(F.col("column_name") == c,
                                     F.struct("field", F.coalesce(v, F.lit(UNSET)).alias("v")))).getField("v")
    return changes.groupBy(key, "release_version", "created_at_utc").agg(
        *[side(c, f"{s}_value").alias(f"{s}_{c}") for c in columns for s in ("new", "old")])


def versions_from_changes(changes: DataFrame, latest: DataFrame, deleted: DataFrame, key: str, columns: Sequence[str], *,
                          chunk: int = 100_000, most: int = MOST) -> DataFrame:
    """Type 2 history out of a change log of diffs.

    Each column holds the `new` of its last diff so far, else the `old` of its next diff, else the value now
    (`latest`). Releases that leave every tracked column unchanged collapse into one version. `deleted`
    (key, deleted_at) closes the last version of entities that are gone. Entities of more than `most` diffs
    are cut into chunks of `chunk` releases.
    """
    return by_size(changes.where(F.col(key).isNotNull()), [key],
                   lambda rows, whole: _logged_versions(rows, latest, deleted, key, columns, chunk, whole), most)


def _logged_versions(changes: DataFrame, latest: DataFrame, deleted: DataFrame, key: str, columns: Sequence[str], chunk: int,
                     whole: bool) -> DataFrame:
    # whole entities are dealt out once, by key, for all steps; else every scan's input is a table
    step = (lambda df: df) if whole else materialize
    wide = step(releases_wide(changes.repartition(key) if whole else changes, key, columns))
    order = ["release_version", "created_at_utc"]
    by_release = by_number("release_version", chunk)
    filled = ordered_scan(wide, [key], order, by_release, whole=whole,
                          carry_forward={f"_new_{c}": F.col(f"new_{c}") for c in columns},
                          carry_backward={f"_old_{c}": F.col(f"old_{c}") for c in columns})
    now = latest.select(key, *[F.col(c).cast("string").alias(f"_now_{c}") for c in columns])
    states = filled.join(now, key, "left").select(
        key, *order, *[F.nullif(F.coalesce(f"_new_{c}", f"_old_{c}", f"_now_{c}"), F.lit(UNSET)).alias(c) for c in columns])
    hashed = step(states.withColumn("config_hash", row_hash(columns)))
    numbered = ordered_scan(hashed, [key], order, by_release, whole=whole, runs={"version_no": F.col("config_hash")})
    # one row of each version starts it
    versions = step(numbered.groupBy(key, "version_no").agg(
        F.max(F.when(F.col("version_no_starts"), F.struct(*columns, "config_hash"))).alias("_state"),
        F.min("release_version").alias("release_from"), F.max("release_version").alias("release_to"),
        F.count("*").alias("n_releases"), F.min("created_at_utc").alias("valid_from")).select("*", "_state.*").drop("_state"))
    windows = ordered_scan(versions, [key], ["version_no"], by_number("version_no", chunk), whole=whole, lead={"_next_from": F.col("valid_from")})
    is_last = F.col("_next_from").isNull()
    return (windows.join(deleted.select(key, "deleted_at"), key, "left").select(
        version_key(F.col(key), F.col("valid_from")).alias("version_key"), key, F.col("version_no").cast("bigint").alias("version_no"),
        "release_from", "release_to", "n_releases", "valid_from", F.coalesce("_next_from", "deleted_at").alias("valid_to"),
        (is_last & F.col("deleted_at").isNull()).alias("is_current"), (is_last & F.col("deleted_at").isNotNull()).alias("is_deleted"),
        *columns, "config_hash"))


def deleted_entities(history: DataFrame, key: str) -> DataFrame:
    return history.where("is_deleted").select(key, F.col("valid_to").alias("deleted_at"))


def state_events(sightings: DataFrame, parent_polls: DataFrame, *, unit: str = "day") -> DataFrame:
    """first_seen / appeared / disappeared / status_changed between consecutive polls of a parent.

    `sightings`: endpoint_id, worker_id, poll_id, polled_at_utc, status (+ anything). `parent_polls`: every
    (endpoint_id, poll_id, polled_at_utc) in which the parent was observed, with or without workers. Each
    sighting is moved to its parent's next poll and full-joined to the sightings there, so the work follows
    the number of sightings; a worker x poll grid is never built.
    """
    polls = materialize(ordered_scan(
        parent_polls.select("endpoint_id", *OBSERVED_ORDER).distinct(), ["endpoint_id"], OBSERVED_ORDER, by_time("polled_at_utc", unit),
        lag={"prev_polled_at_utc": F.col("polled_at_utc")},
        lead={"_next_poll": F.col("poll_id"), "_next_at": F.col("polled_at_utc")}))
    key = ["endpoint_id", "poll_id", "polled_at_utc"]
    now = sightings.where("status is not null").join(polls, key)
    moved = (now.where("_next_poll is not null")
             .select("endpoint_id", "worker_id", F.col("_next_poll").alias("poll_id"), F.col("_next_at").alias("polled_at_utc"),
                     F.col("status").alias("prev_status"), F.col("polled_at_utc").alias("_moved_from")))
    extra = [c for c in sightings.columns if c not in (*key, "worker_id", "status")]
    both = now.drop("_next_poll", "_next_at").join(moved, [*key, "worker_id"], "full")
    status, prev, first = F.col("status"), F.col("prev_status"), F.col("prev_polled_at_utc").isNull()
    event = (F.when(status.isNotNull() & prev.isNull() & first, "first_seen")
             .when(status.isNotNull() & prev.isNull(), "appeared")
             .when(status.isNull(), "disappeared")
             .when(status != prev, "status_changed"))
    return (both.select("endpoint_id", "worker_id", "poll_id", "polled_at_utc",
                        F.coalesce("prev_polled_at_utc", "_moved_from").alias("prev_polled_at_utc"),
                        event.alias("event"), "prev_status", "status", *extra).where("event is not null"))


def merge_snapshot(history: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], *, run_at: Column,
                   updated_at: str = "polled_at_utc") -> DataFrame:
    """One merge step of an incremental history: compare the open row of each key with the incoming row.

    Unchanged rows stay; a changed key closes at the incoming row's time and opens a new row there; a key
    missing from `incoming` closes at `run_at` (no listing time proves when it went); a new key opens.
    Returns the whole new table: closed rows pass through untouched.
    """
    cols = [key, *tracked, "valid_from", "valid_to"]
    closed = history.where("valid_to is not null").select(*cols)
    before = history.where("valid_to is null").select(F.col(key).alias("_key"), *[F.col(c).alias(f"_h_{c}") for c in (*tracked, "valid_from")])
    both = before.join(incoming.select(key, *tracked, updated_at), F.col("_key") == F.col(key), "full")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"_h_{c}").eqNullSafe(F.col(c))
    gone, fresh = F.col(key).isNull(), F.col("_key").isNull()
    changed = ~gone & ~fresh & ~same
    # a full join of two unique keys: at most two output rows per joined row
    old = F.struct(F.col("_key").alias(key), *[F.col(f"_h_{c}").alias(c) for c in tracked], F.col("_h_valid_from").alias("valid_from"),
                   F.when(gone, run_at).when(changed, F.col(updated_at)).alias("valid_to"))
    new = F.struct(F.col(key).alias(key), *[F.col(c).alias(c) for c in tracked], F.col(updated_at).alias("valid_from"),
                   F.lit(None).cast("timestamp").alias("valid_to"))
    rows = F.filter(F.array(F.when(~fresh, old), F.when(fresh | changed, new)), lambda r: r.isNotNull())
    return closed.unionByName(both.select(F.inline(rows)))
