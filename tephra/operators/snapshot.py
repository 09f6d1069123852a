"""Which raw rows are current, and one row per key out of many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

VERSION = ["source_file", "source_sha256"]


def pick_max(df: DataFrame, key: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    """The row of each key with the greatest rank (compared left to right, nulls lowest).

    One aggregation with map-side combine; a busy key shrinks to one row per task before the shuffle, where
    a row_number window would sort all of its rows in one task.
    """
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*key, "_best.*").select(*df.columns)


def pick_min(df: DataFrame, key: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_best"))
    return best.select(*key, "_best.*").select(*df.columns)


def keep_preferred(df: DataFrame, key: Sequence[str], priority: Column, tie: str) -> DataFrame:
    """One row per key: lowest priority number, then lowest `tie`."""
    return pick_min(df, key, [priority, F.col(tie)])


def one_ingest(rows: DataFrame) -> DataFrame:
    """All rows of the latest ingest of each file version; a forced second append does not double them.

    The versions are a table of their own, so that its true size is known: while it is small the rows are not dealt out by version, where a few
    files would fill a few tasks.
    """
    latest = (rows.groupBy(*VERSION).agg(F.max(F.struct("ingested_at", "run_label")).alias("_l"))
              .select(*VERSION, "_l.*"))
    return rows.join(materialize(latest), [*VERSION, "ingested_at", "run_label"], "left_semi")


def current_rows(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the file versions the manifest names now, one ingest each.

    The manifest decides, not ingest time: a reverted, renamed or emptied file selects the right version.
    """
    current = materialize(manifest.select(*VERSION).distinct())
    return one_ingest(rows.join(current, VERSION, "left_semi"))


def missing_versions(expected: DataFrame, data_keys: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected (table, file, sha) neither in the data nor in the ledger; any row must stop the build."""
    cols = ["table", *VERSION]
    present = data_keys.select(*cols).unionByName(ledger.select(*cols)).distinct()
    return expected.select(*cols).distinct().join(present, cols, "left_anti")


def latest_of(polls: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the newest poll whose listing was complete."""
    newest = polls.where("endpoints_complete").agg(
        F.max(F.struct("polled_at_utc", "poll_id")).alias("_p")).select(F.col("_p.poll_id").alias("poll_id"))
    return rows.join(newest, "poll_id", "left_semi")


def latest_wins(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Newest poll of each key (a bucket that keeps growing until it closes)."""
    return pick_max(rows, key, [F.col("polled_at_utc"), F.col("poll_id")])


# Job states that never change again.
TERMINAL = ("COMPLETED", "FAILED", "CANCELLED", "TIMED_OUT")


def terminal_wins(rows: DataFrame, key: Sequence[str], status: str = "status",
                  terminal: Sequence[str] = TERMINAL) -> DataFrame:
    """A terminal state beats any other, then the newest poll wins."""
    done = F.coalesce(F.col(status).isin(*terminal), F.lit(False))
    return pick_max(rows, key, [done.cast("int"), F.col("polled_at_utc"), F.col("poll_id")])
