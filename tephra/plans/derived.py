"""Tables derived from polls and from the typed layer: poll tables, histories, campaign tables and their scores.

Each table is a recipe that names its inputs, so the order of a build follows from the recipes, and so does what a build
may leave alone. A source's version says which files it consists of; a table's version is a digest of its recipe and of its
inputs' versions. A table is written only where its recorded version is another one. Versions are recorded after a table is
written and its checks have passed: a build that dies, or is ended by a check, takes up again at that table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import campaign, history, polls, scoring, snapshot
from ..sources import bronze, landing, readers
from ..streaming import poll_load
from . import checks
from .lakehouse import BuildError, Lake

LAYER = "derived"
RAW_POLLS = "doc string, source_file string, source_sha256 string, ingested_at timestamp, run_label string"
VERSIONS = "table string, version string, n_rows bigint, recorded_at timestamp"


@dataclass(frozen=True)
class Recipe:
    """`build` gets the inputs in the order named; a name with a dot is a source (layer.table). Raise `revision` when `build` changes."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    revision: int = 1


def _history(config: DataFrame, heads: DataFrame) -> DataFrame:
    return history.versions_from_observations(config, heads.where("endpoints_complete"), "endpoint_id", history.TRACKED, current={"current_name": "name"})


def _release_history(changes: DataFrame, config: DataFrame, observed: DataFrame) -> DataFrame:
    newest = snapshot.latest_wins(config, ["endpoint_id"])
    return history.versions_from_changes(changes, newest, history.deleted_entities(observed, "endpoint_id"), "endpoint_id", history.LOGGED)


def _worker_events(seen: DataFrame, endpoints: DataFrame) -> DataFrame:
    return history.state_events(seen.select("endpoint_id", "worker_id", "poll_id", "polled_at_utc", "status", "gpu_type_id", "data_center_id"),
                                endpoints.select("endpoint_id", "poll_id", "polled_at_utc"))


RECIPES: dict[str, Recipe] = {
    "poll_documents": Recipe(("raw.polls",), polls.documents),
    "polls": Recipe(("poll_documents",), polls.polls),
    "endpoints": Recipe(("poll_documents",), polls.endpoints),
    "workers": Recipe(("poll_documents",), polls.workers),
    "endpoint_health": Recipe(("poll_documents",), polls.health),
    "billing_hourly": Recipe(("poll_documents",), polls.billing_hourly),
    "jobs": Recipe(("poll_documents",), polls.jobs),
    "releases": Recipe(("poll_documents",), polls.releases),
    "endpoint_config": Recipe(("endpoints",), history.endpoint_config),
    "latest_endpoints": Recipe(("polls", "endpoints"), snapshot.latest_of),
    "endpoint_history": Recipe(("endpoint_config", "polls"), _history),
    "release_history": Recipe(("releases", "endpoint_config", "endpoint_history"), _release_history),
    "worker_events": Recipe(("workers", "endpoints"), _worker_events),
    "endpoint_daily": Recipe(("endpoints", "workers", "worker_events", "endpoint_health", "billing_hourly"), polls.daily_rollup),
    "campaign_requests": Recipe(("typed.requests", "seeds.coldstart_series", "raw.series_runs", "typed.startup_phases"), campaign.campaign_requests),
    "campaign_hit_rate_by_gap": Recipe(("campaign_requests",), campaign.hit_rate_by_gap),
    "campaign_placement_wait": Recipe(("campaign_requests",), campaign.placement_wait),
    "campaign_cost_vs_billed": Recipe(("campaign_requests", "billing_hourly"), campaign.cost_vs_billed),
    "campaign_config": Recipe(("campaign_requests", "release_history", "endpoint_history", "seeds.campaign_gpu_pins"), scoring.config_asof),
    "campaign_config_agreement": Recipe(("campaign_config",), lambda scored: scoring.agreement(scored, scoring.AGREEMENT)),
    "setting_verdict": Recipe(("gold.hit_rate", "latest_endpoints"), scoring.setting_verdict),
}


def load_polls(lake: Lake, folder: str, run_label: str) -> int:
    """Append the poll documents below `folder` that the lake does not hold yet; returns how many."""
    return poll_load.load_polls(lake.spark, folder, lake.path("raw", "polls"), lake.path("raw", "polls_checkpoint"), run_label)


def in_order(recipes: Mapping[str, Recipe], wanted: Iterable[str] | None = None) -> list[str]:
    """The wanted tables (all by default) and what they need, inputs first."""
    done: list[str] = []

    def visit(name: str, above: tuple[str, ...]) -> None:
        if name in above:
            raise BuildError(f"recipes in a circle: {' -> '.join([*above, name])}")
        if name in done or "." in name:
            return
        if name not in recipes:
            raise BuildError(f"no recipe for {name}, an input of {above[-1] if above else 'the build'}")
        for i in recipes[name].inputs:
            visit(i, (*above, name))
        done.append(name)

    for name in recipes if wanted is None else wanted:
        visit(name, ())
    return done


def _source(lake: Lake, name: str) -> DataFrame:
    layer, _, table = name.partition(".")
    if layer == "seeds":
        return readers.seed(lake.spark, lake.seeds, table)
    if name == "raw.polls":
        return bronze.load(lake.spark, lake.path(layer, table), RAW_POLLS)
    if layer == "raw":
        return snapshot.current_rows(lake.raw(table), landing.snapshot(lake.manifest()))
    return lake.table(layer, table).drop("built_at")


def _digest(rows: DataFrame, *columns: str) -> str:
    """An order-free fingerprint of a table of names."""
    n, total = rows.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def source_version(lake: Lake, name: str) -> str:
    """Which files a source consists of, by name, size and time; for raw tables also which file versions the manifest calls current. No file is opened."""
    layer, _, table = name.partition(".")
    path = f"{lake.seeds}/{table}.csv" if layer == "seeds" else lake.path(layer, table)
    if not bronze.exists(lake.spark, path):
        if layer == "raw":
            return "none"
        raise BuildError(f"{path} is not there, build it first")
    files = (lake.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", F.unix_micros("modificationTime").alias("at")))
    said = _digest(files, "path", "length", "at")
    if layer == "raw" and table != "polls":
        said += "/" + _digest(landing.snapshot(lake.manifest()), "source_file", "source_sha256")
    return said


def versions(lake: Lake, recipes: Mapping[str, Recipe], names: list[str]) -> dict[str, str]:
    """The version each of the tables `names` (inputs first) should have, given what its sources are now."""
    found: dict[str, str] = {}
    for name in names:
        r = recipes[name]
        for i in r.inputs:
            if i not in found:
                found[i] = source_version(lake, i)
        found[name] = hashlib.sha256("|".join([name, str(r.revision), *(f"{i}={found[i]}" for i in r.inputs)]).encode()).hexdigest()
    return found


def build_derived(lake: Lake, wanted: Iterable[str] | None = None, recipes: Mapping[str, Recipe] = RECIPES) -> dict[str, int]:
    """Rebuild what is not at its version, inputs first, with its checks; returns the rows written for each table that was.

    A broken rule of severity `error` ends the build at its table, so that nothing is built on it.
    """
    names = in_order(recipes, wanted)
    want = versions(lake, recipes, names)
    log = lake.path(LAYER, "versions")
    recorded = bronze.load(lake.spark, log, VERSIONS).groupBy("table").agg(F.max_by("version", "recorded_at").alias("version"))
    have = {r.table: r.version for r in recorded.collect()}                                  # as many rows as there are recipes
    get = lambda name: _source(lake, name) if "." in name else lake.table(LAYER, name).drop("built_at")
    done: dict[str, int] = {}
    for name in names:
        if have.get(name) == want[name] and bronze.exists(lake.spark, lake.path(LAYER, name)):
            continue
        df = recipes[name].build(*map(get, recipes[name].inputs))
        done[name], counted = bronze.overwrite_watched(df, lake.path(LAYER, name), checks.watched(LAYER, name))
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        broken = checks.run(lake.spark, LAYER, {name: counted}, get, get, lake.path("checks", "results"), lake.path("checks", "violations"), now).collect()
        if broken:
            raise BuildError("checks of the derived tables failed: " + "; ".join(f"{r.table}: {r.rule}, {r.violations} rows" for r in broken))
        bronze.append(lake.spark.createDataFrame([(name, want[name], done[name], now)], VERSIONS), log)
    return done
