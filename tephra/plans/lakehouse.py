"""The layered build in one session: manifest -> raw tables -> typed tables -> aggregates.

Each step is a function over a `Lake`; tables are Parquet below its root, one writer at a time. Nothing is
collected but verdicts: keys, checksums and counts stay in DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.redaction import PATTERNS
from ..operators import conform, logs, marts, snapshot
from ..session import materialize
from ..sources import bronze, landing, readers
from . import checks

# Dataset tag -> raw tables it feeds.
FEEDS = {
    "coldstart_series": ["series_docs", "series_runs"],
    "sweep": ["sweep_runs", "sweep_records"],
    "worker_log": ["log_lines"],
    "request_csv": ["request_rows"],
    "throughput_csv": ["throughput_rows"],
    "scored_items_csv": ["scored_item_rows"],
    "scored_batches_csv": ["scored_batch_rows"],
}
RAW_TABLES = [t for tables in FEEDS.values() for t in tables]
_H = "source_file string, kind string, mode string, endpoint string, label string, image string, note string, max_tokens bigint, idle_s double"
RAW_SCHEMAS = {
    "series_docs": f"{_H}, n_runs int, summary_json string",
    "series_runs": f"{_H}, run_index int, health_before_json string, cold_json string, warm_json string",
    "sweep_runs": "source_file string, kind string, system string, server string, base_url string, model string, args_json string, run_index int, "
                  "request_rate double, wall_s double, summary_json string, trace_json string, server_counters_json string, server_latency_json string, n_records int",
    "sweep_records": "source_file string, system string, run_index int, request_rate double, request_id string, arrival_s double, first_token_s double, "
                     "finish_s double, prompt_tokens bigint, output_tokens bigint, success boolean, error string",
    "log_lines": "source_file string, line_no int, raw_line string",
    **{t: ", ".join(f"{c} string" for c in cols) + ", source_file string" for t, cols in readers.CSV_COLUMNS.items()},
}
TYPED_TABLES = ["requests", "startup_phases", "sweep_summaries", "sweep_requests", "log_events", "scored_items", "scored_batches"]
GOLD_TABLES = ["latency_distribution", "hit_rate", "cohort_comparison", "boot_phases", "cost_per_job", "scoring_cost_per_batch", "sweep_latency", "cold_events"]


class BuildError(RuntimeError):
    """A gate found rows that make the next layer untrustworthy."""


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    landing: str
    root: str
    seeds: str | None = None
    preferred_file: str | None = None                              # among overlapping request files the one whose rows win

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def raw(self, table: str) -> DataFrame:
        """The raw table, or an empty one with its columns when nothing has fed it yet."""
        schema = RAW_SCHEMAS[table] + ", source_sha256 string, ingested_at timestamp, run_label string"
        df = bronze.load(self.spark, self.path("raw", table), schema)
        return bronze.evolve([df, self.spark.createDataFrame([], schema)]) if table in readers.CSV_COLUMNS else df

    def ledger(self) -> DataFrame:
        return bronze.load(self.spark, self.path("raw", "ledger"), bronze.LEDGER)

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(self.path("landing", "manifest"))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))


def _stop_on(rows: DataFrame, what: str) -> None:
    some = rows.limit(5).collect()
    if some:
        raise BuildError(f"{what}: " + "; ".join(str(r.asDict()) for r in some))


def build_manifest(lake: Lake, rules: Sequence[landing.Rule], roots: Sequence[str], *, reread: bool = False) -> int:
    """List the landed files below each root and record what they are; files must hold no credential.

    Only files that are new, or whose size, time or dataset is not the recorded one, are opened (`reread`: all); other entries stay, as do
    those of other roots. Returns the number of entries of `roots`.
    """
    path = lake.path("landing", "manifest")
    old = bronze.load(lake.spark, path)
    if old is not None and "expected" not in old.columns:
        old = old.limit(0).withColumn("expected", F.lit(None).cast(EXPECTED))       # recorded before row counts were: all is read again
    key = lambda size: [F.col("source_relpath").alias("relpath"), F.col("dataset"), F.col(size).alias("bytes"), landing.at_time("mtime_utc").alias("_at")]
    parts, total = [], 0
    for root in roots:
        folder = f"{lake.landing}/{root}"
        files = materialize(landing.discover(landing.listed(lake.spark, folder), root, rules))
        total += files.count()
        fresh = files.withColumn("_at", landing.at_time("mtime_utc"))
        if old is not None and not reread:
            mine = old.where(F.col("source_root") == root)
            same = mine.select(*key("bytes_source"), "source_relpath").join(fresh.select("relpath", "dataset", "bytes", "_at"), ["relpath", "dataset", "bytes", "_at"], "left_semi")
            parts.append(mine.join(same.select("source_relpath"), "source_relpath", "left_semi"))
            fresh = fresh.join(mine.select(*key("bytes_source")), ["relpath", "dataset", "bytes", "_at"], "left_anti")
        fresh = materialize(fresh.drop("_at"))
        found = landing.discover(landing.opened(lake.spark, folder, fresh.drop("dataset", "source_root")), root, rules)
        entries = landing.manifest_entries(found, PATTERNS)
        parts.append(entries.withColumns({"expected": expected_of(F.col("dataset"), F.col("landed")), "listed_at": F.current_timestamp()}).drop("landed"))
    others = [old.where(~F.col("source_root").isin(list(roots)))] if old is not None else []
    bronze.overwrite(materialize(bronze.evolve([*parts, *others])), path, F.col("listed_at"), stamp="listed_at")    # written aside first: the old manifest is one of its sources
    _stop_on(lake.manifest().where("cardinality(redactions) > 0").select("landed_relpath", "redactions"), "unredacted credentials in the landing folder")
    return total


def _paths(lake: Lake, files: DataFrame) -> list[str]:
    """The new files by name. The driver holds the names of what it reads, as the file index of any scan does, and nothing of their content."""
    return [f"{lake.landing}/{r.source_file}" for r in files.select("source_file").distinct().toLocalIterator()]


EXPECTED = "array<struct<table:string,expected_rows:bigint>>"


def expected_of(dataset: Column, text: Column) -> Column:
    """How many rows of which tables a file's text must give, counted apart from the readers."""
    lines = F.regexp_count(text, F.lit("\r\n|\r|\n")) + F.when((F.length(text) == 0) | text.endswith("\n") | text.endswith("\r"), 0).otherwise(1)
    csv_text = F.regexp_replace(text, r'"[^"]*"', "q")
    csv_lines = F.greatest(F.regexp_count(csv_text, F.lit(r"(?m)^.+$")) - 1, F.lit(0))     # an empty file has no header either
    runs = F.from_json(text, "runs array<struct<records:array<string>>>")["runs"]
    n_runs = F.greatest(F.coalesce(F.size(runs), F.lit(0)), F.lit(0))
    n_records = F.aggregate(F.coalesce(runs, F.array().cast("array<struct<records:array<string>>>")), F.lit(0),
                            lambda a, r: a + F.greatest(F.coalesce(F.size(r["records"]), F.lit(0)), F.lit(0)))
    one = lambda table, n: F.struct(F.lit(table).alias("table"), n.cast("bigint").alias("expected_rows"))
    per = (F.when(dataset == "coldstart_series", F.array(one("series_docs", F.lit(1)), one("series_runs", n_runs)))
           .when(dataset == "sweep", F.filter(F.array(one("sweep_runs", n_runs), one("sweep_records", n_records)),
                                              lambda x: (x["table"] == "sweep_runs") | (x["expected_rows"] > 0)))
           .when(dataset == "worker_log", F.array(one("log_lines", lines))))
    for name, tables in FEEDS.items():
        if tables[0] in readers.CSV_COLUMNS:
            per = per.when(dataset == name, F.array(one(tables[0], csv_lines)))
    return per.cast(EXPECTED)


def expected_rows(lake: Lake) -> DataFrame:
    """(table, file, sha, expected_rows), as the manifest recorded them when it read the files."""
    return lake.manifest().select(F.col("landed_relpath").alias("source_file"), F.col("sha256_landed").alias("source_sha256"), F.inline("expected"))


def landed_problems(lake: Lake, fresh: DataFrame | None = None) -> DataFrame:
    """Files that the manifest lists and that are gone or changed. Opened are those whose size or time differs from the record, and those
    of `fresh` (source_file), which are about to be read anyway."""
    files = materialize(landing.listed(lake.spark, lake.landing))
    gone = landing.snapshot(lake.manifest()).join(files.select(F.col("relpath").alias("source_file")), "source_file", "left_anti")
    doubtful = landing.touched(lake.manifest(), files)
    if fresh is not None:
        doubtful = doubtful.unionByName(files.join(fresh.select(F.col("source_file").alias("relpath")).distinct(), "relpath", "left_semi")).distinct()
    doubtful = materialize(doubtful)
    read = landing.opened(lake.spark, lake.landing, doubtful)
    listed = lake.manifest().join(doubtful.select(F.col("relpath").alias("landed_relpath")), "landed_relpath", "left_semi")
    return gone.select("source_file", F.lit("missing").alias("problem")).unionByName(landing.checksum_problems(listed, read))


def _read(lake: Lake, table: str, files: DataFrame) -> DataFrame | None:
    paths = _paths(lake, files)
    if table in readers.CSV_COLUMNS:
        rows = readers.csv_table(lake.spark, paths, lake.landing, table, files)
    elif table == "log_lines":
        rows = readers.log_lines(lake.spark, paths, lake.landing)
    else:
        rows = getattr(readers, table)(readers.documents(lake.spark, paths, lake.landing))
    return rows


def ingest(lake: Lake, run_label: str, *, force: bool = False) -> dict[str, int]:
    """Append what the manifest lists and the raw tables lack; returns rows appended per table ("ledger", "reconciled" too).

    Raw rows are keyed by (file, checksum): running it again appends nothing and opens no file. A file is opened where it is new to the raw
    layer, or where its size or time is not the one in the manifest. A run that died between a data
    append and the ledger append is repaired at the end of the next one.
    """
    spark = lake.spark
    now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp")
    expected = materialize(expected_rows(lake))
    ledger_now = bronze.load(spark, lake.path("raw", "ledger"))
    done: dict[str, int] = {}
    entries = []
    # written out before the appends: what counts as new must not change while the tables grow
    parts = []
    for table in RAW_TABLES:
        want = expected.where(F.col("table") == table).select(*bronze.VERSION)
        known = bronze.known_versions(bronze.load(spark, lake.path("raw", table)), ledger_now, table)
        parts.append(bronze.new_versions(want, known, force).withColumn("table", F.lit(table)))
    new = materialize(bronze.evolve(parts))
    _stop_on(landed_problems(lake, new), "landed files differ from the manifest")
    waiting = {r.table for r in new.select("table").distinct().collect()}
    for table in RAW_TABLES:
        if table not in waiting:
            continue
        fresh = new.where(F.col("table") == table).drop("table")
        rows = _read(lake, table, fresh)                           # None: only files without a line, which get their ledger rows all the same
        done[table] = 0 if rows is None else bronze.append(bronze.add_lineage(rows, fresh, run_label, now), lake.path("raw", table))
        mine = lake.raw(table).where((F.col("run_label") == run_label) & (F.col("ingested_at") == now)).select(F.lit(table).alias("table"), *bronze.VERSION)
        entries.append(bronze.ledger_rows(fresh.withColumn("table", F.lit(table)), mine, run_label, now))
    if entries:
        done["ledger"] = bronze.append(bronze.evolve(entries), lake.path("raw", "ledger"))
    held = bronze.evolve([lake.raw(t).select(F.lit(t).alias("table"), *bronze.VERSION, "ingested_at") for t in RAW_TABLES])
    lost = materialize(bronze.reconcile(held, lake.ledger(), run_label))
    if not lost.isEmpty():
        done["reconciled"] = bronze.append(lost, lake.path("raw", "ledger"))
    return done


def typed_builders(lake: Lake) -> dict[str, DataFrame]:
    """The typed tables over the rows the manifest names as current."""
    current = landing.snapshot(lake.manifest())
    rows = lambda t: snapshot.current_rows(lake.raw(t), current)
    dim = {n: readers.seed(lake.spark, lake.seeds, n) for n in ("coldstart_series", "gpu_labels", "coldstart_run_notes", "coldstart_request_overrides")}
    runs = rows("series_runs")
    a = conform.series_requests(runs, dim["coldstart_series"], dim["gpu_labels"], dim["coldstart_run_notes"])
    b = conform.csv_requests(rows("request_rows"), dim["gpu_labels"], dim["coldstart_request_overrides"], preferred_file=lake.preferred_file)
    return {**{f"dim_{n}": df for n, df in dim.items()},
            "requests": conform.requests([a, b]), "startup_phases": conform.startup_phases(runs),
            "sweep_summaries": conform.sweep_summaries(rows("sweep_runs")), "sweep_requests": conform.sweep_requests(rows("sweep_records")),
            "log_events": logs.log_events(rows("log_lines")), "scored_items": conform.scored_items(rows("scored_item_rows")),
            "scored_batches": conform.scored_batches(rows("scored_batch_rows"))}


def completeness(lake: Lake) -> DataFrame:
    """Expected (table, file, sha) that the raw layer lacks."""
    keys = [lake.raw(t).select(F.lit(t).alias("table"), *bronze.VERSION) for t in RAW_TABLES]
    return snapshot.missing_versions(expected_rows(lake), bronze.evolve(keys), lake.ledger())


def _write(lake: Lake, layer: str, below: str, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Write the tables of a layer with their checks; a broken rule of severity error is raised once all is written and recorded."""
    done, counted = {}, {}
    for t, df in tables.items():
        done[t], counted[t] = bronze.overwrite_watched(df, lake.path(layer, t), checks.watched(layer, t))
    under = lake.raw if below == "raw" else lambda t: lake.table(below, t)
    broken = checks.run(lake.spark, layer, counted, lambda t: lake.table(layer, t), under, lake.path("checks", "results"), lake.path("checks", "violations"), datetime.now(timezone.utc).replace(tzinfo=None))
    _stop_on(broken.select("table", "rule", "violations"), f"checks of the {layer} layer failed")
    return done


def build_typed(lake: Lake) -> dict[str, int]:
    """Rebuild the typed tables from the current raw rows; their checks run with it and may end it."""
    _stop_on(completeness(lake), "not in the raw layer at the current checksum, ingest first")
    done = _write(lake, "typed", "raw", typed_builders(lake))
    req = lake.table("typed", "requests")
    over = lake.table("typed", "dim_coldstart_request_overrides").withColumn("request_ts_utc", F.try_to_timestamp(F.col("ts_utc")))
    notes = lake.table("typed", "dim_coldstart_run_notes")
    for seed, facts, key, name in ((over, req.where("gpu_label_override_note is not null"), ["endpoint_id", "request_ts_utc"], "overrides"),
                                   (notes, req, ["series_label", "run_index"], "run_notes")):
        unmatched = conform.unmatched_seeds(seed, facts.select(*key).unionByName(req.select(key[0]).distinct(), allowMissingColumns=True), key, key[0], name)
        _stop_on(unmatched.where("severity = 'error'"), "curated rows matched nothing")
    return done


def gold_builders(lake: Lake) -> dict[str, DataFrame]:
    t = lambda name: lake.table("typed", name)
    req = t("requests")
    return {"latency_distribution": marts.latency_distribution(req), "hit_rate": marts.hit_rate(req), "cohort_comparison": marts.cohort_comparison(req),
            "boot_phases": logs.boot_phases(t("log_events")), "cost_per_job": marts.cost_per_job(req),
            "scoring_cost_per_batch": marts.scoring_cost_per_batch(t("scored_batches"), t("scored_items")),
            "sweep_latency": marts.sweep_latency(t("sweep_summaries"), t("sweep_requests")), "cold_events": marts.cold_events(req)}


def build_gold(lake: Lake) -> dict[str, int]:
    """Rebuild the aggregates, unless a check of the typed layer stands broken."""
    results = bronze.load(lake.spark, lake.path("checks", "results"), checks.RESULTS)
    _stop_on(checks.standing(results, "typed").select("table", "rule", "violations"), "checks of the typed layer failed")
    return _write(lake, "gold", "typed", gold_builders(lake))


def verify(lake: Lake) -> DataFrame:
    """Files whose raw rows are not exactly the rows the landed file holds (expected versions only)."""
    want = materialize(expected_rows(lake))
    keys = bronze.evolve([lake.raw(t).select(F.lit(t).alias("table"), *bronze.VERSION) for t in RAW_TABLES])
    return bronze.verify_counts(want, keys.join(want.select("table", *bronze.VERSION), ["table", *bronze.VERSION], "left_semi"))
