"""The landing manifest: which files exist, what they are, and whether their bytes are still the same."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.redaction import PATTERNS, find_secrets, redaction_counts
from .readers import below

# Names that are never landed.
FORBIDDEN = [r"\.env", r".*\.env", r"\.env\..*", r".*\.pem", r".*\.key", r"\.DS_Store"]


@dataclass(frozen=True)
class Rule:
    """Files of `root` whose relative path matches `path` (a whole-path regex) belong to `dataset`."""

    root: str
    path: str
    dataset: str
    exclude: str | None = None


def forbidden(name: Column) -> Column:
    return name.rlike("^(" + "|".join(FORBIDDEN) + ")$")


def listed(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Every file below `folder` without its bytes: relpath, name, bytes, mtime. No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    f = reader.load(folder)
    rows = f.select(below(folder).alias("relpath"), F.col("_metadata.file_name").alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime_utc"))
    # a scan skips zero-byte files; the file index it keeps on the driver still names them
    named = spark.createDataFrame([(p,) for p in f.inputFiles()], "path string").select(below(folder, "path").alias("relpath"))
    empty = named.join(f.select(below(folder).alias("relpath")), "relpath", "left_anti").select(
        "relpath", F.element_at(F.split("relpath", "/"), -1).alias("name"), F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("mtime_utc"))
    return rows.unionByName(empty)


def opened(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """`files` (rows of listed()) with sha256 and text: these files are read whole, and no others."""
    paths = [f"{folder}/{r.relpath}" for r in files.where("bytes > 0").select("relpath").toLocalIterator()]       # names, as the file index of any scan holds them
    none = files.where("bytes = 0").select("*", F.sha2(F.lit("").cast("binary"), 256).alias("sha256"), F.lit("").alias("text"))
    if not paths:
        return none
    f = spark.read.format("binaryFile").load(paths)
    content = f.select(below(folder).alias("relpath"), F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("text"))
    return files.where("bytes > 0").join(content, "relpath").select(*none.columns).unionByName(none)


def scan(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Every file below `folder` with its bytes: relpath, name, bytes, mtime, sha256, text."""
    return opened(spark, folder, listed(spark, folder, glob))


def at_time(column: str) -> Column:
    """A file's time for comparisons; empty files have none."""
    return F.coalesce(F.unix_micros(column), F.lit(-1))


def discover(files: DataFrame, root: str, rules: Sequence[Rule]) -> DataFrame:
    """Adds root and dataset (first matching rule); unmatched, excluded and forbidden files drop out."""
    dataset = F.lit(None).cast("string")
    for r in reversed([r for r in rules if r.root == root]):
        hit = F.col("relpath").rlike(f"^(?:{r.path})$")
        if r.exclude:
            hit = hit & ~F.col("name").rlike(f"^(?:{r.exclude})$")
        dataset = F.when(hit, r.dataset).otherwise(dataset)
    return (files.where(~forbidden(F.col("name"))).withColumn("dataset", dataset).where("dataset is not null")
            .withColumn("source_root", F.lit(root)))


def manifest_entries(found: DataFrame, patterns=PATTERNS) -> DataFrame:
    """One manifest row per discovered file plus its redacted text in `landed`: sizes and checksums before and after redaction."""
    out = redaction_counts(found.withColumn("_src", F.col("text")), "text", patterns).withColumnRenamed("redacted", "landed")
    src = F.col("_src")
    n = F.regexp_count(src, F.lit("\n"))
    return out.select(
        "dataset", "source_root", F.col("relpath").alias("source_relpath"), F.concat_ws("/", "source_root", "relpath").alias("landed_relpath"),
        F.col("bytes").alias("bytes_source"), F.octet_length("landed").cast("bigint").alias("bytes_landed"), F.col("sha256").alias("sha256_source"),
        F.sha2(F.encode("landed", "UTF-8"), 256).alias("sha256_landed"),
        (n + F.when((F.length(src) == 0) | src.endswith("\n"), 0).otherwise(1)).cast("bigint").alias("lines"), "mtime_utc", F.col("hits").alias("redactions"), "landed")


def totals(manifest: DataFrame) -> DataFrame:
    hits = F.aggregate(F.map_values("redactions"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return manifest.agg(F.count("*").alias("n_files"), F.sum("bytes_landed").alias("bytes_landed"), F.sum(hits).alias("redactions_total"))


def merge_manifest(old: DataFrame, fresh: DataFrame, root: str) -> DataFrame:
    """Re-landing one root replaces that root's entries and keeps the others as they were."""
    return old.where(F.col("source_root") != root).unionByName(fresh, allowMissingColumns=True)


def replace_entries(old: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """Entries of `fresh` replace those of `old` with the same key."""
    return old.join(fresh.select(*key).distinct(), list(key), "left_anti").unionByName(fresh, allowMissingColumns=True)


def stale(entries: DataFrame, listed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Entries no longer listed: what a mirror removes."""
    return entries.join(listed.select(*key).distinct(), list(key), "left_anti")


def current(entries: DataFrame, listed: DataFrame, key: Sequence[str]) -> DataFrame:
    return entries.join(listed.select(*key).distinct(), list(key), "left_semi")


def snapshot(manifest: DataFrame) -> DataFrame:
    """The (source_file, source_sha256, dataset) pairs the manifest names as current."""
    return manifest.select(F.col("landed_relpath").alias("source_file"), F.col("sha256_landed").alias("source_sha256"), "dataset")


def checksum_problems(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Listed files that are missing or whose bytes changed since landing; any row must stop the ingest."""
    actual = files.select(F.col("relpath").alias("source_file"), F.col("sha256").alias("_found"))
    both = snapshot(manifest).join(actual, "source_file", "left")
    problem = F.when(F.col("_found").isNull(), "missing").when(F.col("_found") != F.col("source_sha256"), "changed")
    return both.select("source_file", problem.alias("problem")).where("problem is not null")


def touched(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of listed() for manifest entries whose size or time is not the recorded one: what must be read to tell whether it changed."""
    m = manifest.select(F.col("landed_relpath").alias("relpath"), F.col("bytes_landed").alias("_bytes"), at_time("mtime_utc").alias("_at"))
    both = files.join(m, "relpath")
    return both.where((F.col("bytes") != F.col("_bytes")) | (at_time("mtime_utc") != F.col("_at"))).select(*files.columns)


def manifest_problems(manifest: DataFrame, files: DataFrame, readable: Sequence[str], patterns=PATTERNS) -> DataFrame:
    """Manifest and landed files must agree both ways: (source_file, problem) rows."""
    m = manifest.select(F.col("landed_relpath").alias("relpath"), "dataset", "bytes_landed", "sha256_landed")
    both = m.join(files.drop("text"), "relpath", "full")
    here, listed = F.col("sha256").isNotNull(), F.col("sha256_landed").isNotNull()
    rules = {"listed but missing": listed & ~here, "not listed": here & ~listed, "size differs": F.col("bytes") != F.col("bytes_landed"),
             "checksum differs": F.col("sha256") != F.col("sha256_landed"), "no reader for dataset": listed & ~F.col("dataset").isin(*readable),
             "forbidden name": forbidden(F.element_at(F.split("relpath", "/"), -1))}
    found = F.filter(F.array(*[F.when(bad, F.lit(r)) for r, bad in rules.items()]), lambda x: x.isNotNull())
    secrets = find_secrets(files.select("relpath", "text"), "text", patterns).select("relpath", F.concat(F.lit("secret: "), "pattern").alias("problem"))
    return both.select("relpath", F.explode(found).alias("problem")).unionByName(secrets.distinct()).withColumnRenamed("relpath", "source_file")
