"""Small column builders shared by several operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case spelling -> canonical model name.
MODEL_ALIASES = {
    "qwen/qwen3-8b": "Qwen3-8B",
    "qwen/qwen3-32b-awq": "Qwen3-32B-AWQ",
    "qwen/qwen2.5-7b": "Qwen2.5-7B",
    "qwen2.5-7b": "Qwen2.5-7B",
    "qwen/qwen2.5-0.5b": "Qwen2.5-0.5B",
    "qwen2.5-0.5b": "Qwen2.5-0.5B",
}

# The two URL shapes that carry an endpoint id, in order of preference.
ENDPOINT_URLS = (
    r"/v2/([a-z0-9]+)(?:/|$)",
    r"https://([a-z0-9]+)\.api\.runpod\.ai",
)
QUEUE_MARK = "/v2/"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def extract(value: Column, pattern: str, group: int = 1) -> Column:
    """Capture group, null (not "") where the pattern does not match or captures nothing."""
    return blank_to_null(F.regexp_extract(value, pattern, group))


def canonical_name(value: Column, aliases: Mapping[str, str] = MODEL_ALIASES) -> Column:
    """Case-insensitive alias lookup; names without an alias stay as they are."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(value)), value)


def endpoint_of_url(url: Column, patterns: Sequence[str] = ENDPOINT_URLS) -> Column:
    return F.coalesce(*[extract(url, p) for p in patterns])


def endpoint_mode(url: Column) -> Column:
    return F.when(url.contains(QUEUE_MARK), "queue").otherwise("load_balancer")


def split_status(status: Column) -> dict[str, Column]:
    """One text column that mixes HTTP codes and job states -> two typed columns."""
    numeric = status.rlike(r"^\d+$")
    return {"http_status": F.when(numeric, status.try_cast("int")), "job_status": F.when(~numeric, status)}


def unbounded_if_null(rate: Column) -> Column:
    return F.coalesce(rate, F.lit(float("inf")))


def row_hash(columns: Sequence[str | Column]) -> Column:
    """md5 over the columns as text, with nulls spelled out so they neither vanish nor equal ''."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("<null>")) for c in cols]))


def version_key(entity: Column, valid_from: Column) -> Column:
    """Surrogate key of one version: entity and start at microsecond precision."""
    return F.md5(F.concat_ws("|", entity.cast("string"), F.date_format(valid_from, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


def sorted_csv(value: Column) -> Column:
    return F.array_join(F.array_sort(F.split(value, ",")), ",")


def list_or_all(items: Column) -> Column:
    """Sorted comma list of an array; an empty or missing array means no restriction: ALL."""
    return F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, "ALL").otherwise(F.array_join(F.array_sort(items), ","))


def selection_of_lists(included: Column, excluded: Column) -> Column:
    """Included names, then excluded names prefixed with '-', each sorted; null when both are empty."""
    none = F.array().cast("array<string>")
    minus = F.transform(F.coalesce(excluded, none), lambda x: F.concat(F.lit("-"), x))
    return blank_to_null(F.array_join(F.concat(F.array_sort(F.coalesce(included, none)), F.array_sort(minus)), ","))


def selection_of_csv(value: Column) -> Column:
    """The same canonical order for a comma list that already carries the '-' prefixes."""
    parts = F.split(value, ",")
    keep = F.array_sort(F.filter(parts, lambda x: ~x.startswith("-")))
    drop = F.array_sort(F.filter(parts, lambda x: x.startswith("-")))
    return blank_to_null(F.array_join(F.concat(keep, drop), ","))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def ticks_between(start: Column, end: Column, seconds: int) -> Column:
    """Whole-unit boundaries crossed between two instants (not elapsed time rounded down)."""
    return F.floor(F.unix_seconds(end) / F.lit(seconds)) - F.floor(F.unix_seconds(start) / F.lit(seconds))
