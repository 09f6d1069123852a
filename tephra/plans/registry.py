"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FAMILIES = ("mart_queries", "history_queries", "log_queries", "ingest_queries", "text_queries", "campaign_queries")


def _collect(attribute: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        out |= getattr(import_module(f"tephra.plans.{family}"), attribute)
    return out


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(q) for name, q in _collect("QUERIES").items()}


def oracles() -> dict[str, str]:
    return _collect("ORACLES")
