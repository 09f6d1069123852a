"""Every registered query against its SQL on the smallest data."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_oracle
from tephra.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    state, note, _ = check_oracle.compare(spark, con, SF, name)
    assert state in ("ok", "rows-only"), note


def test_parity_where_extra_keys_are_keys_of_the_table_too(spark, tmp_path):
    import duckdb
    name = "q_table_parity"
    key = F.explode(F.array(*[F.lit(k).cast("bigint") for k in (83, 89, 97, 101, 202, 1_000_101, 1_000_202, 1_000_205)]))
    rows = spark.range(3).select("id", key.alias("l_partkey")).select("l_partkey", F.lit("A").alias("l_returnflag"), (F.col("id") + F.col("l_partkey") % 7 + 1).cast("double").alias("l_quantity"), F.lit("1996-01-02").cast("date").alias("l_shipdate"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    mine = duckdb.connect()
    mine.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    state, note, _ = check_oracle.compare(spark, mine, str(tmp_path), name)
    assert state == "ok", note


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
