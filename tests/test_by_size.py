"""Keys of few rows are sorted whole, busy ones in chunks: the same rows either way, and whole keys are dealt out once."""

import random

import pytest

from pyspark.sql import functions as F
from tephra.functions import ordered
from tephra.functions.text import row_hash
from tephra.operators import history
from tephra.session import materialize

DAY = 86_400


def seen(spark, seed=3, n=300):
    """A third of all observations are of one entity; some share their time."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(25)}", rng.randrange(40) * DAY // 4, i, rng.choice("ab"), f"n{i}", rng.random() < 0.5) for i in range(n)]
    rows += [(None, 5, n, "a", "x", True)]
    return spark.createDataFrame(rows, "k string, t long, poll_id long, image string, name string, ok boolean").withColumn("config_hash", row_hash(["image"])).select("*", F.timestamp_seconds("t").alias("polled_at_utc"))


def logged(spark, seed=4, n=300):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(25)}", i, rng.randrange(900) * 60, rng.choice(["x", "y", None]), rng.choice([None, "1", "2"]), rng.choice([None, "1", "2"]))
            for i in range(n)]
    return spark.createDataFrame(rows, "k string, release_version long, t long, column_name string, old_value string, new_value string").select(
        "*", F.col("column_name").alias("field"), F.timestamp_seconds("t").alias("created_at_utc"))


def observed(spark, **size):
    obs = seen(spark)
    return history.versions_from_observations(obs, obs.where("ok"), "k", ["image"], current={"current_name": "name"}, **size)


def released(spark, **size):
    keys = [("hot", "1", None)] + [(f"k{i}", "2", "3") for i in range(24)]           # one entity has no values of today
    latest = spark.createDataFrame(keys, "k string, x string, y string")
    gone = spark.createDataFrame([("hot", 90 * DAY), ("k1", 90 * DAY)], "k string, t long").select("k", F.timestamp_seconds("t").alias("deleted_at"))
    return history.versions_from_changes(logged(spark), latest, gone, "k", ["x", "y"], chunk=20, **size)


def placed(spark, **size):
    facts = seen(spark, 9).select("k", "poll_id", (F.col("polled_at_utc") + F.expr("interval 7 hours")).alias("at"))
    return ordered.asof_join(facts, [(materialize(observed(spark)), {"version_no": "v", "image": "i"}), (materialize(released(spark)), {"version_no": "w", "x": "x"})], "k", "at", **size)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("build", [observed, released, placed])
def test_results_do_not_depend_on_the_size_of_keys(spark, build):
    whole = rows(build(spark))
    assert len(whole) > 100
    assert rows(build(spark, most=30)) == whole         # one busy key beside the others
    assert rows(build(spark, most=0)) == whole          # all in chunks


def test_by_size_tells_busy_keys(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(3)], "k string, i int")
    mark = lambda rows, whole: rows.withColumn("whole", F.lit(whole))
    assert {(r.k, r.whole) for r in ordered.by_size(df, ["k"], mark, 3).collect()} == {("a", False), ("b", True)}
    assert ordered.by_size(df, ["k"], mark, 3).count() == 8
    assert {r.whole for r in ordered.by_size(df, ["k"], mark, 5).collect()} == {True}
    assert ordered.by_size(df.limit(0), ["k"], mark).count() == 0


def test_scan_of_whole_keys_equals_chunks(spark):
    df = seen(spark).where("k is not null").withColumn("v", F.when(F.col("poll_id") % 3 > 0, F.col("poll_id")))
    scan = lambda **how: rows(ordered.ordered_scan(
        df, ["k"], ["polled_at_utc", "poll_id"], ordered.by_time("polled_at_utc"), lag={"p": F.col("v"), "q": F.col("poll_id")}, lead={"n": F.col("v")},
        running_sum={"s": F.col("v")}, carry_forward={"f": F.col("v")}, carry_backward={"b": F.col("v")}, runs={"r": F.col("image")}, **how))
    assert scan(whole=True) == scan()


def test_whole_keys_are_dealt_out_once(spark):
    """Each scan used to shuffle its rows twice and their chunks' summaries twice; steps on the same key shuffled again."""
    found = {f.__name__: shuffles(f(spark)) for f in (placed, released, observed)}
    # beside the rows: values of today and closed entities; last sightings, and the instants of the timeline they share with polls, twice
    assert found == {"placed": 1, "released": 3, "observed": 4}
