"""A history merged from listings, once each, however often they are announced."""

from pyspark.sql import functions as F

from tephra.operators import history
from tephra.streaming import history_merge

LISTINGS = [{"a": "1", "b": "1", "c": None}, {"a": "2", "b": "1"}, {}, {"a": "2", "d": "1"}]


def rows(df):
    return {(r.k, r.v, str(r.valid_from), str(r.valid_to)) for r in df.select("k", "v", "valid_from", "valid_to").collect()}


def test_replays_and_restarts_change_nothing(spark, tmp_path):
    index, path = str(tmp_path / "index"), str(tmp_path / "history")
    at = [f"2026-01-0{i + 1} 00:00:00" for i in range(len(LISTINGS))]
    want = None
    for i, listing in enumerate(LISTINGS):
        folder = str(tmp_path / f"l{i}")
        frame = spark.createDataFrame(list(listing.items()), "k string, v string").withColumn("other", F.lit(i))
        frame.repartition(2).write.parquet(folder)
        # one rebuild, listing by listing
        now = F.lit(at[i]).cast("timestamp")
        seen = frame.withColumn("at", now)
        want = seen.limit(0).selectExpr("k", "v", "at as valid_from", "at as valid_to") if want is None else want
        want = history.merge_snapshot(want, seen, "k", ["v"], run_at=now, updated_at="at")
        spark.createDataFrame([(at[i], folder)], "t string, folder string").selectExpr("cast(t as timestamp) as listed_at", "folder").coalesce(1).write.mode("append").json(index)
        got = history_merge.follow_listings(spark, index, path, str(tmp_path / f"checkpoint{i // 2}"), "k", ["v"])     # the checkpoint is lost halfway
        assert rows(got) == rows(want)
    assert ("a", "2", "2026-01-02 00:00:00", "2026-01-03 00:00:00") in rows(got) and ("c", "None", at[0], at[1]) not in rows(got)
    before = history_merge.versions(spark, path)
    again = spark.createDataFrame([(at[-1], str(tmp_path / "l3"))], "t string, folder string").selectExpr("cast(t as timestamp) as listed_at", "folder")
    step = history_merge.merge_batch(path, "k", ["v"])
    step(again, before[-1][0])                                      # the batch that was interrupted after its rename
    assert history_merge.versions(spark, path) == before and len(before) <= history_merge.KEPT
    everything = history_merge.follow_listings(spark, index, path, str(tmp_path / "checkpoint-new"), "k", ["v"], files_per_batch=10)
    assert rows(everything) == rows(got) and history_merge.versions(spark, path) == before
    late = again.withColumn("listed_at", F.lit(at[0]).cast("timestamp"))
    step(late, before[-1][0] + 1)                                   # an old listing told under a new batch
    assert rows(history_merge.current_history(spark, path)) == rows(got)
