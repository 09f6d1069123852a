"""Ordered scans and quantiles against brute force, on skewed keys and awkward values."""

import math
import random
import statistics

import pytest

from pyspark.sql import functions as F
from tephra.functions import ordered, text
from tephra.functions.quantiles import Quantile, aggregate


def skewed_rows(seed, n=400):
    """One key holds a third of the rows."""
    rng = random.Random(seed)
    keys = ["hot" if rng.random() < 0.34 else f"k{rng.randrange(12)}" for _ in range(n)]
    order = rng.sample(range(n * 3), n)
    return [(k, o, rng.choice([None, 1, 2, 3]), rng.choice("ab")) for k, o in zip(keys, order)]


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_ordered_scan_equals_plain_order(spark, size):
    rows = skewed_rows(size)
    df = spark.createDataFrame(rows, "k string, o int, v int, s string")
    got = ordered.ordered_scan(df, ["k"], ["o"], ordered.by_number("o", size), lag={"p": F.col("v"), "po": F.col("o")}, lead={"n": F.col("v"), "no": F.col("o")},
                               running_sum={"t": F.col("v")}, carry_forward={"f": F.col("v")}, carry_backward={"b": F.col("v")}, runs={"r": F.col("s")})
    found = {(x.k, x.o): x for x in got.collect()}
    assert len(found) == len(rows)
    by_key = {}
    for r in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(r[0], []).append(r)
    for k, seq in by_key.items():
        run = 0
        for i, (_, o, v, s) in enumerate(seq):
            x = found[(k, o)]
            prev, nxt = (seq[i - 1] if i else None), (seq[i + 1] if i + 1 < len(seq) else None)
            assert (x.p, x.po) == ((prev[2], prev[1]) if prev else (None, None))
            assert (x.n, x.no) == ((nxt[2], nxt[1]) if nxt else (None, None))
            assert x.t == sum(r[2] or 0 for r in seq[: i + 1])
            assert x.f == next((r[2] for r in reversed(seq[: i + 1]) if r[2] is not None), None)
            assert x.b == next((r[2] for r in seq[i:] if r[2] is not None), None)
            starts = prev is None or prev[3] != s
            run += starts
            assert (x.r, x.r_starts) == (run, starts)


def test_ordered_scan_without_keys(spark):
    df = spark.createDataFrame([(i,) for i in (5, 1, 9, 3)], "o int")
    got = ordered.ordered_scan(df, [], ["o"], ordered.by_number("o", 4), running_sum={"n": F.lit(1)})
    assert {r.o: r.n for r in got.collect()} == {1: 1, 3: 2, 5: 3, 9: 4}


def test_asof_join_is_half_open_and_left(spark):
    facts = spark.createDataFrame([("a", 10), ("a", 20), ("a", 29), ("a", 30), ("a", 5), ("b", 10), (None, 10), ("a", None)], "k string, t int")
    hist = spark.createDataFrame([("a", 10, 20, 1), ("a", 20, 30, 2), ("a", 40, None, 3), ("a", 20, 20, 9)], "k string, f int, e int, v int")
    secs = lambda c: F.timestamp_seconds(F.col(c))
    hist = hist.select("k", secs("f").alias("valid_from"), secs("e").alias("valid_to"), "v")
    out = ordered.asof_join(facts.withColumn("at", secs("t")), [(hist, {"v": "v"})], "k", "at", unit="hour")
    assert {(r.k, r.t): r.v for r in out.collect()} == {("a", 10): 1, ("a", 20): 2, ("a", 29): 2, ("a", 30): None, ("a", 5): None, ("b", 10): None,
                                                        (None, 10): None, ("a", None): None}


def test_covering_versions_counts_overlaps(spark):
    secs = lambda c: F.timestamp_seconds(F.col(c))
    pts = spark.createDataFrame([("a", t, t) for t in (0, 10, 15, 20, 30)], "k string, id int, t int").select("k", "id", secs("t").alias("at"))
    hist = spark.createDataFrame([("a", 10, 20), ("a", 15, None), ("a", 30, 25)], "k string, f int, e int").select("k", secs("f").alias("valid_from"), secs("e").alias("valid_to"))
    out = ordered.covering_versions(pts, hist, ["k"], "at", ["id"], out="n")
    assert {r.id: r.n for r in out.collect()} == {0: 0, 10: 1, 15: 2, 20: 1, 30: 1}


def test_quantiles_are_exact(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        k = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        v = rng.choice([None, 0.0, rng.uniform(-5, 5), rng.uniform(1e6, 1e6 + 1e-3), float("inf"), float("-inf"), 2.0 ** rng.randrange(-30, 30), math.nextafter(8.0, 0)])
        rows.append((k, v, rng.randrange(50) if k != "b" else 7))
    df = spark.createDataFrame(rows, "k string, v double, i int")
    q = [Quantile(f"p{int(p * 100)}", F.col("v"), p) for p in (0.01, 0.5, 0.9, 1.0)] + [Quantile("m", F.col("i"), 0.5, interpolate=True), Quantile("i50", F.col("i"), 0.5, "int"),
         Quantile("none", F.when(F.col("k") == "a", F.col("v")), 0.5)]
    got = {r.k: r for r in aggregate(df, ["k"], [F.count("*").alias("n")], q).collect()}
    for k in ("hot", "a", "b", None):
        vals = sorted(v for kk, v, _ in rows if kk == k and v is not None)
        ints = sorted(i for kk, _, i in rows if kk == k)
        r = got[k]
        assert r.n == len(ints)
        for p, name in ((0.01, "p1"), (0.5, "p50"), (0.9, "p90"), (1.0, "p100")):
            assert r[name] == vals[max(1, math.ceil(p * len(vals))) - 1], (k, name)
        assert r.m == statistics.median(ints) and r.i50 == ints[max(1, math.ceil(len(ints) / 2)) - 1]
        assert (r.none is None) == (k != "a")


def test_canonical_text(spark):
    df = spark.createDataFrame([("A,-Z,B,-C",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(text.selection_of_csv(F.col("s"))).collect()]
    assert got == ["A,B,-C,-Z", None, None]
    one = spark.range(1).select(text.list_or_all(F.array().cast("array<string>")), text.list_or_all(F.lit(None).cast("array<string>")), text.list_or_all(F.array(F.lit("b"), F.lit("a"))),
                                text.selection_of_lists(F.array(F.lit("P")), F.array(F.lit("y"), F.lit("x"))), text.row_hash([F.lit(None), F.lit("")])).first()
    import hashlib
    assert list(one) == ["ALL", "ALL", "a,b", "P,-x,-y", hashlib.md5(b"<null>|").hexdigest()]


def test_ticks_count_boundaries(spark):
    r = spark.sql("select timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 00:00:01.1' b").select(
        text.ticks_between(F.col("a"), F.col("b"), 1), text.ticks_between(F.col("a"), F.col("b"), 60)).first()
    assert list(r) == [1, 0]
