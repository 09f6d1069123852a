"""Exact group quantiles by selection on value digits.

`percentile_disc` keeps every distinct value of a group in one task. Here a first pass counts values per
(group, leading digits of the value), which finds exactly the digit bucket that holds each wanted rank; a
second pass ranks only the values of those buckets, except where all values of a bucket are equal. Both passes combine on the map side, no task sees a
whole group, and the result is an observed value at rank ceil(q * n), or the interpolated quantile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ordered import ordered_scan

# Buckets per power of two. The histogram of a group holds at most COARSE rows per octave its values span,
# whatever the number of rows. The values of a wanted bucket are ranked in chunks of FINE digits.
COARSE = 64
FINE = COARSE * 4_096


@dataclass(frozen=True)
class Quantile:
    """`out` = the `q` quantile of `value` (nulls skipped), cast to `type`."""

    out: str
    value: Column
    q: float
    type: str = "double"
    interpolate: bool = False


def leading_digits(value: Column, steps: int) -> Column:
    """A bucket number that never decreases as the value grows.

    floor(log2) may be off by one next to a power of two; exponent * steps + floor(mantissa * steps) gives
    the same number either way.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    finite = (exponent + 1_100) * F.lit(steps) + F.floor(size / F.pow(F.lit(2.0), exponent) * F.lit(steps))
    top = F.lit(4_000 * steps).cast("bigint")
    return (F.when(F.isnan(value), top + 1)
            .when(size == F.lit(float("inf")), F.signum(value).cast("bigint") * top)
            .when(size == 0, F.lit(0).cast("bigint"))
            .otherwise(F.signum(value).cast("bigint") * finite))


def group_quantiles(df: DataFrame, keys: Sequence[str], wanted: Sequence[Quantile]) -> DataFrame:
    """One row per group that has a value: `_k` (struct of the keys) and one column per quantile."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    texts: dict[str, int] = {}
    measures: list[Column] = []
    index = []
    for w in wanted:
        text = str(w.value)
        if text not in texts:
            texts[text] = len(measures)
            measures.append(w.value)
        index.append(texts[text])

    wide = df.select(key.alias("_k"), *[m.cast("double").alias(f"_v{i}") for i, m in enumerate(measures)])
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col(f"_v{i}").alias("v")) for i in range(len(measures))]))
    values = (wide.select("_k", pairs.alias("p")).where("p.v is not null")
              .select("_k", F.col("p.m").alias("_m"), F.col("p.v").alias("_v"), leading_digits(F.col("p.v"), COARSE).alias("_b")))

    group = Window.partitionBy("_k", "_m")
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (values.groupBy("_k", "_m", "_b").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            .withColumn("_upto", F.sum("_n").over(upto)).withColumn("_total", F.sum("_n").over(group)))
    total = F.col("_total")
    ranks = []
    for i, w in enumerate(wanted):
        at = (total - 1) * F.lit(w.q)
        low = F.floor(at) + 1 if w.interpolate else F.greatest(F.ceil(total * F.lit(w.q)), F.lit(1))
        high = F.ceil(at) + 1 if w.interpolate else low
        part = at - F.floor(at) if w.interpolate else F.lit(0.0)
        ends = [(0, low), (1, high)] if w.interpolate else [(0, low)]
        ranks += [F.struct(F.lit(i).alias("w"), F.lit(end).alias("end"), F.lit(index[i]).alias("m"),
                           rank.cast("bigint").alias("rank"), part.cast("double").alias("part"))
                  for end, rank in ends]
    here = F.filter(F.array(*ranks), lambda r: (r["m"] == F.col("_m")) & (r["rank"] <= F.col("_upto"))
                    & (r["rank"] > F.col("_upto") - F.col("_n")))
    targets = (hist.select("_k", "_m", "_b", "_lo", "_hi", (F.col("_upto") - F.col("_n")).alias("_below"), F.explode(here).alias("t"))
               .select("_k", "_m", "_b", "_lo", "_hi", (F.col("t.rank") - F.col("_below")).alias("_rank"), "t.w", "t.end", "t.part"))
    all_targets = materialize(targets)
    one_value = F.col("_lo") == F.col("_hi")
    # adding zero leaves no negative one
    sure = all_targets.where(one_value).select("_k", (F.col("_lo") + F.lit(0.0)).alias("_v"), "w", "end", "part")
    targets = all_targets.where(~one_value).drop("_lo", "_hi")

    inside = (values.join(targets.select("_k", "_m", "_b"), ["_k", "_m", "_b"], "left_semi")
              .groupBy("_k", "_m", "_b", "_v").agg(F.count("*").alias("_n")))
    ranked = ordered_scan(inside, ["_k", "_m", "_b"], ["_v"], leading_digits(F.col("_v"), FINE),
                          running_sum={"_upto": F.col("_n")})
    found = (ranked.join(targets, ["_k", "_m", "_b"])
             .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
             .select("_k", "_v", "w", "end", "part").unionByName(sure))

    cells = []
    for i, w in enumerate(wanted):
        pick = lambda end, col, i=i: F.max(F.when((F.col("w") == i) & (F.col("end") == end), F.col(col)))
        low = pick(0, "_v")
        cell = low + (pick(1, "_v") - low) * pick(0, "part") if w.interpolate else low
        cells.append(cell.cast(w.type).alias(w.out))
    return found.groupBy("_k").agg(*cells)


def aggregate(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], quantiles: Sequence[Quantile]) -> DataFrame:
    """`df.groupBy(keys).agg(aggs)` plus exact quantile columns; null keys form groups as in groupBy."""
    base = df.groupBy(*keys).agg(*aggs)
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    return (base.withColumn("_k", key)
            .join(group_quantiles(df, keys, quantiles), "_k", "left").drop("_k"))
