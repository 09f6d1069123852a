"""Row-for-row comparison of two tables by natural key, with tolerance for reals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import ordered_scan
from ..session import materialize

REL, ABS = 1e-6, 1e-9
REAL = ("double", "float")


def close(a: Column, b: Column) -> Column:
    """Equal within max(REL * larger size, ABS); NaN counts as null; infinities only equal themselves."""
    inf = F.lit(float("inf"))
    finite = (F.abs(a) < inf) & (F.abs(b) < inf)
    gap = F.abs(a - b)
    return F.coalesce((a == b) | (finite & (gap <= F.greatest(F.lit(REL) * F.greatest(F.abs(a), F.abs(b)), F.lit(ABS)))), a.isNull() & b.isNull())


WHOLE = ("int", "bigint", "smallint", "tinyint")


def comparable(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Numbers as doubles (NaN null; whole numbers of the key stay whole), timestamps as UTC text to the second, the rest as text."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def one(c: str) -> Column:
        kind = kinds[c]
        if c in key and kind in WHOLE:
            return F.col(c).cast("bigint")
        if kind in REAL or kind.startswith("decimal") or kind in WHOLE:
            x = F.col(c).cast("double")
            return F.when(~F.isnan(x), x)
        if kind in ("timestamp", "timestamp_ntz"):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.to_json(c) if kind.startswith(("array", "map", "struct")) else F.col(c).cast("string")

    return df.select(*[one(c).alias(c) for c in columns])


def in_ranges(rows: DataFrame) -> DataFrame:
    """`rows` (written out) with `_range`: the number of a stretch of the order by (_key, _sort), as many as there are shuffle partitions."""
    many = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartitionByRange(many, "_key", "_sort").withColumn("_range", F.spark_partition_id()))


def suspects(left: DataFrame, right: DataFrame) -> DataFrame:
    """The keys of two tables (_key, _sort) whose rows are not the same multiset: by number, xor and sum of two 64-bit hashes of the rows, one aggregate a side."""
    def prints(rows: DataFrame, side: str) -> DataFrame:
        h = F.xxhash64(F.lit(3), "_sort").cast("decimal(38,0)")
        return rows.groupBy("_key").agg(F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("_sort")).alias("x"), F.sum(h).alias("s")).alias(side))
    both = prints(left, "_pl").join(prints(right, "_pr"), "_key", "full")
    return materialize(both.where(~F.col("_pl").eqNullSafe(F.col("_pr"))).select("_key"))


def table_parity(left: DataFrame, right: DataFrame, key: Sequence[str], *, ignore: Sequence[str] = ()) -> DataFrame:
    """One row per difference: key (JSON), `problem` (only left, only right, or the columns that differ).

    Keys whose rows are equal on both sides are told by fingerprints and go no further; reals that differ within the tolerance make a key a suspect, no more. Rows of
    a suspect are paired in the order of their values, column after column, nulls first. Equal rows collapse to a count before pairing, and the pairing
    number runs in chunks of the order of all rows, cut at sampled quantiles: a key with very many rows is spread over
    as many tasks as it needs, whatever its rows begin with.
    """
    shared = [c for c in left.columns if c in right.columns and c not in ignore]
    rest = [c for c in shared if c not in key]

    def ordered(df: DataFrame) -> DataFrame:
        c = comparable(df, shared, key)
        text = c.select(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}).alias("_key"), F.struct(*rest).alias("_row"))
        short = F.struct(*[F.col(f"_row.{c}").alias(str(i)) for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("0"))
        return text.withColumn("_sort", F.to_json(short, {"ignoreNullFields": "false"}))

    def prepared(rows: DataFrame, side: str) -> DataFrame:
        distinct = rows.join(wanted, "_key", "left_semi").groupBy("_key", F.col("_row").alias("_sort")).agg(F.count("*").alias("_n"))
        numbered = ordered_scan(in_ranges(distinct), ["_key"], ["_sort"], F.col("_range"), running_sum={"_upto": F.col("_n")})
        return numbered.select("_key", F.explode(F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto"))).alias("_i"),
                               F.col("_sort").alias(side))

    one, two = ordered(left), ordered(right)
    wanted = suspects(one.select("_key", "_sort"), two.select("_key", "_sort"))
    both = prepared(one, "_l").join(prepared(two, "_r"), ["_key", "_i"], "full")
    kinds = {f.name: f.dataType.simpleString() for f in comparable(left, shared, key).schema.fields}
    wrong = [F.when(~(close(F.col(f"_l.{c}"), F.col(f"_r.{c}")) if kinds[c] == "double" else F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))), F.lit(c))
             for c in rest]
    differing = F.array_join(F.filter(F.array(*wrong), lambda x: x.isNotNull()), ",") if rest else F.lit("")
    problem = F.when(F.col("_r").isNull(), "only left").when(F.col("_l").isNull(), "only right").otherwise(F.nullif(differing, F.lit("")))
    return both.select(F.col("_key").alias("key"), problem.alias("problem")).where("problem is not null")
