"""Ordered computations per key that never need a whole key in one task.

A window `PARTITION BY key ORDER BY t` puts every row of a key into one task; with a third of all rows
on one key that task never ends. Here each key's timeline is cut into chunks (a day, a range of line
numbers). A window runs inside each (key, chunk), the last row of each chunk summarises it, a second
window runs over those summaries only (one row per chunk of a key), and its result is joined back on
(key, chunk), the partitioning the rows already have.

Keys of few rows need none of this: `by_size` counts the rows of each key and cuts only the busy ones into
chunks; the others are sorted once, by key, and steps that follow on the same key find them in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

CHUNK = "_chunk"
MOST = 200_000          # rows of one key that a task sorts at once; busier keys are cut into chunks


def by_time(col: str, unit: str = "day") -> Column:
    """Chunk of a timestamp column."""
    return F.date_trunc(unit, F.col(col))


def by_number(col: str, size: int = 1_000_000) -> Column:
    """Chunk of an integer column: at most `size` consecutive numbers."""
    return F.floor(F.col(col) / F.lit(size))


def by_size(df: DataFrame, keys: Sequence[str], build: Callable[[DataFrame, bool], DataFrame], most: int = MOST) -> DataFrame:
    """`build(rows, whole)` on the rows of all keys: whole=True for keys of at most `most` rows, False for busier ones.

    There are at most rows / `most` busy keys; their names become a table, so that the plan has their branch only where there are any.
    `keys` must hold no nulls, and `build` must keep keys apart.
    """
    busy = materialize(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys))
    if busy.isEmpty():
        return build(df, True)
    return build(df.join(busy, keys, "left_anti"), True).unionByName(build(df.join(busy, keys, "left_semi"), False))


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, *, whole: bool = False,
                 lag: Mapping[str, Column] | None = None,
                 lead: Mapping[str, Column] | None = None,
                 running_sum: Mapping[str, Column] | None = None,
                 carry_forward: Mapping[str, Column] | None = None,
                 carry_backward: Mapping[str, Column] | None = None,
                 runs: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ordered columns to `df`; each mapping is {output name: expression}.

    lag / lead        value on the previous / next row of the key
    running_sum       sum up to and including the row
    carry_forward     last non-null value at or before the row
    carry_backward    first non-null value at or after the row
    runs              number (from 1) of the row's run of equal values, and NAME_starts on its first row

    `whole` says that each key fits a task: one window by key, no chunks.

    The rows and their chunk summaries both read `df`: give chains of scans a materialised input
    (`tephra.session.materialize`), or each step doubles the work before it.

    `keys` must hold no nulls, `order` must be a total order within a key (ascending), and `chunk` must be
    non-null and non-decreasing along it. `keys` may be empty: then only the chunk summaries are ordered
    globally.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    sums, fwd, bwd, runs = dict(running_sum or {}), dict(carry_forward or {}), dict(carry_backward or {}), dict(runs or {})
    kept = df.columns
    names = list(keys) if whole else list(keys) + [CHUNK]
    inside = Window.partitionBy(*names).orderBy(*order)
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = (Window.partitionBy(*names).orderBy(*[F.col(c).desc() for c in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    staged = df if whole else df.withColumn(CHUNK, chunk)
    exprs = {}
    for kind, group in (("lag", lag), ("lead", lead)):
        if group:
            exprs[f"_{kind}"] = F.struct(*[e.alias(n) for n, e in group.items()])
    exprs |= {f"_s_{n}": e for n, e in sums.items()}
    exprs |= {f"_f_{n}": e for n, e in fwd.items()} | {f"_b_{n}": e for n, e in bwd.items()}
    exprs |= {f"_r_{n}": e for n, e in runs.items()}
    staged = staged.select("*", *[e.alias(n) for n, e in exprs.items()])

    local = {} if whole else {"_is_last": F.lead(F.lit(1)).over(inside).isNull()}
    if lag:
        local["_lag_in"] = F.lag("_lag").over(inside)
    if lead:
        local["_lead_in"] = F.lead("_lead").over(inside)
        if not whole:
            local["_lead_first"] = F.first("_lead").over(sofar)
    local |= {f"_sl_{n}": F.coalesce(F.sum(f"_s_{n}").over(sofar), F.lit(0)) for n in sums}
    local |= {f"_fl_{n}": F.last(f"_f_{n}", ignorenulls=True).over(sofar) for n in fwd}
    if not whole:       # the first non-null of the whole chunk, known on its last row, is what earlier chunks see
        local |= {f"_bh_{n}": F.first(f"_b_{n}", ignorenulls=True).over(sofar) for n in bwd}
    local |= {f"_bl_{n}": F.last(f"_b_{n}", ignorenulls=True).over(onward) for n in bwd}
    for n in runs:
        before_it = F.lag(f"_r_{n}").over(inside)
        local[f"_rd_{n}"] = (before_it.isNotNull() & (before_it != F.col(f"_r_{n}"))).cast("bigint")
        local[f"_r0_{n}"] = F.lag(F.lit(1)).over(inside).isNull()
        if not whole:
            local[f"_rf_{n}"] = F.first(f"_r_{n}").over(sofar)
    rows = staged.select("*", *[e.alias(n) for n, e in local.items()])
    rows = rows.select("*", *[F.sum(f"_rd_{n}").over(sofar).alias(f"_rl_{n}") for n in runs])
    if whole:
        return rows.select(
            *kept, *[F.col("_lag_in")[n].alias(n) for n in lag], *[F.col("_lead_in")[n].alias(n) for n in lead],
            *[F.col(f"_sl_{n}").alias(n) for n in sums], *[F.col(f"_fl_{n}").alias(n) for n in fwd], *[F.col(f"_bl_{n}").alias(n) for n in bwd],
            *[c for n in runs for c in ((F.col(f"_rl_{n}") + 1).alias(n), (F.col(f"_r0_{n}") | (F.col(f"_rd_{n}") == 1)).alias(f"{n}_starts"))])

    over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
    after = (Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    carry = {}
    if lag:
        carry["_lag_out"] = F.lag("_lag").over(over_chunks)
    if lead:
        carry["_lead_out"] = F.lead("_lead_first").over(over_chunks)
    carry |= {f"_sc_{n}": F.sum(f"_sl_{n}").over(before) for n in sums}
    carry |= {f"_fc_{n}": F.last(f"_fl_{n}", ignorenulls=True).over(before) for n in fwd}
    carry |= {f"_bc_{n}": F.last(f"_bh_{n}", ignorenulls=True).over(after) for n in bwd}
    for n in runs:
        # the first row of a chunk starts a run unless the chunk before ended with the same value
        last = F.lag(f"_r_{n}").over(over_chunks)
        carry[f"_rs_{n}"] = (last.isNull() | (last != F.col(f"_rf_{n}"))).cast("bigint")
        carry[f"_rl_{n}"] = F.col(f"_rl_{n}")
    summary = rows.where("_is_last").select(*names, *[e.alias(n) for n, e in carry.items()])
    if runs:
        summary = summary.select("*", *[F.coalesce(F.sum(F.col(f"_rl_{n}") + F.col(f"_rs_{n}")).over(before), F.lit(0)).alias(f"_ro_{n}")
                                        for n in runs]).drop(*[f"_rl_{n}" for n in runs])

    joined = rows.join(summary, names, "left")
    out = [F.col(c) for c in kept]
    if lag:
        prev = F.coalesce("_lag_in", "_lag_out")
        out += [prev[n].alias(n) for n in lag]
    if lead:
        nxt = F.coalesce("_lead_in", "_lead_out")
        out += [nxt[n].alias(n) for n in lead]
    out += [(F.col(f"_sl_{n}") + F.coalesce(F.col(f"_sc_{n}"), F.lit(0))).alias(n) for n in sums]
    out += [F.coalesce(f"_fl_{n}", f"_fc_{n}").alias(n) for n in fwd]
    out += [F.coalesce(f"_bl_{n}", f"_bc_{n}").alias(n) for n in bwd]
    for n in runs:
        starts = F.when(F.col(f"_r0_{n}"), F.col(f"_rs_{n}")).otherwise(F.col(f"_rd_{n}")) == 1
        out += [(F.col(f"_ro_{n}") + F.col(f"_rs_{n}") + F.col(f"_rl_{n}")).alias(n), starts.alias(f"{n}_starts")]
    return joined.select(*out)


def asof_join(facts: DataFrame, histories: Sequence[tuple[DataFrame, Mapping[str, str]]], key: str, at: str, *,
              valid_from: str = "valid_from", valid_to: str = "valid_to", unit: str = "day", most: int = MOST) -> DataFrame:
    """Left point-in-time join: per history the version of `key` with valid_from <= at < valid_to (null = open).

    `histories` pairs each history with {its column: output name}; the windows of one key must not overlap
    within a history. Facts and the version starts of all histories are laid on one timeline and the latest
    version of each is carried forward, so the cost is one sort; a range join would pair every fact of a
    busy key with every version of it. Facts without a key or time keep null version columns. A key of more than
    `most` facts and versions is cut into chunks of a `unit`.
    """
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    line = facts.where(known).select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(0).alias("_which"),
                                     F.struct(*facts.columns).alias("_fact"))
    for i, (history, columns) in enumerate(histories):
        version = F.struct(F.col(valid_to).alias("_to"), *[F.col(c).alias(o) for c, o in columns.items()])
        line = line.unionByName(
            history.where(F.col(key).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))))
            .select(F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_side"), F.lit(i).alias("_which"),
                    version.alias(f"_version{i}")), allowMissingColumns=True)
    seen = by_size(line, ["_key"], lambda rows, whole: ordered_scan(
        rows, ["_key"], ["_at", "_side", "_which"], by_time("_at", unit), whole=whole,
        carry_forward={f"_seen{i}": F.col(f"_version{i}") for i in range(len(histories))}).where("_side = 1"), most)
    out = []
    for i, (_, columns) in enumerate(histories):
        last = F.col(f"_seen{i}")
        live = F.when(last["_to"].isNull() | (F.col("_at") < last["_to"]), last)
        out += [live[o].alias(o) for o in columns.values()]
    return seen.select("_fact.*", *out).unionByName(facts.where(~known), allowMissingColumns=True)


def covering_versions(points: DataFrame, history: DataFrame, keys: Sequence[str], at: str, ids: Sequence[str], *,
                      out: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                      unit: str = "day") -> DataFrame:
    """How many history windows of the same `keys` cover each point; unlike `asof_join` it counts overlaps.

    A sweep over window starts (+1) and ends (-1): a point at an end no longer counts that window, a point
    at a start does.
    """
    valid = history.where(F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
    marks = (points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(0).alias("_step"),
                           F.struct(*ids).alias("_id"))
             .unionByName(valid.select(*keys, F.col(valid_from).alias("_at"), F.lit(0).alias("_side"),
                                       F.lit(1).alias("_step")), allowMissingColumns=True)
             .unionByName(valid.where(F.col(valid_to).isNotNull())
                          .select(*keys, F.col(valid_to).alias("_at"), F.lit(0).alias("_side"),
                                  F.lit(-1).alias("_step")), allowMissingColumns=True))
    swept = ordered_scan(marks, list(keys), ["_at", "_side"], by_time("_at", unit),
                         running_sum={out: F.col("_step")})
    return swept.where("_side = 1").select("_id.*", *[k for k in keys if k not in ids], out)
