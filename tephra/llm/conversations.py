"""Repair the turns of conversations: faults, and the cheapest edits to an optional system turn and alternating user and assistant turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLANKS, table
from .spelling import CRC_SQL, crc_sql

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
ENDS = [".", "!", "?"]
#: A row's code: whose turn it is by the role's initial, and its fault.
USER, ASSISTANT, SYSTEM, OTHER = range(4)
INITIALS = {"u": USER, "a": ASSISTANT, "s": SYSTEM}
MUST_GO, TRUNCATED = 4, 8
#: Rows aligned at a time. What lies after a block enters it as four costs, so a conversation costs its length times a block's band.
BLOCK_ROWS = 64
NEVER = float("inf")


class Block:
    """Rows aligned with every feasible length of the alternating string at once.

    w[x][i][k] is the least cost of rows i.. against the last k turns of a string after which turn x (user or assistant) is due, plus
    what the conversation costs from there: one Wagner-Fischer table for each x holds all lengths, since shorter targets are
    ends of longer ones. Only the diagonals are filled in on which a script can stay within the incumbent's cost (Ukkonen); the
    incumbent deletes what must go, takes all else in turn and inserts one turn first where the parity asks for it.
    """

    def __init__(self, codes: bytes, after: tuple, last: bool):
        self.codes, self.last = codes, last
        n = len(codes)
        self.w = {x: self.table(x, after[x]) for x in (USER, ASSISTANT) if after[x] < NEVER}
        # nothing emitted yet, and nothing but the system turn
        self.start, self.opened = [NEVER] * (n + 1), [NEVER] * (n + 1)
        for i in range(n, -1, -1):
            turns = min((v for _, _, v in self.cells(i, USER, 1)), default=NEVER)
            if i == n:
                self.opened[i], self.start[i] = min(after[2], turns), min(after[3], turns)
                continue
            self.opened[i] = min(DELETE + self.opened[i + 1], turns)
            self.start[i] = min(DELETE + self.start[i + 1], turns, self.kept_system(i))

    def kept_system(self, i: int) -> float:
        code = self.codes[i]
        return self.opened[i + 1] + (CUT if code & TRUNCATED else 0) if code & 3 == SYSTEM and not code & MUST_GO else NEVER

    def table(self, x: int, after: float) -> list[tuple[int, list]]:
        codes, n = self.codes, len(self.codes)
        taken = [c for c in codes if not c & MUST_GO]
        slack = 0
        for due in (USER, ASSISTANT):
            lead = (due + len(taken) + x) % 2                # one turn inserted first
            slack = max(slack, INSERT * lead + REROLE * sum(c & 3 != (due + lead + j) % 2 for j, c in enumerate(taken)))
        # a deletion costs a truncated row one more than to keep it, and others four
        rows: list = [None] * (n + 1)
        left = cut = 0
        for i in range(n, -1, -1):
            code = codes[i] if i < n else MUST_GO
            if not code & MUST_GO:
                left, cut = left + 1, cut + bool(code & TRUNCATED)
            gone = slack if slack <= cut else cut + (slack - cut) // DELETE
            low, high = max(0, left - gone), left + slack // INSERT
            if i == n:
                rows[i] = (low, [after + INSERT * k if self.last or not k else NEVER for k in range(low, high + 1)])
                continue
            base, under = rows[i + 1]
            top, out, before = base + len(under), [], NEVER
            extra = CUT if code & TRUNCATED else 0
            for k in range(low, high + 1):
                best = before + INSERT
                if base <= k < top and (v := under[k - base] + DELETE) < best:
                    best = v
                if not code & MUST_GO and base < k <= top and (v := under[k - 1 - base] + extra + (0 if code & 3 == x ^ (k & 1) else REROLE)) < best:
                    best = v
                out.append(best)
                before = best
            rows[i] = (low, out)
        return rows

    def at(self, x: int, i: int, k: int) -> float:
        low, values = self.w[x][i]
        return values[k - low] if low <= k < low + len(values) else NEVER

    def cells(self, i: int, due: int, least: int = 0) -> Iterator[tuple[int, int, float]]:
        """(x, k, cost) of the targets whose first turn, or the turn due after none, is `due`."""
        for x, rows in self.w.items():
            low, values = rows[i]
            first = max(low, least)
            for k in range(first + ((first ^ x ^ due) & 1), low + len(values), 2):
                yield x, k, values[k - low]

    def costs(self) -> tuple:
        """The least cost from this block's start to the end: user due, assistant due, user due after the system turn alone, nothing emitted."""
        least = lambda due: min((v for _, _, v in self.cells(0, due)), default=NEVER)
        return least(USER), least(ASSISTANT), self.opened[0], self.start[0]

    def walk(self, state: int) -> tuple[str, int]:
        """(edits, state after the block): of all cheapest scripts over all lengths the one whose letters are least, by backtracing all of them together."""
        n, i, audit = len(self.codes), 0, []
        cost = self.costs()[state]
        # a script in progress: (x, k) within a target, or ("open",) and ("start",) before its first turn
        live = {(x, k) for x, k, v in self.cells(0, state) if v == cost} if state < 2 else {("open",) if state == 2 else ("start",)}
        while i < n or cost > 0 and self.last:
            moves: dict[str, set] = {}
            for script in list(live):
                if len(script) == 1:
                    live |= {(x, k) for x, k, v in self.cells(i, USER, 1) if v == cost}
                    if i < n and DELETE + (self.opened if script[0] == "open" else self.start)[i + 1] == cost:
                        moves.setdefault("D", set()).add(script)
                    if i < n and script[0] == "start" and self.kept_system(i) == cost:
                        moves.setdefault("K", set()).add(("open",))
            code = self.codes[i] if i < n else MUST_GO
            keep = CUT if code & TRUNCATED else 0
            for x, k in (s for s in live if len(s) == 2):
                if i < n and DELETE + self.at(x, i + 1, k) == cost:
                    moves.setdefault("D", set()).add((x, k))
                if k and INSERT + self.at(x, i, k - 1) == cost:
                    moves.setdefault("I", set()).add((x, k - 1))
                same = code & 3 == x ^ (k & 1)
                if k and not code & MUST_GO and self.at(x, i + 1, k - 1) + keep + (0 if same else REROLE) == cost:
                    moves.setdefault("K" if same else "R", set()).add((x, k - 1))
            letter = min(moves)
            live = moves[letter]
            audit.append(letter)
            cost -= {"D": DELETE, "I": INSERT, "K": keep, "R": keep + REROLE}[letter]
            i += letter != "I"
        end = next(iter(live))
        return "".join(audit), {"open": 2, "start": 3}.get(end[0], end[0])


@lru_cache(maxsize=50_000)
def cheapest(codes: bytes, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair of a conversation, ties by the least letters: D delete, I insert, K keep, R rerole.

    The state between two blocks is which turn is due. Insertions stand before the row that follows them, so that blocks' edits are
    comparable one by one.
    """
    parts = [codes[at:at + block_rows] for at in range(0, len(codes), block_rows)]
    after = [(0, NEVER, NEVER, 0)]
    for k in range(len(parts) - 1, -1, -1):
        block = Block(parts[k], after[-1], k == len(parts) - 1)
        after.append(block.costs())
    after = after[::-1]
    state, audit = 3, []
    for k, part in enumerate(parts):
        if len(parts) > 1:
            block = Block(part, after[k + 1], k == len(parts) - 1)
        edits, state = block.walk(state)
        audit.append(edits)
    return int(after[0][3]), "".join(audit)


def flagged(rows: DataFrame) -> DataFrame:
    """`rows` (conv, turn, role, text, dropped) with nulls filled, their place among the turns, and what is wrong with each by itself or for a turn before it."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = rows.select("conv", F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn")).alias("at"), role.alias("role"), text.alias("text"), "dropped")
    bare = F.rtrim("text", F.lit(BLANKS))
    rows = rows.select("*", F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"), (F.btrim("text", F.lit(BLANKS)) == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(ENDS)).alias("cut"))
    # what stands at several turns; repeats within one turn lie side by side
    first = rows.where(~F.col("dropped")).groupBy("conv", "digest").agg(F.min("at").alias("first"), F.max("at").alias("last")).where(F.col("first") < F.col("last"))
    first = materialize(first.select(F.col("conv").alias("of"), F.col("digest").alias("same"), "first"))
    both = rows.join(first, rows.conv.eqNullSafe(first.of) & (F.col("digest") == F.col("same")), "left")
    return materialize(both.select("conv", "at", "role", "text", "digest", "blank", "cut", F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("again"), "dropped"))


def in_order(rows: DataFrame, *lead: str) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions("conv", *lead, "at", "role", "digest")


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """(conv, COUNTS, audit) for each conversation of flagged(): a task passes over the sorted rows and holds one byte a row of one conversation."""
    schema = "conv " + rows.schema["conv"].dataType.simpleString() + ", " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
    cols = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(c, pa.int64() if c in COUNTS else pa.string()) for c in cols])

    def judged(stream: Iterator[tuple]) -> Iterator[tuple]:
        legal = {("s", "u"), ("u", "a"), ("a", "u")}
        row = next(stream, None)
        while row is not None:
            conv, codes, turns, least, most = row[0], bytearray(), 0, None, None
            n = dict.fromkeys(COUNTS, 0)
            before = None
            while row is not None and row[0] == conv:
                _, at, role, digest, blank, cut, again, dropped = row
                row = next(stream, None)
                if dropped:
                    continue
                here = (at["turn"], role, digest)
                fault = "blank" if blank else "duplicate" if again or here == before else "truncated" if cut else None
                if fault:
                    n[fault] += 1
                if at["turn"] is not None and (before is None or before[0] != at["turn"]):
                    turns, least, most = turns + 1, at["turn"] if least is None else least, at["turn"]
                n["illegal"] += before is not None and (before[1][:1], role[:1]) not in legal
                codes.append(INITIALS.get(role[:1], OTHER) | {"truncated": TRUNCATED, None: 0}.get(fault, MUST_GO))
                before = here
            n["gaps"] = most - least + 1 - turns if turns else 0
            n["cost"], audit = cheapest(bytes(codes)) if codes else (0, "")
            yield conv, *n.values(), audit

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed_rows(judged(records(batches)), batch_schema, 4096)

    compact = in_order(rows.select("conv", "at", "role", "digest", "blank", "cut", "again", "dropped"))
    batch_schema = arrow.set(0, pa.field("conv", arrow_type(rows, "conv")))
    return compact.mapInArrow(work, schema)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def packed_rows(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation in order, each conversation led by its row of audits()."""
    none = F.lit(None).cast("string")
    result = F.struct(*[F.col(c) for c in (*COUNTS, "audit")])
    heads = found.select("conv", F.lit(0).alias("place"), F.struct(F.lit(False).alias("known"), F.lit(None).cast("long").alias("turn")).alias("at"), none.alias("role"), none.alias("text"), none.alias("digest"), result.alias("result"))
    body = rows.where(~F.col("dropped")).select("conv", F.lit(1).alias("place"), "at", "role", "text", "digest", F.lit(None).cast(heads.schema["result"].dataType).alias("result"))
    return in_order(heads.unionByName(body), "place").select("conv", "role", "text", "result")


def edited(stream: Iterator[tuple], heads: bool = False) -> Iterator[tuple]:
    """(conv, edit, role, text) for every edit of the audits, in order; with `heads` also (conv, None, result, None) before each conversation's."""
    for conv, _, _, result in stream:
        due = "user"
        if heads:
            yield conv, None, result, None
        for edit in result["audit"]:
            role, text = (due, "") if edit == "I" else next(stream)[1:3]
            if edit == "R":
                role = due
            if edit != "D" and not (edit == "K" and role[:1] == "s"):
                due = "assistant" if due == "user" else "user"
            yield conv, edit, role, text


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv, position, edit, role, text): the turns of each repaired conversation, numbered from 0, and what became of each; deleted rows are left out.

    `rows` has conv, turn, role, text and dropped (rows that only name their conversation). Null roles and texts are one space, null
    turns come first, rows of one turn go by role and then by the digest of role and text. A row's first fault counts: no visible
    character, role and text of a row before it, no full stop at the end. An empty table gives no rows. Other columns are not read.
    The rows of a conversation are read in one task, which holds one byte a row.
    """
    marked = flagged(rows)
    full = with_audits(marked, audits(marked))
    schema = pa.schema([("conv", arrow_type(rows, "conv")), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def numbered(stream: Iterator[tuple]) -> Iterator[tuple]:
        position = 0
        for conv, edit, role, text in edited(stream, heads=True):
            if edit is None:
                position = 0
            elif edit != "D":
                yield conv, position, edit, role, text
                position += 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed_rows(numbered(records(batches)), schema, 512)
    return full.mapInArrow(work, f"conv {rows.schema['conv'].dataType.simpleString()}, position long, edit string, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """(conv, COUNTS, audit, repaired_sha256) for every conv of `rows`, as repaired_turns() reads and repairs them.

    gaps are missing numbers between the smallest and the largest turn; blank, duplicate and truncated count rows by their first fault, illegal
    neighbours whose initials are not su, ua or au. The digest is of `role:text` lines, hashed as they are read. A conversation
    without rows has zeros, an empty audit and the digest of nothing.
    """
    marked = flagged(rows)
    full = with_audits(marked, audits(marked))
    schema = pa.schema([("conv", arrow_type(rows, "conv")), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def hashed(stream: Iterator[tuple]) -> Iterator[tuple]:
        head, digest = None, hashlib.sha256()
        for conv, edit, role, text in edited(stream, heads=True):
            if edit is None:
                if head:
                    yield *head, digest.hexdigest()
                head, digest, between = (conv, *role.values()), hashlib.sha256(), b""
            elif edit != "D":
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        if head:
            yield *head, digest.hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed_rows(hashed(records(batches)), schema, 4096)
    return full.mapInArrow(work, f"conv {rows.schema['conv'].dataType.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, dropped): by crc32 of `conv_id:turn` (nulls: one space) modulo 20, rows are dropped, emptied, stripped of full stops, repeated or given to the user."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")) % 20
    text = F.when(h == 1, F.lit("")).when(h == 2, F.translate(filled("text"), "".join(ENDS), "")).otherwise(filled("text"))
    role = F.when(h == 4, F.lit("user")).otherwise(filled("role"))
    twice = F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"), (h == 0).alias("dropped"), twice.alias("copy")).drop("copy")


def op12_conversation_repair(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


REPAIR_SQL = f"""
with recursive {CRC_SQL.strip()},
o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
h as (select o.*, {crc_sql("name")} % 20 as h from o, crc_table),
d as (select conv_id, turn, case when h = 4 then 'user' else role end as role, case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text,
             unnest(case when h = 3 then [0, 1] else [0] end) as copy from h where h <> 0),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text), copy) as i,
             row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen, regexp_replace(text, '[ \\t-\\r]+', '', 'g') as solid from d),
f as (select *, case when solid = '' then 'blank' when seen > 1 then 'duplicate' when right(solid, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault, left(role, 1) as r,
             lag(left(role, 1)) over (partition by conv_id order by i) as before from n),
c as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
             count(*) filter (where fault = 'truncated') as truncated, count(*) filter (where before is not null and before || r not in ('su', 'ua', 'au')) as illegal,
             list({{'r': r, 'go': fault in ('blank', 'duplicate'), 'x': case when fault = 'truncated' then 3 else 0 end}} order by i) as codes, list(role order by i) as roles, list(text order by i) as texts, count(*) as n
      from f group by conv_id),
p as (select conv_id, codes, 0 as i, {{'c': 0, 'w': ''}} as st, {{'c': 1000000000, 'w': ''}} as op, {{'c': 1000000000, 'w': ''}} as us, {{'c': 1000000000, 'w': ''}} as an from c
      union all
      select conv_id, codes, i + 1, {{'c': st.c + 4, 'w': st.w || 'D'}}, list_min([{{'c': op.c + 4, 'w': op.w || 'D'}}, {{'c': case when k.r = 's' and not k.go then st.c + k.x else 1000000000 end, 'w': st.w || 'K'}}]),
             list_min([{{'c': u1.c + 4, 'w': u1.w || 'D'}}, {{'c': case when k.go then 1000000000 when k.r = 'a' then a1.c + k.x else a1.c + 3 + k.x end, 'w': a1.w || case when k.r = 'a' then 'K' else 'R' end}}]),
             list_min([{{'c': a1.c + 4, 'w': a1.w || 'D'}}, {{'c': case when k.go then 1000000000 when k.r = 'u' then t1.c + k.x else t1.c + 3 + k.x end, 'w': t1.w || case when k.r = 'u' then 'K' else 'R' end}}])
      from (select *, list_min([u1, st, op]) as t1 from (select *, codes[i + 1] as k, list_min([us, {{'c': an.c + 3, 'w': an.w || 'I'}}]) as u1,
              list_min([an, {{'c': us.c + 3, 'w': us.w || 'I'}}, {{'c': st.c + 3, 'w': st.w || 'I'}}, {{'c': op.c + 3, 'w': op.w || 'I'}}]) as a1 from p where i < len(codes)))),
e as (select conv_id, list_min([st, us, {{'c': an.c + 3, 'w': an.w || 'I'}}]) as best from p where i = len(codes)),
l as (select conv_id, w, unnest(range(1, length(w) + 1)) as j, substr(w, cast(unnest(range(1, length(w) + 1)) as integer), 1) as letter from (select conv_id, best.w as w from e)),
m as (select *, sum(case when letter <> 'I' then 1 else 0 end) over (partition by conv_id order by j) as row from l),
q as (select m.conv_id, j, letter, case when letter <> 'I' then c.roles[cast(row as bigint)] end as role, case when letter <> 'I' then c.texts[cast(row as bigint)] else '' end as text from m join c on c.conv_id is not distinct from m.conv_id where letter <> 'D'),
s as (select *, sum(case when letter = 'K' and left(role, 1) = 's' then 0 else 1 end) over (partition by conv_id order by j) as place from q),
z as (select conv_id, string_agg(case when letter = 'K' then role when place % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by j) as repaired from s group by conv_id),
a as (select distinct conv_id from conversations)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce(best.c, 0) as cost, coalesce(best.w, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from a left join c on a.conv_id is not distinct from c.conv_id left join e on a.conv_id is not distinct from e.conv_id left join z on a.conv_id is not distinct from z.conv_id
"""

QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES = {"op12_conversation_repair": REPAIR_SQL}
