"""Personal data: patterns of its own form first, then what stands in the contexts in which that is found. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLANKS, LOWER, UPPER, let, packed, table, unpacked

#: Fixed order of the kinds, and of spans that start together.
KINDS = ["email", "ip", "card", "phone"]
#: The patterns, written so that no match recurses or tries a long run of characters from each of its places: a match starts
#: where its run of characters does or where the last match ended, and what cannot be given back is possessive.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What makes a text worth a pattern's pass.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
#: Whatever may be an identifier: words around an at sign, and digits with little between them.
ITEMS = {"mail": r"(?<![^\x20\x09-\x0D@])[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D@]++", "number": r"\+?\(?[0-9](?:[\x20()./:-]{0,3}+[0-9])*+"}
#: Characters that may touch an identifier on its left and right, besides blanks.
BEFORE, AFTER = "\"'([{<:=,;", "\"')]}>.,;:!?"
#: Stripped from words of a context.
MARKS = ".,;:!?\"'()[]{}<>="
#: Slots of the table that tells which contexts are worth counting: one byte each, whatever the corpus.
SLOTS = 1 << 18


def running(lengths: Column) -> Column:
    """Running sums of an array, in blocks of its size's root: a fold that appends to an array copies it each time."""
    def sums(xs: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(xs))).cast("int")

        def block(b: Column) -> Column:
            before = F.aggregate(F.slice(xs, F.lit(1), b * step), F.lit(0), lambda s, x: s + x)
            start = F.struct(before.alias("sum"), F.array().cast("array<int>").alias("out"))
            return F.aggregate(F.slice(xs, b * step + 1, step), start, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"] + x)).alias("out")))["out"]
        return F.when(F.size(xs) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / step).cast("int")), block))).otherwise(F.array().cast("array<int>"))
    return let(lengths, sums)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<before, match, after, end>>: every match, the pieces of text on both sides of it, and where it ends in code points."""
    both = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def zipped(s: Column) -> Column:
        ends = running(F.zip_with(F.slice(s["pieces"], F.lit(1), F.size(s["found"])), s["found"], lambda p, m: F.char_length(p) + F.char_length(m)))
        return F.arrays_zip(F.slice(s["pieces"], F.lit(1), F.size(s["found"])).alias("before"), s["found"].alias("match"), F.slice(s["pieces"], F.lit(2), F.size(s["found"])).alias("after"), ends.alias("end"))
    return let(both, zipped)


def digits_of(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, "0123456789", ""))


def luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def parts_fit(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.char_length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255)))


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": parts_fit,
    "card": lambda m: let(F.translate(m, " -", ""), lambda d: F.when(F.char_length(d).between(14, 19), luhn(d)).otherwise(False)),
    "phone": lambda m: digits_of(m).between(10, 15),
}
SPANS = "array<struct<start:int,place:int,end:int>>"


def base_spans(text: Column) -> Column:
    """array<struct<start, place, end>>, sorted: leftmost matches of each kind, without those that fail its test; `place` is the kind's in KINDS."""
    def of_kind(place: int, kind: str) -> Column:
        valid = F.filter(matches(text, PATTERNS[kind]), lambda m: VALID[kind](m["match"]))
        found = F.transform(valid, lambda m: F.struct((m["end"] - F.char_length(m["match"])).alias("start"), F.lit(place).alias("place"), m["end"].alias("end")))
        return F.when(text.rlike(NEEDS[kind]), found).otherwise(F.array().cast(SPANS))
    return F.array_sort(F.concat(*[of_kind(place, kind) for place, kind in enumerate(KINDS)]))


def bare(word: Column) -> Column:
    """A word of a context: marks stripped, digits and at signs make it a `#`."""
    return F.when(word.rlike("[0-9@#]"), F.lit("#")).otherwise(F.btrim(word, F.lit(MARKS)))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER + BLANKS, LOWER + " " * len(BLANKS)), " "), "")


def contexts(l2: str, l1: str, r1: str, r2: str) -> list[Column]:
    """Three lexical patterns: the two words before, the words on both sides, the two words after. 64-bit hashes."""
    return [F.xxhash64(F.lit(1), l2, l1), F.xxhash64(F.lit(2), l1, r1), F.xxhash64(F.lit(3), r1, r2)]


def items_of(base: DataFrame) -> DataFrame:
    """(id, version, start, end, value, seed, fits, keys) of everything that may be an identifier in `base` (id, version, text).

    seed is the kind that it has by its own form, else null; fits are the kinds that its form allows. Neighbouring items are `#` to each other.
    """
    of = lambda form: F.when(F.col("text").rlike({"mail": "@", "number": "[0-9]"}[form]), matches(F.col("text"), ITEMS[form]))
    each = [base.select("id", "version", F.lit(form).alias("form"), F.posexplode(of(form)).alias("k", "m"), F.size(of(form)).alias("n")) for form in ITEMS]
    rows = each[0].unionByName(each[1]).select("id", "version", "form", "k", "n", "m.*")
    rows = rows.select("*", F.right("before", F.lit(1)).alias("touches"), F.left("after", F.lit(1)).alias("touched"), words_of(F.col("before")).alias("left"), words_of(F.col("after")).alias("right"))
    alone = lambda c, marks: (F.col(c) == "") | F.lit(BLANKS + marks).contains(F.col(c))
    rows = rows.where(alone("touches", BEFORE) & alone("touched", AFTER))
    start = lambda far: F.when(F.col("k") == 0, F.lit("^")).otherwise(F.lit("#"))
    stop = F.when(F.col("k") == F.col("n") - 1, F.lit("$")).otherwise(F.lit("#"))
    rows = rows.select("id", "version", "form", "match", "end", F.coalesce(bare(F.get("left", F.size("left") - 2)), start(2)).alias("l2"), F.coalesce(bare(F.get("left", F.size("left") - 1)), start(1)).alias("l1"),
                       F.coalesce(bare(F.get("right", F.lit(0))), stop).alias("r1"), F.coalesce(bare(F.get("right", F.lit(1))), stop).alias("r2"))
    m, n = F.col("match"), digits_of(F.col("match"))
    whole = lambda kind: m.rlike(f"^(?:{PATTERNS[kind]})$") & VALID[kind](m)
    seed = F.coalesce(*[F.when(whole(kind), F.lit(place)) for place, kind in enumerate(KINDS)])
    number = F.col("form") == "number"
    fits = {"email": ~number, "ip": number & m.rlike(r"^[0-9]+(?:[.:][0-9]+){3,}$"), "card": number & n.between(12, 19), "phone": number & n.between(7, 15)}
    places = F.array_compact(F.array(*[F.when(fits[kind], F.lit(place)) for place, kind in enumerate(KINDS)]))
    return rows.select("id", "version", (F.col("end") - F.char_length(m)).alias("start"), "end", F.translate(m, UPPER + " ", LOWER).alias("value"), seed.alias("seed"), places.alias("fits"),
                       F.array(*contexts("l2", "l1", "r1", "r2")).alias("keys"))


def slot_words(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(key, words): how often plain words stand in the contexts of `patterns`, over all texts.

    A byte table of a fixed number of slots drops most other contexts where they are made; counts are combined before the shuffle, and
    the join keeps exactly the patterns. With very many patterns the table lets more through, and nothing else changes.
    """
    marked = np.zeros(SLOTS, np.uint8)
    slot = lambda key: F.pmod(key, F.lit(SLOTS))
    bits = patterns.select(slot(F.col("key")).alias("slot")).groupBy(F.expr("slot div 32768").alias("piece")).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits"))
    for row in bits.toLocalIterator():                             # eight rows at most
        marked[row.piece * 32768:(row.piece + 1) * 32768] = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
    known = F.lit(bytes(marked))
    words = F.transform(words_of(F.col("text")), bare)
    padded = texts.select(F.concat(F.array(F.lit("^"), F.lit("^")), words, F.array(F.lit("$"), F.lit("$"))).alias("w"))
    windows = padded.select(F.explode(F.arrays_zip(*[F.slice("w", F.lit(k + 1), F.size("w") - 4).alias(c) for k, c in enumerate(("l2", "l1", "at", "r1", "r2"))])).alias("x")).select("x.*")
    keys = windows.where((F.col("at") != "#") & (F.col("at") != "")).select(*[k.alias(f"k{j}") for j, k in enumerate(contexts("l2", "l1", "r1", "r2"))])
    each = keys.select(F.explode(F.array("k0", "k1", "k2")).alias("key")).where(F.substring(known, (slot(F.col("key")) + 1).cast("int"), F.lit(1)) == F.lit(b"\x01"))
    counted = each.groupBy("key").agg(F.count("*").alias("words"))
    return patterns.select("key").join(counted, "key", "left").select("key", F.coalesce("words", F.lit(0)).alias("words"))


def scored(items: DataFrame, texts: DataFrame, least_values: int, least_trust: int, accept: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(key, place, trust) of patterns and (value, place, score) of unseen values, in thousandths, after `rounds` passes over the graph
    of patterns and the distinct values found in them.

    A pattern's trust for a kind is the sum of its values' scores over everything that fills it, other kinds, unknown values and plain
    words included; it needs `least_values` sure values. Seeds score 1000 for their kind for good. An unseen value of
    fitting form scores what the trusted patterns (`least_trust`) around it leave of doubt when they err independently, and counts for
    the next round from `accept` on.
    """
    edges = items.select(F.explode("keys").alias("key"), "value", "seed", "fits").distinct()
    size = edges.groupBy("key").agg(F.count("*").alias("values")).where(F.col("values") >= least_values)
    size = materialize(size)
    words = slot_words(texts, size)
    total = materialize(size.join(words, "key").select("key", (F.col("values") + F.col("words")).alias("total")))
    edges = materialize(edges.join(total.select("key"), "key"))
    score = None
    for _ in range(rounds):
        sure = edges.where(F.col("seed").isNotNull()).select("key", F.col("seed").alias("place"), F.lit(1000).cast("long").alias("score"))
        if score is not None:
            sure = sure.unionByName(edges.where(F.col("seed").isNull()).join(score.where(F.col("score") >= accept), "value").select("key", "place", "score"))
        gained = sure.groupBy("key", "place").agg(F.sum("score").alias("gained")).where(F.col("gained") >= 1000 * least_values)
        trust = materialize(gained.join(total, "key").select("key", "place", F.expr("gained div total").alias("trust")).where(F.col("trust") >= least_trust))
        doubt = F.log((1000 - F.least("trust", F.lit(999))) / 1000)
        around = edges.where(F.col("seed").isNull()).join(trust, "key").where(F.array_contains("fits", F.col("place")))
        score = materialize(around.groupBy("value", "place").agg(F.floor(1000 * (1 - F.exp(F.sum(doubt))) + 1e-6).cast("long").alias("score")))
    return trust, score


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True, least_values: int = 5, least_trust: int = 500, accept: int = 700, rounds: int = 3) -> DataFrame:
    """`docs` with base and spans, array<struct<start, kind, end>> each: what its own form shows to be personal data, and all that is taken for it.

    Base entities are the seeds of a bootstrap. The words around them are lexical patterns; patterns and values found in them form a graph,
    scored in `rounds` passes (see scored()). An unseen identifier is added where its score is `accept` or more, a trusted
    pattern holds at that very place and no base span overlaps it; it gets the kind that scores highest, ties the first. Values
    count once in a pattern, so copies of a document prove nothing more. Patterns are 64-bit hashes.

    Null and empty texts have no spans. Rows without an id, and repeated rows, are treated by their text like all others. An empty table gives
    no rows. Extra columns stay; base and spans are replaced. Without `keep` only id and spans return, and no text is written.
    """
    base = packed(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("version", F.xxhash64("text"))
    own = materialize(base.select(*(["doc"] if keep else []), "id", "version", base_spans(F.col("text")).alias("base")))
    items = materialize(items_of(base.select("id", "version", "text").where(F.col("text").rlike("[0-9@]"))))
    trust, score = scored(items, base.select("text"), least_values, least_trust, accept, rounds)
    # the best kind of each unseen value; then the places where a pattern of that kind stands around it
    best = score.where(F.col("score") >= accept).groupBy("value").agg(F.max(F.struct("score", (-F.col("place")).alias("p"))).alias("b")).select("value", (-F.col("b.p")).alias("place"))
    placed = items.where(F.col("seed").isNull()).select("id", "version", "start", "end", "value", F.explode("keys").alias("key")).join(materialize(best), "value").join(trust.select("key", "place"), ["key", "place"])
    found = placed.groupBy("id", "version").agg(F.array_sort(F.collect_set(F.struct("start", "place", "end"))).alias("found"))
    own, found = own.alias("o"), materialize(found).alias("f")
    both = own.join(found, F.col("o.id").eqNullSafe(F.col("f.id")) & (F.col("o.version") == F.col("f.version")), "left")
    apart = F.filter(F.coalesce("found", F.array().cast(SPANS)), lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    named = lambda spans: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.get(F.array(*map(F.lit, KINDS)), x["place"]).alias("kind"), x["end"].alias("end")))
    out = {"base": named(F.col("base")), "spans": named(F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", apart))))}
    return unpacked(both, docs.columns, **out) if keep else both.select(F.col("o.id").alias("id"), *[v.alias(c) for c, v in out.items()])


def op11_personal_data(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents"), keep=False)
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(F.col("id").alias("doc_id"), *map(of, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The contract's own forms of the patterns, for an engine without look-behind and possessive quantifiers.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": PATTERNS["phone"],
    "mail": r"[^\x20\x09-\x0D@]+@[^\x20\x09-\x0D@]+", "number": r"\+?\(?[0-9](?:[\x20()./:-]{0,3}[0-9])*",
}
VALID_SQL = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda q: length(ltrim(q, '0')) > 3 or coalesce(try_cast(ltrim(q, '0') as integer), 0) > 255)) = 0",
    "card": "length(regexp_replace(m, '[ -]', '', 'g')) between 14 and 19 and list_sum(list_transform(range(1, length(regexp_replace(m, '[ -]', '', 'g')) + 1), lambda i: "
            "(case when i % 2 = 1 then 1 else 2 end) * cast(substr(reverse(regexp_replace(m, '[ -]', '', 'g')), cast(i as integer), 1) as integer) "
            "- case when i % 2 = 0 and substr(reverse(regexp_replace(m, '[ -]', '', 'g')), cast(i as integer), 1) > '4' then 9 else 0 end)) % 10 = 0",
    "phone": "length(regexp_replace(m, '[^0-9]', '', 'g')) between 10 and 15",
}


def matches_sql(name: str, pattern: str) -> str:
    """CTE `name`: (rid, k, n, before, m, after, s, e) of every match."""
    return f"""
{name}_a as (select rid, string_split_regex(t, {quoted(pattern)}) as p, regexp_extract_all(t, {quoted(pattern)}) as x from d),
{name}_b as (select rid, p, x, unnest(range(1, len(x) + 1)) as k from {name}_a),
{name} as (select rid, k, len(x) as n, p[k] as before, x[k] as m, p[k + 1] as after, list_sum(list_transform(p[1:k], lambda y: length(y))) + coalesce(list_sum(list_transform(x[1:k - 1], lambda y: length(y))), 0) as s, s + length(m) as e from {name}_b)"""


def personal_sql(least_values: int = 5, least_trust: int = 500, accept: int = 700, rounds: int = 3) -> str:
    bare_sql = f"case when regexp_matches(w, '[0-9@#]') then '#' else trim(w, {quoted(MARKS)}) end"
    words_sql = lambda c: f"list_transform(list_filter(string_split_regex(translate({c}, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''), lambda w: {bare_sql})"
    valid = [f"select rid, {place} as place, s, e from {kind} where {VALID_SQL[kind]}" for place, kind in enumerate(KINDS)]
    whole = [f"when regexp_full_match(m, {quoted(PLAIN[kind])}) and ({VALID_SQL[kind]}) then {place}" for place, kind in enumerate(KINDS)]
    digits = "length(regexp_replace(m, '[^0-9]', '', 'g'))"
    fits = f"list_filter([case when form = 'mail' then 0 end, case when form = 'number' and regexp_matches(m, '^[0-9]+(?:[.:][0-9]+){{3,}}$') then 1 end, case when form = 'number' and {digits} between 12 and 19 then 2 end, case when form = 'number' and {digits} between 7 and 15 then 3 end], lambda y: y is not null)"
    keys = "['1|' || l2 || ' ' || l1, '2|' || l1 || ' ' || r1, '3|' || r1 || ' ' || r2]"
    steps, score = [], None
    for k in range(rounds):
        again = f" union all select key, place, score from edges join s{k - 1} using (value) where edges.seed is null and score >= {accept}" if k else ""
        steps.append(f"""
t{k} as (select key, place, sum(score) // any_value(total) as trust from (select key, seed as place, 1000 as score from edges where seed is not null{again}) join total using (key)
         group by key, place having sum(score) >= {1000 * least_values} and sum(score) // any_value(total) >= {least_trust}),
s{k} as (select value, place, cast(floor(1000 * (1 - exp(sum(ln((1000 - least(trust, 999)) / 1000.0)))) + 1e-6) as bigint) as score from edges join t{k} using (key) where seed is null and list_contains(fits, place) group by value, place)""")
    last = rounds - 1
    kinds = "[" + ", ".join(map(quoted, KINDS)) + "]"
    joined = lambda spans: f"array_to_string(list_transform({spans}, lambda y: {kinds}[y.p + 1] || ':' || y.s || ':' || y.e), ',')"
    of = lambda place: f"len(list_filter(base, lambda y: y.p = {place}))"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
{','.join(matches_sql(name, pattern) for name, pattern in PLAIN.items())},
base as ({' union all '.join(valid)}),
raw as (select 'mail' as form, * from mail union all select 'number', * from number),
near as (select *, {words_sql('before')} as lw, {words_sql('after')} as rw from raw
         where (before = '' or regexp_matches(right(before, 1), '[\\x20\\x09-\\x0D' || {quoted(chr(92) + chr(92).join(BEFORE))} || ']')) and (after = '' or regexp_matches(left(after, 1), '[\\x20\\x09-\\x0D' || {quoted(chr(92) + chr(92).join(AFTER))} || ']'))),
ctx as (select *, case when len(lw) >= 2 then lw[len(lw) - 1] when k = 1 then '^' else '#' end as l2, case when len(lw) >= 1 then lw[len(lw)] when k = 1 then '^' else '#' end as l1,
               case when len(rw) >= 1 then rw[1] when k = n then '$' else '#' end as r1, case when len(rw) >= 2 then rw[2] when k = n then '$' else '#' end as r2 from near),
items as (select rid, s, e, replace(translate(m, '{UPPER}', '{LOWER}'), ' ', '') as value, case {' '.join(whole)} end as seed, {fits} as fits, {keys} as keys from ctx),
edge as (select distinct unnest(keys) as key, value, seed, fits from items),
size as (select key, count(*) as vals from edge group by key having count(*) >= {least_values}),
pad as (select list_concat(['^', '^'], {words_sql('t')}, ['$', '$']) as w from d),
win as (select w[i - 2] as l2, w[i - 1] as l1, w[i] as a, w[i + 1] as r1, w[i + 2] as r2 from (select w, unnest(range(3, len(w) - 1)) as i from pad)),
slot as (select key, count(*) as words from (select unnest({keys}) as key from win where a <> '#' and a <> '') group by key),
total as (select size.key, vals + coalesce(words, 0) as total from size left join slot using (key)),
edges as (select edge.* from edge join size using (key)),
{','.join(steps)},
best as (select value, -max({{'c': score, 'p': -place}}).p as place from s{last} where score >= {accept} group by value),
hits as (select distinct i.rid, b.place, i.s, i.e from (select rid, s, e, value, unnest(keys) as key from items where seed is null) i join best b using (value) join t{last} t on t.key = i.key and t.place = b.place),
new as (select * from hits h where not exists (select 1 from base b where b.rid = h.rid and b.s < h.e and h.s < b.e)),
g as (select rid, list({{'s': s, 'p': place, 'e': e}} order by s, place, e) as base from base group by rid),
f as (select rid, list({{'s': s, 'p': place, 'e': e}} order by s, place, e) as spans from (select rid, place, s, e from base union all select rid, place, s, e from new) group by rid)
select doc_id, {', '.join(f"coalesce({of(place)}, 0) as n_{kind}" for place, kind in enumerate(KINDS))}, sha256(coalesce({joined('base')}, '')) as base_sha256, coalesce({joined('spans')}, '') as spans
from d left join g using (rid) left join f using (rid)
"""


QUERIES = {"op11_personal_data": op11_personal_data}
ORACLES = {"op11_personal_data": personal_sql()}
