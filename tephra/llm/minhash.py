"""Near-duplicate documents by MinHash with tensored banding, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize
from .common import WORD_BYTES, add_by_text, table

MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a task remembers at a time.
REMEMBER = 200_000
#: Words of 64 bits in a set's parity bitmap.
PARITY = 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBER:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles; a text of fewer words is one shingle, a wordless one none."""
    words = text.encode().translate(WORD_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * MULTIPLY + h[k:k + len(out)])
    return np.unique(out)


class Collections:
    """Two collections of `tables` bands of `rows` min-hashes each. A table of the index pairs a band of one with a band of the other, so
    2 * tables * rows min-hashes make tables ** 2 tables of 2 * rows rows."""

    def __init__(self, tables: int, rows: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.tables, self.rows = tables, rows
        self.flip = rng.integers(0, 1 << 63, 2 * tables * rows, dtype=np.uint64)
        self.times = rng.integers(0, 1 << 63, 2 * tables * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        """2 * tables values; those of the first collection lead."""
        least = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            least = np.minimum(least, ((shingles[at:at + 4096] ^ self.flip[:, None]) * self.times[:, None]).min(axis=1))
        out = np.zeros(2 * self.tables, np.uint64)
        for column in least.reshape(2 * self.tables, self.rows).T:
            out = mixed(out * MULTIPLY + column)
        return out.view(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """A bitmap in which each shingle flips one bit. Two sets' bitmaps differ in at most as many bits as their symmetric difference has members."""
    bits = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(bool)).view(np.int64)


def signatures(docs: DataFrame, text_col: str, size: int, tables: int, rows: int) -> DataFrame:
    """`docs` without its text, with cls (a digest of the shingle set, null if it is empty), n_shingles, bands and parity."""
    def start():
        hashes, both = WordHashes(), Collections(tables, rows)

        def work(texts: list[str]) -> list[list]:
            sets = [shingle_set(t, size, hashes) for t in texts]
            return [[hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], [len(s) for s in sets],
                    [both.bands(s) if len(s) else None for s in sets], [parity(s) if len(s) else None for s in sets]]
        return work
    return add_by_text(docs, text_col, "cls string, n_shingles long, bands array<long>, parity array<long>", start, keep_text=False)


def index_rows(classes: DataFrame, tables: int) -> DataFrame:
    """(key, node, n, weight): one row for each table in which a class may meet another.

    A class meets another in table (i, j) only if both bands i and j are shared, so bands that no other class has are set aside
    first. weight is the number of classes behind a class's shared bands: the text that others were copied from has the most.
    """
    each = classes.select("node", "n", F.posexplode("bands").alias("band", "value"))
    met = materialize(each.groupBy("band", "value").agg(F.count("*").alias("size")).where(F.col("size") > 1))   # a table of its own: the join can split a busy band
    live = (each.join(met, ["band", "value"]).groupBy("node", "n")
            .agg(F.sum("size").alias("weight"), F.collect_list(F.when(F.col("band") < tables, F.struct("band", "value"))).alias("us"), F.collect_list(F.when(F.col("band") >= tables, F.struct("band", "value"))).alias("vs")))
    pairs = live.select("node", "n", "weight", F.explode("us").alias("u"), "vs").select("node", "n", "weight", "u", F.explode("vs").alias("v"))
    return pairs.select(F.xxhash64("u", "v").alias("key"), "node", "n", "weight")


def buckets_of(index: DataFrame) -> DataFrame:
    """(key, members, centre) of the buckets that hold two classes or more, one for each set of members: the many buckets that near copies share are one.

    The centre is the member of greatest weight. Sets are told apart by their size and two 64-bit sums of their members.
    """
    each = index.groupBy("key").agg(F.count("*").alias("members"), F.max(F.struct("weight", "node"))["node"].alias("centre"), F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(5), "node")).alias("s2"))
    return each.where(F.col("members") > 1).groupBy("members", "centre", "s1", "s2").agg(F.min("key").alias("key")).select("key", "members", "centre")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, total) for pairs (a, b): sizes of the intersection and union of the whole sets."""
    one = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    two = one.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return two.select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb")).alias("sum")).select("a", "b", "shared", (F.col("sum") - F.col("shared")).alias("total"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links` (a, b): the smallest id it is connected to.

    Alternates large-star and small-star steps until the links are stars: each step hangs neighbours on their smallest one.
    A step joins with a minimum per vertex, combined before the shuffle; a hub's links are split by adaptive execution. Each round is
    written to the shared folder.
    """
    edges = materialize(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = materialize(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(materialize(large.groupBy("u").agg(F.min("v").alias("m"))), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        edges = materialize(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = now


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, tables: int = 16, rows: int = 3) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of `docs`: groups of texts linked by 100 * intersection >= percent * union of their
    distinct `size`-word shingles (64-bit hashes).

    Rows with equal sets form a class, the node of the graph. Classes meet in tensored tables: with 16 bands of three
    min-hashes a side, a pair at 0.8 is missed with probability 2 * (1 - 0.8 ** 3) ** 16, about 2 in 100,000, and less above. In each
    bucket every class is compared with one centre, the class with most shared bands, never all with all. Where some then still lie in
    another component than a centre they met, all that met this centre are open, and links between open classes are found without loss: two sets that
    link share one of their rarest shingles (see rare_rows()). Open classes that share one are first compared with one drawn member for each such shingle; what
    stays apart is compared pair by pair, except where the shingle's places, sizes or parity bitmaps prove that a pair cannot link. One rule serves groups of any size.

    Null, empty and wordless texts have no shingles and link with nothing, as do rows without an id (component null, kept). Rows that
    repeat an id are one document: linked to what either is, and kept or not alike.
    """
    found = signatures(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "text", size, tables, rows)
    found = materialize(found.withColumn("node", F.when(F.col("cls").isNotNull(), F.xxhash64("cls"))))
    classes = found.where(F.col("id").isNotNull() & F.col("cls").isNotNull()).groupBy("node").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity"))
    classes = materialize(classes)
    index = materialize(index_rows(classes, tables))
    met = materialize(index.select("key", "node").join(materialize(buckets_of(index)), "key").groupBy("centre", "node").agg(F.max("members").alias("members")))
    drop_materialized(index)
    first = met.where(F.col("node") != F.col("centre")).select(F.col("centre").alias("a"), F.col("node").alias("b"))
    sets = shingle_sets(docs, met.select("node").distinct(), classes, id_col, text_col, size)
    linked = lambda df: df.where(100 * F.col("shared") >= percent * F.col("total")).select("a", "b")
    groups = components(linked(overlaps(first, sets)).unionByName(one_document(found)))
    rare = materialize(rare_rows(open_classes(met, groups), sets, percent))
    for pairs in (second_stars, leftover_pairs):
        more = materialize(linked(overlaps(materialize(pairs(apart_rows(rare, groups, classes), percent)), sets)))
        if more.limit(1).count():                                  # the stars found so far stand for their links
            groups = components(groups.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    for done in (met, sets, rare):                                 # groups is a table of its own by now
        drop_materialized(done)
    return labelled(found, classes, groups)


def one_document(found: DataFrame) -> DataFrame:
    """(a, b): classes that one id holds, each with the least of them."""
    several = found.where(F.col("id").isNotNull() & F.col("node").isNotNull()).groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where(F.col("a") != F.col("z"))
    return found.join(materialize(several), "id").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, shingles) of the classes that met another."""
    wanted = wanted.join(classes.select("node", "rep"), "node")
    texts = docs.select(F.col(f"`{id_col}`").alias("rep"), F.col(f"`{text_col}`").alias("text")).join(wanted, "rep")

    def start():
        hashes = WordHashes()

        def work(batch: list[str]) -> list[list]:
            sets = [shingle_set(t, size, hashes) for t in batch]
            return [[hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets], [s.view(np.int64) for s in sets]]
        return work
    sets = add_by_text(texts, "text", "cls string, shingles array<long>", start, keep_text=False)
    return materialize(sets.where(F.xxhash64("cls") == F.col("node")).dropDuplicates(["node"]).select("node", "shingles"))


def open_classes(met: DataFrame, groups: DataFrame) -> DataFrame:
    """(node): the classes that met a centre in a bucket of three or more, where some class that did lies in another component than that centre."""
    group = lambda of, name: groups.select(F.col("id").alias(of), F.col("component").alias(name))
    at = met.where(F.col("members") > 2).select("centre", "node")          # a bucket of two is done
    of = at.join(group("node", "g"), "node", "left").join(group("centre", "h"), "centre", "left")
    strays = of.where(F.coalesce("g", "node") != F.coalesce("h", "centre")).select("centre").distinct()
    return materialize(at.join(materialize(strays), "centre", "left_semi").select("node").distinct())


def rare_rows(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, place): each set's rarest shingles among the open classes, so many that two sets which link must share one.

    All sets are put in one order, by the number of open classes that hold a shingle, then by its hash. If the first shingle that two sets share is number `place` of
    n, they share n - place + 1 at most; below percent of n no set can link. Shingles of one class count for the places but make no row.
    """
    each = materialize(sets.join(open_, "node").select("node", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("key")))
    held = materialize(each.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > 1))
    # those of one class lead every order, so that their number is all that counts
    ranked = each.join(held, "key").withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("held", "key")))
    alone = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    places = ranked.withColumn("place", alone + F.col("at"))
    return places.where(100 * (F.col("n") - F.col("place") + 1) >= percent * F.col("n")).select("key", "node", "n", "place")


def apart_rows(rare: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of the rare shingles that classes of several components share, with the component and the parity words."""
    at = rare.join(groups.select(F.col("id").alias("node"), F.col("component").alias("g")), "node", "left").withColumn("g", F.coalesce("g", "node"))
    at = materialize(at)
    several = materialize(at.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where(F.col("lo") != F.col("hi")).select("key"))
    words = [F.get("parity", k).alias(f"p{k}") for k in range(PARITY)]
    return materialize(at.join(several, "key", "left_semi").join(classes.select("node", *words), "node"))


def could_link(x: str, y: str, percent: int) -> Column:
    """Different components, and places, sizes and bitmaps that allow a link: what follows the first shared shingle is all that two sets can share; as many bits as differ,
    as many members at least are not shared."""
    apart = sum((F.bit_count(F.col(f"{x}.p{k}").bitwiseXOR(F.col(f"{y}.p{k}"))) for k in range(1, PARITY)), F.bit_count(F.col(f"{x}.p0").bitwiseXOR(F.col(f"{y}.p0"))))
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    rest = F.least(F.col(f"{x}.n") - F.col(f"{x}.place"), F.col(f"{y}.n") - F.col(f"{y}.place")) + 1
    return ((F.col(f"{x}.g") != F.col(f"{y}.g")) & (100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n"))
            & ((100 + percent) * rest >= percent * both)
            & (100 * (both - apart) >= percent * (both + apart)))          # intersection (both - apart) / 2 at most, union (both + apart) / 2 at least


def second_stars(at: DataFrame, percent: int) -> DataFrame:
    """(a, b): the holders of each rare shingle against one drawn by hash, another for every shingle: what links at all mostly finds a link so."""
    drawn = at.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node").alias("by"), *[c for c in at.columns if c != "key"])).alias("c"))
    pairs = at.alias("x").join(materialize(drawn.select("key", "c.*")).alias("y"), (F.col("x.key") == F.col("y.key")) & could_link("x", "y", percent))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def second_keys(sets: DataFrame, bands: int = 128, rows: int = 16) -> DataFrame:
    """(key, node, n): `bands` further bands of `rows` min-hashes each, for the members of large buckets alone. A pair at 0.8 shares one with probability
    1 - (1 - 0.8 ** 16) ** 128, 0.97; a pair at 0.56 with 0.01, where two bands of the index let nine in ten meet."""
    def work(batches):
        both = Collections(bands // 2, rows, seed=21)
        for batch in batches:
            for node, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = both.bands(values.values.to_numpy().view(np.uint64)) ^ np.arange(bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(bands, node)), pa.array(np.full(bands, len(values.values)))], names=["key", "node", "n"])
    return sets.select("node", "shingles").mapInArrow(work, "key long, node long, n long")


def leftover_pairs(at: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that share a rare shingle and could still link. The smaller set of a pair shares more than `percent` of itself, so fewer of its shingles are looked at."""
    x, y = at.alias("x"), at.where((100 + percent) * (F.col("n") - F.col("place") + 1) >= 2 * percent * F.col("n")).alias("y")
    smaller = (F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.node") < F.col("x.node")))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & smaller & could_link("x", "y", percent)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def labelled(found: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with the smallest id of its component; a class that links with nothing is a component."""
    of = classes.select("node", "rep").join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    of = materialize(of)
    least = materialize(of.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("classes")).where(F.col("classes") > 1))
    named = of.join(least, "component", "left").select(F.col("node").alias("of_node"), F.coalesce("least", "rep").alias("component_id"))
    out = found.select("id", "n_shingles", "node").join(named, F.col("node") == F.col("of_node"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select("id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` without those whose group has a smaller id; the options are those of near_groups()."""
    gone = near_groups(docs, id_col, text_col, **options).where(~F.col("kept")).select(F.col("id").alias("gone_id")).distinct()
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("own_id")).join(gone, F.col("own_id") == F.col("gone_id"), "left_anti")
    return kept.select("doc.*")


def op9_near_dedup(spark, sf_dir):
    out = near_groups(table(spark, sf_dir, "documents"), size=2)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


NEAR_SQL = """
with recursive d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) = 1 then [w] else list_transform(range(1, len(w)), lambda p: list_slice(w, p, p + 1)) end) as s from d),
c as (select s, min(doc_id) as rep, hash(s) as h from s where len(s) > 0 group by s),
x as (select rep, len(s) as n, unnest(s) as g from c),
k as (select a.rep as p, b.rep as q, count(*) as m, any_value(a.n) as np, any_value(b.n) as nq from x a join x b on a.g = b.g and a.rep < b.rep and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) group by a.rep, b.rep),
l as (select p, q from k where 100 * m >= 80 * (np + nq - m)),
e as (select p as a, q as b from l union all select q, p from l),
r as (select rep as id, rep as root from c union select e.b, r.root from r join e on e.a = r.id),
z as (select id, min(root) as root from r group by id)
select s.doc_id, len(s.s) as n_shingles, coalesce(z.root, s.doc_id) as component_id, coalesce(z.root, s.doc_id) = s.doc_id as kept from s left join c on c.s = s.s left join z on z.id = c.rep
"""

QUERIES = {"op9_near_dedup": op9_near_dedup}
ORACLES = {"op9_near_dedup": NEAR_SQL}
