"""Find benchmark passages in training documents and take them out."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, UPPER, add_by_text, packed, table, unpacked

#: A-Z become a-z; digits and bytes above 127 stay; all else parts words.
WORD_TABLE = bytes(ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if b >= 128 or chr(b) in LOWER + "0123456789" else 32 for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
STEP = np.uint64(0x9E3779B97F4A7C15)
HIT = "n_words long, n_hit long, items array<string>, hits array<int>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_TABLE).split()


def item_windows(bench: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(item, window): each run of `n` words of an item, or all words of a shorter one; a window once an item."""
    words = F.filter(F.split(F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " "), lambda w: w != "")
    split = bench.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1))
    return split.select("item", F.explode(F.array_distinct(F.transform(at, lambda i: F.slice(F.col("words"), i, n)))).alias("window")).distinct()


class WindowSet:
    """The windows of one block as hash sets over word numbers: a hash finds candidates, the words themselves confirm them."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.ids: dict[bytes, int] = {}
        self.exact: dict[int, dict[bytes, set[str]]] = {}
        for item, window in rows:
            numbers = np.array([self.ids.setdefault(w.encode(), len(self.ids) + 1) for w in window], np.int32)
            self.exact.setdefault(len(window), {}).setdefault(numbers.tobytes(), set()).add(item)
        self.hashes = {n: np.unique(self.hashed(np.array([np.frombuffer(k, np.int32) for k in keys]).ravel(), n)[::n]) for n, keys in self.exact.items()}

    @staticmethod
    def hashed(numbers: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(max(0, len(numbers) - n + 1), np.uint64)
        for k in range(n):
            out = out * STEP + numbers[k:k + len(out)].astype(np.uint64)
        return out ^ (out >> np.uint64(29))

    def find(self, texts: list[list[bytes]]) -> tuple[list[np.ndarray], list[set[str]]]:
        """For each text, which of its words are hit, and the items that occur."""
        known = self.ids.get
        starts = np.cumsum([0] + [len(w) + 1 for w in texts])                          # a 0 between texts: no window spans two
        numbers = np.zeros(starts[-1], np.int32)
        for at, words in zip(starts, texts):
            numbers[at:at + len(words)] = np.fromiter(map(known, words, repeat(0)), np.int32, len(words))
        hit, items = np.zeros(len(numbers), bool), [set() for _ in texts]
        upto = np.concatenate([[0], np.cumsum(numbers > 0)])
        for n, keys in self.exact.items():
            at = np.flatnonzero(upto[n:] - upto[:-n] == n) if len(numbers) >= n else np.zeros(0, int)  # all n words occur in some window
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h = h * STEP + numbers[at + k].astype(np.uint64)
            at = at[np.isin(h ^ (h >> np.uint64(29)), self.hashes[n])]
            for i in at:
                if found := keys.get(numbers[i:i + n].tobytes()):
                    hit[i:i + n] = True
                    items[int(np.searchsorted(starts, i, "right")) - 1] |= found
        return [hit[a:a + len(w)] for a, w in zip(starts, texts)], items


def hit_spans(text: str, hits: list[int]) -> list[tuple[int, int]]:
    """Byte ranges of the hit words; neighbouring ones join."""
    spans: list[list[int]] = []
    wanted, last = set(hits), -2
    for i, m in enumerate(WORD.finditer(text.encode().translate(WORD_TABLE))):
        if i in wanted:
            if i == last + 1:
                spans[-1][1] = m.end()
            else:
                spans.append([m.start(), m.end()])
            last = i
    return [tuple(s) for s in spans]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    data, out, at = text.encode(), [], 0
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]]).decode()


def blocks_of(bench: DataFrame, id_col: str, text_col: str, n: int, block_windows: int) -> list:
    """The windows in broadcasts of about `block_windows` each: their number is counted first, and more windows make more blocks, not larger ones."""
    windows = materialize(item_windows(bench, id_col, text_col, n))
    blocks = max(1, -(-windows.count() // block_windows))
    spark = bench.sparkSession
    part = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    return [spark.sparkContext.broadcast(WindowSet([(r.item, r.window) for r in windows.where(part == b).toLocalIterator()])) for b in range(blocks)]


def finder(block) -> Callable[[], Callable[[list[str]], list[list]]]:
    def start():
        windows = block.value

        def work(texts: list[str]) -> list[list]:
            words = [words_of(t) for t in texts]
            hit, items = windows.find(words)
            return [[len(w) for w in words], [int(h.sum()) for h in hit], [sorted(i) for i in items], [np.flatnonzero(h) for h in hit]]
        return work
    return start


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "item_id", bench_text: str = "text", text_col: str = "text", n: int = 10, block_windows: int = 200_000, keep_text: bool = True) -> DataFrame:
    """`docs` with n_words, n_hit, items (ids as sorted strings) and hits (positions of hit words).

    One block of windows, the usual case: a map over the documents without a shuffle. A benchmark of more windows is dealt
    over several blocks by hash; each block scans all documents, and the reports meet by document. Every text is scanned
    whole in either case.

    Null and empty texts have no words. Null, empty and wordless items have no window; items with equal texts all occur.
    Extra columns stay; the four new ones replace columns of their names.
    """
    blocks = blocks_of(bench, id_col, bench_text, n, block_windows)
    if len(blocks) == 1:
        return add_by_text(docs, text_col, HIT, finder(blocks[0]), keep_text)
    base = materialize(packed(docs, text_col, text_col).select("doc", "text").withColumn("row", F.expr("uuid()")))
    found = None
    for block in blocks:
        one = add_by_text(base.select("row", "text"), "text", HIT, finder(block), keep_text=False)
        found = one if found is None else found.unionByName(one.where(F.col("n_hit") > 0))   # the first reports every document
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    found = found.groupBy("row").agg(F.max("n_words").alias("n_words"), union("items").alias("items"), union("hits").alias("hits"))
    keep = [c for c in docs.columns if keep_text or c != text_col]
    return unpacked(base.join(found, "row"), keep, n_words=F.col("n_words"), n_hit=F.size("hits").cast("long"), items=F.col("items"), hits=F.col("hits"))


def decontaminate(docs: DataFrame, bench: DataFrame, action: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """The columns of `docs`. action "documents": those with a hit go; "spans": their hit words go, the rest of the text stays as it was.

    A null text has no hit and stays null.
    """
    inner = packed(docs, text_col, text_col).select("doc", "text")
    found = scan(inner, bench, text_col="text", **options)
    if action == "documents":
        return unpacked(found.where(F.col("n_hit") == 0), docs.columns)
    if action != "spans":
        raise ValueError(f"action is documents or spans, not {action}")

    @F.pandas_udf("string")
    def cut(text: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(h) else without(t, hit_spans(t, h)) for t, h in zip(text, hits)])

    return unpacked(found, docs.columns, **{text_col: cut("text", "hits")})


def op4_decontaminate(spark, sf_dir):
    hits = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SPLIT_SQL = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
HIT_SQL = f"""
with i as (select cast(item_id as varchar) as item, {SPLIT_SQL} as w from benchmark),
g as (select distinct item, least(10, len(w)) as n, list_slice(w, p, p + 9) as win from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from i where len(w) > 0)),
d as (select doc_id, {SPLIT_SQL} as w from documents),
s as (select distinct n from g),
o as (select distinct doc_id, item, p, x.n from (select doc_id, s.n, w, unnest(range(1, len(w) - s.n + 2)) as p from d, s where len(w) >= s.n) x join g on g.n = x.n and g.win = list_slice(x.w, x.p, x.p + x.n - 1)),
h as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from o) group by doc_id),
t as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from o group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""

QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLES = {"op4_decontaminate": HIT_SQL}
