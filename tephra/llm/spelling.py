"""Spelling variants of a corpus's words: which words differ by one edit, and which of them the others are written for.

Edits of every word are generated in batches and looked up in broadcast Bloom filters, one for each word length; only those
found there are shuffled to the vocabulary, which confirms or drops them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import lower_ascii, table
from .minhash import mixed

RUN = r"[a-zÀ-ÿ]"
#: Lengths from here on share one filter, so that there are few filters however long a word may be.
LONG = 64
#: Bits of a filter's block (a cache line), bits spent on a word, and bits of all filters together at most (32 MB).
BLOCK, PER_WORD, MOST_BITS = 512, 16, 1 << 28
#: Bits in one of the pieces that the filters are gathered in.
PIECE = 32_768
ODD = 0x9E3779B97F4A7C15
BACK = np.uint64(pow(ODD, -1, 1 << 64))


class Filters:
    """Where a word's bits lie. A word's block and bits follow from a sum over its letters, so an edit's sum is that of the word plus a difference."""

    def __init__(self, counts: dict[int, int]):
        share = min(1.0, MOST_BITS / max(1, PER_WORD * sum(counts.values())))
        self.blocks = {k: max(1, int(n * PER_WORD * share) // BLOCK) for k, n in sorted(counts.items())}
        self.first = dict(zip(self.blocks, np.cumsum([0, *self.blocks.values()]).tolist()))
        self.n_bits = sum(self.blocks.values()) * BLOCK

    @staticmethod
    def letters(codes: np.ndarray) -> np.ndarray:
        return mixed(codes.astype(np.uint64) + np.uint64(ODD))

    @staticmethod
    def powers(n: int) -> np.ndarray:
        out = np.full(n, ODD, np.uint64)
        out[:1] = 1
        return np.cumprod(out)

    def places(self, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(the block's first 64-bit word, what picks two words of the block and three bits in each)."""
        h = mixed(sums + np.uint64(length))
        shard = min(length, LONG)
        block = np.uint64(self.first[shard]) + ((h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32))
        return block * np.uint64(BLOCK // 64), mixed(h + np.uint64(ODD))

    @staticmethod
    def mask(g: np.ndarray, at: int) -> np.ndarray:
        one, six = np.uint64(1), np.uint64(63)
        return (one << (g >> np.uint64(at) & six)) | (one << (g >> np.uint64(at + 6) & six)) | (one << (g >> np.uint64(at + 12) & six))

    def bits(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Six positions for each word."""
        first, g = self.places(sums, length)
        out = []
        for at, lane in ((0, g >> np.uint64(58)), (18, g >> np.uint64(55))):
            word = (first + (lane & np.uint64(7))) * np.uint64(64)
            out += [word + (g >> np.uint64(at + k) & np.uint64(63)) for k in (0, 6, 12)]
        return np.concatenate(out).astype(np.int64)

    def held(self, words: np.ndarray, sums: np.ndarray, length: int) -> np.ndarray:
        """The indexes of `sums` whose bits are all set: every word of the vocabulary, and a few others."""
        if min(length, LONG) not in self.blocks:
            return np.zeros(0, np.int64)
        first, g = self.places(sums, length)
        need = self.mask(g, 0)
        at = np.flatnonzero(words[(first + (g >> np.uint64(58) & np.uint64(7))).astype(np.int64)] & need == need)
        need = self.mask(g[at], 18)
        return at[words[(first[at] + (g[at] >> np.uint64(55) & np.uint64(7))).astype(np.int64)] & need == need]


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, indexes) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def code_points(words: list[str], length: int) -> np.ndarray:
    return np.array(words, f"U{max(1, length)}").view(np.uint32).reshape(len(words), -1)[:, :length]


def filter_bits(vocabulary: DataFrame, filters: Filters) -> np.ndarray:
    """All filters as one array of 64-bit words. Tasks name the bits, Spark combines them into pieces of 4 KB before and after the shuffle;
    the driver receives MOST_BITS / PIECE pieces at most, however many words there are."""
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for n, at in by_length(words):
                codes = code_points([words[k] for k in at], n)
                with np.errstate(over="ignore"):
                    sums = (filters.letters(codes) * filters.powers(n)).sum(axis=1, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(filters.bits(sums, n))], names=["bit"])

    bits = vocabulary.select("word").mapInArrow(named, "bit long")
    pieces = bits.groupBy(F.expr(f"bit div {PIECE}").alias("piece")).agg(F.bitmap_construct_agg(F.col("bit") % PIECE).alias("bits"))
    out = np.zeros(-(-filters.n_bits // PIECE) * PIECE // 8, np.uint8)
    for row in pieces.toLocalIterator():
        out[row.piece * PIECE // 8:(row.piece + 1) * PIECE // 8] = np.frombuffer(row.bits, np.uint8)
    return out.view("<u8")


def edits_held(vocabulary: DataFrame, filters: Filters, alphabet: str) -> DataFrame:
    """(word, n, edit): the edits of each word that the filters hold. A word of L letters has L deletions and, for each place, a replacement
    by every later letter of the alphabet; what is inserted or replaced by an earlier letter is found from the other word."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(filter_bits(vocabulary, filters))
    letters = np.array(sorted(map(ord, alphabet)), np.uint32)

    def probed(words: list[str], length: int) -> Iterator[tuple[np.ndarray, list[str]]]:
        codes, bits, power = code_points(words, length), sent.value, filters.powers(length)
        values, of_letter = filters.letters(codes), filters.letters(letters)
        terms = values * power
        sums = terms.sum(axis=1, dtype=np.uint64)
        before = np.zeros(len(words), np.uint64)
        for i in range(length):
            row, c = np.nonzero(letters[None, :] > codes[:, i][:, None])
            hit = filters.held(bits, sums[row] + (of_letter[c] - values[row, i]) * power[i], length)
            yield row[hit], [words[r][:i] + chr(letters[k]) + words[r][i + 1:] for r, k in zip(row[hit], c[hit])]
            new = np.flatnonzero(codes[:, i] != codes[:, i - 1]) if i else np.arange(len(words))
            hit = new[filters.held(bits, before[new] + (sums[new] - before[new] - terms[new, i]) * BACK, length - 1)]
            yield hit, [words[r][:i] + words[r][i + 1:] for r in hit]
            before = before + terms[:, i]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for length, at in by_length(words):
                step = max(1, 150_000 // len(letters))
                for k in range(0, len(at), step):
                    part = at[k:k + step]
                    with np.errstate(over="ignore"):
                        for rows, edits in probed([words[j] for j in part], length):
                            if len(edits):
                                yield pa.RecordBatch.from_arrays([pa.array([words[j] for j in part[rows]]), pa.array(n[part[rows]]), pa.array(edits)], names=["word", "n", "edit"])

    return vocabulary.select("word", "n").mapInArrow(work, "word string, n long, edit string")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words of `vocabulary` (word, n) that differ by one inserted, deleted or replaced code point, both ways round."""
    length = F.least(F.char_length("word"), F.lit(LONG))
    counts = {r.length: r["count"] for r in vocabulary.groupBy(length.alias("length")).count().collect()}
    alphabet = "".join(r.letter for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect())   # the letters of a script, not of a corpus
    # a word takes hundreds of probes but few bytes, so the words are dealt out by their number, not by the size of their files
    held = edits_held(vocabulary.repartition(1 + sum(counts.values()) // 50_000), Filters(counts), alphabet)
    # false positives end here
    one = materialize(held.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), F.col("edit") == F.col("near")).select("word", "n", "near", "near_n"))
    return one.unionByName(one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, each round twice as far. Forms only lead to more frequent words, so they end."""
    out = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        longer = out.join(out.select(F.col("word").alias("mid"), F.col("root").alias("next")), F.col("root") == F.col("mid"), "left")
        further = materialize(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        out = further.select("word", "root")
        if not further.where("went").limit(1).count():
            return out


def variant_groups(words: DataFrame, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word that `words` (one row an occurrence, column word) holds `least_count` times or more.

    n_near is how many other such words differ from it by exactly one code point inserted, deleted or replaced. form is the most
    frequent of them (ties: the smallest in code-point order) if it occurs `ratio` times as often or more, else null; root is where
    forms lead, the word itself if nowhere. Occurrences are counted before the shuffle. The filters' size is bounded: a vocabulary beyond some
    16 million words makes them say yes more often and the shuffle larger, and changes no result. A word has at most some
    90 near words a letter, so no join has a hot key.

    Null words count nowhere; the empty word is a word. Repeated rows are occurrences. An empty table gives no rows. Other columns of `words` are not read.
    """
    counted = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    vocabulary = materialize(counted)
    near = near_words(vocabulary)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    found = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    passes = -F.col("best.m") >= ratio * F.col("n")
    found = materialize(found.select("word", "n_near", F.when(passes, F.col("best.near")).alias("form"), F.when(passes, -F.col("best.m")).alias("form_n")))
    led = roots(found.where(F.col("form").isNotNull()))
    out = vocabulary.join(found, "word", "left").join(led, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def runs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7) -> DataFrame:
    """(id, run): each maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) of at least `least_chars`, A-Z lower-cased. Null texts have none."""
    runs = F.regexp_extract_all(lower_ascii(F.col(f"`{text_col}`")), F.lit(f"{RUN}{{{least_chars},}}"), F.lit(0))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(runs).alias("run"))


def one_lost(id_col: Column, run: Column, every: int = 31) -> Column:
    """The run, or, where `every` divides the crc32 of `<id>:<run>` (a null id: empty), the run without one code point."""
    h = F.crc32(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), run).cast("binary"))
    k = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(run.substr(F.lit(1), k), run.substr(k + 2, F.char_length(run)))).otherwise(run)


def op13_spelling_variants(spark, sf_dir):
    runs = runs_of(table(spark, sf_dir, "documents"))
    words = runs.select(one_lost(F.col("id"), F.col("run")).alias("word")).where(F.char_length("word") >= 7)
    return variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


#: CRC-32 in SQL: its table from the polynomial (one row, to be read beside the texts), then one step a byte.
CRC_SQL = """
crc_table as (select list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps)
"""


def crc_sql(text: str) -> str:
    data = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({data}) // 2 + 1), lambda k: cast('0x' || substr({data}, cast(2 * k - 1 as integer), 2) as bigint))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), cast(4294967295 as bigint)), 4294967295)"


VARIANT_SQL = f"""
with recursive {CRC_SQL.strip()},
t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run from documents),
r as (select run, {crc_sql("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from t, crc_table where length(run) >= 7),
w as (select case when h % 31 = 0 then substr(run, 1, cast(h % length(run) as integer)) || substr(run, cast(h % length(run) as integer) + 2) else run end as word from r),
v as (select word, count(*) as n from w where length(word) >= 7 group by word having count(*) >= 2),
d as (select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
p as (select a.word, a.n, b.word as near, b.n as near_n from d a join d b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
      union select a.word, a.n, b.word, b.n from d a join v b on a.head || a.tail = b.word
      union select b.word, b.n, a.word, a.n from d a join v b on a.head || a.tail = b.word),
o as (select word, n, near, near_n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by near_n desc, encode(near)) as place from p),
f as (select word, n_near, case when near_n >= 10 * n then near end as form, case when near_n >= 10 * n then near_n end as form_n from o where place = 1),
c as (select word, word as root from v union all select c.word, f.form from c join f on f.word = c.root where f.form is not null),
e as (select c.word, c.root from c left join f on f.word = c.root where f.form is null)
select v.word, f.form, e.root, v.n, coalesce(f.n_near, 0) as n_near, f.form_n from v left join f using (word) join e on e.word = v.word
"""

QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLES = {"op13_spelling_variants": VARIANT_SQL}
