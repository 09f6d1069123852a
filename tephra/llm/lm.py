"""Language-model scores from an n-gram trie in Elias-Fano levels, sharded by context."""

from __future__ import annotations

import mmap
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD_BYTES, crc_part, table
from .minhash import mixed

END, START = b"\n", xxhash.xxh3_64_intdigest(b"\r")     # no word holds a blank
#: Successors are known by so many bits of their hash, within their context.
PRINT = 48
SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def squeezed(a: np.ndarray) -> bytes:
    """An array's bytes, those of equal significance together, compressed."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()) if len(a) else b""


def unsqueezed(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


#: Position of the k-th set bit of a byte, by (byte, k).
BIT = np.array([[i for i in range(8) if byte >> i & 1] + [8] * (8 - byte.bit_count()) for byte in range(256)], np.int64)
#: Bits of the unary part for each entry of its directory.
BLOCK = 512
#: Numbers looked up at a time, so that a search holds little beside its answers.
AT_ONCE = 1 << 16


def nth(counts: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In each row of bit counts, the cell that holds bit number k, and the bit's number within it."""
    upto = counts.cumsum(axis=1, dtype=np.int64)
    cell = (upto <= k[:, None]).sum(axis=1)
    row = np.arange(len(k))
    return cell, k - (upto[row, cell] - counts[row, cell])


class EliasFano:
    """A sorted sequence of n numbers below `top` in about 2 + log2(top / n) bits each, searched as it lies.

    The low bits of all numbers follow one another; the high ones are gaps in unary, with a count of ones for every BLOCK
    bits. All parts are views of one buffer, so a level opens from bytes, an Arrow buffer or a mapped file without being
    copied or expanded.
    """

    HEAD = struct.Struct("<QQQ")

    def __init__(self, buffer):
        self.n, self.low_bits, size = self.HEAD.unpack_from(buffer)
        words = np.frombuffer(buffer, np.uint64)[self.HEAD.size // 8:]
        lows = self.n * self.low_bits // 64 + 2
        self.low, self.high = words[:lows], words[lows:lows + size].reshape(-1, BLOCK // 64)
        self.ones = words[lows + size:].view(np.int64)             # set bits before each block, then all of them
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * BLOCK - self.ones

    @classmethod
    def packed(cls, values: np.ndarray, top: int) -> bytes:
        n = len(values)
        low = min(63, max(0, (top // max(1, n)).bit_length() - 1))
        values = values.astype(np.uint64)
        words = np.zeros(n * low // 64 + 2, np.uint64)
        if low and n:
            bit = np.arange(n, dtype=np.int64) * low
            word, shift, part = bit >> 6, (bit & 63).astype(np.uint64), values & np.uint64((1 << low) - 1)
            new = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            words[word[new]] = np.bitwise_or.reduceat(part << shift, new)
            over = np.flatnonzero(shift + np.uint64(low) > 64)     # at most one number runs on from a word into the next
            words[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(high[-1]) + 1 if n else 0) // BLOCK * BLOCK + BLOCK, bool)     # at least one 0 at the end
        bits[high] = True
        upper = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.append(0, bits.reshape(-1, BLOCK).sum(axis=1).cumsum()).astype(np.int64)
        return cls.HEAD.pack(n, low, len(upper)) + words.tobytes() + upper.tobytes() + ones.tobytes()

    def select(self, k: np.ndarray, ones: bool = True) -> np.ndarray:
        """Where the unary part has its k-th 1, or its k-th 0."""
        directory = self.ones if ones else self.zeros
        block = np.searchsorted(directory, k, "right") - 1
        words = self.high[block] if ones else ~self.high[block]
        cell, k = nth(np.bitwise_count(words), k - directory[block])
        octets = np.ascontiguousarray(words[np.arange(len(k)), cell]).view(np.uint8).reshape(-1, 8)
        octet, k = nth(np.bitwise_count(octets), k)
        return block * BLOCK + cell * 64 + octet * 8 + BIT[octets[np.arange(len(k)), octet], k]

    def lows(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        after = np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return ((self.low[word] >> shift) | after) & np.uint64((1 << self.low_bits) - 1)

    def at(self, k: np.ndarray) -> np.ndarray:
        """The numbers at places k."""
        high = (self.select(k) - k).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self.lows(k)

    def values(self) -> np.ndarray:
        return np.concatenate([self.at(np.arange(a, min(self.n, a + AT_ONCE))) for a in range(0, max(1, self.n), AT_ONCE)])

    def successor(self, goals: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each goal, the place of the first number at or above it in places [begin, end), which is `end` if there is none, and whether it equals the goal.

        Its high bits choose the numbers that share them, between two zeros of the unary part; these are halved by their low bits.
        """
        end = np.full(len(goals), self.n) if end is None else end
        high = (goals >> np.uint64(self.low_bits)).astype(np.int64)
        known = high <= self.zeros[-1] - 1
        high = np.where(known, high, 0)
        first = np.where(high > 0, self.select(np.maximum(high, 1) - 1, False) - high + 1, 0)
        last = self.select(high, False) - high
        first, last = np.where(known, first, self.n), np.where(known, last, self.n)
        first = np.minimum(np.maximum(first, begin), end)
        last = np.maximum(np.minimum(last, end), first)
        goal, lo, hi = goals & np.uint64((1 << self.low_bits) - 1), first, last.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) >> 1
            less = self.lows(middle) < goal[open_]
            lo[open_] = np.where(less, middle + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], middle)
            open_ = open_[lo[open_] < hi[open_]]
        equal = np.zeros(len(goals), bool)
        inside = np.flatnonzero(lo < last)
        equal[inside] = self.lows(lo[inside]) == goal[inside]
        return lo, equal


class Trie:
    """Two levels: contexts, and their successors with quantised probabilities.

    Level one is the sorted context hashes and a monotone pointer for each to where its successors begin. In level two a
    successor is a number relative to its context: its rank among the shard's successor words, added to a base that grows from
    context to context, so the whole level is one monotone sequence. A probability is a step of its logarithm in 255 steps.
    No level is expanded: what a search holds beside the buffer is the directories and AT_ONCE n-grams.
    """

    PARTS = struct.Struct("<6Qd")

    def __init__(self, buffer):
        *sizes, self.least = self.PARTS.unpack_from(buffer)
        view, at, parts = memoryview(buffer), self.PARTS.size, []
        for size in sizes:
            parts.append(view[at:at + size])
            at += size
        self.contexts, self.pointers, self.words, self.successors = map(EliasFano, parts[:4])
        self.codes = np.frombuffer(parts[4], np.uint8)

    @classmethod
    def packed(cls, contexts: np.ndarray, words: np.ndarray, probabilities: np.ndarray) -> bytes:
        """From n-grams in order of (context, word)."""
        level, begin = np.unique(contexts, return_index=True)
        vocabulary, rank = np.unique(words, return_inverse=True)
        base = np.repeat(np.arange(len(level), dtype=np.uint64), np.diff(np.append(begin, len(contexts)))) * np.uint64(len(vocabulary))
        logs = np.log10(probabilities)
        least = float(min(logs.min(), -1e-9)) if len(logs) else -1.0
        codes = (1 + np.rint((1 - logs / least) * 254)).astype(np.uint8)
        parts = [EliasFano.packed(level, 1 << 64), EliasFano.packed(np.append(begin, len(contexts)), len(contexts) + 1), EliasFano.packed(vocabulary, 1 << PRINT),
                 EliasFano.packed(base + rank.astype(np.uint64), max(1, len(level) * len(vocabulary))), codes.tobytes()]
        return cls.PARTS.pack(*map(len, parts), 0, least) + b"".join(parts)

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        """A trie over pages of its own outside the heap, which the system takes back with it."""
        pages = mmap.mmap(-1, len(data))
        pages.write(data)
        return cls(pages)

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The codes of n-grams, 0 for one that is absent: the context's pointers bound the search for its successor.

        A context is looked up once for each run of equal ones.
        """
        out = np.zeros(len(contexts), np.uint8)
        if not self.contexts.n:
            return out
        for a in range(0, len(contexts), AT_ONCE):
            context, word = contexts[a:a + AT_ONCE], words[a:a + AT_ONCE]
            new = np.append(True, context[1:] != context[:-1])
            place, there = self.contexts.successor(context[new])
            begin, end = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            begin[there], end[there] = (self.pointers.at(place[there] + k).astype(np.int64) for k in (0, 1))
            run = np.cumsum(new) - 1
            rank, known = self.words.successor(word)
            seek = np.flatnonzero(there[run] & known)
            run = run[seek]
            goal = place[run].astype(np.uint64) * np.uint64(self.words.n) + rank[seek].astype(np.uint64)
            at, hit = self.successors.successor(goal, begin[run], end[run])
            out[a + seek[hit]] = self.codes[at[hit]]
        return out

    @staticmethod
    def probability(codes: np.ndarray, least: float) -> np.ndarray:
        return np.where(codes > 0, 10.0 ** (least * (1 - (codes.astype(np.float64) - 1) / 254)), 0.0)


class Pairs:
    """The distinct (context, word) pairs of a batch, the shard of each, and which pair stands at each token."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, words: np.ndarray, shards: int, hot: tuple[np.ndarray, np.ndarray], capacity: int):
        n = len(words)
        context = np.empty(len(tokens), np.int64)
        context[1:] = tokens[:-1]
        context[np.cumsum(np.append(0, lengths[:-1]))] = n         # the first token of a document follows START
        self.pairs, self.at = np.unique(context * n + tokens, return_inverse=True)
        self.context, self.word = self.pairs // n, self.pairs % n
        hashes = np.append(words, np.uint64(START))
        keys, counts = hot
        found = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        split = np.where(keys[found] == hashes, 1 + counts[found] // capacity, 1)
        self.context_hash, self.word_print = hashes[self.context], words[self.word] >> np.uint64(64 - PRINT)
        own = (mixed(self.context_hash) % np.uint64(shards)).astype(np.int64)
        self.shard = (own + (mixed(self.word_print) % split[self.context].astype(np.uint64)).astype(np.int64)) % shards
        self.order = np.argsort(self.shard, kind="stable")
        self.cuts = np.searchsorted(self.shard[self.order], np.arange(shards + 1))


def batches(docs: DataFrame, batch_tokens: int) -> DataFrame:
    """Documents in batches of about `batch_tokens` tokens: their distinct words as sorted hashes with training counts, and tokens as numbers among these."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
            order = np.argsort(hashes)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            tokens, sizes = place[np.concatenate(parts)], np.array(lengths, np.int32)
            counts = np.bincount(tokens[np.repeat(np.array(train), sizes)], minlength=len(order)).astype(np.uint32)
            return pa.RecordBatch.from_pydict({"batch": [uuid.uuid4().hex], "ids": pa.array([ids], pa.list_(pa.int64())), "train": [train], "lengths": pa.array([sizes], pa.list_(pa.int32())),
                                               "n_tokens": pa.array([len(tokens)], pa.int64()), "tokens": [squeezed(tokens)], "words": [squeezed(hashes[order])], "counts": [squeezed(counts)]})

        numbers, parts, ids, train, lengths, held = {END: 0}, [], [], [], [], 0
        for arrow in source:
            for doc, text, trains in zip(arrow.column("id").to_pylist(), arrow.column("text"), arrow.column("train").to_pylist()):
                words = (text.as_py() or "").encode().translate(WORD_BYTES).split()
                words.append(END)
                add = numbers.setdefault
                parts.append(np.fromiter((add(w, len(numbers)) for w in words), np.int32, len(words)))
                ids.append(doc)
                train.append(trains)
                lengths.append(len(words))
                held += len(words)
                if held >= batch_tokens:
                    yield flush()
                    numbers, parts, ids, train, lengths, held = {END: 0}, [], [], [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, "batch string, ids array<long>, train array<boolean>, lengths array<int>, n_tokens long, tokens binary, words binary, counts binary")


def word_counts(state: DataFrame, shards: int, capacity: int) -> DataFrame:
    """Rows of kind "answer": a batch's words of one shard with their counts over all training tokens; and one of kind "sum" a shard: its
    tokens, distinct words, and the words with more than `capacity` tokens."""
    def ask(source):
        edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
        for arrow in source:
            for batch, words, counts in zip(*(arrow.column(c).to_pylist() for c in ("batch", "words", "counts"))):
                w, c = unsqueezed(words, np.uint64), unsqueezed(counts, np.uint32)
                cuts = [0, *np.searchsorted(w, edges), len(w)]
                full = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
                yield pa.RecordBatch.from_pydict({"shard": pa.array(full, pa.int32()), "batch": [batch] * len(full), "keys": [squeezed(w[cuts[s]:cuts[s + 1]]) for s in full],
                                                  "counts": [squeezed(c[cuts[s]:cuts[s + 1]]) for s in full]})

    def answer(asked: pa.Table) -> pa.Table:
        keys = [unsqueezed(k, np.uint64) for k in asked.column("keys").to_pylist()]
        counts = np.concatenate([unsqueezed(c, np.uint32) for c in asked.column("counts").to_pylist()]).astype(np.int64)
        level, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(level), np.int64)
        np.add.at(total, at, counts)
        cuts = np.cumsum([0] + [len(k) for k in keys])
        shard, n, hot = asked.column("shard")[0].as_py(), len(keys), total > capacity
        return pa.table({"kind": ["answer"] * n + ["sum"], "batch": asked.column("batch").to_pylist() + [None], "shard": pa.array([shard] * (n + 1), pa.int32()),
                         "data": [squeezed(total[at[a:b]]) for a, b in zip(cuts, cuts[1:])] + [None], "tokens": pa.array([None] * n + [int(total.sum())], pa.int64()),
                         "words": pa.array([None] * n + [int((total > 0).sum())], pa.int64()), "hot": pa.array([None] * n + [level[hot].view(np.int64)], pa.list_(pa.int64())),
                         "hot_counts": pa.array([None] * n + [total[hot]], pa.list_(pa.int64()))})

    asked = state.select("batch", "words", "counts").mapInArrow(ask, "shard int, batch string, keys binary, counts binary")
    return asked.groupBy("shard").applyInArrow(answer, "kind string, batch string, shard int, data binary, tokens long, words long, hot array<long>, hot_counts array<long>")


def trie_answers(state: DataFrame, shards: int, capacity: int, hot, prior: float) -> DataFrame:
    """Each shard's trie (kind "trie") and, for every batch, the codes of the pairs it asked for (kind "answer").

    The pairs of a batch go to the shard of their context, those of a hot context to several by successor; a batch sends each
    distinct pair once, with its count in training documents, so no frequency makes a shard large. The shard adds up the counts, packs the
    trie from them, and answers from the packed trie.
    """
    def ask(source):
        for arrow in source:
            for batch, train, lengths, tokens, words in zip(*(arrow.column(c).to_pylist() for c in ("batch", "train", "lengths", "tokens", "words"))):
                sizes = np.array(lengths)
                p = Pairs(unsqueezed(tokens, np.int32), sizes, unsqueezed(words, np.uint64), shards, hot.value, capacity)
                counts = np.bincount(p.at, np.repeat(np.array(train), sizes), len(p.pairs)).astype(np.uint32)
                rows = []
                for s in range(shards):
                    cell = p.order[p.cuts[s]:p.cuts[s + 1]]
                    if len(cell):
                        _, first, runs = np.unique(p.context[cell], return_index=True, return_counts=True)
                        prints = p.word_print[cell].view(np.uint8).reshape(-1, 8)[:, :PRINT // 8]
                        rows.append((s, batch, squeezed(p.context_hash[cell][first]), squeezed(runs.astype(np.uint32)), np.ascontiguousarray(prints).tobytes(), squeezed(counts[cell])))
                for k in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows[k:k + 64]), ASKED)], names=ASKED_NAMES)

    def answer(asked: pa.Table) -> pa.Table:
        contexts, prints, counts = [], [], []
        for level, runs, raw, c in zip(*(asked.column(n).to_pylist() for n in ("contexts", "runs", "prints", "counts"))):
            contexts.append(np.repeat(unsqueezed(level, np.uint64), unsqueezed(runs, np.uint32)))
            wide = np.zeros((len(contexts[-1]), 8), np.uint8)
            wide[:, :PRINT // 8] = np.frombuffer(raw, np.uint8).reshape(-1, PRINT // 8)
            prints.append(wide.view(np.uint64).ravel())
            counts.append(unsqueezed(c, np.uint32))
        c, w, k = (np.concatenate(x) for x in (contexts, prints, counts))
        seen = np.flatnonzero(k)
        seen = seen[np.lexsort((w[seen], c[seen]))]
        c, w, k = c[seen], w[seen], k[seen].astype(np.int64)
        new = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))) if len(c) else np.zeros(0, int)
        k = np.add.reduceat(k, new) if len(new) else k[:0]
        c, w = c[new], w[new]
        level, at = np.unique(c, return_inverse=True)
        total = np.bincount(at, k, len(level)) if len(level) else np.zeros(0)
        keys, known = hot.value
        if len(level):                                             # a context that is split knows its own total
            i = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            total[i[level[i] == keys]] = known[level[i] == keys]
        packed = Trie.packed(c, w, k / (total[at] + prior))
        trie = Trie.mapped(packed)
        data = [squeezed(trie.find(a, b)) for a, b in zip(contexts, prints)]
        n, shard = len(data), asked.column("shard")[0].as_py()
        return pa.table({"kind": ["answer"] * n + ["trie"], "batch": asked.column("batch").to_pylist() + [None], "shard": pa.array([shard] * (n + 1), pa.int32()),
                         "data": pa.array(data + [packed], pa.binary()), "least": [trie.least] * (n + 1), "n_grams": pa.array([None] * n + [len(k)], pa.int64())})

    asked = state.select("batch", "train", "lengths", "tokens", "words").mapInArrow(ask, "shard int, batch string, contexts binary, runs binary, prints binary, counts binary")
    return asked.groupBy("shard").applyInArrow(answer, "kind string, batch string, shard int, data binary, least double, n_grams long")


ASKED_NAMES = ["shard", "batch", "contexts", "runs", "prints", "counts"]
ASKED = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: str = "held_out", prior: float = 20.0, batch_tokens: int = 2_000_000, shard_tokens: int = 2_000_000) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs`; rows whose boolean `held_out` is false are learnt from.

    The model is P(w | v) = (c(v w) + prior * P(w)) / (c(v) + prior), P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)), over lower-cased words and an end,
    with a start before the first. Documents are numbered in batches; batches ask for the counts of their words, then for
    the codes of their distinct pairs, and add up their documents. Shards follow the number of tokens: about `shard_tokens` each. What the driver gets
    is the sums, and the words with over `shard_tokens` training tokens, of which there are at most N / shard_tokens.

    A null text is an empty one: an end alone. A null held_out counts as training. Rows that repeat an id are separate documents.
    An empty table gives no rows. With nothing to learn from, every word has the same score.
    """
    held = F.coalesce(F.col(f"`{held_out}`"), F.lit(False))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), (~held).alias("train"))
    state = materialize(batches(rows, batch_tokens))
    shards = max(1, -(-(state.agg(F.sum("n_tokens")).first()[0] or 0) // shard_tokens))
    spark = docs.sparkSession
    words = materialize(word_counts(state, shards, shard_tokens))
    sums = words.where("kind = 'sum'")
    n, v = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    starts = state.select(F.size(F.filter("train", lambda t: t)).alias("n")).agg(F.sum("n")).first()[0] or 0
    hot = [(h % (1 << 64), c) for r in sums.where(F.size("hot") > 0).toLocalIterator() for h, c in zip(r.hot, r.hot_counts)] + [(START, starts)]
    shared = spark.sparkContext.broadcast((np.array([h for h, _ in sorted(hot)], np.uint64), np.array([c for _, c in sorted(hot)], np.int64)))
    tries = materialize(trie_answers(state, shards, shard_tokens, shared, prior))

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_pydict({k: [] for k in names}, kinds)
        ids, train, lengths, tokens, vocabulary = (own.column(c)[0].as_py() for c in ("ids", "train", "lengths", "tokens", "words"))
        sizes, tokens, vocabulary = np.array(lengths), unsqueezed(tokens, np.int32), unsqueezed(vocabulary, np.uint64)
        got = {(level, shard): (data, least) for level, shard, data, least in zip(*(answers.column(c).to_pylist() for c in ("level", "shard", "data", "least")))}
        count = np.concatenate([unsqueezed(got[1, s][0], np.int64) for s in range(shards) if (1, s) in got])
        single = (count + 0.1) / (n + 0.1 * (v + 1))
        p = Pairs(tokens, sizes, vocabulary, shards, shared.value, shard_tokens)
        pair = np.zeros(len(p.pairs))
        for s in range(shards):
            if p.cuts[s] < p.cuts[s + 1]:
                data, least = got[2, s]
                pair[p.order[p.cuts[s]:p.cuts[s + 1]]] = Trie.probability(unsqueezed(data, np.uint8), least)
        before = np.append(count, starts)[p.context]
        pair = np.log10(pair + prior / (before + prior) * single[p.word])
        first = np.cumsum(np.append(0, sizes[:-1]))
        return pa.Table.from_pydict({"id": ids, "held_out": [not t for t in train], "n_tokens": sizes, "n_known": np.add.reduceat((count > 0)[tokens].astype(np.int64), first), "train_tokens": np.full(len(ids), n),
                                     "base_score": np.add.reduceat(np.log10(single)[tokens], first), "score": np.add.reduceat(pair[p.at], first)}, kinds)

    names = [f.split(" ")[0] for f in SCORES.split(", ")]
    kinds = pa.schema(list(zip(names, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))
    answers = (words.where("kind = 'answer'").select("batch", F.lit(1).alias("level"), "shard", "data", F.lit(0.0).alias("least"))
               .unionByName(tries.where("kind = 'answer'").select("batch", F.lit(2).alias("level"), "shard", "data", "least")))
    own = state.select("batch", "ids", "train", "lengths", "tokens", "words")
    return own.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, SCORES)


def op5_lm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_part(F.col("doc_id"), 10) == 0)
    return lm_scores(docs).withColumnRenamed("id", "doc_id")


QUERIES = {"op5_lm_scores": op5_lm_scores}
ORACLES: dict[str, str] = {}
