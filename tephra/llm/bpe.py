"""Byte-level BPE: overlapping chunks are cut into pre-tokens in parallel and stitched; the pieces are encoded; ids decode to bytes."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import add_by_text, packed, table, unpacked

#: Pieces kept per worker with their ids.
CACHE = 200_000


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(2)
def merger(path: str, pattern: str) -> Callable[[bytes], list[int]]:
    """The merges of one piece; the rank file is read once a worker."""
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})._core_bpe.encode_single_piece


def boundaries(text: str, start: int, end: int, pattern) -> list[int]:
    """Where pre-tokens begin in [start, end), if one begins at `start`. The pattern looks ahead only, so what follows a
    boundary does not depend on what went before it: two runs that share one boundary share all later ones."""
    out = []
    for m in pattern.finditer(text, start):
        if m.start() >= end:
            break
        out.append(m.start())
    return out


def chunk_starts(length: int, chunk: int) -> list[int]:
    return list(range(0, max(1, length), chunk))


class Pieces(dict):
    """Encodes stretches of text that begin and end at pre-token boundaries. Remembers the ids of pieces, as the bytes of 32-bit numbers."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.merge, self.pattern = merger(path, pattern), regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = np.array(self.merge(piece.encode()), np.int32).tobytes()
        return ids

    def ids(self, text: str, start: int = 0, end: int | None = None) -> bytes:
        if len(self) > CACHE:
            self.clear()
        return b"".join(map(self.__getitem__, self.pattern.findall(text, start, len(text) if end is None else end)))


def id_lists(coded: list[bytes | None]) -> pa.Array:
    """One list of 32-bit numbers for each run of bytes."""
    values = pa.Array.from_buffers(pa.int32(), sum(len(c or b"") for c in coded) // 4, [None, pa.py_buffer(b"".join(c or b"" for c in coded))])
    offsets = np.concatenate([[0], np.cumsum([len(c or b"") // 4 for c in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([c is None for c in coded]))


def long_chunks(texts: DataFrame, chunk: int, overlap: int, pattern: str) -> DataFrame:
    """(row, k, body, offset, head, tail): the chunks of each text and the boundaries that a run started at the chunk's first character
    has in its own first `overlap` characters (head) and in those of the next chunk (tail). `body` reaches twice the overlap into the
    next chunk, so that no boundary in the tail depends on where the body was cut. A text is cut in one pass."""
    def cut(batches):
        names = ["row", "k", "body"]
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text")):
                text, held = text.as_py(), []
                for k, at in enumerate(chunk_starts(len(text), chunk)):
                    held.append((row, k, text[at:at + chunk + 2 * overlap]))
                    if len(held) * chunk > 4 << 20:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held))), names=names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held))), names=names)

    pieces = texts.mapInArrow(cut, "row string, k long, body string").withColumn("k", F.col("k").cast("int")).repartition("row", "k")     # the chunks of one long text go to many tasks

    def start():
        compiled = regex.compile(pattern)

        def work(bodies: list[str]) -> list[list]:
            heads, tails = [], []
            for body in bodies:
                at = boundaries(body, 0, chunk + overlap, compiled)
                heads.append([b for b in at if b < overlap])
                tails.append([b - chunk for b in at if b >= chunk])
            return [heads, tails]
        return work
    return add_by_text(pieces, "body", "head array<int>, tail array<int>", start)


def encode_long(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, ids) for texts of several chunks. A chunk counts from the first boundary it shares with the run of the chunk before it;
    a text of which some chunk shares none (one run of letters longer than the overlap, say) is encoded in one go instead."""
    from pyspark.sql import Window

    chunks = materialize(long_chunks(texts, chunk, overlap, pattern))
    order = Window.partitionBy("row").orderBy("k")               # the chunks of one document, without their text
    joint = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    syncs = chunks.select("row", "k", F.when(F.col("k") == 0, 0).otherwise(joint).alias("begin"))
    syncs = syncs.select("row", "k", "begin", F.lead("begin").over(order).alias("next"), F.max("k").over(Window.partitionBy("row")).alias("last"),
                         F.max(F.col("begin").isNull()).over(Window.partitionBy("row")).alias("lost"))
    whole = texts.join(syncs.where("lost").select("row").distinct(), "row").select("row", F.lit(0).alias("k"), F.col("text").alias("body"), F.lit(0).alias("begin"), F.char_length("text").alias("end"))
    stretches = (chunks.select("row", "k", "body").join(syncs.where("not lost"), ["row", "k"])
                 .select("row", "k", "body", "begin", F.when(F.col("k") < F.col("last"), chunk + F.col("next")).otherwise(F.char_length("body")).alias("end")))

    def run(batches):
        pieces = Pieces(path, pattern)
        for b in batches:
            made = [pieces.ids(t, s, e) for t, s, e in zip(b.column("body").to_pylist(), b.column("begin").to_pylist(), b.column("end").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("k"), id_lists(made)], names=["row", "k", "ids"])

    parts = stretches.unionByName(whole).mapInArrow(run, "row string, k int, ids array<int>")
    return parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts")).select("row", F.flatten(F.col("parts.ids")).alias("ids"))


def bpe_encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids", chunk: int = 65_536, overlap: int = 1_024) -> DataFrame:
    """`docs` with `out_col` array<int>: the ids of the whole text, each match of `pattern` merged by the ranks of the file at `path`.

    Texts of one chunk are encoded where they lie. Longer ones become overlapping chunks that many tasks pre-tokenise; the
    runs are stitched at the first boundary that both have, the stretches between stitches are encoded in parallel, and their
    ids are put in order by chunk.

    Null and empty texts have no ids. Repeated rows each keep theirs. Extra columns stay; one named as `out_col` is replaced.
    The rank file must be readable by every worker.
    """
    packs = packed(docs, text_col, text_col).select("doc", "text")

    def start():
        pieces = Pieces(path, pattern)
        return lambda texts: [id_lists([pieces.ids(t) for t in texts])]

    is_long = F.coalesce(F.char_length("text") > chunk, F.lit(False))
    short = add_by_text(packs.where(~is_long), "text", "ids array<int>", start)
    long = packs.where(is_long)
    if long.limit(1).count():
        long = materialize(long.withColumn("row", F.expr("uuid()")))
        long = long.join(encode_long(long.select("row", "text"), path, pattern, chunk, overlap), "row").select("doc", "text", "ids")
        short = short.unionByName(long)
    return unpacked(short, docs.columns, **{out_col: F.col("ids")})


def bpe_decode(coded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`coded` with `out_col` binary: the bytes of the ids joined. Null ids decode to nothing; an unknown id is an error."""
    kept = [f for f in coded.schema.fields if f.name != out_col]
    names = [f.name for f in kept]
    schema = type(coded.schema)(kept).add(out_col, "binary")

    def run(batches):
        token = {rank: t for t, rank in ranks_of(path).items()}.__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                ids = b.column(ids_col)
                flat, sizes = ids.flatten().to_numpy(zero_copy_only=False).tolist(), pc.fill_null(pc.list_value_length(ids), 0).to_pylist()
                made, start = [], 0
                for size in sizes:
                    made.append(b"".join(map(token, flat[start:start + size])))
                    start += size
                yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(made, pa.binary())], names=names + [out_col])

    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes, by the public 50k byte-level ranks."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe_encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).select("doc_id", "ids")
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return bpe_decode(coded, path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op6_bpe": op6_bpe}
ORACLES: dict[str, str] = {}
