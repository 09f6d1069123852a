"""Documents to training tokens: quality rules, line dedup, near-duplicates, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on every row it is given and returns a DataFrame; run() writes each result as
Parquet to the application's folder in the shared one and reads it back for the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from tephra.llm.common import table
from tephra.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the learnt rules keep. `labels` is learnt from as far as its documents are still there."""
    judged = quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more share; the one with the largest id keeps them. n_chars follows the text."""
    out = line_dedup.line_dedup(docs)
    return renewed(out, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by two-word shingles at 0.8, as op9_near_dedup links them: with
    five words a copy with a tenth of its words changed falls far below 0.8."""
    return minhash.near_dedup(docs, size=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of `benchmark`."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), action="documents")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded by the public 50k byte-level ranks, and decoded again."""
    return bpe.digests(docs)


def renewed(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_near_dedup", near_duplicates), ("benchmark_decontamination", benchmark_free), ("byte_level_bpe", tokens)]

#: The near-duplicate index and the tokenizer have no SQL; a brute-force version of the whole pipeline is in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
