"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLANKS, lower_ascii, packed, table, unpacked


def line_keys(text: Column) -> Column:
    """The lines of a text as their keys: blanks stripped at both ends, A-Z lower-cased."""
    return F.transform(F.split(lower_ascii(text), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))


def digest(key: Column) -> Column:
    """128 bits in two words; the second hash starts from another seed."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """`docs` without the lines whose key, of at least `min_chars` code points, `min_docs` or more documents hold; plus n_lines, n_dropped.

    The document with the largest id keeps its lines of a shared key, however many. Lines explode to (id, position,
    digest); documents are counted per digest over all rows; positions to drop are gathered per document, and the text is
    put together again from the positions that stay. A line that a third of all documents share is first counted by
    (digest, id), then combined per task, so no task holds its rows; the join that marks its lines is one that adaptive
    execution splits.

    A null text has one line, stays null and drops nothing. Rows without an id neither count nor lose lines. Repeated rows
    of one id count as one document. Extra columns stay; n_lines and n_dropped replace columns of these names.
    """
    base = packed(docs, id_col, text_col)
    row = [F.col("id"), F.xxhash64("text").alias("version")]        # rows of one id with different texts keep their own positions
    lines = (base.where(F.col("id").isNotNull())
             .select(*row, F.posexplode(F.transform(line_keys(F.col("text")), lambda k: F.when(F.char_length(k) >= min_chars, digest(k)))).alias("pos", "key"))
             .where(F.col("key").isNotNull()))
    lines = materialize(lines)
    shared = (lines.groupBy("key", "id").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("one").alias("n_docs"), F.max("id").alias("keeper"))
              .where(F.col("n_docs") >= min_docs).select("key", "keeper"))
    shared = materialize(shared)                                   # a table of its own, so that the join can split a line that very many share
    drops = (lines.join(shared, "key").where(F.col("id") != F.col("keeper"))
             .groupBy("id", "version").agg(F.collect_set("pos").alias("drop")))
    marked = base.withColumn("version", F.xxhash64("text")).join(drops.select(F.col("id").alias("drop_id"), F.col("version").alias("drop_version"), "drop"),
                                                                 (F.col("id") == F.col("drop_id")) & (F.col("version") == F.col("drop_version")), "left")
    split = marked.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    n_lines = F.size("lines")
    stays = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("drop"))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda i: F.get(F.col("lines"), i)), "\n"))
    return unpacked(split, docs.columns, **{text_col: text, "n_lines": n_lines.cast("long"), "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("long")})


def op10_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


LINE_SQL = """
with l as (select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
s as (select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
m as (select k.*, s.keeper is not null and k.doc_id <> s.keeper as gone from k left join s on k.key = s.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256 from m group by doc_id
"""

QUERIES = {"op10_line_dedup": op10_line_dedup}
ORACLES = {"op10_line_dedup": LINE_SQL}
