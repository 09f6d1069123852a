"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII characters that part words.
BLANKS = " \t\n\x0b\f\r"
#: For bytes.translate: A-Z become a-z, the blanks become spaces. Non-ASCII bytes stay.
WORD_BYTES = bytes.maketrans((UPPER + BLANKS).encode(), (LOWER + " " * len(BLANKS)).encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc_part(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`: how the queries split rows into folds. Null ids fall into part 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts, F.lit(0))


def hashed_share(value: Column, most: int, total: int) -> Column:
    """Whether a value is among about `most` of `total`, by its hash: a bounded sample that no task has to gather."""
    return F.pmod(F.xxhash64(F.lit(11), value), F.lit(1_000_000_000)) < int(1_000_000_000 * min(1.0, most / max(1, total)))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row as one struct `doc` beside `id` and `text`: whatever else it is called, no column clashes with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of `doc` in their order, those named in `changed` replaced, the new ones last."""
    lead = [changed.pop(c).alias(c) if c in changed else F.col(f"doc.`{c}`").alias(c) for c in columns]
    return df.select(*lead, *[v.alias(c) for c, v in changed.items()])


def add_by_text(df: DataFrame, text_col: str, schema: str, start: Callable[[], Callable[[list[str]], list]], keep_text: bool = True, rows: int = 256) -> DataFrame:
    """`df` with the columns of `schema` computed from whole texts (null: empty) in Python.

    `start` runs once a task and returns a function from a list of texts to one list or Arrow array for each new column. Rows come in
    Arrow batches, which Spark bounds by rows and bytes, and are worked off `rows` texts at a time. An existing column of
    the same name is replaced.
    """
    new = df.sparkSession.createDataFrame([], schema).schema
    kept = [f for f in df.schema.fields if f.name not in new.names and (keep_text or f.name != text_col)]
    out_schema = type(df.schema)(kept + list(new.fields))
    names = [f.name for f in kept]
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                made = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(work(texts), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + made, names=names + new.names)

    return df.mapInArrow(run, out_schema)
