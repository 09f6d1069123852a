"""Write pages as WARC archives and read archives back record by record."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from io import BytesIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, run_dir
from .common import table

RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, digest_ok boolean"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Bytes read from a file at a time.
READ = 1 << 18


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder that the executors share."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, first_id) -> bytes:
    """One record: headers, block, two line ends. A revisit has the headers of its response, and its length, but no payload."""
    revisit = None not in (page_id, first_id) and first_id != page_id
    http = HTTP_HEAD % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"), "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first_id}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 0,
                   max_bytes: int = 256 << 20, level: int = 6) -> DataFrame:
    """One record for each row, in archives of about `max_bytes` below `folder`; returns (path, n_records, n_bytes), written and complete.

    Of rows with equal payloads of `min_revisit` bytes or more, the one with the smallest id is the response and the others revisit
    it. That id comes from an aggregate by digest, combined in every task first and kept as a table; digests of one row join nothing, and
    the rows of one payload can be joined and written by many tasks. A task writes to a
    name of its own and renames the finished file, so an attempt that is lost or runs twice leaves whole archives only: the
    list that is returned names those of the attempts that counted.

    Null payloads are empty. Rows without an id are responses, and nothing refers to them. Rows that share an id and payload are all responses.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    first = rows.select("sha", "page_id", F.length("payload").alias("n")).where(F.col("n") >= min_revisit).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    first = materialize(first.where(F.col("copies") > 1).select(F.col("sha").alias("first_sha"), "first_id"))     # a table, so that adaptive execution can split a payload's rows
    rows = rows.join(first, F.col("sha") == F.col("first_sha"), "left").select("page_id", "url", "payload", "sha", "first_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        out, path, count, size = None, "", 0, 0

        def done():
            out.close()
            files.move(f"{path}.part", path)
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{path.rpartition('/')[2]}"], "n_records": [count], "n_bytes": [size]})

        for batch in batches:
            for page_id, url, payload, sha, first_id in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "first_id"))):
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{path}.part", compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)        # a gzip member of its own for each record
                member = packer.compress(record_bytes(page_id, url, payload, base64.b32encode(sha).decode(), first_id)) + packer.flush()
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= max_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    files, root = opened(folder)
    files.create_dir(root, recursive=True)
    return materialize(rows.mapInArrow(write, "path string, n_records long, n_bytes long"))


class Members:
    """The bytes of a file's gzip members, one after the other, inflated as they are read."""

    def __init__(self, source):
        self.source, self.rest = source, b""

    def __iter__(self) -> Iterator[Callable[[], bytes]]:
        while self.rest or self.fill():
            inflate = zlib.decompressobj(31)
            state = [inflate]

            def more() -> bytes:
                """Some more bytes of this member; empty at its end."""
                while not state[0].eof:
                    if not self.rest and not self.fill():
                        raise EOFError("the archive ends within a record")
                    data = state[0].decompress(self.rest, READ)
                    self.rest = state[0].unused_data if state[0].eof else state[0].unconsumed_tail
                    if data:
                        return data
                return b""
            yield more
            while more():                                              # what the reader left of the member
                pass

    def fill(self) -> bool:
        self.rest = self.source.read(READ)
        return bool(self.rest)


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_record(more: Callable[[], bytes], keep: bool = True) -> dict:
    """One record from its member: headers up to the empty line, then as many bytes as Content-Length says, digests summed on the way.

    Only the headers, and the payload if it is to be kept, are held.
    """
    data = bytearray()
    while (cut := data.find(b"\r\n\r\n")) < 0:
        if not (new := more()):
            raise ValueError("a record without headers")
        data += new
    head, new = headers(bytes(data[:cut])), bytes(data[cut + 4:])
    left = int(head["content-length"])
    block, body, http, inside, size, kept = hashlib.sha1(), hashlib.sha1(), bytearray(), False, 0, []
    while left:
        new = new[:left] or more()
        if not new:
            raise ValueError("a record shorter than its Content-Length")
        new = new[:left]
        left -= len(new)
        block.update(new)
        if not inside:                                                 # the headers of the answer come before its payload
            seen = max(0, len(http) - 3)
            http += new
            end = http.find(b"\r\n\r\n", seen)
            inside, new = end >= 0, bytes(http[end + 4:]) if end >= 0 else b""
            del http[end if inside else len(http):]
        body.update(new)
        size += len(new)
        if keep:
            kept.append(new)
        new = b""
    kind = head["warc-type"]
    number = lambda name: int(v) if (v := head.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
    base32 = lambda digest: base64.b32encode(digest.digest()).decode()
    said = head.get("warc-payload-digest", "").removeprefix("sha1:")
    whole = head.get("warc-block-digest", "").removeprefix("sha1:") == base32(block)
    own = base32(body) if kind != "revisit" else said
    n = size if kind != "revisit" else int(headers(bytes(http))["content-length"])
    return {"page_id": number("warc-record-id"), "url": head.get("warc-target-uri"), "record_type": kind, "refers_to": number("warc-refers-to"),
            "payload": b"".join(kept) if keep and kind != "revisit" else None, "payload_bytes": n, "payload_digest": own, "digest_ok": whole and own == said}


def read_archives(paths: DataFrame, path_col: str = "path", payload: bool = True) -> DataFrame:
    """The records of gzip archives, one file a task after another: (page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest, digest_ok).

    A file is read forward in pieces; each member is inflated as far as its record needs, framed by Content-Length, and its
    block and payload digests are computed from what was read. digest_ok is false where they differ from the headers; a file that breaks off
    within a record is an error. A revisit has no payload; its length and digest are those its headers give. An empty list of
    paths gives no records.
    """
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_())])
        for batch in batches:
            for uri in batch.column(path_col).to_pylist():
                files, path = opened(uri)
                with files.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for more in Members(source):
                        held.append(record := read_record(more, payload))
                        size += len(record["payload"] or b"") + 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    many = max(1, int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = paths.select(path_col).repartition(many).mapInArrow(read, RECORD)
    return out.select(*names)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    archives = write_archives(pages, f"{run_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read_archives(archives, payload=False)


def op8_warc(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
f as (select h, min(page_id) as first_id from p group by h),
j as (select p.page_id, strlen(p.h) as payload_bytes, sha1(p.h) as x, f.first_id from p join f using (h))
select page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(x, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31)::int, 1)), '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type, case when page_id <> first_id then first_id end as refers_to, true as digest_ok
from j
"""

QUERIES = {"op8_warc": op8_warc}
ORACLES = {"op8_warc": WARC_SQL}
