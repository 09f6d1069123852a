"""WARC archives written and read back."""

import base64
import gzip
import hashlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from tephra.llm import warc
from tephra.session import run_dir

PAGES = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://e", "x" * 3_000_000), (6, "http://f", "é\r\n\r\nbody"), (7, "g", "same"), (None, "h", "same"), (8, "i", "one"), (8, "i", "one")]


def folder(spark):
    return f"{run_dir(spark)}/warc-test-{uuid.uuid4().hex}"


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and first[h or ""] != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "extra", 1) for r in PAGES], "page_id long, url string, html string, payload string, sha int")
    archives = warc.write_archives(pages, folder(spark), max_bytes=2_000)
    assert archives.count() > 1 and archives.agg(F.sum("n_records")).first()[0] == len(PAGES)
    got = warc.read_archives(archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(PAGES)
    assert all(r.digest_ok for r in got)
    text = {i: h for i, _, h in PAGES}
    assert all(bytes(r.payload) == (text[r.page_id] or "").encode() for r in got if r.record_type == "response" and r.page_id is not None)
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_small_payloads_do_not_become_revisits(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, folder(spark), min_revisit=3)).collect()
    assert [r.record_type for r in got] == ["response", "response"]


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, folder(spark))).count() == 0


def records(data):
    return [warc.read_record(more) for more in warc.Members(io.BytesIO(data))]


def test_damage_shows():
    good = warc.record_bytes(1, "u", b"payload", warc.sha1_base32(b"payload"), None)
    assert records(gzip.compress(good) * 3)[2]["digest_ok"]
    assert not records(gzip.compress(good.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n")))[0]["digest_ok"]
    with pytest.raises(EOFError):
        records(gzip.compress(good)[:-12])
    with pytest.raises(ValueError):
        records(gzip.compress(good[:-20]))
