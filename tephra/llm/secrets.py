"""Find credentials: keywords first, then anchored patterns at the hits, then the checks that some tokens carry in themselves."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, add_by_text, table

#: Fixed order of the kinds, and of spans that start together.
KINDS = ["assign", "access", "hex", "github", "npm", "jwt", "private_key"]
#: keyword (lower case) -> kind; longer keywords that start alike stand for themselves.
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access",
            "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm", "eyj": "jwt", "-----begin ": "private_key"}
#: What must match where a keyword was found. Bytes; text beyond ASCII never belongs to a secret.
ANCHORED = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "private_key": re.compile(rb"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----"),
}
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Lower-case hex digits become h, all else a space: a run of hex digits is then found as a plain substring.
HEX_CLASS = bytes(104 if b in b"0123456789abcdef" else 32 for b in range(256))
HEX_RUN = re.compile(rb"[0-9a-f]+")
MIN_HEX, MIN_ACCESS, MIN_VALUE = 24, 20, 6
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(number: int, width: int) -> bytes:
    out = bytearray()
    while number:
        number, digit = divmod(number, 62)
        out.append(BASE62[digit])
    return bytes(out[::-1]).rjust(width, b"0")


def crc_token(m: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before them, in base 62."""
    body = m[0].partition(b"_")[2]
    return base62(zlib.crc32(body[:30]), 6) == body[30:]


def json_header(m: re.Match) -> bool:
    """The first part decodes to a JSON object that names an algorithm."""
    head = m[0].partition(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, binascii.Error, TypeError):
        return False


def der_body(m: re.Match) -> bool:
    """The body decodes to one DER sequence whose length field equals what follows it."""
    try:
        der = base64.b64decode(re.sub(rb"\s+", b"", m[2]), validate=True)
    except binascii.Error:
        return False
    if len(der) < 2 or der[0] != 0x30:
        return der[:14] == b"openssh-key-v1"
    n = der[1] & 0x7F if der[1] & 0x80 else 0
    return int.from_bytes(der[2:2 + n] if n else der[1:2], "big") == len(der) - 2 - n


ACCEPT: dict[str, Callable[[re.Match], bool]] = {
    "assign": lambda m: len(m[2]) >= MIN_VALUE, "access": lambda m: len(m[0]) >= MIN_ACCESS,
    "github": crc_token, "npm": crc_token, "jwt": json_header, "private_key": der_body,
}


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, order of kind, end) in code points, leftmost without overlap within a kind; a match that fails its test still uses up its text."""
    data = text.encode()
    found: list[tuple[int, int, int]] = []
    reach = dict.fromkeys(KINDS, 0)
    starts = sorted((end + 1 - n, kind) for end, (kind, n) in automaton.iter(data.translate(LOWER_BYTES).decode("latin-1")))  # one character a byte
    for start, kind in starts:
        if start >= reach[kind] and (m := ANCHORED[kind].match(data, start)):
            reach[kind] = m.end()
            if ACCEPT[kind](m):
                found.append((start, KINDS.index(kind), m.end()))
    classes, at = data.translate(HEX_CLASS), 0
    while (at := classes.find(b"h" * MIN_HEX, at)) >= 0:
        end = HEX_RUN.match(data, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = end
    if not found or len(data) == len(text):
        return sorted(found)
    edges, points, last = sorted({x for s, _, e in found for x in (s, e)}), {}, (0, 0)
    for edge in edges:                                             # bytes to code points, each stretch of text decoded once
        last = (edge, last[1] + len(data[last[0]:edge].decode()))
        points[edge] = last[1]
    return sorted((points[s], k, points[e]) for s, k, e in found)


def find_secrets(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with secrets array<struct<kind, start, end>>: the spans in the whole text, by start and then by the order of KINDS.

    An Aho-Corasick automaton finds the keywords of all kinds in one pass; each pattern is tried only where one of its keywords
    begins. Runs of hex digits have no keyword; they are found as a run in the text's character classes. Tokens with a check
    of their own (CRC, JSON header, DER length) count only if it holds.

    Null and empty texts have no secrets. Extra columns stay; one named `secrets` is replaced.
    """
    def start():
        automaton = keyword_automaton()
        return lambda texts: [[[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, automaton)] for t in texts]]

    return add_by_text(docs, text_col, "secrets array<struct<kind:string,start:int,end:int>>", start, keep_text)


def op7_secrets(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    of = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


QUERIES = {"op7_secrets": op7_secrets}
ORACLES: dict[str, str] = {}
