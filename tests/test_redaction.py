"""Redaction against Python's own regex engine and the shapes it must catch or leave."""

import re

import pytest

from pyspark.sql import functions as F
from tephra.functions import redaction

DASH = "-" * 5
CAUGHT = {
    "hf_" + "A" * 34: "hf_token", "rpa_" + "B" * 40: "runpod_key", "sk-or-v1-" + "c" * 48: "sk_key", "ghp_" + "D" * 36: "github_token",
    "github_pat_" + "x" * 22 + "_" + "Y" * 40: "github_pat", "ASIA" + "Q" * 16: "aws_access_key", "xoxb-" + "1" * 12 + "-abc": "slack_token",
    "eyJ" + "a" * 20 + ".eyJ" + "b" * 20 + "." + "c" * 20: "jwt", "AIza" + "A" * 35: "google_api_key", "sk_live_" + "a" * 24: "stripe_key",
    "SG." + "a" * 22 + "." + "b" * 43: "sendgrid_key", "https://hooks.slack.com/services/T000/B000/" + "x" * 24: "slack_webhook",
    "Authorization: Bearer " + "t" * 30: "bearer", "Authorization: Basic " + "QWxhZGRpbjpvcGVuIHNl": "basic_auth",
    "postgres://admin:S3cret" + "Pass@host/db": "url_password", "https://x.io/v1?" + "key=abcdefgh1234&x=1": "query_secret",
    "pass" + "word = hunter2xx": "kv_secret", '"api_key": "' + "ZmFrZXZhbHVl" * 3 + '"': "kv_secret", "AWS_SECRET_ACCESS_KEY=+" + "ab/CD" * 5 + "==": "kv_secret",
    f"a\n{DASH}BEGIN RSA PRIVATE KEY{DASH}\nMIIE\n{DASH}END RSA PRIVATE KEY{DASH}\nb": "private_key", f"a\n{DASH}BEGIN PRIVATE KEY{DASH}\nMIIE": "private_key_truncated",
}
LEFT_ALONE = [
    '"api_key": "<redacted>"', "Please set a HF_TOKEN to enable higher rate limits", "revision/b968826d9c46dd6066d109eabc6255188de91218",
    "fixture_sha,7e6005269552", "export SOME_API_KEY=...   ENDPOINT_ID=kbme98", '"tokenizer": "models/Qwen2.5-0.5B-Instruct"',
    '"max_tokens": 16, "prompt_tokens": 53404', '"first_token_s": 2073169.405621416, "arrival_s": 2073168.797192291', "'hf_token': 'hf_REDACTED'",
    "YOUR_API_KEY=your_api_key_here", "API_KEY=xxxxxxxxxxxx", "api_key: changeme-now", "",
]


def brute(text):
    """The same patterns through Python's engine: (redacted text, hits, matches on the original)."""
    hits, found, out = {}, [], text
    for name, rx, to in redaction.PATTERNS:
        found += [(name, m.group(0)) for m in re.finditer(rx, text)]
        out, n = re.subn(rx, re.sub(r"\$(\d)", r"\\\1", to), out)
        if n:
            hits[name] = n
    return out, hits, found


@pytest.fixture(scope="module")
def texts(spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    return [*CAUGHT, *LEFT_ALONE, *docs, " and ".join(CAUGHT), *[d + "\n" + t for d, t in zip(docs, CAUGHT)]]


def test_equals_python_on_whole_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r for r in redaction.redaction_counts(df, "text").collect()}
    plain = {r.id: r.t for r in df.select("id", redaction.redact(F.col("text")).alias("t")).collect()}
    found = {}
    for r in redaction.find_secrets(df, "text").collect():
        found.setdefault(r.id, []).append((r.pattern, r.masked))
    for i, t in enumerate(texts):
        out, hits, matches = brute(t)
        assert plain[i] == got[i].redacted == out
        assert got[i].hits == hits
        assert sorted(found.get(i, [])) == sorted((n, m[:6] + "…" + m[-3:] if len(m) > 12 else m[:3] + "…") for n, m in matches)


def test_shapes(spark):
    df = spark.createDataFrame([(t, n) for t, n in CAUGHT.items()] + [(t, None) for t in LEFT_ALONE], "text string, want string")
    for r in redaction.redaction_counts(df.withColumn("was", F.col("text")), "text").collect():
        if r.want is None:
            assert r.redacted == r.was and r.hits == {}, r.was
        else:
            assert r.hits.get(r.want) == 1, r.was
    once = df.select(redaction.redact(F.col("text")).alias("text"))
    assert once.where(redaction.redact(F.col("text")) != F.col("text")).count() == 0        # idempotent


def test_plain_text_is_not_searched(spark):
    df = spark.createDataFrame([("Plain prose about keys, tides and İstanbul.", None), *[(t.swapcase(), n) for t, n in CAUGHT.items() if n in redaction.LOWER_ANCHORS]], "text string, want string")
    for r in df.select("want", *[redaction.may_match(n, F.col("text")).alias(n) for n in redaction.LOWER_ANCHORS]).collect():
        assert [n for n in redaction.LOWER_ANCHORS if r[n]] == [] if r.want is None else r[r.want]
