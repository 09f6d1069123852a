"""Credential redaction, counting and scanning over a text column, pattern after pattern on the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pattern = tuple[str, str, str]

# Fixed values: (name, pattern, replacement), applied in this order. A whole key block goes before a truncated one.
PATTERNS = [
    ("hf_token", r"hf_[A-Za-z0-9]{20,}", "<redacted:hf_token>"),
    ("runpod_key", r"rpa_[A-Za-z0-9]{20,}", "<redacted:runpod_key>"),
    ("sk_key", r"sk-[A-Za-z0-9_\-]{20,}", "<redacted:sk_key>"),
    ("github_token", r"gh[pousr]_[A-Za-z0-9]{30,}", "<redacted:github_token>"),
    ("github_pat", r"github_pat_[A-Za-z0-9_]{20,}", "<redacted:github_pat>"),
    ("aws_access_key", r"(?:AKIA|ASIA)[0-9A-Z]{16}", "<redacted:aws_access_key>"),
    ("slack_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", "<redacted:slack_token>"),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----", "<redacted:private_key>"),
    ("private_key_truncated", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*", "<redacted:private_key>"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "<redacted:jwt>"),
    ("google_api_key", r"AIza[0-9A-Za-z_\-]{35}", "<redacted:google_api_key>"),
    ("stripe_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", "<redacted:stripe_key>"),
    ("sendgrid_key", r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}", "<redacted:sendgrid_key>"),
    ("slack_webhook", r"https://hooks\.slack\.com/services/T[A-Za-z0-9]+/B[A-Za-z0-9]+/[A-Za-z0-9]{16,}", "<redacted:slack_webhook>"),
    ("bearer", r"(?i)\bbearer\s+[A-Za-z0-9._+/=\-]{20,}", "Bearer <redacted:bearer>"),
    ("basic_auth", r"(?i)\bbasic\s+[A-Za-z0-9+/=]{16,}", "Basic <redacted:basic_auth>"),
    ("url_password", r"(://[^:/\s@'\"]+:)([^@\s'\"]{6,})@", "$1<redacted:url_password>@"),
    ("query_secret", r"(?i)([?&](?:api[_-]?key|key|token|access[_-]?token|secret|password)=)([^&\s'\"<]{8,})", "$1<redacted:query_secret>"),
    ("kv_secret",
     r"(?i)([A-Za-z0-9_\-]*(?:api[_-]?key|secret|token(?!izer)|password|passwd|authorization|credential)[A-Za-z0-9_\-]*)"
     r"(['\"]?\s*[:=]\s*['\"]?)(?![0-9.]+(?:[\s'\"<>,;)\]}]|$))"
     r"(?![^\s'\"<>,;)\]}]*(?:redacted|placeholder|\.\.\.|\*\*\*|xxxx|changeme|your[_-]?))([^\s'\"<>,;)\]}]{8,})",
     "$1$2<redacted:kv_secret>"),
]
# The patterns without look-around, which every SQL engine can run.
PORTABLE = [p for p in PATTERNS if p[0] != "kv_secret"]


# Text every match of the pattern contains. Looking for it costs far less than running the pattern,
# and most texts hold none.
ANCHORS = {
    "hf_token": ["hf_"], "runpod_key": ["rpa_"], "sk_key": ["sk-"], "github_token": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "github_pat": ["github_pat_"], "aws_access_key": ["AKIA", "ASIA"], "slack_token": ["xox"], "private_key": ["-----BEGIN "],
    "private_key_truncated": ["-----BEGIN "], "jwt": ["eyJ"], "google_api_key": ["AIza"], "stripe_key": ["k_live_", "k_test_"],
    "sendgrid_key": ["SG."], "slack_webhook": ["https://hooks.slack.com/services/T"], "url_password": ["://"],
}
# The same for patterns that ignore case, looked for in the text in lower case.
LOWER_ANCHORS = {
    "bearer": ["bearer"], "basic_auth": ["basic"], "query_secret": ["key=", "token=", "secret=", "password="],
    "kv_secret": ["apikey", "api_key", "api-key", "secret", "token", "password", "passwd", "authorization", "credential"],
}


def may_match(name: str, text: Column) -> Column:
    if name in LOWER_ANCHORS:
        return bound(F.lower(text), lambda t: any_of(t, LOWER_ANCHORS[name]))
    return any_of(text, ANCHORS[name]) if name in ANCHORS else F.lit(True)


def any_of(text: Column, anchors: Sequence[str]) -> Column:
    return reduce(or_, [text.contains(a) for a in anchors])


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often `body` uses it.

    A pattern's step needs the text three times; written plainly, nineteen nested steps (or a filter pushed
    below them) would grow threefold each.
    """
    return F.transform(F.array(value), body)[0]


def replaced(text: Column, name: str, pattern: str, replacement: str) -> Column:
    return F.when(may_match(name, text), F.regexp_replace(text, F.lit(pattern), F.lit(replacement))).otherwise(text)


def redact(text: Column, patterns: Sequence[Pattern] = PATTERNS) -> Column:
    """Replace every credential by <redacted:NAME>; already redacted text stays as it is."""
    def step(p: Pattern) -> Callable[[Column], Column]:
        return lambda t: replaced(t, *p)

    for p in patterns:
        text = bound(text, step(p))
    return text


def redaction_counts(df: DataFrame, text: str, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """`df` without `text` plus `redacted` and `hits` (map name -> count > 0).

    Each pattern counts on the text as the earlier ones left it, so a token is counted once.
    """
    def step(i: int) -> Callable[[Column], Column]:
        name, pattern, _ = patterns[i]

        def body(s: Column) -> Column:
            n = F.when(may_match(name, s["t"]), F.regexp_count(s["t"], F.lit(pattern))).otherwise(0)
            return F.struct(replaced(s["t"], *patterns[i]).alias("t"), *[s[f"n{j}"].alias(f"n{j}") for j in range(i)], n.alias(f"n{i}"))
        return body

    def result(s: Column) -> Column:
        pairs = F.map_from_entries(F.array(*[F.struct(F.lit(p[0]), s[f"n{i}"].cast("bigint")) for i, p in enumerate(patterns)]))
        return F.struct(s["t"].alias("redacted"), F.map_filter(pairs, lambda _, v: v > 0).alias("hits"))

    state = F.struct(F.col(text).alias("t"))
    for i in range(len(patterns)):
        state = bound(state, step(i))
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, bound(state, result).alias("_s")).select(*keep, "_s.redacted", "_s.hits")


def total_hits(counted: DataFrame, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """Hits per pattern over the whole table (patterns without hits have no row)."""
    sums = [F.sum(F.coalesce(F.try_element_at("hits", F.lit(p[0])), F.lit(0))).alias(f"n{i}") for i, p in enumerate(patterns)]
    rows = F.array(*[F.struct(F.lit(p[0]).alias("pattern"), F.col(f"n{i}").alias("n")) for i, p in enumerate(patterns)])
    return counted.agg(*sums).select(F.inline(rows)).where("n > 0")


def mask(match: Column) -> Column:
    """Enough of a match to find it again, never the secret."""
    dots = F.lit("…")
    return F.when(F.length(match) > 12, F.concat(F.left(match, F.lit(6)), dots, F.right(match, F.lit(3)))).otherwise(
        F.concat(F.left(match, F.lit(3)), dots))


def find_secrets(df: DataFrame, text: str, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """One row per match of any pattern on the original text: (columns of df without text, pattern, masked)."""
    def matches(name: str, rx: str) -> Column:
        all_of = F.when(may_match(name, F.col(text)), F.regexp_extract_all(text, F.lit(rx), F.lit(0))).otherwise(F.array().cast("array<string>"))
        return F.transform(all_of, lambda m: F.struct(F.lit(name).alias("pattern"), mask(m).alias("masked")))

    found = F.flatten(F.array(*[matches(name, rx) for name, rx, _ in patterns]))
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.inline(found))
