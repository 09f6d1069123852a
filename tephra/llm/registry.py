"""The queries of this folder and their SQL."""

from __future__ import annotations

from . import bpe, conversations, decontaminate, licenses, line_dedup, lm, minhash, pii, quality_rules, secrets, spelling, toxicity, warc

MODULES = (quality_rules, licenses, toxicity, decontaminate, lm, bpe, secrets, warc, minhash, line_dedup, pii, conversations, spelling)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
