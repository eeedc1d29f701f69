"""Queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from kiln.llm import common
from kiln.llm import chat, codes, ctw, decontaminate, forest, jaccard, licenses, mixing, quality, substrings, tokens, toxicity, turns  # noqa: F401


def all_queries() -> dict:
    return dict(common.QUERIES)


def all_oracle_sql() -> dict:
    return dict(common.ORACLE)
