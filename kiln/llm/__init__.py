"""Operators of a training-data pipeline: mixing, deduplication, decontamination,
extraction, scoring and secret scans. Nothing outside this subpackage imports it."""

from kiln.llm.registry import ORACLE, QUERIES
from kiln.llm import decontaminate, divergence, exact_dedup, html_text, language, line_dedup, mixing, ngram_join, periodic, quality, secrets, substring_dedup, toxicity  # noqa: F401


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLE)
