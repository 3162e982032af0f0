"""Operators for training-data pipelines, and their registered queries."""

from parley.llm import (  # noqa: F401
    q_alignment, q_bpe, q_chat, q_fingerprints, q_jaccard, q_licenses, q_lm, q_packing, q_quality, q_substrings, q_urls,
    q_variants, q_warc,
)
from parley.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
