"""op5: repeats of passages and paragraphs across all documents."""

from parley.llm.registry import query
from parley.llm.substrings import find_repeats
from parley.registry.base import table


@query("op5_substring_dedup")
def substring_dedup(spark, sf_dir):
    """Every repeat: which words of which document, and whether this is the copy that stays."""
    return find_repeats(table(spark, sf_dir, "documents")).drop("place")
