"""op12: spelling variants among the words of all documents."""

from parley.llm.registry import query
from parley.llm.variants import group_variants
from parley.registry.base import table


@query("op12_spelling_variant_grouping")
def spelling_variant_grouping(spark, sf_dir):
    """Every word with its near words' number, its form and its root."""
    return group_variants(table(spark, sf_dir, "documents"))
