"""op1: exact Jaccard components of all documents."""

from parley.llm.jaccard import link_components
from parley.llm.registry import query
from parley.registry.base import table


@query("op1_ngram_jaccard_join")
def ngram_jaccard_join(spark, sf_dir):
    """Set size and component of every document."""
    return link_components(table(spark, sf_dir, "documents"))
