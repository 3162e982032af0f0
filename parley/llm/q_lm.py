"""op4: language-model scores of all documents."""

from parley.llm.lm import score
from parley.llm.registry import query
from parley.registry.base import table


@query("op4_lm_scoring")
def lm_scoring(spark, sf_dir):
    """Base and interpolated log probability of every document."""
    return score(table(spark, sf_dir, "documents"))
