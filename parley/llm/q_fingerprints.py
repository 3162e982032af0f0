"""op7: Order MinHash fingerprints of all documents and of their edited texts."""

from parley.llm.fingerprints import fingerprint_pairs
from parley.llm.registry import query
from parley.registry.base import table


@query("op7_document_fingerprints")
def document_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
