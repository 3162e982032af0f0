"""op13: byte alignment of two tokenizers over all documents."""

import public_tokenizers

from parley.llm.alignment import align
from parley.llm.registry import query
from parley.registry.base import table


@query("op13_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark, sf_dir):
    """Groups and links of every document's tokens, and what its links count in the corpus."""
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
