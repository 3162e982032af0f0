"""op10: byte-level BPE over all documents."""

import public_tokenizers

from parley.llm.bpe import digests
from parley.llm.registry import query
from parley.registry.base import table


@query("op10_byte_bpe")
def byte_bpe(spark, sf_dir):
    """Digests of every document's ids and of what they decode to."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
