"""op2: harmonic packing of all documents."""

import public_tokenizers

from parley.llm.packing import pack
from parley.llm.registry import query
from parley.registry.base import table


@query("op2_packing")
def packing(spark, sf_dir):
    """Every document's pieces and where they lie in sequences of 4096 ids."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
