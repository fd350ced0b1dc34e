"""Query of best-fit packing."""

import public_tokenizers
from pyspark.sql import DataFrame

from dayfold.llm.packing import best_fit_pack
from dayfold.llm.registry import Tables, query


@query("op4_best_fit_packing")
def op4_best_fit_packing(t: Tables) -> DataFrame:
    """All documents, packed into sequences of 1024 tokens."""
    return best_fit_pack(t.documents, public_tokenizers.path("byte_bpe_50k.json"))
