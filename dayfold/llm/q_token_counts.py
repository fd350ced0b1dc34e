"""Query of token counts."""

import public_tokenizers
from pyspark.sql import DataFrame

from dayfold.llm.registry import Tables, query
from dayfold.llm.token_counts import count_tokens


@query("op9_token_counts")
def op9_token_counts(t: Tables) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(t.documents, public_tokenizers.path("piece_bpe_32k.model"))
