"""The queries of this subpackage."""

from dayfold.llm import (  # noqa: F401
    q_conversations,
    q_decontaminate,
    q_embeddings,
    q_exact_dedup,
    q_html_extract,
    q_langid,
    q_lexical,
    q_licenses,
    q_near_dedup,
    q_packing,
    q_quality,
    q_secrets,
    q_token_counts,
)
from dayfold.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
