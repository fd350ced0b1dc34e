"""Queries of language identification."""

from pyspark.sql import DataFrame

from dayfold.llm.langid import identify_languages, page_evidence
from dayfold.llm.registry import Tables, query


@query("op8_language_id")
def op8_language_id(t: Tables) -> DataFrame:
    """The language of all documents; the source is the host, and no suffix is known."""
    return identify_languages(t.documents)


@query("page_languages")
def page_languages(t: Tables) -> DataFrame:
    """The language of all pages: text, declared language of the markup, address suffix, host and its domain."""
    pages = page_evidence(t.pages)
    return identify_languages(pages, "page_id", "plain", "declared", "suffix", "host", carry=["declared", "suffix", "host"])
