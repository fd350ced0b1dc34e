"""Query of HTML extraction."""

from pyspark.sql import DataFrame

from dayfold.llm.html_extract import extract_pages
from dayfold.llm.registry import Tables, query


@query("op2_html_extraction")
def op2_html_extraction(t: Tables) -> DataFrame:
    """The main text of all pages."""
    return extract_pages(t.pages)
