"""Query of the licence scan."""

from pyspark.sql import DataFrame

from dayfold.llm.licenses import scan_licenses
from dayfold.llm.registry import Tables, query


@query("op5_license_scan")
def op5_license_scan(t: Tables) -> DataFrame:
    """Licence notices of all documents."""
    return scan_licenses(t.documents)
