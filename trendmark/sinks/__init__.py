"""Writers."""

from trendmark.sinks.convert import convert_csv, conversion_manifest
from trendmark.sinks.raw_json import write_raw_documents
from trendmark.sinks.tables import publish, register, write_partitioned

__all__ = [
    "conversion_manifest",
    "convert_csv",
    "publish",
    "register",
    "write_partitioned",
    "write_raw_documents",
]
