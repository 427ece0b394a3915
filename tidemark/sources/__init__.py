"""Sources and sinks."""

from .files import read_changes, read_columns
from .sinks import write_change, write_parts, write_snapshot
from .sql import bind_placeholders, bindable, query_source, statements_in
from .jdbc import jdbc_source
from .listings import flatten_pages
from .catalog_doc import read_catalog, write_catalog

__all__ = ["read_changes", "read_columns", "write_change", "write_parts", "write_snapshot",
           "query_source", "bind_placeholders", "bindable", "statements_in", "jdbc_source", "flatten_pages", "read_catalog", "write_catalog"]
