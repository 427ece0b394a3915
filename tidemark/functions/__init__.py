"""Column-level functions (JVM-side expressions, no UDFs)."""

from .text import bounded_text, col_or_null, first_non_empty, is_guid, truthy
from .types import cast_type, file_type, spark_type

__all__ = ["bounded_text", "col_or_null", "first_non_empty", "is_guid", "truthy",
           "cast_type", "file_type", "spark_type"]
