"""DataFrame operators: projections, filters, joins, aggregates, ordering
and nested catalog structures."""

from .aggregates import (assert_unique, catalog_totals, count_by, duplicate_keys, key_summary, max_column,
                         max_tuple, next_watermark, pk_columns, run_outcome, table_counts, watermark_after,
                         wm_columns)
from .filters import in_schemas, mark_range, non_empty, non_system_schemas, since, typed_lit, with_any_tag
from .joins import (change_order, change_rows, columns_of, copy_plan, delta_key_bounds, domain_workspaces,
                    resolve_unique, tagged_reports, with_children)
from .nested import build_catalog, catalog_entries, flatten_catalog, inventory
from .ordering import head, ordered_metadata, sort_rows, sorted_files
from .project import conform, envelope, normalise_columns

__all__ = [n for n in dir() if not n.startswith("_")]
