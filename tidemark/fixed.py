"""Fixed values that must equal the reference behaviour for equal results.

They are stated plainly here, in one place, and used by name elsewhere.
"""

# Change-row envelope column names and codes.
WATERMARK_COL = "__watermark"
OP_COL = "__op"
DELETED_COL = "__deleted"
ROW_MARKER_COL = "__rowMarker__"
OP_UPSERT = "u"
MARKER_PRESENT = 4
MARKER_GONE = 2

# Change-feed file numbering.
SEQUENCE_DIGITS = 10

# Default batch / fetch size and row-group size.
BATCH_ROWS = 50_000

# Column-name prefixes for discovered keys and watermarks.
PK_PREFIX = "PK"
WM_PREFIX = "WM"

# System schemas are those starting with SYS or named below.
SYSTEM_SCHEMA_PREFIX = "SYS"
SYSTEM_SCHEMA_NAMES = ("SYSTEM", "PUBLIC")

# Declared-type rules.
DEFAULT_DECIMAL_PRECISION = 38
DEFAULT_DECIMAL_SCALE = 0
DEFAULT_VARCHAR_LENGTH = 5000
DEFAULT_CHAR_LENGTH = 1
FALLBACK_CAST_TYPE = "VARCHAR(8000)"
LARGE_STRING_FROM_LENGTH = 1024

# Nullable flags in normalised column metadata.
NULLABLE_YES = "YES"
NULLABLE_NO = "NO"

# An id in a listing is a hyphenated 8-4-4-4-12 hex string.
GUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

# Listing pages hold their items under this key by default,
# and point to the next page with one of these keys.
DEFAULT_LIST_FIELD = "value"
NEXT_LINK_FIELDS = ("continuationUri", "@odata.nextLink")

# The elapsed time in run records is rounded to 6 decimals.
ELAPSED_DECIMALS = 6
