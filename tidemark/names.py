"""Fixed values shared by all modules: output column names, defaults and name lists."""

# Columns stamped on replicated rows.
UPDATED_AT = "_ab_cdc_updated_at"
DELETED_AT = "_ab_cdc_deleted_at"
CURSOR = "_ab_cdc_cursor"

# Documents.
DOCUMENT_ID = "_id"
PACKED = "data"
TEXT_SUFFIX = "_aibyte_transform"

# The cursor is emitted-epoch-seconds * CURSOR_STRIDE + a counter that starts at 1.
CURSOR_STRIDE = 100_000_000

# Sizes.
SPLIT_SAMPLE = 1_024
CHUNK_BYTES = 1 << 30
CHUNK_ROWS = 1_000_000

# Schemas that are never discovered unless named.
SYSTEM_SCHEMAS = (
    "sys",
    "INFORMATION_SCHEMA",
    "cdc",
    "guest",
    "db_accessadmin",
    "db_backupoperator",
    "db_datareader",
    "db_datawriter",
    "db_ddladmin",
    "db_denydatareader",
    "db_denydatawriter",
    "db_owner",
    "db_securityadmin",
    "spt_fallback_db",
    "spt_fallback_dev",
    "spt_fallback_usg",
    "spt_monitor",
    "spt_values",
    "MSreplication_options",
)

# Collections whose name starts with one of these are never discovered.
SYSTEM_COLLECTIONS = ("system.", "replset.", "oplog.")

# Document id types that can be resumed.
ID_TYPES = ("objectId", "string", "int", "long", "binData")
