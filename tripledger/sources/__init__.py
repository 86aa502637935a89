"""Reading delimited text and writing tables."""

from tripledger.sources.delimited import find_file, has_open_quotes, read_delimited
from tripledger.sources.tables import (
    PublishConflict,
    create_tables,
    current_parts,
    current_version,
    current_versions,
    discard,
    insert_absent,
    publish,
    release,
    replace_table,
    rows_to_table,
    table_name,
    write_version,
)

__all__ = [
    "PublishConflict", "create_tables", "current_parts", "current_version", "current_versions", "discard", "find_file",
    "has_open_quotes", "insert_absent", "publish", "read_delimited", "release", "replace_table", "rows_to_table", "table_name", "write_version",
]
