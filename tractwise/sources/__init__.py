"""Tables, files and catalog."""

from tractwise.sources.files import (
    export_csv, read_csv, read_csv_column, read_grouped, read_state_codes, write_grouped,
)
from tractwise.sources.tables import (
    append_table, ensure_schema, latest_schema, preview, query, read_table, replace_table,
    replace_view, write_counted,
)
from tractwise.sources.versions import BatchTable, current_path, publish_folder, publish_table

__all__ = [
    "BatchTable", "append_table", "current_path", "ensure_schema", "export_csv", "latest_schema", "preview", "publish_folder", "publish_table", "query",
    "read_csv", "read_csv_column", "read_grouped", "read_state_codes", "read_table",
    "replace_table", "replace_view", "write_counted", "write_grouped",
]
