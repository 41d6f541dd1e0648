"""Readers, writers and the adapters that shape the given tables as entities."""

from tallyroom.sources.index import ContentIndex
from tallyroom.sources.readers import (
    align_for_union,
    conform_schema,
    read_entity,
    read_staged_stream,
    read_stream,
    read_table,
    stamp,
    stored_files,
    table_exists,
    union_aligned,
)
from tallyroom.sources.versions import Versions
from tallyroom.sources.writers import (
    Workspace,
    materialise,
    remove_path,
    write_entity,
    write_if_any,
    write_table,
)

__all__ = [
    "ContentIndex", "Versions", "Workspace", "align_for_union", "conform_schema", "materialise", "read_entity",
    "read_staged_stream", "read_stream", "read_table", "remove_path",
    "stamp", "stored_files", "table_exists", "union_aligned", "write_entity", "write_if_any", "write_table",
]
