"""Readers (Parquet file, catalog table, SQL text, path) and previews."""

from daybook.sources.readers import (
    limit_rows,
    preview,
    read_parquet,
    read_path,
    read_sql,
    read_table,
    register_view,
)

__all__ = ["limit_rows", "preview", "read_parquet", "read_path", "read_sql", "read_table", "register_view"]
