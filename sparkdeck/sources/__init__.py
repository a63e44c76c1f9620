"""Sources, sinks and the session catalog."""

from .files import count_lines, read_csv, read_delimited, write_csv, write_parquet
from .tables import (DRIVER_TABLES, clean_names, create_table, head, list_tables, load_table,
                     materialize, read_parquet, register_tables, sql, table)

__all__ = ["count_lines", "read_csv", "read_delimited", "write_csv", "write_parquet",
           "DRIVER_TABLES", "clean_names", "create_table", "head", "list_tables", "load_table",
           "materialize", "read_parquet", "register_tables", "sql", "table"]
