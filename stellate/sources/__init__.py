from stellate.sources.codelists import inline_code_list, parse_code_lists, render_code_list
from stellate.sources.csv import read_csv_strings, write_csv
from stellate.sources.tables import TABLES, read_table, table_counts

__all__ = [
    "TABLES",
    "inline_code_list",
    "parse_code_lists",
    "read_csv_strings",
    "read_table",
    "render_code_list",
    "table_counts",
    "write_csv",
]
