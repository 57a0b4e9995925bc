"""Column-level building blocks: names, missing values, hashes, HTML extraction."""

from millrace.functions.columns import (
    FLOATS,
    INTEGERS,
    NUMERICS,
    STRINGS,
    col,
    columns_of,
    field,
    is_missing,
    missing_test,
    present,
    quoted,
)
from millrace.functions.hashing import hash_normals, hash_uniform
from millrace.functions.html import (
    explode_range,
    extract_json_block,
    extract_list_items,
    extract_numbers,
    extract_row_headers,
    extract_table_cells,
    extract_table_rows,
    extract_tables,
    parse_rate,
)

__all__ = [
    "FLOATS",
    "INTEGERS",
    "NUMERICS",
    "STRINGS",
    "col",
    "columns_of",
    "explode_range",
    "extract_json_block",
    "extract_list_items",
    "extract_numbers",
    "extract_row_headers",
    "extract_table_cells",
    "extract_table_rows",
    "extract_tables",
    "field",
    "hash_normals",
    "hash_uniform",
    "is_missing",
    "missing_test",
    "parse_rate",
    "present",
    "quoted",
]
