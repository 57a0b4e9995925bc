"""Reading and writing files and tables."""

from millrace.sources.readers import (
    ingest_union,
    literal_table,
    read_csv,
    read_jdbc,
    read_json,
    read_parquet,
    read_table,
    read_tables,
    read_text,
    read_xml,
    split_lines,
)
from millrace.sources.scratch import scratch_path
from millrace.sources.tables import drop_tables, list_tables, recover_table, reset_schema, stage, write_table
from millrace.sources.writers import (
    partition_count,
    write_csv,
    write_jdbc,
    write_json,
    write_parquet,
    write_text,
    write_xml,
)

__all__ = [name for name in dir() if not name.startswith("_")]
