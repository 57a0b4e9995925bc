"""Extraction of rates, lists and tables from page text, as plain column expressions.

Everything here runs inside the scan stage: no parser library, no Python worker. The
functions work on the markup shapes that the statistics pages use (regular, machine
written), not on arbitrary broken HTML.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup and the sentence forms of the statistics pages.
CHART_WRAPPER = '<div class="chart-data-wrapper"'
CHART_CAPTION = r'(?s)<pre class="chart-caption"[^>]*>(.*?)</pre>'
CHART_DATA = r'(?s)<pre class="chart-data"[^>]*>(.*?)</pre>'
LIST_ITEM = r"(?s)<li[^>]*>(.*?)</li>"
TABLE_ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?s)<td[^>]*>(.*?)</td>"
ROW_HEADER = r'(?s)<th scope="row"[^>]*>(.*?)</th>'
PERCENT_IN_PARENTHESES = r"\((\d+(?:\.\d+)?)%"
AGED = r"aged (\d+)(?:(?:–|&ndash;)(\d+))?"
NUMBER = r"(\d+(?:\.\d+)?)"


def extract_json_block(html: Column, caption: str, schema: str = "array<array<double>>") -> Column:
    """JSON payload of the first chart block whose caption contains `caption`, else null."""
    blocks = F.split(html, CHART_WRAPPER)
    hits = F.filter(
        blocks, lambda b: F.regexp_extract(b, CHART_CAPTION, 1).contains(F.lit(caption))
    )
    return F.from_json(F.regexp_extract(F.get(hits, F.lit(0)), CHART_DATA, 1), schema)


def extract_list_items(html: Column, css_class: str | None = None, n: int = 0) -> Column:
    """Inner markup of the items of the n-th list (from 0) with the given class, in order."""
    attributes = rf'[^>]*class="{css_class}"[^>]*' if css_class else r"[^>]*"
    lists = F.regexp_extract_all(html, F.lit(rf"(?s)<ul{attributes}>(.*?)</ul>"), 1)
    return F.regexp_extract_all(F.get(lists, F.lit(n)), F.lit(LIST_ITEM), 1)


def extract_tables(html: Column, css_class: str | None = None) -> Column:
    attributes = rf'[^>]*class="{css_class}"[^>]*' if css_class else r"[^>]*"
    return F.regexp_extract_all(html, F.lit(rf"(?s)<table{attributes}>(.*?)</table>"), 1)


def extract_table_rows(html: Column, n: int = 0, css_class: str | None = None) -> Column:
    """Rows (inner markup) of the n-th table, an array of strings; null when there is none."""
    return F.regexp_extract_all(
        F.get(extract_tables(html, css_class), F.lit(n)), F.lit(TABLE_ROW), 1
    )


def extract_table_cells(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(TABLE_CELL), 1)


def extract_row_headers(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(ROW_HEADER), 1)


def _captured(text: Column, pattern: str, group: int, data_type: str) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found).try_cast(data_type)


def parse_rate(text: Column) -> Column:
    """Struct (lo, hi, rate) of a sentence such as "... adults aged 25–44 years (12.6%)".

    The dash may be written as an entity. "aged 65 years and older" has a null `hi`; a part
    that is not in the sentence is null.
    """
    return F.struct(
        _captured(text, AGED, 1, "int").alias("lo"),
        _captured(text, AGED, 2, "int").alias("hi"),
        _captured(text, PERCENT_IN_PARENTHESES, 1, "double").alias("rate"),
    )


def extract_numbers(text: Column) -> Column:
    """All numbers of a text in order, as an array of doubles."""
    return F.transform(F.regexp_extract_all(text, F.lit(NUMBER), 1), lambda n: n.cast("double"))


def explode_range(lo: Column, hi: Column) -> Column:
    """One row per whole number from `lo` to `hi`, both included; none when `hi` < `lo`."""
    return F.explode(F.when(hi >= lo, F.sequence(lo, hi)))
