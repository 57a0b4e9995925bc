"""Extraction from page text: the given pages, and pages with the statistics sites' markup.

The second kind is made from the rows of `part`, so that it grows with the tables and its
SQL can state the expected values without any parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import query, table
from millrace.functions import (
    explode_range,
    extract_json_block,
    extract_list_items,
    extract_numbers,
    extract_row_headers,
    extract_table_cells,
    extract_table_rows,
    parse_rate,
)


@query(r"""
SELECT page_id, i - 1 AS pos, items[i] AS item FROM (
  SELECT page_id, items, unnest(generate_series(1, len(items)))::INTEGER AS i FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul[^>]*>(.*?)</ul>', 1),
                                       '(?s)<li[^>]*>(.*?)</li>', 1) AS items FROM pages))
""")
def page_list_items(spark: SparkSession, sf: str) -> DataFrame:
    """The items of the first list of every page, in order."""
    items = F.posexplode(extract_list_items(F.col("html")))
    return table(spark, sf, "pages").select("page_id", items.alias("pos", "item"))


@query(r"""
SELECT doc_id, i - 1 AS pos, numbers[i]::DOUBLE AS number FROM (
  SELECT doc_id, numbers, unnest(generate_series(1, len(numbers)))::INTEGER AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '\d+(?:\.\d+)?') AS numbers FROM documents))
""")
def text_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """All numbers in all documents."""
    numbers = F.posexplode(extract_numbers(F.col("text")))
    return table(spark, sf, "documents").select("doc_id", numbers.alias("pos", "number"))


def _join(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


@query("""
SELECT p_partkey, 0 AS pos, 10 + p_size AS lo, 19 + p_size AS hi, p_size + 0.5::DOUBLE AS rate FROM part
UNION ALL
SELECT p_partkey, 1, 20 + p_size, 29 + p_size, p_size::DOUBLE FROM part
UNION ALL
SELECT p_partkey, 2, 30 + p_size, CAST(NULL AS INTEGER), p_size + 0.25::DOUBLE FROM part
""")
def page_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Age bands and rates from the sentences of a page's second list of a class."""
    size = F.col("p_size")
    html = _join(
        '<div class="row "><ul class="block-list"><li class="main">men (13.1%)</li></ul>',
        '<ul class="plain"><li>aged 1–2 years (3%)</li></ul><ul class="block-list">\n',
        "<li>Nearly 1 of every 8 adults aged ", size + 10, "–", size + 19, " years (", size, ".5%)</li>\n",
        "<li>About 1 of every 7 adults aged ", size + 20, "&ndash;", size + 29, " years (", size, "%)</li>",
        "<li>Nearly 1 of every 12 adults aged ", size + 30, " years and older (", size, ".25%)</li>",
        "</ul></div>",
    )
    page = table(spark, sf, "part").select("p_partkey", html.alias("html"))
    items = F.posexplode(extract_list_items(F.col("html"), "block-list", 1))
    return page.select("p_partkey", items.alias("pos", "item")).select(
        "p_partkey", "pos", parse_rate(F.col("item")).alias("r")
    ).select("p_partkey", "pos", "r.*")


@query("""
SELECT p_partkey, (lo + unnest(generate_series(0, width)))::INTEGER AS age, rate FROM (
  SELECT p_partkey, 15 + p_size AS lo, 2 AS width, p_retailprice AS rate FROM part
  UNION ALL SELECT p_partkey, 18 + p_size, 6, p_size + 0.5::DOUBLE FROM part)
""")
def page_table_rates(spark: SparkSession, sf: str) -> DataFrame:
    """One row per age from the second table of a page: row headers hold ranges, cells rates."""
    size, price = F.col("p_size"), F.col("p_retailprice").cast("string")

    def row(lo: Column, hi: Column, rate: Column) -> Column:
        return _join(
            '<tr><th scope="row" class="row-header">', lo, "–", hi, "</th>\n",
            '<td class="data-value">1.0</td><td class="data-value">', rate, "</td></tr>\n",
        )

    html = _join(
        '<table class="responsive-enabled" data-x="1"><tr><td>no</td></tr></table>',
        "<table><tr><td>other</td></tr></table>",
        '<table class="responsive-enabled">\n<tr><th>age</th></tr>',
        row(size + 15, size + 17, price),
        row(size + 18, size + 24, _join(size, ".5")),
        "</table>",
    )
    rows = F.explode(extract_table_rows(html, 1, "responsive-enabled")).alias("row")
    ranges = F.split(F.get(extract_row_headers(F.col("row")), F.lit(0)), "–|-")
    bands = table(spark, sf, "part").select("p_partkey", rows).select(
        "p_partkey",
        F.get(ranges, F.lit(0)).try_cast("int").alias("lo"),
        F.get(ranges, F.lit(1)).try_cast("int").alias("hi"),
        F.get(extract_table_cells(F.col("row")), F.lit(1)).try_cast("double").alias("rate"),
    )
    return bands.select("p_partkey", explode_range(F.col("lo"), F.col("hi")).alias("age"), "rate")


@query("""
SELECT p_partkey, i AS pos, (CASE WHEN i = 0 THEN p_size + 0.5::DOUBLE ELSE p_retailprice END) / 100 AS rate
FROM part, (VALUES (0), (1)) v(i)
""")
def page_json_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers of the chart whose caption contains a text."""
    size, price = F.col("p_size"), F.col("p_retailprice").cast("string")

    def chart(caption: str, *data: Column | str) -> Column:
        return _join(
            '<div class="chart-data-wrapper"><pre class="chart-caption">', caption, "</pre>\n",
            '<pre class="chart-data">', *data, "</pre></div>",
        )

    html = _join(
        "<body>",
        chart("Share of people by sex", "[[1.0],[2.0]]"),
        chart("Proportion of people 15 years and over by age, 2011", "[[", size, ".5],[", price, "]]"),
        "</body>",
    )
    rates = F.flatten(extract_json_block(html, "15 years and over by age"))
    df = table(spark, sf, "part").select("p_partkey", F.posexplode(rates).alias("pos", "percent"))
    return df.select("p_partkey", "pos", (F.col("percent") / 100).alias("rate"))
