from pyspark.sql import functions as F

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


def one(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("x")).first().x


def test_rate_forms(spark):
    rate = parse_rate(F.col("t"))
    cases = {
        "Nearly 13 of every 100 adults aged 25–44 years (12.6%)": (25, 44, 12.6),
        "About 1 of every 9 adults aged 45&ndash;64 years (14%)": (45, 64, 14.0),
        "Nearly 9 of every 100 adults aged 65 years and older (8.3%)": (65, None, 8.3),
        "13 of every 100 men (13.1%)": (None, None, 13.1),
        "nothing of the kind": (None, None, None),
        None: (None, None, None),
    }
    for text, expected in cases.items():
        assert tuple(one(spark, rate, text)) == expected


def test_lists(spark):
    html = '<ul class="x"><li>a</li></ul><ul id="1" class="x"><li class="main">b\nc</li><li>d</li></ul>'
    assert one(spark, extract_list_items(F.col("t"), "x", 1), html) == ["b\nc", "d"]
    assert one(spark, extract_list_items(F.col("t")), html) == ["a"]
    assert one(spark, extract_list_items(F.col("t"), "y"), html) is None


def test_table(spark):
    html = (
        '<table><tr><td>1</td></tr></table><table class="t">\n<tr><th scope="row" class="row-header">'
        '15–17</th>\n<td class="v">3.1</td><td>4</td></tr><tr><td/></tr></table>'
    )
    rows = extract_table_rows(F.col("t"), 0, "t")
    assert len(one(spark, rows, html)) == 2
    assert one(spark, extract_table_cells(F.get(rows, F.lit(0))), html) == ["3.1", "4"]
    assert one(spark, extract_row_headers(F.get(rows, F.lit(0))), html) == ["15–17"]
    assert one(spark, extract_table_rows(F.col("t"), 5), html) is None


def test_json_block(spark):
    def chart(caption, data):
        return (
            '<div class="chart-data-wrapper"><pre class="chart-caption">' + caption
            + '</pre><pre class="chart-data">' + data + "</pre></div>"
        )

    html = "<p>Smokers, 2011</p>" + chart("Other", "[[9]]") + chart("Smokers, 2011 (a)", "[[1.5],[2]]")
    assert one(spark, extract_json_block(F.col("t"), "Smokers, 2011"), html) == [[1.5], [2.0]]
    assert one(spark, extract_json_block(F.col("t"), "Absent"), html) is None


def test_numbers_and_ranges(spark):
    assert one(spark, extract_numbers(F.col("t")), "a 12 b3.50c .7") == [12.0, 3.5, 7.0]
    df = spark.createDataFrame([(1, 3), (5, 5), (7, 6)], "lo int, hi int")
    ages = df.select(explode_range(F.col("lo"), F.col("hi")).alias("a")).collect()
    assert sorted(r.a for r in ages) == [1, 2, 3, 5]
