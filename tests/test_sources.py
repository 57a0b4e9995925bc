import pytest

from millrace import operators as op
from millrace import sources
from millrace.sources import scratch_path


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, " a", 1.5), (2, "b,c", None), (3, 'q"', 0.1)], "id int, s string, x double")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_fixed_schema_csv_without_header(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("39, State-gov, 77516",), ("50, ?, 83311",)], "v string").write.text(path)
    out = sources.read_csv(spark, path + "/*", "age int, work string, weight float", strip=True)
    assert rows(out) == [(39, "State-gov", 77516.0), (50, "?", 83311.0)]


def test_written_files_come_back(spark, df):
    plain = df.filter("id <> 1")
    for write, read in (
        (sources.write_json, lambda p: sources.read_json(spark, p, df.schema)),
        (sources.write_parquet, lambda p: sources.read_parquet(spark, p)),
        (sources.write_xml, lambda p: sources.read_xml(spark, p, schema=df.schema)),
        (sources.write_csv, lambda p: sources.read_csv(spark, p)),
    ):
        path = scratch_path(spark, "f")
        write(plain, path)
        write(plain, path)  # overwrites
        assert rows(read(path)) == rows(plain)


def test_text_is_one_file(spark, df):
    path = scratch_path(spark, "text")
    sources.write_text(df.repartition(3), path, partitions=1)
    assert spark.read.text(path).inputFiles().__len__() == 1
    assert sources.read_text(spark, path).count() == 3


def test_union_of_formats(spark):
    schema = "car_model string, price double"
    folder = scratch_path(spark, "cars")
    spark.createDataFrame([("800", 1.0)], schema).write.option("header", True).csv(folder + "/a.csv")
    spark.createDataFrame([("beat", 2.0)], schema).write.json(folder + "/b.json")
    sources.write_xml(spark.createDataFrame([("ritz", 3.0)], schema), folder + "/c.xml")
    out = sources.ingest_union(spark, {k: f"{folder}/*.{k}" for k in ("csv", "json", "xml")}, schema)
    assert rows(out) == [("800", 1.0), ("beat", 2.0), ("ritz", 3.0)]


def test_tables(spark, df):
    sources.reset_schema(spark, "shop", "a comment with 'quotes'")
    sources.write_table(df, "shop.t")
    sources.write_table(spark.table("shop.t").filter("id > 1"), "shop.t")
    assert sources.read_table(spark, "shop.t").count() == 2
    assert sources.list_tables(spark, "shop") == ["t"]

    @sources.stage(["shop.t"], ["shop.u", "shop.v"], drop=["shop.t"])
    def halves(t, limit):
        return {"shop.u": t.filter(t.id < limit), "shop.v": t.filter(t.id >= limit), "note": 7}

    assert halves(spark, limit=3) == {"note": 7}
    assert sources.list_tables(spark, "shop") == ["u", "v"]
    frames = sources.read_tables(spark, ["shop.u", "shop.v"])
    assert [frames[n].count() for n in frames] == [1, 1]
    sources.reset_schema(spark, "shop")
    assert sources.list_tables(spark, "shop") == []


def test_a_failed_write_keeps_the_table(spark, df):
    sources.reset_schema(spark, "keep")
    sources.write_table(df, "keep.t")
    broken = df.selectExpr("id", "raise_error('no') AS s")
    with pytest.raises(Exception, match="no"):
        sources.write_table(broken, "keep.t")
    assert sources.read_table(spark, "keep.t").count() == 3
    sources.write_table(op.first_n(df, ["id"], 1), "keep.t")
    assert sources.read_table(spark, "keep.t").count() == 1


def test_step_must_return_its_outputs(spark, df):
    df.createOrReplaceTempView("step_input")
    step = sources.stage(["step_input"], ["never"])(lambda t: {})
    with pytest.raises(ValueError, match="never"):
        step(spark)


def test_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError):
        sources.read_jdbc(spark, "jdbc:none:x", "t", partition_column="id")


ODD_VALUES = [(1, " a "), (2, 'say "x", y'), (3, "x\ny"), (4, ""), (5, None), (6, "a\tb\\sc\\\\n\r"), (7, "\\N"), (8, "\\x")]


def test_csv_keeps_blanks_quotes_and_line_breaks(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(ODD_VALUES[:5], "k int, v string")
    sources.write_csv(df, path, nullValue="\\N")
    back = sources.read_csv(spark, path, "k int, v string", header=True, multi_line=True, nullValue="\\N")
    assert sorted(map(tuple, back.collect())) == ODD_VALUES[:5]


def test_text_keeps_separators_line_breaks_and_nulls(spark):
    path = scratch_path(spark, "text")
    sources.write_text(spark.createDataFrame(ODD_VALUES, "k int, v string"), path)
    back = sources.split_lines(sources.read_text(spark, path), "k int, v string")
    assert sorted(map(tuple, back.collect())) == ODD_VALUES
