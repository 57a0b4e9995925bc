"""Replacing a table: all old or all new rows at any time, wherever it stops."""

import pytest
from pyspark.sql import functions as F

from millrace import sources
from millrace.sources import tables


@pytest.fixture
def shop(spark):
    sources.reset_schema(spark, "versions")
    yield "versions.t"
    spark.sql("DROP DATABASE versions CASCADE")


def rows(spark, name):
    return sorted(r.id for r in spark.table(name).select("id").collect())


class Lost(Exception):
    pass


@pytest.mark.parametrize("other_columns", [False, True])
@pytest.mark.parametrize("at", range(4))
def test_a_crash_leaves_a_whole_table(spark, shop, monkeypatch, other_columns, at):
    old, new = spark.range(5).toDF("id"), spark.range(10, 13).toDF("id")
    sources.write_table(old, shop)
    if other_columns:
        new = new.withColumn("more", F.lit("x"))
    run, seen = tables._run, []

    def stopping(session, statement):
        if len(seen) == at:
            raise Lost(statement)
        seen.append(statement)
        return run(session, statement)

    monkeypatch.setattr(tables, "_run", stopping)
    done = False
    try:
        sources.write_table(new, shop)
        done = True
    except Lost:
        pass
    monkeypatch.setattr(tables, "_run", run)
    assert done == (at == 3)
    if not other_columns:  # there is a table even before anything is cleared up
        assert rows(spark, shop) == ([10, 11, 12] if at else [0, 1, 2, 3, 4])
    tables.recover_table(spark, shop)
    assert rows(spark, shop) in ([0, 1, 2, 3, 4], [10, 11, 12])
    assert sources.list_tables(spark, "versions") == ["t"]
    sources.write_table(spark.table(shop).select("id").union(spark.range(7, 8)), shop)
    assert 7 in rows(spark, shop) and sources.list_tables(spark, "versions") == ["t"]


def test_versions_are_cleared_and_read_from_themselves(spark, shop):
    sources.write_table(spark.range(3).toDF("id"), shop)
    for i in range(4):
        before, _ = tables._described(spark, shop)
        sources.write_table(spark.table(shop).withColumn("id", F.col("id") + 1), shop)
        assert rows(spark, shop) == [i + 1, i + 2, i + 3]
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(before).count()


def test_failed_content_leaves_the_old_rows(spark, shop):
    sources.write_table(spark.range(3).toDF("id"), shop)
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        sources.write_table(broken, shop)
    assert rows(spark, shop) == [0, 1, 2]


def test_external_tables(spark, shop, tmp_path):
    sources.write_table(spark.range(3).toDF("id"), shop, str(tmp_path / "a"))
    sources.write_table(spark.range(4).toDF("id"), shop, str(tmp_path / "b"))
    assert rows(spark, shop) == [0, 1, 2, 3] and tables._described(spark, shop)[0].endswith("/b")
    sources.write_table(spark.range(2).toDF("id"), shop)  # managed again
    assert rows(spark, shop) == [0, 1] and tables._described(spark, shop)[1] == "MANAGED"
