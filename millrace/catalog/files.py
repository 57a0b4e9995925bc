"""Files and tables: what is written is read back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace import sources
from millrace.catalog.registry import query, table

_CUSTOMER = "SELECT * FROM customer"


@query(_CUSTOMER)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with header, read with a schema."""
    df, path = table(spark, sf, "customer"), sources.scratch_path(spark, "csv")
    sources.write_csv(df, path)
    return sources.read_csv(spark, path, df.schema, header=True)


@query("SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with header, types found by reading."""
    path = sources.scratch_path(spark, "csv")
    sources.write_csv(table(spark, sf, "customer"), path, partitions=2)
    return sources.read_csv(spark, path)


@query(_CUSTOMER)
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df, path = table(spark, sf, "customer"), sources.scratch_path(spark, "json")
    sources.write_json(df, path)
    return sources.read_json(spark, path, df.schema)


@query(_CUSTOMER)
def xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df, path = table(spark, sf, "customer"), sources.scratch_path(spark, "xml")
    sources.write_xml(df, path)
    return sources.read_xml(spark, path, "row", df.schema)


@query(_CUSTOMER)
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df, path = table(spark, sf, "customer"), sources.scratch_path(spark, "parquet")
    sources.write_parquet(df, path)
    return sources.read_parquet(spark, path)


@query("SELECT c_custkey, c_name FROM customer")
def text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of text, split again after reading."""
    path = sources.scratch_path(spark, "text")
    sources.write_text(table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    return sources.split_lines(sources.read_text(spark, path), "c_custkey bigint, c_name string")


@query(_CUSTOMER)
def table_replace_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table that is replaced by a frame computed from itself."""
    df = table(spark, sf, "customer")
    name = "millrace_customer_copy"
    sources.drop_tables(spark, [name])
    sources.write_table(
        df.withColumn("c_acctbal", F.col("c_acctbal") * 2), name, sources.scratch_path(spark, name)
    )
    doubled = sources.read_table(spark, name)
    sources.write_table(
        doubled.withColumn("c_acctbal", F.col("c_acctbal") / 2), name, sources.scratch_path(spark, name)
    )
    return sources.read_tables(spark, [name])[name]


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey < 8
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey BETWEEN 8 AND 15
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey > 15
""")
def ingest_union(spark: SparkSession, sf: str) -> DataFrame:
    """Three formats, one table: the customers of some nations in each."""
    df = table(spark, sf, "customer")
    nation, kept = F.col("c_nationkey"), ["c_custkey", "c_name", "c_acctbal"]
    paths = {kind: sources.scratch_path(spark, kind) for kind in ("csv", "json", "xml")}
    sources.write_csv(df.filter(nation < 8).select(*kept), paths["csv"])
    sources.write_json(df.filter(nation.between(8, 15)).select(*kept), paths["json"])
    sources.write_xml(df.filter(nation > 15).select(*kept), paths["xml"])
    return sources.ingest_union(spark, paths, df.select(*kept).schema)


@query("""
SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL
SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier
""")
def schema_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A schema emptied and filled again: its tables, with their rows."""
    schema = "millrace_schema"
    sources.reset_schema(spark, schema, "copies of three tables")
    for name in ("customer", "orders", "supplier", "nation"):
        path = sources.scratch_path(spark, name)
        sources.write_table(table(spark, sf, name), f"{schema}.{name}", path)
    sources.drop_tables(spark, [f"{schema}.nation"])
    counts = [
        op.row_count(spark.table(f"{schema}.{name}")).select(F.lit(name).alias("name"), "n")
        for name in sources.list_tables(spark, schema)
    ]
    return op.union_all(counts)


@query("SELECT c_mktsegment, round(avg(c_acctbal), 6) AS average_c_acctbal FROM customer GROUP BY 1")
def stage_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two steps from tables to tables; the one in between is dropped."""
    source, clean, result = (f"millrace_stage_{n}" for n in ("source", "clean", "result"))
    sources.drop_tables(spark, [source, clean, result])
    table(spark, sf, "customer").createOrReplaceTempView(source)

    @sources.stage([source], [clean], paths=lambda n: sources.scratch_path(spark, n))
    def cleaned(customers: DataFrame) -> DataFrame:
        return op.drop_missing(customers)

    @sources.stage([clean], [result], drop=[clean], paths=lambda n: sources.scratch_path(spark, n))
    def averaged(customers: DataFrame) -> DataFrame:
        return op.group_avg(customers, ["c_mktsegment"], "c_acctbal")

    cleaned(spark)
    averaged(spark)
    return op.round_columns(spark.table(result), ["average_c_acctbal"], 6)
