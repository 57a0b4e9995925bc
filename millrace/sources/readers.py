"""Sources. Paths may be globs and may name any file system that Hadoop knows (`s3a://`)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.setops import union_all

Schema = T.StructType | str
Paths = str | Sequence[str]


def _paths(path: Paths) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: Schema | None = None,
    header: bool | None = None,
    strip: bool = False,
    multi_line: bool = False,
    **options: object,
) -> DataFrame:
    """CSV files. With a schema there is no header unless said; without one there is.

    Without a schema the types are inferred, which reads the files once more. `strip` takes
    blanks off both ends of the values. `multi_line` reads values with line breaks, at the
    price that a file is read by one task.
    """
    header = schema is None if header is None else header
    kept = {"escape": '"', "ignoreLeadingWhiteSpace": strip, "ignoreTrailingWhiteSpace": strip}
    reader = spark.read.options(header=header, multiLine=multi_line, **{**kept, **options})
    if schema is not None:
        return reader.schema(schema).csv(_paths(path))
    return reader.option("inferSchema", True).csv(_paths(path))


def read_json(
    spark: SparkSession, path: Paths, schema: Schema | None = None, **options: object
) -> DataFrame:
    """JSON, one record per line."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(_paths(path))


def read_xml(
    spark: SparkSession,
    path: Paths,
    row_tag: str = "row",
    schema: Schema | None = None,
    **options: object,
) -> DataFrame:
    """XML, one record per `row_tag` element."""
    reader = spark.read.format("xml").option("rowTag", row_tag).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(",".join(_paths(path)))


def read_text(spark: SparkSession, path: Paths) -> DataFrame:
    """Text lines, in the column `value`."""
    return spark.read.text(_paths(path))


def split_lines(lines: DataFrame, schema: str, sep: str = "\t") -> DataFrame:
    """The columns of lines that `write_text` wrote, with the types of `schema`."""
    parts = F.split("value", f"\\Q{sep}\\E", -1)
    fields = T.StructType.fromDDL(schema)

    def plain(value: Column) -> Column:
        mark = F.lit("\\x")  # no code: keeps escaped backslashes apart while the rest is turned back
        text = F.replace(value, F.lit("\\\\"), mark)
        for code, sign in (("\\s", sep), ("\\n", "\n"), ("\\r", "\r")):
            text = F.replace(text, F.lit(code), F.lit(sign))
        return F.when(value != "\\N", F.replace(text, mark, F.lit("\\")))

    return lines.select(*[plain(parts[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def read_parquet(spark: SparkSession, path: Paths, **options: object) -> DataFrame:
    """Parquet files, or all of a folder."""
    return spark.read.options(**options).parquet(*_paths(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.table(name) for name in names}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table, read in `partitions` ranges of a column when one is named.

    Connection options such as user and password are arguments; nothing is stored.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        lower, upper = bounds or (None, None)
        if lower is None or upper is None:
            raise ValueError("a partition column needs its bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=partitions,
        )
    return reader.load()


def ingest_union(
    spark: SparkSession, sources: Mapping[str, Paths], schema: Schema, row_tag: str = "row"
) -> DataFrame:
    """Files of several formats ("csv", "json", "xml", "parquet") under one schema.

    CSV files have a header. The schema is given, so no file is read to find it out.
    """
    readers = {
        "csv": lambda p: read_csv(spark, p, schema, header=True),
        "json": lambda p: read_json(spark, p, schema),
        "xml": lambda p: read_xml(spark, p, row_tag, schema),
        "parquet": lambda p: spark.read.schema(schema).parquet(*_paths(p)),
    }
    return union_all([readers[kind](path) for kind, path in sources.items()])


def literal_table(
    spark: SparkSession, rows: Sequence[Sequence[object]], schema: Schema | Sequence[str]
) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)
