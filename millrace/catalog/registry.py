"""The query register, and small helpers for tables and for SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with SQL for the same result if there is any."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; most have none, so `quality` and `toxic` are often null."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"


def uniform_sql(key: str, seed: int | str, start: int = 1) -> str:
    """What `hash_uniform` computes; `hash_normals` also takes the digits from the 14th on."""
    digits = f"substr(md5({key}::VARCHAR || ':{seed}'), {start}, 13)"
    return f"(('0x' || {digits})::BIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def mode_sql(column: str, source: str, where: str = "true") -> str:
    """The most frequent non-null value, the lowest on ties."""
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL AND {where}"
        f" GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def values_sql(rows: list[tuple], types: list[str], names: list[str]) -> str:
    """An inline table with typed columns."""

    def literal(v: object, t: str) -> str:
        text = "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)
        return f"{text}::{t}"

    body = ", ".join("(" + ", ".join(literal(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"
