"""Catalog tables, and functions that go from tables to tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.columns import quoted


def _quoted_table(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def _run(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(statement)


def _described(spark: SparkSession, name: str) -> tuple[str, str]:
    """Location and type (MANAGED or EXTERNAL) of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted_table(name)}").collect()}
    return rows["Location"], rows["Type"]


def _moved(spark: SparkSession, name: str, location: str) -> None:
    text = location.replace("\\", "\\\\").replace("'", "\\'")
    _run(spark, f"ALTER TABLE {_quoted_table(name)} SET LOCATION '{text}'")


def _beside(spark: SparkSession, name: str, mark: str) -> list[str]:
    """Tables beside `name` that a replacement made."""
    *schema, last = name.split(".")
    listed = spark.catalog.listTables(".".join(map(quoted, schema)) or None)
    return [".".join([*schema, t.name]) for t in listed if t.name.startswith(f"{last}__{mark}".lower())]


def recover_table(spark: SparkSession, name: str) -> None:
    """Clear up after a replacement that did not come to its end; `write_table` does so first."""
    for before in _beside(spark, name, "before"):
        if spark.catalog.tableExists(name):
            _run(spark, f"DROP TABLE {_quoted_table(before)}")
        else:
            _run(spark, f"ALTER TABLE {_quoted_table(before)} RENAME TO {_quoted_table(name)}")
    for made in _beside(spark, name, "next_"):
        location, _ = _described(spark, made)
        if spark.catalog.tableExists(name) and _described(spark, name)[0] == location:
            _moved(spark, made, f"{location}__unused")
        _run(spark, f"DROP TABLE {_quoted_table(made)}")


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a catalog table.

    The new content is a version in a folder of its own, which becomes the table's by one change
    of the catalog, the table's location. So there is no time without a table; a failure leaves
    either all old or all new rows, and the content may be computed from the old one. The old
    version's folder is then removed. A version with other columns, or of another type, cannot
    be switched to like that: the old table is renamed before and dropped after the new one has
    its name, and `recover_table`, or the next replacement, brings it back if that was not
    reached. `path`, a folder not used before, makes an external table.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    exists = spark.catalog.tableExists(name)
    target = f"{name}__next_{uuid.uuid4().hex}" if exists else name
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(_quoted_table(target))
    if not exists:
        return
    old, new = _described(spark, name), _described(spark, target)
    kinds = [[(f.name, f.dataType) for f in spark.table(_quoted_table(t)).schema] for t in (name, target)]
    if old[1] == new[1] and kinds[0] == kinds[1]:
        _moved(spark, name, new[0])
        _moved(spark, target, old[0])
        _run(spark, f"DROP TABLE {_quoted_table(target)}")
    else:
        before = f"{name}__before"
        _run(spark, f"ALTER TABLE {_quoted_table(name)} RENAME TO {_quoted_table(before)}")
        _run(spark, f"ALTER TABLE {_quoted_table(target)} RENAME TO {_quoted_table(name)}")
        _run(spark, f"DROP TABLE {_quoted_table(before)}")
    spark.catalog.refreshTable(_quoted_table(name))


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted_table(name)}")


def reset_schema(spark: SparkSession, name: str, comment: str | None = None) -> None:
    """Drop a schema with all its tables and create it empty."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")
    spark.sql(f"CREATE DATABASE {quoted(name)}")
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON DATABASE {quoted(name)} IS '{text}'")


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    tables = spark.catalog.listTables(schema) if schema else spark.catalog.listTables()
    return sorted(t.name for t in tables if not t.isTemporary)


def stage(
    inputs: Sequence[str],
    outputs: Sequence[str],
    drop: Sequence[str] = (),
    paths: Callable[[str], str] | None = None,
) -> Callable[[Callable[..., object]], Callable[..., object]]:
    """Turn a function of frames into a step from tables to tables.

    The function gets the input tables as lazy frames and returns a mapping of output table
    to frame, or one frame if there is one output; anything else in the mapping is handed on
    to the caller. The outputs are replaced, then the tables in `drop` are dropped. The
    step is called with the session and the function's own keyword arguments. `paths` names
    an unused folder for an output that shall be an external table.
    """

    def decorate(f: Callable[..., object]) -> Callable[..., object]:
        @functools.wraps(f)
        def step(spark: SparkSession, **kwargs: object) -> dict[str, object]:
            result = f(*[spark.table(n) for n in inputs], **kwargs)
            if isinstance(result, DataFrame):
                result = dict(zip(outputs, [result], strict=True))
            made: Mapping[str, object] = result or {}
            missing = [n for n in outputs if n not in made]
            if missing:
                raise ValueError(f"step {f.__name__} did not return {missing}")
            for name in outputs:
                write_table(made[name], name, paths(name) if paths else None)
            drop_tables(spark, drop)
            return {k: v for k, v in made.items() if k not in outputs}

        return step

    return decorate
