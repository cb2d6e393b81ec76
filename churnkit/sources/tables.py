"""Layer tables: versioned Parquet folders ``<root>/<layer>/<name>``, made known in catalog databases."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.schemas import LAYERS

TECHNICAL_COLUMNS = ("_ingested_at", "_source", "churn_profile")


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


# --- versions ---------------------------------------------------------------
# A table is a folder of version folders ``_v=<id>`` and of numbered commits, small files that name the version a table consists of or,
# for a table partitioned by one column, the version of each partition. Rows are written first, the commit last, by renaming a finished file to the next
# number, which no other writer can take as well. So a write that is killed at any time leaves the table as it was.

COMMITS = "_commits"
VERSION = "_v"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Commits, and versions they name, that stay for readers that planned before; older ones are removed.
KEPT_COMMITS = 3


def _store_of(spark: SparkSession, path: str):
    """The file system that holds a path, and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, make = _store_of(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(make(path))) if fs.exists(make(path)) else []


def _commits(spark: SparkSession, path: str) -> list[str]:
    return [name for name in _names(spark, f"{path}/{COMMITS}") if name.isdigit()]


def _committed(spark: SparkSession, path: str, number: str) -> dict:
    """``{"version": id}`` or ``{"column": name, "parts": {value: id}}``."""
    fs, make = _store_of(spark, path)
    stream = fs.open(make(f"{path}/{COMMITS}/{number}"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _versions_of(state: Mapping) -> set[str]:
    return set(state["parts"].values()) if "parts" in state else {state["version"]}


def _commit(spark: SparkSession, path: str, state: Mapping) -> None:
    fs, make = _store_of(spark, path)
    numbers = _commits(spark, path)
    number = f"{int(numbers[-1]) + 1 if numbers else 0:012d}"
    fs.mkdirs(make(f"{path}/{COMMITS}"))
    draft = make(f"{path}/{COMMITS}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(state).encode()))
    stream.close()
    target = make(f"{path}/{COMMITS}/{number}")
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer committed {path} at the same time")
    past = [*numbers, number]
    if len(past) > KEPT_COMMITS:
        needed = set().union(*[_versions_of(_committed(spark, path, n)) for n in past[-KEPT_COMMITS:]])
        for old in past[:-KEPT_COMMITS]:
            for version in _versions_of(_committed(spark, path, old)) - needed:
                fs.delete(make(f"{path}/{VERSION}={version}"), True)
            fs.delete(make(f"{path}/{COMMITS}/{old}"), False)


def _write_version(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    version = f"v{uuid.uuid4().hex}"  # never read as a number
    df.write.partitionBy(*partition_by).parquet(f"{path}/{VERSION}={version}")
    return version


def _parts_of(spark: SparkSession, path: str, version: str, column: str) -> dict[str, str]:
    found = [name for name in _names(spark, f"{path}/{VERSION}={version}") if name.startswith(f"{column}=")]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {unescape(name.removeprefix(f"{column}=")): version for name in found}


def table_state(spark: SparkSession, root: str, layer: str, name: str) -> dict | None:
    """What the newest commit names; None for a plain folder and for no table."""
    path = table_path(root, layer, name)
    numbers = _commits(spark, path)
    return _committed(spark, path, numbers[-1]) if numbers else None


def read_table(spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table as last committed; a folder that others wrote is read as it is. A known schema saves reading file footers and
    is needed while the table is empty."""
    path, state = table_path(root, layer, name), table_state(spark, root, layer, name)
    if state is None:
        folder, wanted = path, None
    elif "version" in state:
        folder, wanted = f"{path}/{VERSION}={state['version']}", None
    elif len(_versions_of(state)) == 1 and set(_parts_of(spark, path, (version := next(iter(_versions_of(state)))), state["column"])) == set(state["parts"]):
        folder, wanted = f"{path}/{VERSION}={version}", None
    elif not state["parts"]:
        return create_empty(spark, schema or T.StructType.fromJson(state["schema"]))
    else:
        value = F.coalesce(F.col(state["column"]).cast("string"), F.lit(NULL_PARTITION))
        of = {v: [part for part, w in state["parts"].items() if w == v] for v in _versions_of(state)}
        folder, wanted = path, reduce(or_, [(F.col(VERSION) == v) & value.isin(parts) for v, parts in of.items()])
    if schema is None:
        found = spark.read.parquet(folder)
        return found if wanted is None else found.filter(wanted).drop(VERSION)
    reader = spark.read.schema(schema if wanted is None else T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
    found = reader.parquet(folder)
    return (found if wanted is None else found.filter(wanted)).select(*schema.fieldNames())


def write_table(
    df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace a table with ``df`` and return the stored table. ``df`` may read the table it replaces."""
    spark, path = df.sparkSession, table_path(root, layer, name)
    if len(partition_by) > 1:
        raise ValueError("tables are partitioned by one column at most")
    version = _write_version(df, path, partition_by)
    if partition_by:
        column = partition_by[0]
        state = {"column": column, "parts": _parts_of(spark, path, version, column), "schema": json.loads(df.schema.json())}
    else:
        state = {"version": version}
    _commit(spark, path, state)
    return read_table(spark, root, layer, name, df.schema)


def rewrite_table(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table by a frame that reads the same table, as the steps of a review do."""
    return write_table(df, root, layer, name, partition_by)


def overwrite_partitions(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` holds rows for; ``df`` may read what it replaces.

    Only these rows are written; one commit then takes up their partitions and keeps the others.
    """
    spark, path, (column,) = df.sparkSession, table_path(root, layer, name), partition_by
    before = table_state(spark, root, layer, name) or {"column": column, "parts": {}}
    if before.get("column") != column:
        raise ValueError(f"{path} is not partitioned by {column}")
    version = _write_version(df, path, partition_by)
    parts = before["parts"] | _parts_of(spark, path, version, column)
    _commit(spark, path, {"column": column, "parts": parts, "schema": json.loads(df.schema.json())})


def create_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def ensure_table(
    spark: SparkSession, schema: T.StructType, root: str, layer: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The stored table, made as an empty one where it is missing."""
    if table_state(spark, root, layer, name) is None:
        try:
            spark.read.schema(schema).parquet(table_path(root, layer, name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            write_table(create_empty(spark, schema), root, layer, name, partition_by)
    return read_table(spark, root, layer, name, schema)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A few literal rows as a relation (parameters, small lookup lists)."""
    return spark.createDataFrame(list(rows), schema)


def ensure_layers(spark: SparkSession, prefix: str = "", comments: Mapping[str, str] | None = None) -> list[str]:
    """Create one database per layer where it is missing."""
    names = []
    for layer in LAYERS:
        name = f"{prefix}{layer}"
        note = (comments or {}).get(layer, f"{layer} layer").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{note}'")
        names.append(name)
    return names


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_catalog_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def apply_comments(
    spark: SparkSession, table: str, table_comment: str | None = None, columns: Mapping[str, str] | None = None
) -> None:
    """Attach documentation to a catalog table and its columns."""
    if table_comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(table_comment)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {_quoted(text)}")


def _state_sql(spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType) -> str:
    """SQL that reads a stored table as committed now."""
    path, state = table_path(root, layer, name), table_state(spark, root, layer, name)
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    if state is None or "version" in state:
        return f"SELECT {columns} FROM parquet.`{path if state is None else path + '/' + VERSION + '=' + state['version']}`"
    if not state["parts"]:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        return f"SELECT {empty} WHERE FALSE"
    value = f"coalesce(CAST(`{state['column']}` AS STRING), '{NULL_PARTITION}')"
    tests = [
        f"({VERSION} = '{v}' AND {value} IN ({', '.join(_quoted(p) for p, w in state['parts'].items() if w == v)}))"
        for v in sorted(_versions_of(state))
    ]
    return f"SELECT {columns} FROM parquet.`{path}` WHERE {' OR '.join(tests)}"


def publish_table(
    spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType, prefix: str = "", comment: str | None = None,
    columns: Mapping[str, str] | None = None,
) -> str:
    """Make a stored table known in the catalog as ``<prefix><layer>.<name>`` with its comments, as it is committed now.

    It is a view on the committed folders, replaced in one statement, so readers of the catalog see a whole table at any time. Comments that
    the schema carries are used where none are given.
    """
    notes = {f.name: f.metadata["comment"] for f in schema if "comment" in f.metadata} | dict(columns or {})
    listed = ", ".join(f"`{f.name}`" + (f" COMMENT {_quoted(notes[f.name])}" if f.name in notes else "") for f in schema)
    about = f"COMMENT {_quoted(comment)} " if comment else ""
    table = f"`{prefix}{layer}`.`{name}`"
    spark.sql(f"CREATE OR REPLACE VIEW {table} ({listed}) {about}AS {_state_sql(spark, root, layer, name, schema)}")
    return table


def stamp(df: DataFrame, source: str, ingested_at=None) -> DataFrame:
    """Add the ingestion time and the name of the delivering system."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumn("_ingested_at", at).withColumn("_source", F.lit(source))


def drop_meta(df: DataFrame, columns: Sequence[str] = TECHNICAL_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a report as CSV with a header; Spark writes one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
