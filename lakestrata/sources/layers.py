"""Layer routing, versions of layer tables, and their readers.

A table lives in the namespace of its layer: an explicit layer wins, else the
layer named by the model's folder (``bronze silver gold ops``).  On storage
that is ``<root>/<layer>/<table>``.

A table that this engine writes is a folder of versions.  ``_CURRENT`` names
the one that readers see, and its schema; it is replaced by renaming a file
over it, after all files of the new version are there, so that a write that
fails leaves the version before it in place.  (On a file system that renames by
copying, such as some object stores, the switch is as atomic as putting one
small object.)  A folder without ``_CURRENT`` is read as it is.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LAYERS = ("bronze", "silver", "gold", "ops")
POINTER = "_CURRENT"
#: Versions that stay on disk: the current one, and the one that running readers may hold.
KEPT_VERSIONS = 2


def layer_of(table: str, explicit: str | None = None) -> str:
    if explicit:
        return explicit.strip()
    if table.startswith("silver_"):
        return "silver"
    if table.startswith("gold_") and table != "gold_data_quality_report":
        return "gold"
    if table in ("gold_data_quality_report", "medallion_reconciliation_report", "medallion_layer_mapping",
                 "mapping_input", "relationship_definitions", "silver_dq_summary"):
        return "ops"
    return "bronze"


def layer_path(root: str, table: str, layer: str | None = None) -> str:
    return f"{root.rstrip('/')}/{layer_of(table, layer)}/{table}"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def new_version(path: str) -> str:
    """A fresh folder for the next version of the table at ``path``; later ones sort last."""
    return f"{path}/v{int(time.time() * 1000):014d}-{uuid.uuid4().hex[:12]}"


def switch_version(spark: SparkSession, path: str, version: str, schema: StructType) -> None:
    """Makes a wholly written version the current one, and drops those before
    the last ``KEPT_VERSIONS``."""
    jvm = spark._jvm
    fs, target = _fs(spark, f"{path}/{POINTER}")
    _, staged = _fs(spark, f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    try:
        out.write(bytearray(json.dumps({"version": version.rsplit("/", 1)[1], "schema": schema.jsonValue()}).encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(staged, target, options)
    versions = sorted(x.getPath().getName() for x in fs.listStatus(target.getParent()) if x.isDirectory() and x.getPath().getName().startswith("v"))
    current = versions.index(version.rsplit("/", 1)[1])
    for old in versions[: max(0, current + 1 - KEPT_VERSIONS)]:
        fs.delete(_fs(spark, f"{path}/{old}")[1], True)


def current_version(spark: SparkSession, path: str) -> tuple[str, StructType | None]:
    """Folder that holds the table's files now, and its schema where it is known."""
    fs, pointer = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return path, None
    stream = fs.open(pointer)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return f"{path}/{found['version']}", StructType.fromJson(found["schema"])


def read_layer_table(spark: SparkSession, root: str, table: str, layer: str | None = None, schema: StructType | None = None) -> DataFrame:
    """The current version of a table, without partition columns of its own."""
    where, written = current_version(spark, layer_path(root, table, layer))
    schema = schema or written
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(where)
    return df.select(*written.names) if written is not None else df


class ParquetBronze:
    """Bronze provider reading ``<root>/bronze/<table>`` (all columns, no filter;
    Catalyst prunes columns and pushes filters into the scan).

    ``schemas`` optionally declares a table's schema (no footer inference, and
    a stable column order/type contract for the silver specs)."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict | None = None):
        self.spark = spark
        self.root = root
        self.schemas = schemas or {}
        self._memo: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = read_layer_table(self.spark, self.root, name, "bronze", self.schemas.get(name))
        return self._memo[name]
