"""Layer sinks: full-rebuild table writes, optionally date-partitioned.

Every write makes a new version of the table and then switches readers to it
(``sources.layers``).

A day partition per date (the reference's layout) gives thousands of small
directories at scale; the partition column here is the *month* of the date,
files are sized by AQE's rebalance, and rows are clustered inside each file by
the cluster keys, so parquet min/max statistics skip row groups for key
predicates.  ``open_partitioned`` gives the table to users with its own columns:
their predicates on the date itself prune the directories of other months.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.layers import _fs, current_version, layer_path, new_version, read_layer_table, switch_version


def write_layer_table(df: DataFrame, root: str, table: str, layer: str | None = None) -> str:
    """The next version of ``table``; returns its folder."""
    path = layer_path(root, table, layer)
    version = new_version(path)
    df.write.parquet(version)
    switch_version(df.sparkSession, path, version, df.schema)
    return version


def partition_column(date_col: str) -> str:
    return f"{date_col}_month"


def write_partitioned(
    df: DataFrame,
    root: str,
    table: str,
    date_col: str,
    cluster_by: tuple[str, ...] = (),
    layer: str | None = None,
    max_records_per_file: int = 5_000_000,
) -> str:
    """The next version of ``table``, partitioned by month of ``date_col`` and
    clustered by ``cluster_by`` within each file; returns its folder.

    ``REBALANCE(month)`` gives each month its own shuffle partitions, and AQE
    sizes them (spark.sql.adaptive.advisoryPartitionSizeInBytes): small months
    are coalesced, and a big or skewed month, e.g. one holding a third of all
    rows, or one hot customer inside it, is split into several
    advisory-sized partitions.  So files come out near the target size, each
    writer writes into a single month directory, and no writer is handed a
    whole hot group.  Unlike range partitioning, this needs no sampling job
    that would recompute the whole upstream stage.  Rows are sorted by the
    cluster keys within each file, so parquet row-group statistics skip rows
    for key predicates while month predicates prune directories."""
    path = layer_path(root, table, layer)
    version = new_version(path)
    part = partition_column(date_col)
    staged = df.withColumn(part, F.date_format(F.col(date_col), "yyyy-MM"))
    (
        staged.hint("rebalance", part)
        .sortWithinPartitions(part, *cluster_by)
        .write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(part)
        .parquet(version)
    )
    switch_version(df.sparkSession, path, version, df.schema)
    return version


def _months(spark: SparkSession, version: str, part: str) -> list[str]:
    """Months that have a directory, from one listing of the version's folder."""
    fs, where = _fs(spark, version)
    names = [x.getPath().getName() for x in fs.listStatus(where)]
    found = sorted(x.split("=", 1)[1] for x in names if x.startswith(f"{part}="))
    return [x for x in found if not x.startswith("__")]


def read_partitioned(
    spark: SparkSession,
    root: str,
    table: str,
    date_col: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    layer: str | None = None,
) -> DataFrame:
    """The table as written, or its rows from ``first`` to ``last`` (both
    included): only directories of those months are listed and read."""
    version, schema = current_version(spark, layer_path(root, table, layer))
    part = partition_column(date_col)
    if not _months(spark, version, part) and first is None and last is None:
        return read_layer_table(spark, root, table, layer)
    df = spark.read.schema(schema).option("basePath", version).parquet(version)
    if part not in df.columns:
        return df
    month = F.col(part).cast("string")
    if first is not None:
        df = df.where((month >= F.lit(f"{first:%Y-%m}")) & (F.col(date_col) >= F.lit(first)))
    if last is not None:
        df = df.where((month <= F.lit(f"{last:%Y-%m}")) & (F.col(date_col) <= F.lit(last)))
    return df.drop(part)


def open_partitioned(spark: SparkSession, root: str, table: str, date_col: str, layer: str | None = None) -> DataFrame:
    """The table for users' own queries: a predicate on ``date_col``, of
    whatever form, reads only the directories of the months it leaves.

    Rows meet a calendar of the table's months on (date, month).  Catalyst
    copies a predicate on the date to the calendar over the join's equality,
    and dynamic partition pruning then reads the months that the filtered
    calendar still holds.  The calendar has at most 31 rows for each directory
    and is broadcast.  Rows without a date have a directory of their own, in
    which the date is a NULL literal, so that date predicates drop it whole."""
    version, schema = current_version(spark, layer_path(root, table, layer))
    part = partition_column(date_col)
    months = _months(spark, version, part)
    files = spark.read.schema(schema).option("basePath", version).parquet(version)
    if part not in files.columns:
        return files
    undated = files.where(F.col(part).isNull()).drop(part).withColumn(date_col, F.lit(None).cast("date")).select(*schema.names)
    if not months:
        return undated
    first = F.to_date(F.concat("_month", F.lit("-01")))
    calendar = spark.range(1).select(F.explode(F.array(*map(F.lit, months))).alias("_month"))
    calendar = calendar.select("_month", F.explode(F.sequence(first, F.last_day(first))).alias("_day"))
    met = (F.col(date_col) == F.col("_day")) & (F.col(part) == F.col("_month"))
    dated = files.where(F.col(part).isNotNull()).join(F.broadcast(calendar), met).select(*schema.names)
    return dated.unionByName(undated)


# The two partitioned gold tables (date column, cluster keys).
PARTITIONED_GOLD = {
    "gold_transaction_360": ("transaction_date", ("customer_id", "merchant_id")),
    "gold_account_financial_summary": ("opened_date", ()),
}


def read_written(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A written table, partitioned or not, for scans of the whole table."""
    if table in PARTITIONED_GOLD:
        return read_partitioned(spark, root, table, PARTITIONED_GOLD[table][0])
    return read_layer_table(spark, root, table)


def open_table(spark: SparkSession, root: str, table: str, layer: str | None = None) -> DataFrame:
    """Any written table, as users open it."""
    if table in PARTITIONED_GOLD:
        return open_partitioned(spark, root, table, PARTITIONED_GOLD[table][0], layer)
    return read_layer_table(spark, root, table, layer)
