import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from lakestrata.plans.sinks import open_partitioned, read_partitioned, write_layer_table, write_partitioned
from lakestrata.sources.layers import ParquetBronze, current_version, layer_of, layer_path, read_layer_table


def test_layer_routing():
    assert layer_of("silver_accounts") == "silver" and layer_of("gold_customer_360") == "gold"
    assert layer_of("medallion_reconciliation_report") == "ops" and layer_of("accounts") == "bronze"
    assert layer_of("accounts", "ops") == "ops"
    assert layer_path("/r/", "silver_accounts") == "/r/silver/silver_accounts"


def test_partitioned_write_prunes_months(spark):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("transaction_date"),
        (F.col("id") % 7).cast("string").alias("customer_id"),
        (F.col("id") % 3).cast("string").alias("merchant_id"),
    )
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    path = write_partitioned(df, root, "gold_transaction_360", "transaction_date", ("customer_id", "merchant_id"))
    months = sorted(d for d in os.listdir(path) if d.startswith("transaction_date_month="))
    assert months == [f"transaction_date_month=2024-0{i}" for i in (1, 2, 3)]
    assert read_partitioned(spark, root, "gold_transaction_360", "transaction_date").count() == 200
    back = spark.read.parquet(path).where(F.col("transaction_date_month") == "2024-02")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-02" in plan
    assert back.count() == df.where(F.month("transaction_date") == 2).count()


def test_date_range_prunes_months(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 50 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 120).cast("int"))).alias("transaction_date"),
        F.col("id").cast("string").alias("customer_id"),
    )
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    write_partitioned(df, root, "gold_transaction_360", "transaction_date", ("customer_id",))
    first, last = dt.date(2024, 2, 10), dt.date(2024, 3, 5)
    back = read_partitioned(spark, root, "gold_transaction_360", "transaction_date", first, last)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "2024-02" in plan and "2024-03" in plan
    assert back.columns == df.columns
    want = df.where(F.col("transaction_date").between(first, last))
    assert sorted(back.collect()) == sorted(want.collect()) and want.count() > 0
    assert read_partitioned(spark, root, "gold_transaction_360", "transaction_date").count() == 400


def test_partitioned_write_splits_a_hot_month(spark):
    # 95% of the rows in one month: AQE's rebalance splits that month over
    # several writers (files) instead of handing it to one task
    df = spark.range(0, 40000, 1, 8).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 20 == 0, F.lit("2024-02-10")).otherwise(F.lit("2024-01-15")).cast("date")
        .alias("transaction_date"),
        F.lit("hot").alias("customer_id"),
        (F.col("id") * 7919 % 1000003).cast("string").alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        root = tempfile.mkdtemp(prefix="lakestrata-test-")
        path = write_partitioned(df, root, "gold_transaction_360", "transaction_date", ("customer_id",))
    finally:
        spark.conf.set(key, old)
    hot = [f for f in os.listdir(f"{path}/transaction_date_month=2024-01") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(path).count() == 40000


def _spoil(path):
    """Files that cannot be read, in place of the folder's own."""
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            with open(f"{path}/{name}", "wb") as f:
                f.write(b"not parquet")
            if os.path.exists(f"{path}/.{name}.crc"):
                os.remove(f"{path}/.{name}.crc")


def _dated(spark, n=400):
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 120).cast("int"))).alias("transaction_date"),
        F.col("id").cast("string").alias("customer_id"),
    )


@pytest.mark.parametrize("predicate", [
    "transaction_date BETWEEN DATE'2024-02-10' AND DATE'2024-03-05'", "transaction_date >= '2024-02-10' AND transaction_date < '2024-03-06'",
    "transaction_date IN (DATE'2024-02-11', DATE'2024-03-01')", "transaction_date = DATE'2024-02-29'", "customer_id > '1' AND transaction_date > DATE'2024-01-31' AND transaction_date <= DATE'2024-03-31'",
])
def test_a_predicate_on_the_date_reads_only_its_months(spark, predicate):
    df = _dated(spark)
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    path = write_partitioned(df, root, "gold_transaction_360", "transaction_date", ("customer_id",))
    want = sorted(df.where(predicate).collect())
    for other in ("2024-01", "2024-04", "__HIVE_DEFAULT_PARTITION__"):
        _spoil(f"{path}/transaction_date_month={other}")
    opened = open_partitioned(spark, root, "gold_transaction_360", "transaction_date")
    assert opened.dtypes == df.dtypes
    opened.createOrReplaceTempView("opened")
    assert sorted(spark.sql(f"SELECT * FROM opened WHERE {predicate}").collect()) == want and want
    assert sorted(opened.where(predicate).select("customer_id").collect()) == sorted(r[1:] for r in map(tuple, want))
    with pytest.raises((PySparkException, Py4JJavaError)):
        opened.where("transaction_date > DATE'2024-03-31'").collect()  # a spoilt month is read where it is asked for


def test_opened_table_is_whole(spark):
    df = _dated(spark)
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    write_partitioned(df, root, "gold_transaction_360", "transaction_date")
    key = lambda r: (str(r[0]), r[1])
    for back in (open_partitioned(spark, root, "gold_transaction_360", "transaction_date"), read_partitioned(spark, root, "gold_transaction_360", "transaction_date")):
        assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
        assert back.where("transaction_date IS NULL").count() == 8
    for part in (df.where("transaction_date IS NULL"), df.limit(0)):
        write_partitioned(part, root, "gold_transaction_360", "transaction_date")
        for back in (open_partitioned(spark, root, "gold_transaction_360", "transaction_date"), read_partitioned(spark, root, "gold_transaction_360", "transaction_date")):
            assert back.columns == df.columns and back.count() == part.count()


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    good = spark.range(100).withColumn("x", F.lit("old"))
    write_layer_table(good, root, "silver_accounts")
    before = current_version(spark, layer_path(root, "silver_accounts"))
    half = spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") < 90, F.lit("new")).otherwise(F.raise_error(F.lit("stop")).cast("string")))
    with pytest.raises(PySparkException):
        write_layer_table(half, root, "silver_accounts")
    with pytest.raises(PySparkException):
        write_partitioned(half.withColumn("d", F.lit("2024-01-01").cast("date")), root, "silver_accounts", "d")
    assert current_version(spark, layer_path(root, "silver_accounts")) == before
    assert sorted(read_layer_table(spark, root, "silver_accounts").collect()) == sorted(good.collect())


def test_versions_switch_and_old_ones_go(spark):
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    first = write_layer_table(spark.range(1), root, "accounts", "bronze")
    held = read_layer_table(spark, root, "accounts")
    second = write_layer_table(spark.range(2), root, "accounts", "bronze")
    assert held.count() == 1  # a reader of the version before goes on
    third = write_layer_table(spark.range(3), root, "accounts", "bronze")
    assert not os.path.exists(first) and os.path.exists(second) and os.path.exists(third)
    assert ParquetBronze(spark, root).table("accounts").count() == 3
    write_layer_table(spark.range(4).limit(0), root, "accounts", "bronze")
    assert ParquetBronze(spark, root).table("accounts").dtypes == spark.range(1).dtypes


def test_a_folder_without_versions_is_read_as_it_is(spark):
    root = tempfile.mkdtemp(prefix="lakestrata-test-")
    spark.range(5).write.parquet(layer_path(root, "accounts"))
    assert ParquetBronze(spark, root).table("accounts").count() == 5
