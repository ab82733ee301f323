"""Registered queries: every operator of the engine as a function
``(spark, sf_dir) -> DataFrame`` over the driver's test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.context import RunContext
from lakestrata.operators import assertions
from lakestrata.operators.gold import CTE_BUILDERS, ENTITY_BUILDERS
from lakestrata.operators.quality import gold_data_quality_report
from lakestrata.operators.reconcile import medallion_reconciliation_report
from lakestrata.operators.relationships import fk_orphans_declared, silver_relationship_dq_results
from lakestrata.operators.silver import dq_summary
from lakestrata.plans.medallion import Medallion
from lakestrata.plans.sinks import PARTITIONED_GOLD, open_partitioned, open_table, read_partitioned, write_layer_table, write_partitioned
from lakestrata.session import apply_engine_conf, confirm_scratch, scratch_path
from lakestrata.sources.fixture_sql import DRIVER_TABLES
from lakestrata.sources.layers import ParquetBronze
from lakestrata.sources.testdata import TestdataBronze
from lakestrata.specs import SPECS


_MEDALLIONS: dict[tuple, Medallion] = {}
#: Medallions that are kept, the last ones used: their plans hold the driver's memory.
KEPT_MEDALLIONS = 2


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple | None:
    """Session, and names, sizes and times of the input files; a table that is
    not there counts as such, as only the queries that read it need it.  None
    where Spark reads a table that can't be listed from here."""
    try:
        found = [(spark.sparkContext.applicationId, spark._jsparkSession.hashCode())]
        conf = spark._jsparkSession.sessionState().newHadoopConf()  # as Spark's readers see it
        for t in DRIVER_TABLES:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
            try:
                files = where.getFileSystem(conf).listStatus(where)
            except Py4JJavaError as e:
                if e.java_exception.getClass().getName() != "java.io.FileNotFoundException":
                    return None
                files = []
            found.append((t, *sorted((x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in files)))
    except (AttributeError, Py4JJavaError):  # a remote session has no JVM here
        return None
    return tuple(found)


def medallion_for(spark: SparkSession, sf_dir: str, layered: bool) -> Medallion:
    """The medallion over a dataset as its files are now: queries over the same
    files share its plans (plans are immutable).  Reports that read written
    layers share one of their own, so that no other query's plan depends on
    what was written.  Without a list of files nothing is shared."""
    sf_dir = str(sf_dir).rstrip("/")
    key = _fingerprint(spark, sf_dir)
    if (key, layered) in _MEDALLIONS:
        _MEDALLIONS[key, layered] = _MEDALLIONS.pop((key, layered))  # the last one used
        return _MEDALLIONS[key, layered]
    apply_engine_conf(spark)
    made = Medallion(spark, TestdataBronze(spark, sf_dir), RunContext.fixed())
    if key is not None:
        _MEDALLIONS[key, layered] = made
        while len(_MEDALLIONS) > KEPT_MEDALLIONS:
            _MEDALLIONS.pop(next(iter(_MEDALLIONS)))
    return made


def _on_medallion(fn: Callable[[Medallion], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(medallion_for(spark, sf_dir, getattr(fn, "layered", False)))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _silver(table: str):
    return lambda m: m.silver(table)


def _gold(name: str):
    return lambda m: m.gold(name)


def _dq_summary_all(m: Medallion) -> DataFrame:
    return reduce(DataFrame.unionByName, [dq_summary(m.silver(t), f"silver_{t}") for t in SPECS])


SILVER_MODELS = [f"silver_{t}" for t in SPECS] + ["silver_relationship_dq_results"]
GOLD_MODELS = list(ENTITY_BUILDERS)


def _layers_first(fn: Callable[[Medallion], DataFrame], gold: bool = True) -> Callable[[Medallion], DataFrame]:
    """Wide reports read materialised layers, as they do in production."""

    def run(m: Medallion) -> DataFrame:
        m.materialize([f"silver_{t}" for t in SPECS] + (GOLD_MODELS if gold else []))
        return fn(m)

    run.layered = True
    return run


#: Tables that the routing query writes and finds again, one of each layer.
ROUTED = ("accounts", "silver_accounts", "gold_merchant_performance", "gold_data_quality_report")
DATES = (dt.date(1996, 3, 15), dt.date(1997, 1, 20))


def _written_layer_table(m: Medallion) -> DataFrame:
    """A silver table, written and read back."""
    root = scratch_path(m.spark, "sink")
    write_layer_table(m.silver("accounts"), root, "silver_accounts")
    confirm_scratch(m.spark, root)
    return open_table(m.spark, root, "silver_accounts")


def _bronze_source(m: Medallion) -> DataFrame:
    """A bronze table as the production provider reads it, from its layer's folder."""
    root = scratch_path(m.spark, "sink")
    write_layer_table(m.bronze("transactions"), root, "transactions", "bronze")
    confirm_scratch(m.spark, root)
    return ParquetBronze(m.spark, root).table("transactions")


def _partitioned(m: Medallion, table: str) -> str:
    root = scratch_path(m.spark, "sink")
    date_col, cluster = PARTITIONED_GOLD[table]
    write_partitioned(m.gold(table), root, table, date_col, cluster)
    confirm_scratch(m.spark, root)
    return root


def _written_partitioned(table: str) -> Callable[[Medallion], DataFrame]:
    """A partitioned table, written and read back whole, rows without a date included."""

    def run(m: Medallion) -> DataFrame:
        return read_partitioned(m.spark, _partitioned(m, table), table, PARTITIONED_GOLD[table][0])

    return run


def _date_range(m: Medallion) -> DataFrame:
    """A user's own predicate on the date of the partitioned fact table."""
    table = "gold_transaction_360"
    rows = open_partitioned(m.spark, _partitioned(m, table), table, PARTITIONED_GOLD[table][0])
    return rows.where(F.col("transaction_date").between(*DATES))


def _routed_tables(m: Medallion) -> DataFrame:
    """Table, layer folder it was written into, and rows found there."""
    root = scratch_path(m.spark, "sink")
    rows = {"accounts": m.bronze("accounts"), "gold_data_quality_report": gold_data_quality_report(m)}
    found = []
    for t in ROUTED:
        df = rows.get(t)
        path = write_layer_table(df if df is not None else m.gold(t) if t.startswith("gold_") else m.silver(t), root, t)
        confirm_scratch(m.spark, root)
        folder = F.element_at(F.split(F.input_file_name(), "/"), -4)  # layer, table, version, file
        found.append(m.spark.read.parquet(path).select(F.lit(t).alias("table_name"), folder.alias("layer")))
    return reduce(DataFrame.unionByName, found).groupBy("table_name", "layer").agg(F.count(F.lit(1)).alias("row_count"))


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[Medallion], DataFrame]] = {}
    for t in SPECS:
        q[f"silver_{t}"] = _silver(t)
    q["dq_summary"] = _layers_first(_dq_summary_all, gold=False)
    q["silver_relationship_dq_results"] = _layers_first(silver_relationship_dq_results, gold=False)
    q["fk_orphans_declared"] = _layers_first(fk_orphans_declared, gold=False)
    for name, fn in CTE_BUILDERS.items():
        q[name] = fn
    for name in ENTITY_BUILDERS:
        q[name] = _gold(name)
    q["gold_data_quality_report"] = _layers_first(gold_data_quality_report)
    q["medallion_reconciliation_report"] = _layers_first(medallion_reconciliation_report)
    q["silver_schema_tests"] = _layers_first(lambda m: assertions.schema_test_results(m, SILVER_MODELS), gold=False)
    q["gold_schema_tests"] = _layers_first(lambda m: assertions.schema_test_results(m, GOLD_MODELS))
    q["assert_gold_dq_no_critical"] = _layers_first(
        lambda m: assertions.assert_gold_dq_no_critical(gold_data_quality_report(m))
    )
    q["assert_reconciliation_clean"] = _layers_first(
        lambda m: assertions.assert_reconciliation_clean(medallion_reconciliation_report(m))
    )
    q["assert_no_fk_orphans"] = _layers_first(
        lambda m: assertions.assert_no_fk_orphans(silver_relationship_dq_results(m)), gold=False
    )
    q["write_layer_table"] = _written_layer_table
    q["bronze_source"] = _bronze_source
    q["write_partitioned"] = _written_partitioned("gold_transaction_360")
    q["write_partitioned_accounts"] = _written_partitioned("gold_account_financial_summary")
    q["partitioned_date_range"] = _date_range
    q["layer_routing"] = _layers_first(_routed_tables)
    return {k: _on_medallion(v) for k, v in q.items()}
