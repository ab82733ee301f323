"""The medallion plan: memoised DataFrames for every layer table.

``Medallion(bronze_provider, ctx)`` exposes ``bronze(t)``, ``silver(t)``,
``gold(name)`` and the ops reports.  Nothing executes until an action: each
accessor returns a lazy DataFrame whose plan reaches back to the bronze scans,
unless a table was materialised (:meth:`materialize`, :meth:`use_table`,
``plans.build.build_all``): then downstream layers read the written table,
which also cuts lineage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestrata.context import RunContext
from lakestrata.operators.silver import build_silver
from lakestrata.specs import SPECS

GOLD_ENTITIES = (
    "gold_customer_360",
    "gold_transaction_360",
    "gold_merchant_performance",
    "gold_account_financial_summary",
    "gold_fraud_case_360",
    "gold_rewards_engagement",
)


class Medallion:
    def __init__(self, spark: SparkSession, bronze, ctx: RunContext | None = None):
        self.spark = spark
        self._bronze = bronze
        self.ctx = ctx or RunContext()
        self._memo: dict[str, DataFrame] = {}
        self._overrides: dict[str, DataFrame] = {}

    # -- layer access -------------------------------------------------------
    def _cached(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        if key in self._overrides:
            return self._overrides[key]
        if key not in self._memo:
            self._memo[key] = make()
        return self._memo[key]

    def bronze(self, table: str) -> DataFrame:
        return self._cached(f"bronze:{table}", lambda: self._bronze.table(table))

    def silver(self, table: str) -> DataFrame:
        table = table.removeprefix("silver_")
        return self._cached(
            f"silver_{table}", lambda: build_silver(self.bronze(table), SPECS[table], self.ctx)
        )

    def gold(self, name: str) -> DataFrame:
        from lakestrata.operators import gold

        name = name if name.startswith("gold_") else f"gold_{name}"
        return self._cached(name, lambda: gold.ENTITY_BUILDERS[name](self))

    def use_table(self, key: str, df: DataFrame) -> None:
        """Serve ``key`` (``silver_x``, ``gold_x``, ``bronze:x``) from ``df``,
        e.g. a materialised layer table."""
        self._overrides[key] = df
        self._memo.pop(key, None)

    def materialize(self, keys: list[str], threads: int = 2) -> None:
        """Cut lineage below ``keys`` (``silver_x`` / ``gold_x``).

        Each table is written once as parquet into a fresh folder under the
        session's ``spark.checkpoint.dir`` (shared storage on a cluster; it
        survives executor loss) and served from there, so downstream plans
        start from small scans.  Silver tables are written ``threads`` at a
        time, then gold tables (which read the written silver) one by one: all
        plans that run together, and what AQE plans anew of them, are in the
        driver's memory at once."""
        from lakestrata.plans.parallel import run_all
        from lakestrata.session import confirm_scratch, scratch_path

        if all(k in self._overrides for k in keys):
            return
        base = scratch_path(self.spark, "layers")
        for layer, at_once in (("silver_", threads), ("gold_", 1)):
            todo = [k for k in keys if k.startswith(layer) and k not in self._overrides]

            def write(key: str) -> str:
                df = self.gold(key) if key.startswith("gold_") else self.silver(key)
                path = f"{base}/{key}"
                df.write.mode("overwrite").parquet(path)
                return path

            paths = run_all({k: (lambda k=k: write(k)) for k in todo}, at_once)
            confirm_scratch(self.spark, base)
            for k, path in paths.items():
                self.use_table(k, self.spark.read.parquet(path))
