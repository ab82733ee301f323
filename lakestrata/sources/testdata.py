"""Bronze provider over the driver's test tables (``/root/testdata/sf*/``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.sources.fixture_sql import BRONZE, DIALECT, DRIVER_TABLES, HELPERS, refs


class TestdataBronze:
    """Derives the 26 bronze tables from the driver tables in ``sf_dir``.

    Each derived table is a lazy DataFrame (a Catalyst plan over the parquet
    scans), memoised per provider so shared helpers are planned once.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._memo: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _relation(self, name: str) -> DataFrame:
        if name in self._memo:
            return self._memo[name]
        if name in DRIVER_TABLES:
            df = self.raw(name)
        else:
            text = HELPERS.get(name) or BRONZE[name]
            args = {r: self._relation(r) for r in refs(text)}
            for name_, form in DIALECT.items():
                text = text.replace("{" + name_ + "}", form)
            df = self.spark.sql(text, **args)
        self._memo[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        if name not in BRONZE:
            raise KeyError(f"unknown bronze table {name!r}")
        return self._relation(name)
