"""Full medallion build: seeds → silver → relationship report → gold → ops.

Each layer is written as tables under ``root`` and downstream layers read the
written tables (this is also where lineage is cut: no plan spans layers).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakestrata.context import RunContext
from lakestrata.operators import assertions
from lakestrata.operators.quality import gold_data_quality_report
from lakestrata.operators.reconcile import medallion_reconciliation_report
from lakestrata.operators.relationships import silver_relationship_dq_results
from lakestrata.plans.medallion import GOLD_ENTITIES, Medallion
from lakestrata.plans.parallel import run_all
from lakestrata.plans.metrics import dq_summary_of, observed
from lakestrata.plans.sinks import PARTITIONED_GOLD, read_written, write_layer_table, write_partitioned
from lakestrata.sources.layers import read_layer_table
from lakestrata.specs import SPECS


@dataclass(frozen=True)
class Build:
    """Paths of the written tables, and the failing tests by name."""

    written: dict[str, str]
    failures: dict[str, int]

    @property
    def ok(self) -> bool:
        return not self.failures


def _failing_tests(m: Medallion, models: list[str]) -> dict[str, int]:
    """Column tests of ``models`` that fail; there are at most as many as tests."""
    return {r.test_id: r.failures for r in assertions.schema_test_results(m, models).where("failures > 0").collect()}


def build_all(
    spark: SparkSession, bronze, root: str, ctx: RunContext | None = None, threads: int = 8, run_tests: bool = True
) -> Build:
    """Write every layer, and run each layer's tests after it: the column
    tests of its models and the three assertions over its reports."""
    m = Medallion(spark, bronze, ctx or RunContext())
    written: dict[str, str] = {}
    failures: dict[str, int] = {}

    def keep(name: str, path: str) -> None:
        written[name] = path
        m.use_table(name, read_written(spark, root, name))

    def write_gold(g: str) -> str:
        if g in PARTITIONED_GOLD:
            date_col, cluster = PARTITIONED_GOLD[g]
            return write_partitioned(m.gold(g), root, g, date_col, cluster)
        return write_layer_table(m.gold(g), root, g)

    def check(name: str, rows: DataFrame) -> None:
        if n := rows.count():
            failures[name] = n

    # error codes are counted while the tables are written
    watched = {t: observed(m.silver(t), SPECS[t]) for t in SPECS}
    silver = {f"silver_{t}": (lambda t=t: write_layer_table(watched[t].rows, root, f"silver_{t}")) for t in SPECS}
    for name, path in run_all(silver, threads).items():
        keep(name, path)
    written["silver_dq_summary"] = write_layer_table(dq_summary_of(spark, watched), root, "silver_dq_summary")
    keep("silver_relationship_dq_results", write_layer_table(silver_relationship_dq_results(m), root, "silver_relationship_dq_results"))
    if run_tests:
        failures |= _failing_tests(m, [*silver, "silver_relationship_dq_results"])
        check("assert_no_fk_orphans", assertions.assert_no_fk_orphans(m.silver("silver_relationship_dq_results")))

    for g, path in run_all({g: (lambda g=g: write_gold(g)) for g in GOLD_ENTITIES}, threads).items():
        keep(g, path)
    if run_tests:
        failures |= _failing_tests(m, list(GOLD_ENTITIES))

    quality = write_layer_table(gold_data_quality_report(m), root, "gold_data_quality_report", "ops")
    reconciliation = write_layer_table(medallion_reconciliation_report(m), root, "medallion_reconciliation_report", "ops")
    written |= {"gold_data_quality_report": quality, "medallion_reconciliation_report": reconciliation}
    if run_tests:
        check("assert_gold_dq_no_critical", assertions.assert_gold_dq_no_critical(read_layer_table(spark, root, "gold_data_quality_report")))
        check("assert_reconciliation_clean", assertions.assert_reconciliation_clean(read_layer_table(spark, root, "medallion_reconciliation_report")))
    return Build(written, failures)


__all__ = ["Build", "build_all"]
