"""Benchmark: the full medallion build at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``.

The bronze fixtures are derived from the driver tables and written once
(untimed: in production bronze already exists).  Then every layer is built the
way production runs it: silver tables written from bronze, gold entities
from the written silver, ops reports and assertions over the written layers.
Each step is timed (best of ``$BENCH_REPS`` runs, default 3) and one JSON line is
printed.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestrata.context import RunContext  # noqa: E402
from lakestrata.operators import assertions  # noqa: E402
from lakestrata.operators.quality import gold_data_quality_report  # noqa: E402
from lakestrata.operators.reconcile import medallion_reconciliation_report  # noqa: E402
from lakestrata.operators.relationships import fk_orphans_declared, silver_relationship_dq_results  # noqa: E402
from lakestrata.plans.medallion import GOLD_ENTITIES, Medallion  # noqa: E402
from lakestrata.plans.parallel import run_all  # noqa: E402
from lakestrata.plans.sinks import PARTITIONED_GOLD, read_written, write_layer_table, write_partitioned  # noqa: E402
from lakestrata.session import ensure_checkpoint_dir, local_session  # noqa: E402
from lakestrata.sources.fixture_sql import BRONZE  # noqa: E402
from lakestrata.sources.layers import ParquetBronze  # noqa: E402
from lakestrata.sources.testdata import TestdataBronze  # noqa: E402
from lakestrata.specs import SPECS  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="lakestrata-bench")
    # Scratch tables go to a fresh folder under the session's checkpoint dir
    # (the cluster's shared folder; a local one is set only when unset).
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestrata-bench-{uuid.uuid4().hex}"
    ctx = RunContext.fixed()

    # Untimed: materialise bronze from the driver tables.
    src = TestdataBronze(spark, sf_dir)
    for t in BRONZE:
        write_layer_table(src.table(t), root, t, "bronze")
    bronze = ParquetBronze(spark, root)

    timings: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        best = None
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    m = Medallion(spark, bronze, ctx)

    def silver_build() -> None:
        # The 26 silver tables are independent: submit their jobs concurrently.
        run_all({t: (lambda t=t: write_layer_table(m.silver(t), root, f"silver_{t}")) for t in SPECS}, cpus)

    timed("silver_build_26", silver_build)
    for t in SPECS:
        m.use_table(f"silver_{t}", read_written(spark, root, f"silver_{t}"))

    timed("silver_relationship_dq_results", lambda: write_layer_table(
        silver_relationship_dq_results(m), root, "silver_relationship_dq_results"))
    m.use_table("silver_relationship_dq_results", read_written(spark, root, "silver_relationship_dq_results"))
    timed("fk_orphans_declared", lambda: fk_orphans_declared(m).collect())
    for g in GOLD_ENTITIES:
        def build_gold(g=g) -> None:
            if g in PARTITIONED_GOLD:
                date_col, cluster = PARTITIONED_GOLD[g]
                write_partitioned(m.gold(g), root, g, date_col, cluster)
            else:
                write_layer_table(m.gold(g), root, g)

        timed(g, build_gold)
    for g in GOLD_ENTITIES:
        m.use_table(g, read_written(spark, root, g))
    timed("gold_data_quality_report", lambda: gold_data_quality_report(m).collect())
    timed("medallion_reconciliation_report", lambda: medallion_reconciliation_report(m).collect())
    timed("silver_schema_tests", lambda: assertions.schema_test_results(
        m, [f"silver_{t}" for t in SPECS] + ["silver_relationship_dq_results"]).collect())
    timed("gold_schema_tests", lambda: assertions.schema_test_results(m, list(GOLD_ENTITIES)).collect())

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "medallion_build_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
