"""Physical-plan summary of every gold entity and report, in the shape they
take at scale: broadcasts disabled (no dimension passes the size check, no
automatic broadcast), every layer read from written parquet: gold entities
from written silver, reports from written bronze, silver and gold (as the
registered report queries run).

Usage: python scripts/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Prints per plan: sort-merge / broadcast joins, hash exchanges (by key), and
any Expand, cartesian, nested-loop or Python node.  (gold_schema_tests shows
one Expand: the distinct count of failing accepted values, over rows already
aggregated by (model, failing values), never over table rows.)"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.context import RunContext  # noqa: E402
from lakestrata.operators import assertions  # noqa: E402
from lakestrata.operators.quality import gold_data_quality_report  # noqa: E402
from lakestrata.operators.reconcile import medallion_reconciliation_report  # noqa: E402
from lakestrata.operators.relationships import fk_orphans_declared, silver_relationship_dq_results  # noqa: E402
from lakestrata.plans.medallion import GOLD_ENTITIES, Medallion  # noqa: E402
from lakestrata.plans.sinks import write_layer_table  # noqa: E402
from lakestrata.session import ensure_checkpoint_dir, local_session  # noqa: E402
from lakestrata.sources.fixture_sql import BRONZE  # noqa: E402
from lakestrata.sources.layers import ParquetBronze, layer_path  # noqa: E402
from lakestrata.sources.testdata import TestdataBronze  # noqa: E402
from lakestrata.specs import SPECS  # noqa: E402

FLAGS = ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16, app="lakestrata-plans")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestrata-plans-{uuid.uuid4().hex}"
    src = Medallion(spark, TestdataBronze(spark, sf_dir), RunContext.fixed())
    for t in BRONZE:
        write_layer_table(src.bronze(t), root, t, "bronze")
    for t in SPECS:
        write_layer_table(src.silver(t), root, f"silver_{t}")
    for g in GOLD_ENTITIES:
        write_layer_table(src.gold(g), root, g)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    m = Medallion(spark, ParquetBronze(spark, root), RunContext.fixed())
    m._small = {k: False for k in ("merchants", "merchants_ctx", "dim_transaction_types",
                                   "dim_merchant_categories", "dim_card_types")}
    for t in SPECS:
        m.use_table(f"silver_{t}", spark.read.parquet(layer_path(root, f"silver_{t}")))
    plans = {g: (lambda g=g: m.gold(g)) for g in GOLD_ENTITIES}
    # reports read the written gold tables (after the entity plans above)
    written_gold = lambda: [m.use_table(g, spark.read.parquet(layer_path(root, g))) for g in GOLD_ENTITIES]
    plans.update({
        "_gold_written": written_gold,
        "silver_relationship_dq_results": lambda: silver_relationship_dq_results(m),
        "fk_orphans_declared": lambda: fk_orphans_declared(m),
        "gold_data_quality_report": lambda: gold_data_quality_report(m),
        "medallion_reconciliation_report": lambda: medallion_reconciliation_report(m),
        "silver_schema_tests": lambda: assertions.schema_test_results(m, [f"silver_{t}" for t in SPECS]),
        "gold_schema_tests": lambda: assertions.schema_test_results(m, list(GOLD_ENTITIES)),
    })
    for name, make in plans.items():
        df = make()
        if name.startswith("_"):
            continue
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        p = df._jdf.queryExecution().executedPlan().toString()
        keys = Counter(re.sub(r"#\d+", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^,]*)", p))
        flags = [f for f in FLAGS if f in p]
        print(f"{name}: SMJ={p.count('SortMergeJoin')} BHJ={p.count('BroadcastHashJoin')} "
              f"hash_exchanges={sum(keys.values())} {dict(keys)} flags={flags or '-'}")
    spark.stop()


if __name__ == "__main__":
    main()
