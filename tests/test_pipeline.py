import os
import tempfile
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from lakestrata.context import RunContext
from lakestrata.operators.silver import dq_summary
from lakestrata.plans.build import build_all
from lakestrata.plans.medallion import GOLD_ENTITIES, Medallion
from lakestrata.plans.sinks import open_table, write_layer_table
from lakestrata.sources.fixture_sql import BRONZE
from lakestrata.sources.frames import bronze_schema
from lakestrata.sources.layers import ParquetBronze, read_layer_table
from lakestrata.sources.seeds import RELATIONSHIP_COLUMNS, read_seed_csv
from lakestrata.sources.testdata import TestdataBronze
from lakestrata.specs import SPECS

SF = "/root/testdata/sf0.001"


def test_seed_csv_quoted_commas(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="lakestrata-seed-"), "rel.csv")
    with open(path, "w") as f:
        f.write("child_table,fk_column,parent_table,pk_column,cardinality,notes\n")
        f.write('fees,transaction_id,transactions,transaction_id,many-to-one (nullable),"Optional, may be empty"\n')
    rows = read_seed_csv(spark, path, RELATIONSHIP_COLUMNS).collect()
    assert len(rows) == 1 and rows[0]["notes"] == "Optional, may be empty"
    assert all(isinstance(v, str) for v in rows[0])


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_build_all_writes_every_layer(spark):
    root = tempfile.mkdtemp(prefix="lakestrata-build-")
    src = TestdataBronze(spark, SF)
    for t in BRONZE:
        write_layer_table(src.table(t), root, t, "bronze")
    bronze = ParquetBronze(spark, root, schemas={t: bronze_schema(t) for t in BRONZE})
    built = build_all(spark, bronze, root, RunContext.fixed(), threads=4)
    written = built.written
    assert len(written) == 26 + 1 + 1 + 6 + 2
    for name, path in written.items():
        assert os.path.isdir(path) and os.path.exists(os.path.join(path, "_SUCCESS")), name
    assert any(d.startswith("transaction_date_month=") for d in os.listdir(written["gold_transaction_360"]))
    # the written gold equals the lazily planned one
    m = Medallion(spark, TestdataBronze(spark, SF), RunContext.fixed())
    for g in GOLD_ENTITIES:
        assert open_table(spark, root, g).count() == m.gold(g).count(), g
    # counted while silver was written: the same rows as the query over the written tables
    summary = read_layer_table(spark, root, "silver_dq_summary")
    want = reduce(DataFrame.unionByName, [dq_summary(read_layer_table(spark, root, f"silver_{t}"), f"silver_{t}") for t in SPECS])
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, want.collect())) and summary.count() > 26
    recon = read_layer_table(spark, root, "medallion_reconciliation_report")
    assert recon.count() == 32
    # the planted defects fail their tests, and nothing but tests that fail is reported
    assert not built.ok and all(built.failures.values())
    assert {"not_null:silver_customers.last_name", "assert_no_fk_orphans", "assert_gold_dq_no_critical",
            "assert_reconciliation_clean"} <= set(built.failures)
    assert "unique:silver_merchants.merchant_id" not in built.failures


def test_changed_input_is_read_anew(spark, tmp_path):
    import shutil
    import time

    from lakestrata.registry import build_queries

    for t in "region nation customer supplier lineitem orders events".split():
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    query = build_queries()["dq_summary"]
    total = lambda: {r.table_name: r.n for r in query(spark, str(tmp_path)).groupBy("table_name").sum("row_count").toDF("table_name", "n").collect()}
    before = total()
    time.sleep(0.01)
    shutil.copy("/root/testdata/sf0.01/supplier.parquet", tmp_path / "supplier.parquet")
    spark.catalog.clearCache()
    after = total()
    assert after["silver_merchants"] > before["silver_merchants"] and after["silver_addresses"] == before["silver_addresses"]
