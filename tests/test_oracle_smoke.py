"""Selected registered queries against their DuckDB oracle on sf0.001
(the full set runs with scripts/check_oracle.py)."""

import os

import pytest

import __spark_entry__ as contract
from lakestrata.oracle.compare import compare, duck_connect

SF = "/root/testdata/sf0.001"
NAMES = ["silver_transactions", "silver_customers", "gold_transaction_360", "gold_merchant_performance",
         "gold_rewards_engagement", "silver_relationship_dq_results", "medallion_reconciliation_report"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    q, o = contract.queries(), contract.oracle_sql()
    res = compare(q[name](spark, SF), duck_connect(SF), o[name])
    assert res["match"], res


def test_contract_keys_align():
    q, o = contract.queries(), contract.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 68


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "gold_record_hash" in df.columns
