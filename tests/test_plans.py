"""Plan-shape checks: the properties the engine relies on at scale."""

import re

import pytest

from lakestrata.operators.gold import CTE_BUILDERS
from lakestrata.operators.gold.customer_360 import g1a_primary_address
from lakestrata.operators.quality import gold_data_quality_report
from lakestrata.operators.reconcile import medallion_reconciliation_report
from lakestrata.operators.relationships import SILVER_FK_CHECKS, declared_checks, orphaned_keys

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)


@pytest.fixture
def m(medallion):
    return medallion({})


def test_silver_is_narrow_and_codegen(m):
    p = plan(m.silver("transactions"))
    assert "Exchange" not in p
    assert re.search(r"\*\(\d+\) Project", p), p


@pytest.mark.parametrize("name", sorted(set(CTE_BUILDERS)))
def test_gold_ctes_have_no_forbidden_nodes(m, name):
    p = plan(CTE_BUILDERS[name](m))
    assert not any(f in p for f in FORBIDDEN), p
    assert "Expand" not in p  # at most one distinct aggregate per CTE


@pytest.mark.parametrize("entity", ["gold_customer_360", "gold_transaction_360", "gold_merchant_performance",
                                    "gold_account_financial_summary", "gold_fraud_case_360",
                                    "gold_rewards_engagement"])
def test_gold_entities_have_no_forbidden_nodes(m, entity):
    p = plan(m.gold(entity))
    assert not any(f in p for f in FORBIDDEN), p


def test_top1_is_an_aggregate_not_a_window(m):
    p = plan(g1a_primary_address(m))
    assert "Window" not in p and "Aggregate" in p


def test_fk_report_shuffles_group_key_and_mask(m):
    for checks in (SILVER_FK_CHECKS, declared_checks()):
        df = orphaned_keys(m, checks)
        assert df.columns == ["_g", "_k", "_mask"]
        # one shuffle of key rows for all checks; a table that holds several keys is scanned once
        ex = hash_exchanges(plan(df))
        assert len(ex) == 1 and ex[0].startswith("_g") and "_k" in ex[0], ex


def test_account_summary_bridges_all_children_once(m, spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(m.gold("gold_account_financial_summary"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("Exchange") <= 15 and p.count("SortMergeJoin") <= 5, p


def test_distinct_strings_are_made_distinct_before_they_meet(m):
    p = plan(CTE_BUILDERS["g5d_velocity_agg"](m))
    assert "collect_set" not in p and "listagg" in p and "Expand" not in p
    assert any("action_taken" in e for e in hash_exchanges(p)), p


def test_reconciliation_is_one_keyed_shuffle(m):
    p = plan(medallion_reconciliation_report(m))
    keyed = [e for e in hash_exchanges(p) if "_k" in e]
    assert len(keyed) == 1, hash_exchanges(p)
    assert not any(f in p for f in FORBIDDEN)


def test_schema_tests_share_keyed_shuffles(m):
    from lakestrata.operators.assertions import schema_test_results
    from lakestrata.specs import SPECS

    p = plan(schema_test_results(m, [f"silver_{t}" for t in SPECS]))
    ex = hash_exchanges(p)
    # not_null + accepted_values: ONE shuffle keyed by (model, failing values)
    assert len([e for e in ex if "_v0" in e]) == 1, ex
    # unique: ONE shuffle of (model, key) rows
    assert len([e for e in ex if e.startswith("_m") and "_k" in e]) == 1, ex
    # the distinct count of failing values expands pre-aggregated rows only:
    # the Expand sits above the (model, failing values) aggregation
    expand_at = p.find("Expand")
    assert expand_at == -1 or p.find("_v0", expand_at) != -1
    assert not any(f in p for f in FORBIDDEN)


def test_dq_report_has_no_fanout_join(m):
    p = plan(gold_data_quality_report(m))
    assert not any(f in p for f in FORBIDDEN)


def test_bronze_and_gold_plans_have_no_nested_loop(spark):
    """Over the real bronze derivation, with automatic broadcast off."""
    from lakestrata.context import RunContext
    from lakestrata.plans.medallion import Medallion
    from lakestrata.sources.testdata import TestdataBronze
    from lakestrata.specs import SPECS

    sf_dir = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = Medallion(spark, TestdataBronze(spark, sf_dir), RunContext.fixed())
        for t in SPECS:
            text = m.silver(t)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in text and "NestedLoop" not in text, t
            assert "Scan parquet" in text, t
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
