"""The medallion behind the registered queries needs what a query reads, not more."""

import os

import pytest

from lakestrata import registry
from lakestrata.session import apply_engine_conf


@pytest.fixture
def only_customer(spark, tmp_path):
    """A dataset of one table, which Spark wrote as a folder."""
    rows = [(1, "Customer#1", 3, 120.5, "BUILDING"), (2, "Customer#2", 4, -3.25, "MACHINERY")]
    ddl = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "customer.parquet"))
    return tmp_path


def accounts(spark, sf_dir) -> dict:
    return {r.customer_id: (r.account_count, r.total_balance) for r in registry.build_queries()["g1b_accounts_agg"](spark, sf_dir).collect()}


def test_a_query_needs_only_the_tables_that_it_reads(spark, only_customer):
    assert accounts(spark, str(only_customer)) == {"CU0000001": (1, 120.5), "CU0000002": (1, -3.25)}


def test_lookup_needs_no_fact_table(spark, tmp_path):
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    spark.createDataFrame([(7, "GERMANY", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    found = registry.build_queries()["g3a_mcc_lookup"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [("5007", "GERMANY", "EUROPE")]


def test_folder_may_be_a_path_object(spark, only_customer):
    assert accounts(spark, only_customer) == accounts(spark, f"{only_customer}/")


def test_a_table_that_comes_later_is_seen(spark, only_customer):
    before = registry.medallion_for(spark, str(only_customer), False)
    assert registry.medallion_for(spark, str(only_customer), False) is before
    spark.createDataFrame([(1, "S1", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(str(only_customer / "supplier.parquet"))
    after = registry.medallion_for(spark, str(only_customer), False)
    assert after is not before and after.silver("merchants").count() == 1


def test_without_a_list_of_files_plans_are_not_shared(spark, only_customer, monkeypatch):
    monkeypatch.setattr(registry, "_fingerprint", lambda *_: None)
    held = len(registry._MEDALLIONS)
    assert registry.medallion_for(spark, str(only_customer), False) is not registry.medallion_for(spark, str(only_customer), False)
    assert len(registry._MEDALLIONS) == held and len(accounts(spark, str(only_customer))) == 2


def test_sessions_without_a_checkpoint_folder_can_be_prepared():
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf()

    assert apply_engine_conf(Session()).conf == {"spark.sql.session.timeZone": "UTC"}


def test_all_driver_tables_missing_is_an_error_of_the_read(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        registry.build_queries()["g1b_accounts_agg"](spark, os.path.join(tmp_path, "none")).count()


def test_velocity_rules_are_those_of_the_nations_and_those_that_events_hit(spark, tmp_path):
    spark.createDataFrame([(0,), (8,), (24,)], "n_nationkey int").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(i,) for i in (7, 8, 9, 9, 13)], "event_id long").write.parquet(str(tmp_path / "events.parquet"))
    rules = registry.build_queries()["silver_dim_velocity_rules"](spark, str(tmp_path)).collect()
    assert sorted(r.rule_id for r in rules) == ["VR001", "VR002", "VR0025", "VR003", "VR007", "VR009"]
    assert {r.rule_id: r.threshold for r in rules}["VR0025"] == 125.0
    assert {r.rule_id: r.dq_errors for r in rules}["VR007"] == "CAST_FAILED:threshold:FLOAT64"


def test_few_plans_are_in_the_drivers_memory_at_once(monkeypatch):
    import threading
    import time
    from types import SimpleNamespace

    from lakestrata.plans.medallion import Medallion

    lock, running, most = threading.Lock(), [], {}

    class Frame:
        def __init__(self, layer):
            self.layer, self.write = layer, self

        def mode(self, _):
            return self

        def parquet(self, _):
            with lock:
                running.append(self.layer)
                most[self.layer] = max(most.get(self.layer, 0), len(running))
            time.sleep(0.05)
            with lock:
                running.remove(self.layer)

    monkeypatch.setattr("lakestrata.session.scratch_path", lambda *_: "/layers")
    monkeypatch.setattr(Medallion, "silver", lambda *_: Frame("silver"))
    monkeypatch.setattr(Medallion, "gold", lambda *_: Frame("gold"))
    m = Medallion(SimpleNamespace(read=SimpleNamespace(parquet=lambda path: path)), None)
    keys = [*registry.SILVER_MODELS, *registry.GOLD_MODELS]
    m.materialize(keys)
    assert most == {"silver": 2, "gold": 1}
    assert m._overrides == {k: f"/layers/{k}" for k in keys}


def test_plans_of_the_last_datasets_are_kept(spark, only_customer, tmp_path):
    import shutil

    held = [registry.medallion_for(spark, str(only_customer), layered) for layered in (False, True)]
    for name in ("a", "b"):
        shutil.copytree(only_customer / "customer.parquet", tmp_path / name / "customer.parquet")
        last = registry.medallion_for(spark, str(tmp_path / name), False)
    assert len(registry._MEDALLIONS) == registry.KEPT_MEDALLIONS and not set(map(id, held)) & set(map(id, registry._MEDALLIONS.values()))
    assert registry.medallion_for(spark, str(tmp_path / "b"), False) is last and len(accounts(spark, str(only_customer))) == 2
