"""Assertions: data tests that pass when they return no failing rows.

Generic column tests (``unique``, ``not_null``, ``accepted_values``,
``relationships``) follow the usual semantics: NULLs are ignored by unique,
accepted_values and relationships.  Each test returns its failing rows; the
summary runs the tests of a whole layer as one fused aggregation for null
checks and accepted values, one for unique keys, and the grouped anti-join of
the FK report for relationships.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.relationships import FkCheck, orphan_counts

# ---------------------------------------------------------------------------
# Generic tests declared on the silver and gold models.
# Per model: unique key, not_null columns, accepted values, relationships
# (column → parent model.column).
# ---------------------------------------------------------------------------
_C360, _MP = "gold_customer_360", "gold_merchant_performance"
SCHEMA_TESTS: dict[str, dict] = {
    "silver_customers": dict(unique="customer_id", not_null="customer_id first_name last_name customer_status",
                             accepted={"dq_status": ["PASS", "FAIL"]}),
    "silver_addresses": dict(unique="address_id", not_null="address_id customer_id",
                             rel=[("customer_id", "silver_customers", "customer_id")]),
    "silver_accounts": dict(unique="account_id", not_null="account_id customer_id account_status",
                            rel=[("customer_id", "silver_customers", "customer_id")]),
    "silver_credit_cards": dict(unique="card_id", not_null="card_id customer_id account_id card_type_id card_status",
                                rel=[("customer_id", "silver_customers", "customer_id"),
                                     ("account_id", "silver_accounts", "account_id"),
                                     ("card_type_id", "silver_dim_card_types", "card_type_id")]),
    "silver_merchants": dict(unique="merchant_id", not_null="merchant_id merchant_name mcc_code",
                             rel=[("mcc_code", "silver_dim_merchant_categories", "mcc_code")]),
    "silver_transactions": dict(unique="transaction_id", not_null="transaction_id card_id amount status",
                                accepted={"status": ["Posted", "Pending", "Declined", "Reversed"]},
                                rel=[("card_id", "silver_credit_cards", "card_id"),
                                     ("merchant_id", "silver_merchants", "merchant_id")]),
    "silver_statements": dict(unique="statement_id", not_null="statement_id card_id payment_status",
                              accepted={"payment_status": ["Paid", "Partial", "Missed", "Pending"]},
                              rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_payments": dict(unique="payment_id", not_null="payment_id card_id amount status",
                            accepted={"status": ["Cleared", "Pending", "Failed"]},
                            rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_fees": dict(unique="fee_id", not_null="fee_id card_id fee_type",
                        rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_fraud_alerts": dict(unique="alert_id", not_null="alert_id card_id alert_type status",
                                rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_disputes": dict(unique="dispute_id", not_null="dispute_id card_id dispute_reason status",
                            rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_chargeback_cases": dict(unique="chargeback_id", not_null="chargeback_id card_id current_stage",
                                    rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_velocity_hits": dict(unique="hit_id", not_null="hit_id rule_id card_id action_taken",
                                 rel=[("rule_id", "silver_dim_velocity_rules", "rule_id"),
                                      ("card_id", "silver_credit_cards", "card_id")]),
    "silver_merchant_blacklist": dict(unique="blacklist_id", not_null="blacklist_id merchant_id blacklist_reason",
                                      rel=[("merchant_id", "silver_merchants", "merchant_id")]),
    "silver_rewards": dict(unique="reward_id", not_null="reward_id card_id customer_id program_type",
                           rel=[("card_id", "silver_credit_cards", "card_id"),
                                ("customer_id", "silver_customers", "customer_id")]),
    "silver_reward_redemptions": dict(unique="redemption_id",
                                      not_null="redemption_id reward_id card_id customer_id status",
                                      rel=[("reward_id", "silver_rewards", "reward_id"),
                                           ("card_id", "silver_credit_cards", "card_id"),
                                           ("customer_id", "silver_customers", "customer_id")]),
    "silver_kyc_documents": dict(unique="kyc_id", not_null="kyc_id customer_id document_type status",
                                 rel=[("customer_id", "silver_customers", "customer_id")]),
    "silver_contact_history": dict(unique="contact_id", not_null="contact_id customer_id channel",
                                   rel=[("customer_id", "silver_customers", "customer_id")]),
    "silver_emi_plans": dict(unique="emi_plan_id", not_null="emi_plan_id card_id status",
                             rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_notifications": dict(unique="notification_id", not_null="notification_id customer_id notification_type",
                                 rel=[("customer_id", "silver_customers", "customer_id")]),
    "silver_credit_limit_history": dict(unique="limit_history_id", not_null="limit_history_id card_id new_limit",
                                        rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_interest_rates": dict(unique="rate_id", not_null="rate_id card_id rate_type apr",
                                  rel=[("card_id", "silver_credit_cards", "card_id")]),
    "silver_dim_card_types": dict(unique="card_type_id", not_null="card_type_id card_name network tier",
                                  accepted={"network": ["VISA", "MASTERCARD", "AMEX"]}),
    "silver_dim_merchant_categories": dict(unique="mcc_code", not_null="mcc_code category_name category_group"),
    "silver_dim_transaction_types": dict(unique="txn_type_id", not_null="txn_type_id type_name"),
    "silver_dim_velocity_rules": dict(unique="rule_id", not_null="rule_id rule_name action",
                                      accepted={"action": ["Alert", "Block"]}),
    "silver_relationship_dq_results": dict(accepted={"fk_status": ["PASS", "FAIL"]}),
    "gold_customer_360": dict(unique="customer_id",
                              not_null="customer_id full_name customer_status gold_entity_name gold_created_ts "
                                       "gold_record_hash",
                              accepted={"gold_entity_name": ["customer_360"]}),
    "gold_transaction_360": dict(unique="transaction_id",
                                 not_null="transaction_id customer_id amount transaction_status gold_entity_name "
                                          "gold_record_hash",
                                 accepted={"transaction_status": ["Posted", "Pending", "Declined", "Reversed"],
                                           "gold_entity_name": ["transaction_360"]},
                                 rel=[("customer_id", _C360, "customer_id"), ("merchant_id", _MP, "merchant_id")]),
    "gold_merchant_performance": dict(unique="merchant_id",
                                      not_null="merchant_id merchant_name mcc_code merchant_risk_tier "
                                               "gold_entity_name gold_record_hash",
                                      accepted={"merchant_risk_tier": ["LOW_RISK", "MEDIUM_RISK", "HIGH_RISK",
                                                                       "BLACKLISTED"],
                                                "gold_entity_name": ["merchant_performance"]}),
    "gold_account_financial_summary": dict(unique="account_id",
                                           not_null="account_id customer_id account_status payment_event_count "
                                                    "total_amount_paid delinquency_bucket gold_entity_name "
                                                    "gold_record_hash",
                                           accepted={"delinquency_bucket": ["Current", "30-60 DPD", "60-90 DPD",
                                                                            "90+ DPD"],
                                                     "gold_entity_name": ["account_financial_summary"]},
                                           rel=[("customer_id", _C360, "customer_id")]),
    "gold_fraud_case_360": dict(unique="alert_id",
                                not_null="alert_id card_id alert_type alert_status case_resolution_status "
                                         "gold_entity_name gold_record_hash",
                                accepted={"case_resolution_status": ["CHARGEBACK_RAISED", "DISPUTED",
                                                                     "FRAUD_CONFIRMED_NO_ACTION", "FALSE_POSITIVE",
                                                                     "RESOLVED", "OPEN"],
                                          "gold_entity_name": ["fraud_case_360"]}),
    "gold_rewards_engagement": dict(unique="reward_id",
                                    not_null="reward_id card_id customer_id program_type engagement_tier "
                                             "gold_entity_name gold_record_hash",
                                    accepted={"engagement_tier": ["HIGHLY_ENGAGED", "ENGAGED", "ACTIVE",
                                                                  "SPENDING_NOT_REDEEMING", "INACTIVE"],
                                              "gold_entity_name": ["rewards_engagement"]},
                                    rel=[("customer_id", _C360, "customer_id")]),
}


# -- single tests (failing rows) ------------------------------------------
def assert_unique(df: DataFrame, col: str) -> DataFrame:
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def assert_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def assert_accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    return (
        df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
        .groupBy(F.col(col).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def assert_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    parent_keys = parent.select(F.col(field).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return (
        child.select(F.col(col).alias("from_field"))
        .where(F.col("from_field").isNotNull())
        .join(parent_keys, F.col("from_field") == F.col("_k"), "left_anti")
    )


# -- layer summary ----------------------------------------------------------
def _table(m, name: str) -> DataFrame:
    if name in getattr(m, "_overrides", {}):
        return m._overrides[name]
    if name == "silver_relationship_dq_results":
        from lakestrata.operators.relationships import silver_relationship_dq_results

        return silver_relationship_dq_results(m)
    return m.gold(name) if name.startswith("gold_") else m.silver(name)


def schema_test_results(m, models: list[str]) -> DataFrame:
    """One row per declared test: ``test_id, model_name, column_name,
    test_type, failures, status``.

    All not_null and accepted_values tests share ONE scan per table and ONE
    aggregation keyed by (model, failing values) (NULL counter slots and
    failing-value slots, unpivoted with ``stack``); all unique tests ONE over
    narrow ``(model, key)`` rows; all relationships tests the single grouped
    anti-join of :func:`orphan_counts`.  So a layer's tests are three keyed
    aggregations, however many tables and tests it has.  (Folding the unique
    tests into the relationships aggregation would save the parents' key
    scans but make every key row as wide as the largest check group, which
    measured slower; so did a separate scan per accepted_values test.)"""
    parts = []
    uniq = []
    not_null: list[tuple[int, str, list[str]]] = []
    accepted: list[tuple[int, str, str, list[str]]] = []
    fk_checks: list[FkCheck] = []
    for mi, model in enumerate(models):
        t = SCHEMA_TESTS[model]
        nn = t.get("not_null", "").split()
        if nn:
            not_null.append((mi, model, nn))
        accepted += [(len(accepted) + i, model, c, vals) for i, (c, vals) in enumerate(t.get("accepted", {}).items())]
        if t.get("unique"):
            uniq.append((mi, model, t["unique"]))
        for col, parent, field in t.get("rel", []):
            fk_checks.append(FkCheck(model, col, parent, field, skip_null=True))
    if not_null or accepted:
        # not_null and accepted_values tests of all tables: each table is
        # scanned once, as (model, NULL flags..., failing value per accepted
        # column or NULL) rows.  Grouping by (model, failing values) collapses
        # map-side to about one row per model per task (failing values are
        # rare); the second aggregation sums the NULL counts and counts the
        # distinct failing values per column.  Its distinct-count Expand only
        # sees the tiny pre-aggregated rows, never the table rows.
        nn_of = {mi: nn for mi, _, nn in not_null}
        acc_of: dict[str, list[tuple[str, list[str]]]] = {}
        for _, model, c, vals in accepted:
            acc_of.setdefault(model, []).append((c, vals))
        nw = max((len(nn) for nn in nn_of.values()), default=0)
        aw = max((len(v) for v in acc_of.values()), default=0)
        rows = []
        for mi, model in enumerate(models):
            nn, acc = nn_of.get(mi, []), acc_of.get(model, [])
            if not nn and not acc:
                continue
            rows.append(_table(m, model).select(
                F.lit(mi).alias("_m"),
                *[(F.col(nn[j]).isNull().cast("long") if j < len(nn) else F.lit(0).cast("long")).alias(f"_n{j}")
                  for j in range(nw)],
                *[(F.when(~F.col(acc[j][0]).isin(acc[j][1]), F.col(acc[j][0]).cast("string")) if j < len(acc)
                   else F.lit(None).cast("string")).alias(f"_v{j}") for j in range(aw)],
            ))
        per_values = reduce(DataFrame.unionByName, rows).groupBy("_m", *[f"_v{j}" for j in range(aw)]).agg(
            *[F.sum(f"_n{j}").alias(f"_n{j}") for j in range(nw)], F.count(F.lit(1)).alias("_rows")
        )
        per_model = per_values.groupBy("_m").agg(
            *[F.sum(f"_n{j}").alias(f"_n{j}") for j in range(nw)],
            *[F.count_distinct(f"_v{j}").alias(f"_v{j}") for j in range(aw)],
        )
        slots = [f"{j}, _n{j}" for j in range(nw)] + [f"{100 + j}, _v{j}" for j in range(aw)]
        per_slot = per_model.selectExpr("_m", f"stack({len(slots)}, {', '.join(slots)}) AS (_j, _f)")
        labels = m.spark.createDataFrame(
            [(mi, j, f"not_null:{model}.{c}", model, c, "not_null") for mi, model, nn in not_null
             for j, c in enumerate(nn)]
            + [(models.index(model), 100 + j, f"accepted_values:{model}.{c}", model, c, "accepted_values")
               for model, acc in acc_of.items() for j, (c, _) in enumerate(acc)],
            "_m int, _j int, test_id string, model_name string, column_name string, test_type string",
        )
        parts.append(labels.join(F.broadcast(per_slot), ["_m", "_j"], "left").select(
            "test_id", "model_name", "column_name", "test_type",
            F.coalesce(F.col("_f"), F.lit(0)).cast("bigint").alias("failures"),
        ))
    if uniq:
        # all unique tests: ONE keyed aggregation over narrow (model, key)
        # rows, partial-aggregated map-side
        keys = reduce(DataFrame.unionByName, [
            _table(m, model).select(F.lit(mi).alias("_m"), F.col(c).cast("string").alias("_k"))
            .where(F.col("_k").isNotNull())
            for mi, model, c in uniq
        ])
        dup_values = (
            keys.groupBy("_m", "_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
            .groupBy("_m").agg(F.count(F.lit(1)).alias("_dups"))
        )
        labels = m.spark.createDataFrame(
            [(mi, f"unique:{model}.{c}", model, c) for mi, model, c in uniq],
            "_m int, test_id string, model_name string, column_name string",
        )
        parts.append(labels.join(F.broadcast(dup_values), "_m", "left").select(
            "test_id", "model_name", "column_name", F.lit("unique").alias("test_type"),
            F.coalesce(F.col("_dups"), F.lit(0)).cast("bigint").alias("failures"),
        ))
    if fk_checks:
        # all relationships tests: the single grouped anti-join of the FK report
        counts = orphan_counts(_Prefixless(m), fk_checks)
        parts.append(counts.select(
            F.concat(F.lit("relationships:"), F.expr("substr(child_table, 8)"), F.lit("."), F.col("fk_column"))
            .alias("test_id"),
            F.expr("substr(child_table, 8)").alias("model_name"),
            F.col("fk_column").alias("column_name"),
            F.lit("relationships").alias("test_type"),
            F.col("orphaned_count").alias("failures"),
        ))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


class _Prefixless:
    """Adapter so ``orphan_counts`` (which reads silver tables by bare name)
    can read any model by its full name."""

    def __init__(self, m):
        self._m = m
        self.spark = m.spark

    def silver(self, name: str) -> DataFrame:
        return _table(self._m, name)


# -- singular tests ---------------------------------------------------------
def assert_gold_dq_no_critical(report: DataFrame) -> DataFrame:
    return report.where((F.col("severity") == "CRITICAL") & (F.col("check_status") == "FAIL")).select(
        "check_id", "table_name", "check_type", "failed_rows", "severity", "check_status"
    )


def assert_reconciliation_clean(report: DataFrame) -> DataFrame:
    return report.where(F.col("reconciliation_status") == "FAIL").select(
        "reconciliation_id", "reconciliation_scope", "source_table", "target_table", "source_count",
        "intermediate_count", "target_count", "missing_in_intermediate", "missing_in_target",
        "duplicate_intermediate_keys", "duplicate_target_keys", "reconciliation_status",
    )


def assert_no_fk_orphans(report: DataFrame) -> DataFrame:
    return report.where(F.col("fk_status") == "FAIL").select(
        "child_table", "fk_column", "parent_table", "pk_column", "orphaned_count", "fk_status"
    )
