"""gold_transaction_360: one row per transaction that has a card.

Plan: the three per-transaction flag sets are pre-aggregated by
``transaction_id`` (map-side partial aggregation, so a hot key collapses to
one row before the shuffle) and joined at transaction grain; the card join is
inner (transactions on unknown cards drop out); whether the merchant, type and
MCC lookups are broadcast is the planner's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.aggregates import count_if
from lakestrata.functions.hashing import record_hash
from lakestrata.operators.gold.common import left_join_on_key


def g2b_fraud_flag(m) -> DataFrame:
    return m.silver("fraud_alerts").groupBy("transaction_id").agg(
        F.lit(True).alias("has_fraud_alert"),
        F.max("risk_score").alias("max_risk_score"),
        count_if(F.col("is_genuine_fraud")).alias("confirmed_fraud_count"),
    )


def g2c_dispute_flag(m) -> DataFrame:
    return m.silver("disputes").groupBy("transaction_id").agg(
        F.lit(True).alias("has_dispute"),
        F.max("outcome").alias("dispute_outcome"),
        F.max("disputed_amount").alias("disputed_amount"),
    )


def g2d_velocity_flag(m) -> DataFrame:
    return m.silver("velocity_hits").groupBy("transaction_id").agg(
        F.count("hit_id").alias("velocity_hit_count"),
        F.max("action_taken").alias("velocity_action"),
    )


def build(m) -> DataFrame:
    t = m.silver("transactions").select(
        "transaction_id", "card_id", "merchant_id", "txn_type_id", "transaction_date", "posting_date", "amount",
        "currency", "original_amount", "original_currency", "fx_rate", "description",
        F.col("status").alias("transaction_status"), "is_online", "is_international",
        F.col("mcc_code").alias("transaction_mcc_code"), "auth_code", "is_flagged",
    )
    cards = m.silver("credit_cards").select(
        "card_id", "customer_id", "credit_limit", "card_status", "cardholder_name"
    )
    merchants = m.silver("merchants").select(
        "merchant_id", "merchant_name", "merchant_city", "merchant_country",
        F.col("is_online").alias("merchant_is_online"),
    )
    txn_types = m.silver("dim_transaction_types").select(
        "txn_type_id", F.col("type_name").alias("txn_type_name"), "is_credit"
    )
    mcc = m.silver("dim_merchant_categories").select(
        F.col("mcc_code").alias("transaction_mcc_code"), "category_name", "category_group"
    )
    # Flags first (transaction grain, NULL ids bypass the shuffle), then one
    # card join over the combined rows, then the lookups.
    flagged = left_join_on_key(t, "transaction_id", [g2b_fraud_flag(m), g2c_dispute_flag(m), g2d_velocity_flag(m)])
    j = (
        flagged.join(cards, "card_id", "inner")
        .join(merchants, "merchant_id", "left")
        .join(txn_types, "txn_type_id", "left")
        .join(mcc, "transaction_mcc_code", "left")
    )
    j = j.select(
        "transaction_id", "card_id", "customer_id", "merchant_id", "txn_type_id", "transaction_date",
        "posting_date", "amount", "currency", "original_amount", "original_currency", "fx_rate", "description",
        "transaction_status", "is_online", "is_international", "transaction_mcc_code", "auth_code", "is_flagged",
        "cardholder_name", "credit_limit", "card_status", "txn_type_name", "is_credit", "merchant_name",
        "merchant_city", "merchant_country", "merchant_is_online", "category_name", "category_group",
        F.coalesce("has_fraud_alert", F.lit(False)).alias("has_fraud_alert"),
        F.coalesce("max_risk_score", F.lit(0.0)).alias("max_fraud_risk_score"),
        (F.coalesce("confirmed_fraud_count", F.lit(0)) > 0).alias("is_confirmed_fraud"),
        F.coalesce("has_dispute", F.lit(False)).alias("has_dispute"),
        "dispute_outcome",
        F.coalesce("disputed_amount", F.lit(0.0)).alias("disputed_amount"),
        F.coalesce("velocity_hit_count", F.lit(0)).alias("velocity_hit_count"),
        "velocity_action",
    )
    return j.select(
        "*",
        F.lit("transaction_360").alias("gold_entity_name"),
        m.ctx.ts().alias("gold_created_ts"),
        record_hash(j, ["transaction_id", "card_id", "merchant_id", "amount"]).alias("gold_record_hash"),
    )
