"""gold_fraud_case_360: one row per fraud alert with transaction, card,
customer, merchant, dispute, chargeback and velocity context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.aggregates import string_agg_distinct
from lakestrata.operators.gold.common import with_gold_audit, zero


def g5b_dispute_flag(m) -> DataFrame:
    # Independent maxima: the values may come from different disputes.
    return m.silver("disputes").groupBy("transaction_id").agg(
        F.lit(True).alias("has_dispute"),
        F.max("dispute_id").alias("dispute_id"),
        F.max("dispute_reason").alias("dispute_reason"),
        F.max("outcome").alias("dispute_outcome"),
        F.max("disputed_amount").alias("disputed_amount"),
        F.max("refund_amount").alias("refund_amount"),
        F.max("status").alias("dispute_status"),
    )


def g5c_chargeback_flag(m) -> DataFrame:
    cb = m.silver("chargeback_cases").select(
        "chargeback_id", "dispute_id", "chargeback_amount", "current_stage", "acquirer_response",
        "bank_liability", "recovery_amount",
    )
    d = m.silver("disputes").select("dispute_id", "transaction_id")
    return cb.join(d, "dispute_id").groupBy("transaction_id").agg(
        F.lit(True).alias("has_chargeback"),
        F.max("chargeback_id").alias("chargeback_id"),
        F.max("chargeback_amount").alias("chargeback_amount"),
        F.max("current_stage").alias("chargeback_stage"),
        F.max("acquirer_response").alias("acquirer_response"),
        F.coalesce(F.max("bank_liability"), F.lit(False)).alias("bank_liability"),
        F.max("recovery_amount").alias("recovery_amount"),
    )


def g5d_velocity_agg(m) -> DataFrame:
    return m.silver("velocity_hits").groupBy("transaction_id").agg(
        F.count("hit_id").alias("velocity_hit_count"),
        string_agg_distinct("action_taken").alias("velocity_actions"),
    )


def build(m) -> DataFrame:
    fa = m.silver("fraud_alerts").select(
        "alert_id", "transaction_id", "card_id", "alert_type", F.col("status").alias("alert_status"),
        "alert_timestamp", "risk_score", "is_genuine_fraud", "resolved_at", "analyst_notes",
    )
    t = m.silver("transactions").select(
        "transaction_id", "merchant_id", "transaction_date", "posting_date", "amount", "currency",
        F.col("status").alias("transaction_status"), "is_online", "is_international", "mcc_code", "is_flagged",
    )
    cards = m.silver("credit_cards").select(
        "card_id", "customer_id", F.col("credit_limit").alias("card_credit_limit"), "card_status"
    )
    customers = m.silver("customers").select(
        "customer_id", "first_name", "last_name", "email", "credit_score", "customer_status"
    )
    merchants = (m.silver("merchants").select(
        "merchant_id", "merchant_name", "merchant_city", "merchant_country"
    ))
    nn = F.col("transaction_id").isNotNull()
    # Alerts without a transaction can never match a transaction-keyed side;
    # they bypass those joins instead of piling into one hash partition.
    keyed = (
        fa.where(nn)
        .join(t.where(nn), "transaction_id", "left")
        .join(g5b_dispute_flag(m).where(nn), "transaction_id", "left")
        .join(g5c_chargeback_flag(m).where(nn), "transaction_id", "left")
        .join(g5d_velocity_agg(m).where(nn), "transaction_id", "left")
    )
    j = (
        keyed.unionByName(fa.where(~nn), allowMissingColumns=True)
        .join(cards, "card_id", "left")
        .join(customers, "customer_id", "left")
        .join(merchants, "merchant_id", "left")
    )
    genuine = F.col("is_genuine_fraud")
    has_cb = F.coalesce(F.col("has_chargeback"), F.lit(False))
    has_d = F.coalesce(F.col("has_dispute"), F.lit(False))
    out = j.select(
        "alert_id", "transaction_id", "card_id", "customer_id", "merchant_id", "alert_type", "alert_status",
        "alert_timestamp", "risk_score", "is_genuine_fraud", "resolved_at", "analyst_notes",
        "transaction_date", "posting_date", "amount", "currency", "transaction_status", "is_online",
        "is_international", "mcc_code", "is_flagged", "card_credit_limit", "card_status",
        "first_name", "last_name", "email", "credit_score", "customer_status",
        "merchant_name", "merchant_city", "merchant_country",
        has_d.alias("has_dispute"), "dispute_id", "dispute_reason", "dispute_outcome",
        zero("disputed_amount").cast("double").alias("disputed_amount"),
        zero("refund_amount").cast("double").alias("refund_amount"),
        "dispute_status",
        has_cb.alias("has_chargeback"), "chargeback_id",
        zero("chargeback_amount").cast("double").alias("chargeback_amount"),
        "chargeback_stage", "acquirer_response",
        F.coalesce(F.col("bank_liability"), F.lit(False)).alias("bank_liability"),
        zero("recovery_amount").cast("double").alias("recovery_amount"),
        zero("velocity_hit_count").alias("velocity_hit_count"),
        "velocity_actions",
        F.when(genuine & has_cb, "CHARGEBACK_RAISED")
        .when(genuine & has_d, "DISPUTED")
        .when(genuine, "FRAUD_CONFIRMED_NO_ACTION")
        .when(F.col("alert_status") == "False Positive", "FALSE_POSITIVE")
        .when(F.col("alert_status") == "Resolved", "RESOLVED")
        .otherwise("OPEN")
        .alias("case_resolution_status"),
    )
    return with_gold_audit(out, "fraud_case_360", m.ctx, ["alert_id", "card_id", "alert_type"])
