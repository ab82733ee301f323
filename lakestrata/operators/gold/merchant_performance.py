"""gold_merchant_performance: one row per merchant (merchants without
activity are kept with zero counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.aggregates import count_if
from lakestrata.functions.numeric import nullif0, round_half_up, safe_divide
from lakestrata.operators.gold.common import left_join_on_key, top1, with_gold_audit, zero


def g3a_mcc_lookup(m) -> DataFrame:
    return m.silver("dim_merchant_categories").select("mcc_code", "category_name", "category_group")


def g3b_txn_agg(m) -> DataFrame:
    amt = F.col("amount")
    return m.silver("transactions").groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.count_distinct("card_id").alias("unique_cards"),
        round_half_up(F.sum(amt), 2).alias("total_volume"),
        round_half_up(F.avg(amt), 2).alias("avg_txn_amount"),
        round_half_up(F.min(amt), 2).alias("min_txn_amount"),
        round_half_up(F.max(amt), 2).alias("max_txn_amount"),
        count_if(F.col("is_international")).alias("international_txn_count"),
        count_if(F.col("is_online")).alias("online_txn_count"),
        count_if(F.col("status") == "Posted").alias("posted_txn_count"),
        count_if(F.col("status") == "Declined").alias("declined_txn_count"),
        count_if(F.col("is_flagged")).alias("flagged_txn_count"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def _txn_merchant(m) -> DataFrame:
    return m.silver("transactions").select("transaction_id", "merchant_id")


def g3c_dispute_agg(m) -> DataFrame:
    found = dispute_chargeback_aggregates(m).where(F.col("dispute_count").isNotNull())
    return found.select("merchant_id", "dispute_count", "total_disputed_amount", "total_refunded_amount", "disputes_upheld", "disputes_rejected")


def g3d_chargeback_agg(m) -> DataFrame:
    found = dispute_chargeback_aggregates(m).where(F.col("chargeback_count").isNotNull())
    return found.select("merchant_id", "chargeback_count", "total_chargeback_amount", "total_recovered_amount")


def g3e_blacklist(m) -> DataFrame:
    latest = top1(m.silver("merchant_blacklist"), "merchant_id", ["added_date", "blacklist_id"],
                  ["blacklist_reason", "is_active"])
    return latest.select(
        "merchant_id", F.lit(True).alias("is_blacklisted"), "blacklist_reason",
        F.col("is_active").alias("blacklist_is_active"),
    )


def dispute_chargeback_aggregates(m) -> DataFrame:
    """g3c and g3d with ONE join against the transactions' merchant map.

    Dispute rows and chargeback rows (chargebacks resolved to their dispute's
    transaction first) are tagged, unioned and meet ``(transaction_id,
    merchant_id)`` once; aggregation is by ``(merchant_id, kind)`` so the
    per-kind key is the only distinct aggregate, then folded per merchant."""
    d = m.silver("disputes")
    disputes = d.select(
        "transaction_id", F.lit("d").alias("_kind"), F.col("dispute_id").alias("_id"),
        F.col("disputed_amount").alias("_a"), F.col("refund_amount").alias("_b"), "outcome",
    )
    chargebacks = (
        m.silver("chargeback_cases").select("chargeback_id", "dispute_id", "chargeback_amount", "recovery_amount")
        .join(d.select("dispute_id", "transaction_id"), "dispute_id")
        .select("transaction_id", F.lit("c").alias("_kind"), F.col("chargeback_id").alias("_id"),
                F.col("chargeback_amount").alias("_a"), F.col("recovery_amount").alias("_b"),
                F.lit(None).cast("string").alias("outcome"))
    )
    per_kind = (
        disputes.unionByName(chargebacks)
        .join(_txn_merchant(m), "transaction_id")
        .groupBy("merchant_id", "_kind")
        .agg(
            F.count_distinct("_id").alias("_n"),
            round_half_up(F.sum("_a"), 2).alias("_a"),
            round_half_up(F.sum("_b"), 2).alias("_b"),
            count_if(F.col("outcome") == "Upheld").alias("disputes_upheld"),
            count_if(F.col("outcome") == "Rejected").alias("disputes_rejected"),
        )
    )
    kind = F.col("_kind")

    def pick(k: str, col: str):
        return F.max(F.when(kind == k, F.col(col)))

    return per_kind.groupBy("merchant_id").agg(
        pick("d", "_n").alias("dispute_count"),
        pick("d", "_a").alias("total_disputed_amount"),
        pick("d", "_b").alias("total_refunded_amount"),
        pick("d", "disputes_upheld").alias("disputes_upheld"),
        pick("d", "disputes_rejected").alias("disputes_rejected"),
        pick("c", "_n").alias("chargeback_count"),
        pick("c", "_a").alias("total_chargeback_amount"),
        pick("c", "_b").alias("total_recovered_amount"),
    )


def build(m) -> DataFrame:
    j = left_join_on_key(
        m.silver("merchants"), "merchant_id", [g3b_txn_agg(m), dispute_chargeback_aggregates(m), g3e_blacklist(m)]
    ).join((g3a_mcc_lookup(m)), "mcc_code", "left")
    dispute_rate = round_half_up(safe_divide(zero("dispute_count"), nullif0(zero("total_transactions"))), 4)
    blacklisted = F.coalesce(F.col("blacklist_is_active"), F.lit(False))
    out = j.select(
        "merchant_id", "merchant_name", "merchant_city", "merchant_country", "merchant_postcode", "mcc_code",
        "category_name", "category_group", "acquirer_bank", "is_online", "registered_date",
        *[zero(c).alias(c) for c in (
            "total_transactions unique_cards total_volume avg_txn_amount min_txn_amount max_txn_amount "
            "international_txn_count online_txn_count posted_txn_count declined_txn_count flagged_txn_count"
        ).split()],
        "first_transaction_date", "last_transaction_date",
        round_half_up(safe_divide(zero("declined_txn_count"), nullif0(zero("total_transactions"))), 4)
        .alias("decline_rate"),
        zero("dispute_count").alias("dispute_count"),
        zero("total_disputed_amount").alias("total_disputed_amount"),
        zero("total_refunded_amount").alias("total_refunded_amount"),
        dispute_rate.alias("dispute_rate"),
        zero("chargeback_count").alias("chargeback_count"),
        zero("total_chargeback_amount").alias("total_chargeback_amount"),
        zero("total_recovered_amount").alias("total_recovered_amount"),
        round_half_up(safe_divide(zero("total_recovered_amount"), nullif0(zero("total_chargeback_amount"))), 4)
        .alias("chargeback_recovery_rate"),
        F.coalesce(F.col("is_blacklisted"), F.lit(False)).alias("is_blacklisted"),
        "blacklist_reason",
        blacklisted.alias("blacklist_is_active"),
        F.when(blacklisted, "BLACKLISTED")
        .when(dispute_rate > 0.05, "HIGH_RISK")
        .when(dispute_rate > 0.02, "MEDIUM_RISK")
        .otherwise("LOW_RISK")
        .alias("merchant_risk_tier"),
    )
    return with_gold_audit(out, "merchant_performance", m.ctx, ["merchant_id", "merchant_name", "mcc_code"])
