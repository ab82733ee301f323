"""gold_customer_360: one row per customer, seven per-customer aggregates
left-joined on ``customer_id`` (all pre-aggregated by the join key, so the
joins run co-partitioned and never fan out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.aggregates import count_if
from lakestrata.functions.numeric import nullif0, round_half_up, safe_divide
from lakestrata.operators.gold.common import card_bridge, left_join_on_key, top1, with_gold_audit, zero

ADDRESS_COLS = ["address_line1", "address_line2", "city", "county", "postcode", "country"]


def g1a_primary_address(m) -> DataFrame:
    primary = m.silver("addresses").where(F.col("is_primary") == F.lit(True))
    return top1(primary, "customer_id", ["valid_from", "address_id"], ADDRESS_COLS)


def g1b_accounts_agg(m) -> DataFrame:
    return m.silver("accounts").groupBy("customer_id").agg(
        F.count_distinct("account_id").alias("account_count"),
        F.sum("balance").alias("total_balance"),
        count_if(F.col("account_status") == "Active").alias("active_account_count"),
    )


def card_totals(cards: DataFrame, key: str, rate_name: str) -> DataFrame:
    """Card counts, limits and utilisation per ``key`` (customer or account)."""
    return cards.groupBy(key).agg(
        F.count_distinct("card_id").alias("card_count"),
        F.sum("credit_limit").alias("total_credit_limit"),
        F.sum("available_credit").alias("total_available_credit"),
        count_if(F.col("card_status") == "Active").alias("active_card_count"),
        round_half_up(
            F.lit(1) - safe_divide(F.sum("available_credit"), nullif0(F.sum("credit_limit"))), 4
        ).alias(rate_name),
    )


def g1c_cards_agg(m) -> DataFrame:
    return card_totals(m.silver("credit_cards"), "customer_id", "overall_utilisation_rate")


def g1d_rewards_agg(m) -> DataFrame:
    return m.silver("rewards").groupBy("customer_id").agg(
        F.count_distinct("reward_id").alias("rewards_programme_count"),
        F.sum("points_balance").alias("total_points_balance"),
        F.sum("points_earned_ytd").alias("total_points_earned_ytd"),
        F.sum("points_redeemed_ytd").alias("total_points_redeemed_ytd"),
    )


def g1e_kyc_status(m) -> DataFrame:
    # Lexical max of the status text, as in the reference (not the latest).
    return m.silver("kyc_documents").groupBy("customer_id").agg(
        F.max("status").alias("kyc_latest_status"),
        count_if(F.col("status") == "Verified").alias("kyc_verified_doc_count"),
    )


def g1f_contact_agg(m) -> DataFrame:
    return m.silver("contact_history").groupBy("customer_id").agg(
        F.count("contact_id").alias("total_contact_count"),
        round_half_up(F.avg("satisfaction_score"), 2).alias("avg_satisfaction_score"),
        F.max("contact_date").alias("last_contact_date"),
    )


def g1g_missed_payments(m) -> DataFrame:
    # Counts per card first (partial aggregation collapses hot cards), then
    # the bridge join, then per customer: exact for counts.
    per_card = m.silver("statements").groupBy("card_id").agg(
        count_if(F.col("payment_status") == "Missed").alias("missed"),
        count_if(F.col("payment_status") == "Paid").alias("paid"),
    )
    return (
        per_card.join(card_bridge(m, "customer_id"), "card_id")
        .groupBy("customer_id")
        .agg(
            F.sum("missed").alias("missed_payment_count"),
            F.sum("paid").alias("on_time_payment_count"),
        )
    )


def build(m) -> DataFrame:
    c = m.silver("customers")
    j = left_join_on_key(c, "customer_id", [
        g1a_primary_address(m), g1b_accounts_agg(m), g1c_cards_agg(m), g1d_rewards_agg(m), g1e_kyc_status(m),
        g1f_contact_agg(m), g1g_missed_payments(m),
    ])
    out = j.select(
        "customer_id", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", "phone_mobile", "phone_home", "date_of_birth", "gender", "nationality", "occupation",
        "annual_income", "credit_score", "customer_status", F.col("created_at").alias("customer_since"),
        *ADDRESS_COLS,
        zero("account_count").alias("account_count"),
        zero("total_balance").alias("total_account_balance"),
        zero("active_account_count").alias("active_account_count"),
        zero("card_count").alias("card_count"),
        zero("total_credit_limit").alias("total_credit_limit"),
        zero("total_available_credit").alias("total_available_credit"),
        zero("active_card_count").alias("active_card_count"),
        zero("overall_utilisation_rate").alias("overall_utilisation_rate"),
        zero("rewards_programme_count").alias("rewards_programme_count"),
        zero("total_points_balance").alias("total_points_balance"),
        zero("total_points_earned_ytd").alias("total_points_earned_ytd"),
        zero("total_points_redeemed_ytd").alias("total_points_redeemed_ytd"),
        "kyc_latest_status",
        zero("kyc_verified_doc_count").alias("kyc_verified_doc_count"),
        zero("total_contact_count").alias("total_contact_count"),
        "avg_satisfaction_score", "last_contact_date",
        zero("missed_payment_count").alias("missed_payment_count"),
        zero("on_time_payment_count").alias("on_time_payment_count"),
    )
    return with_gold_audit(out, "customer_360", m.ctx, ["customer_id", "first_name", "last_name", "email"])
