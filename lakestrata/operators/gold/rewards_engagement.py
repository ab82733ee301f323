"""gold_rewards_engagement: one row per reward account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.aggregates import count_if, string_agg_distinct
from lakestrata.functions.numeric import nullif0, round_half_up, safe_divide
from lakestrata.operators.gold.common import with_gold_audit, zero


def g6b_redemption_agg(m) -> DataFrame:
    return m.silver("reward_redemptions").groupBy("reward_id").agg(
        F.count("redemption_id").alias("redemption_count"),
        # round() of an integer sum is a FLOAT64 in the reference.
        F.round(F.sum("points_used"), 0).cast("double").alias("total_points_redeemed"),
        round_half_up(F.sum("cash_equivalent"), 2).alias("total_cash_redeemed"),
        F.max("redeemed_date").alias("last_redemption_date"),
        count_if(F.col("status") == "Processed").alias("successful_redemptions"),
        count_if(F.col("status") == "Failed").alias("failed_redemptions"),
        string_agg_distinct("redemption_type").alias("redemption_types_used"),
    )


def g6c_spend_agg(m) -> DataFrame:
    """Spend per card, over transactions whose card exists.

    Transactions are aggregated per card *before* meeting the card table
    (map-side partial aggregation, so a hot card is one row per task); the
    card side contributes its multiplicity, which keeps the result equal to
    join-then-aggregate even with duplicated card keys."""
    posted = F.col("status") == "Posted"
    per_card = m.silver("transactions").groupBy("card_id").agg(
        F.sum(F.when(posted, F.col("amount")).otherwise(F.lit(0))).alias("_spend"),
        F.count(F.when(posted, F.col("transaction_id"))).alias("_posted"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.min("transaction_date").alias("first_transaction_date"),
    )
    mult = m.silver("credit_cards").groupBy("card_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_card.join(mult, "card_id").select(
        "card_id",
        round_half_up(F.col("_spend") * F.col("_n"), 2).alias("total_spend"),
        (F.col("_posted") * F.col("_n")).alias("posted_txn_count"),
        "last_transaction_date",
        "first_transaction_date",
    )


def build(m) -> DataFrame:
    r = m.silver("rewards").select(
        "reward_id", "card_id", "customer_id", "program_type", F.col("tier").alias("reward_tier"),
        "enrolled_date", "expiry_date", "points_balance", "points_earned_ytd", "points_redeemed_ytd",
        "points_expiring",
    )
    cards = m.silver("credit_cards").select(
        "card_id", "card_type_id", "card_status", "credit_limit", F.col("issued_date").alias("card_issued_date")
    )
    card_types = (m.silver("dim_card_types").select(
        "card_type_id", "card_name", "network", F.col("tier").alias("card_tier"),
        F.col("reward_rate").alias("card_reward_rate"),
    ))
    customers = m.silver("customers").select(
        "customer_id", "first_name", "last_name", "email", "customer_status", "annual_income", "credit_score"
    )
    j = (
        r.join(cards, "card_id", "left")
        .join(g6c_spend_agg(m), "card_id", "left")
        .join(card_types, "card_type_id", "left")
        .join(customers, "customer_id", "left")
        .join(g6b_redemption_agg(m), "reward_id", "left")
    )
    n_red = zero("redemption_count")
    spend = zero("total_spend")
    out = j.select(
        "reward_id", "card_id", "customer_id", "program_type", "reward_tier", "enrolled_date", "expiry_date",
        F.date_diff(F.col("expiry_date"), m.ctx.date()).alias("days_to_expiry"),
        "points_balance", "points_earned_ytd", "points_redeemed_ytd", "points_expiring",
        "card_name", "network", "card_tier", "card_reward_rate", "card_status", "credit_limit", "card_issued_date",
        "first_name", "last_name", "email", "customer_status", "annual_income", "credit_score",
        n_red.alias("redemption_count"),
        zero("total_points_redeemed").cast("double").alias("total_points_redeemed"),
        zero("total_cash_redeemed").cast("double").alias("total_cash_redeemed"),
        "last_redemption_date",
        zero("successful_redemptions").alias("successful_redemptions"),
        zero("failed_redemptions").alias("failed_redemptions"),
        "redemption_types_used",
        spend.cast("double").alias("total_spend_on_card"),
        zero("posted_txn_count").alias("posted_txn_count"),
        "first_transaction_date", "last_transaction_date",
        round_half_up(safe_divide(zero("total_cash_redeemed"), nullif0(spend)) * 100, 4)
        .alias("effective_reward_cost_pct"),
        round_half_up(safe_divide(zero("points_redeemed_ytd"), nullif0(zero("points_earned_ytd"))), 4)
        .alias("redemption_ratio_ytd"),
        F.when((n_red >= 4) & (spend > 10000), "HIGHLY_ENGAGED")
        .when((n_red >= 2) & (spend > 5000), "ENGAGED")
        .when(n_red >= 1, "ACTIVE")
        .when(spend > 0, "SPENDING_NOT_REDEEMING")
        .otherwise("INACTIVE")
        .alias("engagement_tier"),
    )
    return with_gold_audit(out, "rewards_engagement", m.ctx, ["reward_id", "card_id", "customer_id", "program_type"])
