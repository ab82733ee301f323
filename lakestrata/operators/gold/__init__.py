"""Gold entities: per-entity pre-aggregations joined onto an entity spine."""

from __future__ import annotations

from lakestrata.operators.gold import (
    account_financial_summary,
    customer_360,
    fraud_case_360,
    merchant_performance,
    rewards_engagement,
    transaction_360,
)

ENTITY_BUILDERS = {
    "gold_customer_360": customer_360.build,
    "gold_transaction_360": transaction_360.build,
    "gold_merchant_performance": merchant_performance.build,
    "gold_account_financial_summary": account_financial_summary.build,
    "gold_fraud_case_360": fraud_case_360.build,
    "gold_rewards_engagement": rewards_engagement.build,
}

# Every intermediate CTE, addressable on its own (``<id>_<name>``).
CTE_BUILDERS = {
    "g1a_primary_address": customer_360.g1a_primary_address,
    "g1b_accounts_agg": customer_360.g1b_accounts_agg,
    "g1c_cards_agg": customer_360.g1c_cards_agg,
    "g1d_rewards_agg": customer_360.g1d_rewards_agg,
    "g1e_kyc_status": customer_360.g1e_kyc_status,
    "g1f_contact_agg": customer_360.g1f_contact_agg,
    "g1g_missed_payments": customer_360.g1g_missed_payments,
    "g2b_fraud_flag": transaction_360.g2b_fraud_flag,
    "g2c_dispute_flag": transaction_360.g2c_dispute_flag,
    "g2d_velocity_flag": transaction_360.g2d_velocity_flag,
    "g3a_mcc_lookup": merchant_performance.g3a_mcc_lookup,
    "g3b_txn_agg": merchant_performance.g3b_txn_agg,
    "g3c_dispute_agg": merchant_performance.g3c_dispute_agg,
    "g3d_chargeback_agg": merchant_performance.g3d_chargeback_agg,
    "g3e_blacklist": merchant_performance.g3e_blacklist,
    "g4a_cards_agg": account_financial_summary.g4a_cards_agg,
    "g4b_stmt_agg": account_financial_summary.g4b_stmt_agg,
    "g4c_fees_agg": account_financial_summary.g4c_fees_agg,
    "g4d_current_rate": account_financial_summary.g4d_current_rate,
    "g4e_current_limit": account_financial_summary.g4e_current_limit,
    "g4f_emi_agg": account_financial_summary.g4f_emi_agg,
    "g4g_payments_agg": account_financial_summary.g4g_payments_agg,
    "g5b_dispute_flag": fraud_case_360.g5b_dispute_flag,
    "g5c_chargeback_flag": fraud_case_360.g5c_chargeback_flag,
    "g5d_velocity_agg": fraud_case_360.g5d_velocity_agg,
    "g6b_redemption_agg": rewards_engagement.g6b_redemption_agg,
    "g6c_spend_agg": rewards_engagement.g6c_spend_agg,
}
