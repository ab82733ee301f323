"""Silver table specifications.

Each spec is the data that distinguishes one silver model from another: the
bronze column order with the cast target of typed columns, the required
(REQUIRED_NULL) columns in check order, the casts that carry no failure flag,
and the record-hash inputs.  ``build_silver`` turns a spec into a plan.

Cast labels use the reference vocabulary (they appear verbatim in the
``CAST_FAILED:<col>:<TYPE>`` error codes): FLOAT64, INT64, DATE, TIMESTAMP.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    table: str
    pk: str
    columns: tuple[tuple[str, str | None], ...]  # (name, cast label or None)
    required: tuple[str, ...]
    unflagged: tuple[str, ...]
    hash_cols: tuple[str, ...]

    @property
    def silver_name(self) -> str:
        return f"silver_{self.table}"

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def casts(self) -> dict[str, str]:
        return {c: t for c, t in self.columns if t}

    @property
    def flagged_casts(self) -> list[tuple[str, str]]:
        return [(c, t) for c, t in self.columns if t and c not in self.unflagged]


def _spec(table: str, pk: str, columns: str, required: str, hash_cols: str, unflagged: str = "") -> TableSpec:
    cols = []
    for tok in columns.split():
        name, _, label = tok.partition(":")
        cols.append((name, label or None))
    return TableSpec(
        table=table,
        pk=pk,
        columns=tuple(cols),
        required=tuple(required.split()),
        unflagged=tuple(unflagged.split()),
        hash_cols=tuple(hash_cols.split()),
    )


# ---------------------------------------------------------------------------
# The 26 silver models of the reference (column order, casts,
# required columns, unflagged casts, hash inputs, primary key).
# ---------------------------------------------------------------------------
SPECS: dict[str, TableSpec] = {
    s.table: s
    for s in [
        _spec("dim_card_types", "card_type_id",
              "card_type_id card_name network tier annual_fee:FLOAT64 reward_rate:FLOAT64 lounge_access travel_insurance",
              "card_type_id card_name network tier",
              "card_type_id card_name network tier"),
        _spec("dim_merchant_categories", "mcc_code",
              "mcc_code category_name category_group",
              "mcc_code category_name category_group",
              "mcc_code category_name"),
        _spec("dim_transaction_types", "txn_type_id",
              "txn_type_id type_name is_credit",
              "txn_type_id type_name",
              "txn_type_id type_name"),
        _spec("dim_velocity_rules", "rule_id",
              "rule_id rule_name rule_type threshold:FLOAT64 window_hours:INT64 action",
              "rule_id rule_name rule_type action",
              "rule_id rule_name rule_type"),
        _spec("customers", "customer_id",
              "customer_id first_name last_name date_of_birth:DATE gender email phone_mobile phone_home "
              "nationality occupation annual_income:FLOAT64 credit_score:INT64 customer_status "
              "created_at:DATE updated_at:DATE",
              "customer_id first_name last_name customer_status",
              "customer_id first_name last_name email"),
        _spec("addresses", "address_id",
              "address_id customer_id address_type address_line1 address_line2 city county postcode country "
              "is_primary valid_from:DATE valid_to:DATE",
              "address_id customer_id city postcode",
              "address_id customer_id postcode"),
        _spec("accounts", "account_id",
              "account_id customer_id account_type account_number sort_code currency balance:FLOAT64 "
              "overdraft_limit:INT64 account_status opened_date:DATE closed_date:DATE",
              "account_id customer_id account_status currency",
              "account_id customer_id account_number"),
        _spec("credit_cards", "card_id",
              "card_id customer_id account_id card_type_id card_number_masked card_number_hash expiry_date "
              "cardholder_name credit_limit:INT64 available_credit:FLOAT64 card_status issued_date:DATE "
              "activation_date:DATE is_contactless is_virtual pin_failed_attempts:INT64",
              "card_id customer_id account_id card_type_id card_status",
              "card_id customer_id card_number_hash"),
        _spec("merchants", "merchant_id",
              "merchant_id merchant_name mcc_code merchant_city merchant_country merchant_postcode terminal_id "
              "acquirer_bank is_online registered_date:DATE",
              "merchant_id merchant_name mcc_code",
              "merchant_id merchant_name mcc_code"),
        _spec("transactions", "transaction_id",
              "transaction_id card_id merchant_id txn_type_id transaction_date:DATE posting_date:DATE "
              "amount:FLOAT64 currency original_amount:FLOAT64 original_currency fx_rate:FLOAT64 description "
              "status is_online is_international mcc_code auth_code is_flagged",
              "transaction_id card_id amount currency status",
              "transaction_id card_id merchant_id amount"),
        _spec("statements", "statement_id",
              "statement_id card_id statement_date:DATE due_date:DATE opening_balance:FLOAT64 "
              "total_purchases:FLOAT64 total_payments:FLOAT64 total_fees:FLOAT64 total_interest:FLOAT64 "
              "closing_balance:FLOAT64 minimum_payment:FLOAT64 payment_status is_paperless",
              "statement_id card_id payment_status",
              "statement_id card_id statement_date",
              unflagged="total_purchases total_payments total_fees total_interest minimum_payment"),
        _spec("payments", "payment_id",
              "payment_id statement_id card_id payment_date:DATE amount:FLOAT64 payment_method reference "
              "status is_minimum_only",
              "payment_id card_id amount status",
              "payment_id card_id payment_date amount"),
        _spec("fees", "fee_id",
              "fee_id card_id transaction_id fee_type fee_amount:FLOAT64 fee_date:DATE waived waiver_reason "
              "statement_cycle",
              "fee_id card_id fee_type",
              "fee_id card_id fee_type fee_date"),
        _spec("fraud_alerts", "alert_id",
              "alert_id transaction_id card_id alert_type alert_timestamp:TIMESTAMP risk_score:FLOAT64 status "
              "resolved_at:TIMESTAMP analyst_notes is_genuine_fraud",
              "alert_id card_id alert_type status",
              "alert_id card_id alert_type"),
        _spec("disputes", "dispute_id",
              "dispute_id transaction_id card_id dispute_reason filed_date:DATE disputed_amount:FLOAT64 "
              "outcome outcome_date:DATE refund_amount:FLOAT64 case_reference status",
              "dispute_id card_id dispute_reason status",
              "dispute_id card_id dispute_reason filed_date"),
        _spec("chargeback_cases", "chargeback_id",
              "chargeback_id dispute_id card_id chargeback_amount:FLOAT64 filed_date:DATE current_stage "
              "acquirer_response network_case_ref resolution_date:DATE bank_liability recovery_amount:FLOAT64",
              "chargeback_id card_id current_stage",
              "chargeback_id card_id filed_date"),
        _spec("velocity_hits", "hit_id",
              "hit_id rule_id transaction_id card_id triggered_at:DATE measured_value:FLOAT64 action_taken "
              "override_by",
              "hit_id rule_id card_id action_taken",
              "hit_id rule_id card_id"),
        _spec("merchant_blacklist", "blacklist_id",
              "blacklist_id merchant_id merchant_name blacklist_reason added_date:DATE added_by "
              "review_date:DATE is_active notes",
              "blacklist_id merchant_id blacklist_reason",
              "blacklist_id merchant_id blacklist_reason"),
        _spec("rewards", "reward_id",
              "reward_id card_id customer_id program_type points_balance:INT64 points_earned_ytd:INT64 "
              "points_redeemed_ytd:INT64 points_expiring:INT64 expiry_date:DATE tier enrolled_date:DATE",
              "reward_id card_id customer_id program_type",
              "reward_id card_id customer_id program_type",
              unflagged="points_earned_ytd points_redeemed_ytd points_expiring"),
        _spec("reward_redemptions", "redemption_id",
              "redemption_id reward_id card_id customer_id redemption_type points_used:INT64 "
              "cash_equivalent:FLOAT64 redeemed_date:DATE reference status",
              "redemption_id reward_id card_id customer_id status",
              "redemption_id reward_id card_id redeemed_date"),
        _spec("kyc_documents", "kyc_id",
              "kyc_id customer_id document_type document_number issued_country issue_date:DATE "
              "expiry_date:DATE verified_date:DATE verification_method status reviewer_id",
              "kyc_id customer_id document_type status",
              "kyc_id customer_id document_type document_number"),
        _spec("contact_history", "contact_id",
              "contact_id customer_id contact_date:DATE channel reason outcome duration_seconds:INT64 "
              "agent_id satisfaction_score:INT64 notes",
              "contact_id customer_id channel reason",
              "contact_id customer_id contact_date channel"),
        _spec("emi_plans", "emi_plan_id",
              "emi_plan_id transaction_id card_id original_amount:FLOAT64 tenure_months:INT64 "
              "monthly_interest_rate:FLOAT64 emi_amount:FLOAT64 total_payable:FLOAT64 start_date:DATE "
              "end_date:DATE installments_paid:INT64 status",
              "emi_plan_id card_id status",
              "emi_plan_id card_id start_date",
              unflagged="monthly_interest_rate total_payable"),
        _spec("notifications", "notification_id",
              "notification_id customer_id notification_type channel sent_at:DATE delivered read "
              "message_preview action_taken",
              "notification_id customer_id notification_type channel",
              "notification_id customer_id notification_type sent_at"),
        _spec("credit_limit_history", "limit_history_id",
              "limit_history_id card_id effective_date:DATE previous_limit:INT64 new_limit:INT64 "
              "change_reason approved_by is_current",
              "limit_history_id card_id new_limit",
              "limit_history_id card_id effective_date"),
        _spec("interest_rates", "rate_id",
              "rate_id card_id rate_type apr:FLOAT64 daily_rate:FLOAT64 promotional_rate:FLOAT64 "
              "promo_end_date:DATE effective_date:DATE is_current",
              "rate_id card_id rate_type apr",
              "rate_id card_id rate_type effective_date"),
    ]
}

# Bronze → silver reconciliation order of the reference report (26 rows).
RECON_ORDER = (
    "customers addresses accounts credit_cards merchants transactions statements payments fees "
    "fraud_alerts disputes chargeback_cases velocity_hits merchant_blacklist rewards reward_redemptions "
    "kyc_documents contact_history emi_plans notifications credit_limit_history interest_rates "
    "dim_card_types dim_merchant_categories dim_transaction_types dim_velocity_rules"
).split()

AUDIT_COLUMNS = (
    "audit_source_system audit_source_table audit_insert_ts audit_update_ts audit_record_hash "
    "dq_checked_at dq_error_count dq_errors dq_status"
).split()

SPARK_TYPES = {"FLOAT64": "double", "INT64": "bigint", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
