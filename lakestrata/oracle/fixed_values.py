"""Fixed values of the oracle, stated apart from the engine: tables, checks and
tests, one a line."""


#: Silver tables: name | key | columns (with cast) | required | casts without a flag | hashed.
TABLES = """\
dim_card_types | card_type_id | card_type_id card_name network tier annual_fee:FLOAT64 reward_rate:FLOAT64 lounge_access travel_insurance | card_type_id card_name network tier |  | card_type_id card_name network tier
dim_merchant_categories | mcc_code | mcc_code category_name category_group | mcc_code category_name category_group |  | mcc_code category_name
dim_transaction_types | txn_type_id | txn_type_id type_name is_credit | txn_type_id type_name |  | txn_type_id type_name
dim_velocity_rules | rule_id | rule_id rule_name rule_type threshold:FLOAT64 window_hours:INT64 action | rule_id rule_name rule_type action |  | rule_id rule_name rule_type
customers | customer_id | customer_id first_name last_name date_of_birth:DATE gender email phone_mobile phone_home nationality occupation annual_income:FLOAT64 credit_score:INT64 customer_status created_at:DATE updated_at:DATE | customer_id first_name last_name customer_status |  | customer_id first_name last_name email
addresses | address_id | address_id customer_id address_type address_line1 address_line2 city county postcode country is_primary valid_from:DATE valid_to:DATE | address_id customer_id city postcode |  | address_id customer_id postcode
accounts | account_id | account_id customer_id account_type account_number sort_code currency balance:FLOAT64 overdraft_limit:INT64 account_status opened_date:DATE closed_date:DATE | account_id customer_id account_status currency |  | account_id customer_id account_number
credit_cards | card_id | card_id customer_id account_id card_type_id card_number_masked card_number_hash expiry_date cardholder_name credit_limit:INT64 available_credit:FLOAT64 card_status issued_date:DATE activation_date:DATE is_contactless is_virtual pin_failed_attempts:INT64 | card_id customer_id account_id card_type_id card_status |  | card_id customer_id card_number_hash
merchants | merchant_id | merchant_id merchant_name mcc_code merchant_city merchant_country merchant_postcode terminal_id acquirer_bank is_online registered_date:DATE | merchant_id merchant_name mcc_code |  | merchant_id merchant_name mcc_code
transactions | transaction_id | transaction_id card_id merchant_id txn_type_id transaction_date:DATE posting_date:DATE amount:FLOAT64 currency original_amount:FLOAT64 original_currency fx_rate:FLOAT64 description status is_online is_international mcc_code auth_code is_flagged | transaction_id card_id amount currency status |  | transaction_id card_id merchant_id amount
statements | statement_id | statement_id card_id statement_date:DATE due_date:DATE opening_balance:FLOAT64 total_purchases:FLOAT64 total_payments:FLOAT64 total_fees:FLOAT64 total_interest:FLOAT64 closing_balance:FLOAT64 minimum_payment:FLOAT64 payment_status is_paperless | statement_id card_id payment_status | total_purchases total_payments total_fees total_interest minimum_payment | statement_id card_id statement_date
payments | payment_id | payment_id statement_id card_id payment_date:DATE amount:FLOAT64 payment_method reference status is_minimum_only | payment_id card_id amount status |  | payment_id card_id payment_date amount
fees | fee_id | fee_id card_id transaction_id fee_type fee_amount:FLOAT64 fee_date:DATE waived waiver_reason statement_cycle | fee_id card_id fee_type |  | fee_id card_id fee_type fee_date
fraud_alerts | alert_id | alert_id transaction_id card_id alert_type alert_timestamp:TIMESTAMP risk_score:FLOAT64 status resolved_at:TIMESTAMP analyst_notes is_genuine_fraud | alert_id card_id alert_type status |  | alert_id card_id alert_type
disputes | dispute_id | dispute_id transaction_id card_id dispute_reason filed_date:DATE disputed_amount:FLOAT64 outcome outcome_date:DATE refund_amount:FLOAT64 case_reference status | dispute_id card_id dispute_reason status |  | dispute_id card_id dispute_reason filed_date
chargeback_cases | chargeback_id | chargeback_id dispute_id card_id chargeback_amount:FLOAT64 filed_date:DATE current_stage acquirer_response network_case_ref resolution_date:DATE bank_liability recovery_amount:FLOAT64 | chargeback_id card_id current_stage |  | chargeback_id card_id filed_date
velocity_hits | hit_id | hit_id rule_id transaction_id card_id triggered_at:DATE measured_value:FLOAT64 action_taken override_by | hit_id rule_id card_id action_taken |  | hit_id rule_id card_id
merchant_blacklist | blacklist_id | blacklist_id merchant_id merchant_name blacklist_reason added_date:DATE added_by review_date:DATE is_active notes | blacklist_id merchant_id blacklist_reason |  | blacklist_id merchant_id blacklist_reason
rewards | reward_id | reward_id card_id customer_id program_type points_balance:INT64 points_earned_ytd:INT64 points_redeemed_ytd:INT64 points_expiring:INT64 expiry_date:DATE tier enrolled_date:DATE | reward_id card_id customer_id program_type | points_earned_ytd points_redeemed_ytd points_expiring | reward_id card_id customer_id program_type
reward_redemptions | redemption_id | redemption_id reward_id card_id customer_id redemption_type points_used:INT64 cash_equivalent:FLOAT64 redeemed_date:DATE reference status | redemption_id reward_id card_id customer_id status |  | redemption_id reward_id card_id redeemed_date
kyc_documents | kyc_id | kyc_id customer_id document_type document_number issued_country issue_date:DATE expiry_date:DATE verified_date:DATE verification_method status reviewer_id | kyc_id customer_id document_type status |  | kyc_id customer_id document_type document_number
contact_history | contact_id | contact_id customer_id contact_date:DATE channel reason outcome duration_seconds:INT64 agent_id satisfaction_score:INT64 notes | contact_id customer_id channel reason |  | contact_id customer_id contact_date channel
emi_plans | emi_plan_id | emi_plan_id transaction_id card_id original_amount:FLOAT64 tenure_months:INT64 monthly_interest_rate:FLOAT64 emi_amount:FLOAT64 total_payable:FLOAT64 start_date:DATE end_date:DATE installments_paid:INT64 status | emi_plan_id card_id status | monthly_interest_rate total_payable | emi_plan_id card_id start_date
notifications | notification_id | notification_id customer_id notification_type channel sent_at:DATE delivered read message_preview action_taken | notification_id customer_id notification_type channel |  | notification_id customer_id notification_type sent_at
credit_limit_history | limit_history_id | limit_history_id card_id effective_date:DATE previous_limit:INT64 new_limit:INT64 change_reason approved_by is_current | limit_history_id card_id new_limit |  | limit_history_id card_id effective_date
interest_rates | rate_id | rate_id card_id rate_type apr:FLOAT64 daily_rate:FLOAT64 promotional_rate:FLOAT64 promo_end_date:DATE effective_date:DATE is_current | rate_id card_id rate_type apr |  | rate_id card_id rate_type effective_date
"""

#: Tables in the order of the reconciliation report.
RECON_ORDER = """\
customers addresses accounts credit_cards merchants transactions statements payments fees fraud_alerts disputes chargeback_cases velocity_hits merchant_blacklist rewards reward_redemptions kyc_documents contact_history emi_plans notifications credit_limit_history interest_rates dim_card_types dim_merchant_categories dim_transaction_types dim_velocity_rules
"""

#: Checked relationships: child fk parent pk, and whether null keys are left out.
FOREIGN_KEYS = """\
addresses customer_id customers customer_id count
accounts customer_id customers customer_id count
credit_cards customer_id customers customer_id count
credit_cards account_id accounts account_id count
credit_cards card_type_id dim_card_types card_type_id count
merchants mcc_code dim_merchant_categories mcc_code count
transactions card_id credit_cards card_id count
transactions merchant_id merchants merchant_id count
statements card_id credit_cards card_id count
payments card_id credit_cards card_id count
fraud_alerts transaction_id transactions transaction_id skip
disputes transaction_id transactions transaction_id skip
chargeback_cases dispute_id disputes dispute_id skip
rewards card_id credit_cards card_id count
reward_redemptions reward_id rewards reward_id count
kyc_documents customer_id customers customer_id count
contact_history customer_id customers customer_id count
emi_plans card_id credit_cards card_id count
notifications customer_id customers customer_id count
credit_limit_history card_id credit_cards card_id count
interest_rates card_id credit_cards card_id count
"""

#: Declared relationships: child fk parent pk, null keys, cardinality.
DECLARED_KEYS = """\
addresses customer_id customers customer_id count many-to-one
accounts customer_id customers customer_id count many-to-one
credit_cards customer_id customers customer_id count many-to-one
credit_cards account_id accounts account_id count many-to-one
credit_cards card_type_id dim_card_types card_type_id count many-to-one
merchants mcc_code dim_merchant_categories mcc_code count many-to-one
transactions card_id credit_cards card_id count many-to-one
transactions merchant_id merchants merchant_id count many-to-one
transactions txn_type_id dim_transaction_types txn_type_id count many-to-one
transactions mcc_code dim_merchant_categories mcc_code count many-to-one
statements card_id credit_cards card_id count many-to-one
payments statement_id statements statement_id count many-to-one
payments card_id credit_cards card_id count many-to-one
fees card_id credit_cards card_id count many-to-one
fees transaction_id transactions transaction_id skip many-to-one (nullable)
fraud_alerts transaction_id transactions transaction_id count many-to-one
fraud_alerts card_id credit_cards card_id count many-to-one
disputes transaction_id transactions transaction_id count many-to-one
disputes card_id credit_cards card_id count many-to-one
chargeback_cases dispute_id disputes dispute_id count many-to-one
chargeback_cases card_id credit_cards card_id count many-to-one
velocity_hits rule_id dim_velocity_rules rule_id count many-to-one
velocity_hits transaction_id transactions transaction_id count many-to-one
velocity_hits card_id credit_cards card_id count many-to-one
merchant_blacklist merchant_id merchants merchant_id count many-to-one
rewards card_id credit_cards card_id count one-to-one
rewards customer_id customers customer_id count many-to-one
reward_redemptions reward_id rewards reward_id count many-to-one
reward_redemptions card_id credit_cards card_id count many-to-one
reward_redemptions customer_id customers customer_id count many-to-one
kyc_documents customer_id customers customer_id count many-to-one
contact_history customer_id customers customer_id count many-to-one
emi_plans transaction_id transactions transaction_id count many-to-one
emi_plans card_id credit_cards card_id count many-to-one
notifications customer_id customers customer_id count many-to-one
credit_limit_history card_id credit_cards card_id count many-to-one
interest_rates card_id credit_cards card_id count many-to-one
"""

#: Gold checks: table | key | not null | fk parent pk, ...
GOLD_CHECKS = """\
gold_customer_360 | customer_id | full_name customer_status | 
gold_transaction_360 | transaction_id | customer_id amount | customer_id gold_customer_360 customer_id, merchant_id gold_merchant_performance merchant_id
gold_merchant_performance | merchant_id | merchant_name mcc_code | 
gold_account_financial_summary | account_id | account_status | customer_id gold_customer_360 customer_id
gold_fraud_case_360 | alert_id | card_id alert_type | 
gold_rewards_engagement | reward_id | program_type | customer_id gold_customer_360 customer_id
"""

#: Silver to gold: bronze silver gold key.
TO_GOLD = """\
customers silver_customers gold_customer_360 customer_id
transactions silver_transactions gold_transaction_360 transaction_id
merchants silver_merchants gold_merchant_performance merchant_id
accounts silver_accounts gold_account_financial_summary account_id
fraud_alerts silver_fraud_alerts gold_fraud_case_360 alert_id
rewards silver_rewards gold_rewards_engagement reward_id
"""

#: Column tests: model | unique | not null | column=accepted values; ... | column parent field, ...
SILVER_TESTS = """\
silver_dim_card_types | card_type_id | card_type_id card_name network tier | network=VISA,MASTERCARD,AMEX | 
silver_dim_merchant_categories | mcc_code | mcc_code category_name category_group |  | 
silver_dim_transaction_types | txn_type_id | txn_type_id type_name |  | 
silver_dim_velocity_rules | rule_id | rule_id rule_name action | action=Alert,Block | 
silver_customers | customer_id | customer_id first_name last_name customer_status | dq_status=PASS,FAIL | 
silver_addresses | address_id | address_id customer_id |  | customer_id silver_customers customer_id
silver_accounts | account_id | account_id customer_id account_status |  | customer_id silver_customers customer_id
silver_credit_cards | card_id | card_id customer_id account_id card_type_id card_status |  | customer_id silver_customers customer_id, account_id silver_accounts account_id, card_type_id silver_dim_card_types card_type_id
silver_merchants | merchant_id | merchant_id merchant_name mcc_code |  | mcc_code silver_dim_merchant_categories mcc_code
silver_transactions | transaction_id | transaction_id card_id amount status | status=Posted,Pending,Declined,Reversed | card_id silver_credit_cards card_id, merchant_id silver_merchants merchant_id
silver_statements | statement_id | statement_id card_id payment_status | payment_status=Paid,Partial,Missed,Pending | card_id silver_credit_cards card_id
silver_payments | payment_id | payment_id card_id amount status | status=Cleared,Pending,Failed | card_id silver_credit_cards card_id
silver_fees | fee_id | fee_id card_id fee_type |  | card_id silver_credit_cards card_id
silver_fraud_alerts | alert_id | alert_id card_id alert_type status |  | card_id silver_credit_cards card_id
silver_disputes | dispute_id | dispute_id card_id dispute_reason status |  | card_id silver_credit_cards card_id
silver_chargeback_cases | chargeback_id | chargeback_id card_id current_stage |  | card_id silver_credit_cards card_id
silver_velocity_hits | hit_id | hit_id rule_id card_id action_taken |  | rule_id silver_dim_velocity_rules rule_id, card_id silver_credit_cards card_id
silver_merchant_blacklist | blacklist_id | blacklist_id merchant_id blacklist_reason |  | merchant_id silver_merchants merchant_id
silver_rewards | reward_id | reward_id card_id customer_id program_type |  | card_id silver_credit_cards card_id, customer_id silver_customers customer_id
silver_reward_redemptions | redemption_id | redemption_id reward_id card_id customer_id status |  | reward_id silver_rewards reward_id, card_id silver_credit_cards card_id, customer_id silver_customers customer_id
silver_kyc_documents | kyc_id | kyc_id customer_id document_type status |  | customer_id silver_customers customer_id
silver_contact_history | contact_id | contact_id customer_id channel |  | customer_id silver_customers customer_id
silver_emi_plans | emi_plan_id | emi_plan_id card_id status |  | card_id silver_credit_cards card_id
silver_notifications | notification_id | notification_id customer_id notification_type |  | customer_id silver_customers customer_id
silver_credit_limit_history | limit_history_id | limit_history_id card_id new_limit |  | card_id silver_credit_cards card_id
silver_interest_rates | rate_id | rate_id card_id rate_type apr |  | card_id silver_credit_cards card_id
silver_relationship_dq_results |  |  | fk_status=PASS,FAIL | 
"""

#: The same for gold.
GOLD_TESTS = """\
gold_customer_360 | customer_id | customer_id full_name customer_status gold_entity_name gold_created_ts gold_record_hash | gold_entity_name=customer_360 | 
gold_transaction_360 | transaction_id | transaction_id customer_id amount transaction_status gold_entity_name gold_record_hash | transaction_status=Posted,Pending,Declined,Reversed; gold_entity_name=transaction_360 | customer_id gold_customer_360 customer_id, merchant_id gold_merchant_performance merchant_id
gold_merchant_performance | merchant_id | merchant_id merchant_name mcc_code merchant_risk_tier gold_entity_name gold_record_hash | merchant_risk_tier=LOW_RISK,MEDIUM_RISK,HIGH_RISK,BLACKLISTED; gold_entity_name=merchant_performance | 
gold_account_financial_summary | account_id | account_id customer_id account_status payment_event_count total_amount_paid delinquency_bucket gold_entity_name gold_record_hash | delinquency_bucket=Current,30-60 DPD,60-90 DPD,90+ DPD; gold_entity_name=account_financial_summary | customer_id gold_customer_360 customer_id
gold_fraud_case_360 | alert_id | alert_id card_id alert_type alert_status case_resolution_status gold_entity_name gold_record_hash | case_resolution_status=CHARGEBACK_RAISED,DISPUTED,FRAUD_CONFIRMED_NO_ACTION,FALSE_POSITIVE,RESOLVED,OPEN; gold_entity_name=fraud_case_360 | 
gold_rewards_engagement | reward_id | reward_id card_id customer_id program_type engagement_tier gold_entity_name gold_record_hash | engagement_tier=HIGHLY_ENGAGED,ENGAGED,ACTIVE,SPENDING_NOT_REDEEMING,INACTIVE; gold_entity_name=rewards_engagement | customer_id gold_customer_360 customer_id
"""
