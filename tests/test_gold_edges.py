from lakestrata.operators.gold import customer_360, fraud_case_360, merchant_performance
from lakestrata.operators.gold import account_financial_summary as afs


def cust(k, **kw):
    return dict(dict(customer_id=k, first_name="F", last_name="L", customer_status="Active"), **kw)


def test_primary_address_latest_with_tie_break(medallion):
    addr = [
        dict(address_id="A1", customer_id="C1", city="x", postcode="p", is_primary=True, valid_from="2020-01-01"),
        dict(address_id="A2", customer_id="C1", city="y", postcode="p", is_primary=True, valid_from="2021-01-01"),
        dict(address_id="A3", customer_id="C1", city="z", postcode="p", is_primary=True, valid_from="2021-01-01"),
        dict(address_id="A4", customer_id="C1", city="w", postcode="p", is_primary=False, valid_from="2030-01-01"),
        dict(address_id="A5", customer_id="C2", city="n", postcode="p", is_primary=True, valid_from=None),
        dict(address_id="A6", customer_id="C2", city="m", postcode="p", is_primary=True, valid_from="2019-01-01"),
    ]
    m = medallion({"addresses": addr})
    got = {r["customer_id"]: r["city"] for r in customer_360.g1a_primary_address(m).collect()}
    # latest valid_from wins, ties broken by address_id desc; NULL valid_from sorts last
    assert got == {"C1": "z", "C2": "m"}


def test_full_name_null_when_part_null_and_defaults(medallion):
    m = medallion({"customers": [cust("C1"), cust("C2", last_name=None)]})
    got = {r["customer_id"]: r for r in m.gold("gold_customer_360").collect()}
    assert got["C1"]["full_name"] == "F L" and got["C2"]["full_name"] is None
    assert got["C1"]["account_count"] == 0 and got["C1"]["kyc_latest_status"] is None
    assert got["C1"]["gold_entity_name"] == "customer_360"


def test_velocity_actions_string_agg(medallion):
    hits = [
        dict(hit_id="H1", rule_id="R", transaction_id="T1", card_id="C", action_taken="Block"),
        dict(hit_id="H2", rule_id="R", transaction_id="T1", card_id="C", action_taken="Alert"),
        dict(hit_id="H3", rule_id="R", transaction_id="T1", card_id="C", action_taken="Alert"),
        dict(hit_id="H4", rule_id="R", transaction_id="T2", card_id="C", action_taken=None),
    ]
    got = {r["transaction_id"]: (r["velocity_hit_count"], r["velocity_actions"])
           for r in fraud_case_360.g5d_velocity_agg(medallion({"velocity_hits": hits})).collect()}
    assert got == {"T1": (3, "Alert,Block"), "T2": (1, None)}  # all-NULL group gives NULL, not ''


def test_merchant_without_activity(medallion):
    m = medallion({"merchants": [dict(merchant_id="M1", merchant_name="n", mcc_code="5001")]})
    r = m.gold("gold_merchant_performance").first()
    assert r["total_transactions"] == 0 and r["dispute_rate"] is None and r["decline_rate"] is None
    assert r["merchant_risk_tier"] == "LOW_RISK" and r["is_blacklisted"] is False


def test_blacklist_active_wins_and_latest_entry(medallion):
    m = medallion({
        "merchants": [dict(merchant_id="M1", merchant_name="n", mcc_code="5001")],
        "merchant_blacklist": [
            dict(blacklist_id="B1", merchant_id="M1", blacklist_reason="old", added_date="2022-01-01", is_active=True),
            dict(blacklist_id="B2", merchant_id="M1", blacklist_reason="new", added_date="2022-03-01", is_active=False),
        ],
    })
    r = m.gold("gold_merchant_performance").first()
    assert r["blacklist_reason"] == "new" and r["blacklist_is_active"] is False
    assert r["merchant_risk_tier"] == "LOW_RISK"


def test_fees_null_waived_in_neither_bucket(medallion):
    m = medallion({
        "credit_cards": [dict(card_id="K1", customer_id="C1", account_id="A1", card_type_id="T", card_status="Active")],
        "fees": [
            dict(fee_id="F1", card_id="K1", fee_type="x", fee_amount="10", waived=True),
            dict(fee_id="F2", card_id="K1", fee_type="x", fee_amount="20", waived=False),
            dict(fee_id="F3", card_id="K1", fee_type="x", fee_amount="40", waived=None),
        ],
    })
    r = afs.g4c_fees_agg(m).first()
    assert (r["fee_event_count"], r["total_fees_charged"], r["total_fees_waived"], r["total_fees_paid"]) == (
        3, 70.0, 10.0, 20.0)


def test_utilisation_zero_limit_guard(medallion):
    m = medallion({"credit_cards": [
        dict(card_id="K1", customer_id="C1", account_id="A1", card_type_id="T", card_status="Active",
             credit_limit="0", available_credit="0")]})
    r = customer_360.g1c_cards_agg(m).first()
    assert r["overall_utilisation_rate"] is None


def test_transaction_on_unknown_card_is_dropped(medallion):
    m = medallion({
        "credit_cards": [dict(card_id="K1", customer_id="C1", account_id="A1", card_type_id="T", card_status="Active")],
        "transactions": [dict(transaction_id="T1", card_id="K1", amount="1.00", currency="GBP", status="Posted"),
                         dict(transaction_id="T2", card_id="K9", amount="1.00", currency="GBP", status="Posted")],
    })
    assert [r["transaction_id"] for r in m.gold("gold_transaction_360").collect()] == ["T1"]


def test_delinquency_buckets(medallion):
    cards = [dict(card_id=f"K{i}", customer_id="C", account_id=f"A{i}", card_type_id="T", card_status="Active")
             for i in range(4)]
    stmts = []
    for i, missed in enumerate([0, 2, 5, 6]):
        stmts += [dict(statement_id=f"S{i}-{j}", card_id=f"K{i}", payment_status="Missed") for j in range(missed)]
        stmts.append(dict(statement_id=f"S{i}-p", card_id=f"K{i}", payment_status="Paid"))
    accts = [dict(account_id=f"A{i}", customer_id="C", account_status="Active", currency="GBP") for i in range(4)]
    m = medallion({"credit_cards": cards, "statements": stmts, "accounts": accts})
    got = {r["account_id"]: r["delinquency_bucket"] for r in m.gold("gold_account_financial_summary").collect()}
    assert got == {"A0": "Current", "A1": "30-60 DPD", "A2": "60-90 DPD", "A3": "90+ DPD"}


def test_case_resolution_priority(medallion):
    alerts = [
        dict(alert_id="F1", transaction_id="T1", card_id="K", alert_type="v", status="Open", is_genuine_fraud=True),
        dict(alert_id="F2", transaction_id="T2", card_id="K", alert_type="v", status="Resolved", is_genuine_fraud=None),
        dict(alert_id="F3", transaction_id="T3", card_id="K", alert_type="v", status="False Positive",
             is_genuine_fraud=False),
        dict(alert_id="F4", transaction_id=None, card_id="K", alert_type="v", status="Open", is_genuine_fraud=None),
    ]
    disputes = [dict(dispute_id="D1", transaction_id="T1", card_id="K", dispute_reason="r", status="Open")]
    chargebacks = [dict(chargeback_id="CB1", dispute_id="D1", card_id="K", current_stage="First")]
    m = medallion({"fraud_alerts": alerts, "disputes": disputes, "chargeback_cases": chargebacks})
    got = {r["alert_id"]: r["case_resolution_status"] for r in m.gold("gold_fraud_case_360").collect()}
    assert got == {"F1": "CHARGEBACK_RAISED", "F2": "RESOLVED", "F3": "FALSE_POSITIVE", "F4": "OPEN"}


def test_spend_agg_counts_duplicate_cards_like_a_join(medallion):
    card = dict(card_id="K1", customer_id="C1", account_id="A1", card_type_id="T", card_status="Active")
    txns = [dict(transaction_id="T1", card_id="K1", amount="10.00", currency="GBP", status="Posted"),
            dict(transaction_id="T2", card_id="K1", amount="5.00", currency="GBP", status="Declined")]
    from lakestrata.operators.gold import rewards_engagement

    r = rewards_engagement.g6c_spend_agg(medallion({"credit_cards": [card, card], "transactions": txns})).first()
    assert (r["total_spend"], r["posted_txn_count"]) == (20.0, 2)
