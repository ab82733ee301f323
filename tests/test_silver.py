import hashlib
import json

from lakestrata.operators.silver import build_silver, dq_summary
from lakestrata.sources.frames import bronze_frame
from lakestrata.specs import AUDIT_COLUMNS, SPECS

TXN = dict(transaction_id="T1", card_id="C1", merchant_id="M1", txn_type_id="TT01", transaction_date="2024-01-05",
           posting_date="2024-01-07", amount="10.50", currency="GBP", original_amount="10.50",
           original_currency="GBP", fx_rate="1.0", description="d", status="Posted", is_online=True,
           is_international=False, mcc_code="5001", auth_code="A", is_flagged=False)


def test_columns_and_audit_order(spark, ctx):
    df = build_silver(bronze_frame(spark, "transactions", [TXN]), "transactions", ctx)
    assert df.columns == SPECS["transactions"].column_names + AUDIT_COLUMNS
    r = df.first()
    assert r["dq_status"] == "PASS" and r["dq_errors"] == "" and r["dq_error_count"] == 0
    assert r["audit_source_system"] == "SYNTHETIC_CARD_PLATFORM" and r["audit_source_table"] == "transactions"
    assert str(r["audit_insert_ts"]) == "2026-01-01 00:00:00"


def test_error_codes_order_and_double_code(spark, ctx):
    bad = dict(TXN, transaction_id="T2", amount="N/A", currency=None, transaction_date="2024-13-45")
    df = build_silver(bronze_frame(spark, "transactions", [bad]), "transactions", ctx)
    r = df.first()
    # REQUIRED_NULL codes first (on typed values), then CAST_FAILED, in spec order;
    # a failed cast of a required column yields both codes.
    assert r["dq_errors"] == (
        "REQUIRED_NULL:amount|REQUIRED_NULL:currency|CAST_FAILED:transaction_date:DATE|CAST_FAILED:amount:FLOAT64"
    )
    assert r["dq_error_count"] == 4 and r["dq_status"] == "FAIL"
    assert r["amount"] is None and r["transaction_date"] is None


def test_unflagged_cast_stays_pass(spark, ctx):
    spec = SPECS["statements"]
    row = {c: None for c in spec.column_names}
    row.update(statement_id="S1", card_id="C1", payment_status="Paid", total_purchases="bad")
    r = build_silver(bronze_frame(spark, "statements", [row]), "statements", ctx).first()
    assert r["total_purchases"] is None and r["dq_status"] == "PASS"


def test_record_hash_text_form(spark, ctx):
    row = dict(TXN, merchant_id=None, amount="12345678.90")
    r = build_silver(bronze_frame(spark, "transactions", [row]), "transactions", ctx).first()
    text = json.dumps({"transaction_id": "T1", "card_id": "C1", "merchant_id": None, "amount": "1.23456789000000e+07"},
                      separators=(",", ":"))
    assert r["audit_record_hash"] == hashlib.sha256(text.encode()).hexdigest()


def test_rows_never_dropped(spark, ctx):
    rows = [dict(TXN, transaction_id=None), dict(TXN), dict(TXN)]
    df = build_silver(bronze_frame(spark, "transactions", rows), "transactions", ctx)
    assert df.count() == 3
    assert sorted(r["dq_status"] for r in df.collect()) == ["FAIL", "PASS", "PASS"]


def test_dq_summary(spark, ctx):
    rows = [dict(TXN), dict(TXN, amount="N/A"), dict(TXN, currency=None)]
    s = dq_summary(build_silver(bronze_frame(spark, "transactions", rows), "transactions", ctx), "silver_transactions")
    got = {(r["dq_status"], r["error_code"]): r["row_count"] for r in s.collect()}
    assert got == {("PASS", ""): 1, ("FAIL", "REQUIRED_NULL:amount"): 1, ("FAIL", "CAST_FAILED:amount:FLOAT64"): 1,
                   ("FAIL", "REQUIRED_NULL:currency"): 1}
