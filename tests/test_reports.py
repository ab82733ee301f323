from lakestrata.operators import assertions
from lakestrata.operators.mapping import medallion_layer_mapping
from lakestrata.operators.quality import finish, fk_integrity, pk_and_not_null
from lakestrata.operators.reconcile import medallion_reconciliation_report, reconciliation_rows
from lakestrata.operators.relationships import FkCheck, orphan_counts, silver_relationship_dq_results
from lakestrata.sources.seeds import MAPPING_COLUMNS, string_schema


def _checks(spark, df, table, pk, nn):
    return {r["check_id"]: r for r in finish(pk_and_not_null(df, table, pk, nn)).collect()}


def test_pk_duplicate_and_null_fail(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "z")], "k string, v string")
    got = _checks(spark, df, "t", "k", ("v",))
    pk = got["t_PK_UNIQUE"]
    assert (pk["total_rows"], pk["passed_rows"], pk["failed_rows"], pk["check_status"]) == (4, 2, 2, "FAIL")
    assert pk["pass_percentage"] == 50.0 and pk["severity"] == "CRITICAL"
    nn = got["t_NN_v"]
    assert (nn["passed_rows"], nn["failed_rows"], nn["check_status"], nn["severity"]) == (3, 1, "FAIL", "HIGH")


def test_empty_table_passes_with_null_percentage(spark):
    df = spark.createDataFrame([], "k string, v string")
    got = _checks(spark, df, "t", "k", ("v",))
    for r in got.values():
        assert r["total_rows"] == 0 and r["check_status"] == "PASS" and r["pass_percentage"] is None


def test_fk_null_fails_and_duplicate_parent_inflates(spark):
    child = spark.createDataFrame([("p1",), ("p2",), (None,), ("zz",)], "fk string")
    parent = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "pk string")
    r = finish(fk_integrity(child, "c", "fk", parent, "p", "pk")).first()
    # p1 matches two parent rows: the LEFT JOIN has 5 rows, 3 matched, 2 unmatched
    assert (r["total_rows"], r["passed_rows"], r["failed_rows"], r["check_status"]) == (5, 3, 2, "FAIL")
    assert r["checked_columns"] == "fk → p.pk"


def test_orphans_null_counted_or_excluded(medallion):
    m = medallion({
        "customers": [dict(customer_id="C1"), dict(customer_id="C1")],
        "addresses": [dict(address_id="A1", customer_id="C1"), dict(address_id="A2", customer_id=None),
                      dict(address_id="A3", customer_id="C9")],
        "transactions": [dict(transaction_id="T1")],
        "fraud_alerts": [dict(alert_id="F1", transaction_id=None), dict(alert_id="F2", transaction_id="T9"),
                         dict(alert_id="F3", transaction_id="T1")],
    })
    got = {(r["child_table"], r["fk_column"]): r["orphaned_count"] for r in orphan_counts(m, [
        FkCheck("addresses", "customer_id", "customers", "customer_id"),
        FkCheck("fraud_alerts", "transaction_id", "transactions", "transaction_id", skip_null=True),
        FkCheck("fraud_alerts", "transaction_id", "transactions", "transaction_id"),
    ]).collect()}
    assert got[("silver_addresses", "customer_id")] == 2  # NULL and unknown, duplicate parent irrelevant
    rep = {(r["child_table"]): (r["orphaned_count"], r["fk_status"]) for r in silver_relationship_dq_results(m).collect()}
    assert rep["silver_fraud_alerts"] == (1, "FAIL") and rep["silver_accounts"] == (0, "PASS")


def test_many_orphans_are_joined_by_shuffle(medallion, monkeypatch):
    rows = {"customers": [dict(customer_id="C1")], "accounts": [dict(account_id=f"A{i}", customer_id=f"C{i % 3}" if i else None) for i in range(20)],
            "addresses": [dict(address_id="D1", customer_id="C1")]}
    checks = [FkCheck(t, "customer_id", "customers", "customer_id", skip) for t, skip in (("accounts", False), ("accounts", True), ("addresses", False))]
    got = [[r["orphaned_count"] for r in orphan_counts(medallion(rows), checks).orderBy("child_table", "skip_null").collect()]]
    monkeypatch.setattr("lakestrata.operators.relationships.BROADCAST_KEYS", 0)
    got.append([r["orphaned_count"] for r in orphan_counts(medallion(rows), checks).orderBy("child_table", "skip_null").collect()])
    assert got == [[13, 12, 0]] * 2


def test_reconciliation_null_key_missing_and_duplicate(medallion):
    m = medallion({"customers": [dict(customer_id="C1"), dict(customer_id="C1"), dict(customer_id=None)]})
    r = reconciliation_rows(m, ["customers"], []).first()
    assert (r["source_count"], r["intermediate_count"], r["missing_in_intermediate"],
            r["duplicate_intermediate_keys"], r["target_count"]) == (3, 3, 1, 2, None)


def test_reconciliation_shared_domain_matches_standalone(medallion, spark):
    m = medallion({"customers": [dict(customer_id=k) for k in ("C1", "C1", "C2", None)]})
    m.use_table("gold_customer_360", spark.createDataFrame([("C1",)], "customer_id string"))
    cols = ["source_count", "intermediate_count", "target_count", "missing_in_intermediate", "missing_in_target",
            "duplicate_intermediate_keys", "duplicate_target_keys"]
    s2g = ("customers", "silver_customers", "gold_customer_360", "customer_id")
    both = {r["reconciliation_id"]: [r[c] for c in cols] for r in reconciliation_rows(m, ["customers"], [s2g]).collect()}
    alone = [reconciliation_rows(m, [], [s2g]).first()[c] for c in cols]
    assert both["S2G::gold_customer_360"] == alone == [4, 4, 1, None, 2, 2, 0]
    assert both["B2S::customers"] == [4, 4, None, 1, None, 2, None]


def test_reconciliation_report_statuses(medallion):
    m = medallion({"customers": [dict(customer_id="C1", first_name="a", last_name="b", customer_status="x")]})
    got = {r["reconciliation_id"]: r for r in medallion_reconciliation_report(m).collect()}
    assert len(got) == 32
    assert got["B2S::customers"]["reconciliation_status"] == "PASS"
    s2g = got["S2G::gold_customer_360"]
    assert (s2g["source_count"], s2g["intermediate_count"], s2g["target_count"], s2g["missing_in_target"],
            s2g["missing_in_intermediate"], s2g["reconciliation_status"]) == (1, 1, 1, 0, 0, "PASS")


def test_accepted_values_unique_relationships_ignore_nulls(spark):
    df = spark.createDataFrame([("a", "Posted"), ("a", "Bogus"), (None, None), (None, "Bogus")], "k string, s string")
    assert assertions.assert_accepted_values(df, "s", ["Posted"]).count() == 1
    assert [r["unique_field"] for r in assertions.assert_unique(df, "k").collect()] == ["a"]
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r["from_field"] for r in assertions.assert_relationships(child, "k", parent, "k").collect()] == ["b"]


def test_schema_test_results_pass_and_fail(medallion):
    m = medallion({"customers": [dict(customer_id="C1", first_name="a", last_name="b", customer_status="x"),
                                 dict(customer_id="C1", first_name=None, last_name="b", customer_status="x")]})
    got = {r["test_id"]: (r["failures"], r["status"]) for r in
           assertions.schema_test_results(m, ["silver_customers"]).collect()}
    assert got["unique:silver_customers.customer_id"] == (1, "FAIL")
    assert got["not_null:silver_customers.first_name"] == (1, "FAIL")
    assert got["not_null:silver_customers.last_name"] == (0, "PASS")
    assert got["accepted_values:silver_customers.dq_status"] == (0, "PASS")


def test_schema_test_accepted_values_count_distinct_failing_values(medallion):
    base = dict(transaction_id="T", card_id="K", amount="1.0", currency="EUR")
    m = medallion({"transactions": [dict(base, transaction_id=f"T{i}", status=s) for i, s in
                                    enumerate(["Posted", "Bogus", "Bogus", "Odd", None, "Pending"])]})
    res = assertions.schema_test_results(m, ["silver_transactions"])
    got = {r["test_id"]: (r["failures"], r["status"]) for r in res.collect()}
    # two distinct failing values (a repeated one counts once); NULL is ignored
    assert got["accepted_values:silver_transactions.status"] == (2, "FAIL")
    assert got["not_null:silver_transactions.status"] == (1, "FAIL")
    assert "Expand" not in res._jdf.queryExecution().executedPlan().toString()


def test_singular_assertions_filter_failures(spark):
    rep = spark.createDataFrame([("a", "t", "PK_UNIQUE", 1, "CRITICAL", "FAIL"), ("b", "t", "NOT_NULL", 1, "HIGH", "FAIL")],
                                "check_id string, table_name string, check_type string, failed_rows long, "
                                "severity string, check_status string")
    assert [r["check_id"] for r in assertions.assert_gold_dq_no_critical(rep).collect()] == ["a"]


def test_mapping_layer_order(spark, ctx):
    base = {c: None for c in MAPPING_COLUMNS}
    rows = [dict(base, source_layer="bronze", source_object="x", target_layer="silver", implementation="Complete"),
            dict(base, source_layer="silver", source_object="y", target_layer="gold", implementation="Planned"),
            dict(base, source_layer="raw", source_object="z", target_layer="archive", implementation="Complete")]
    seed = spark.createDataFrame([tuple(r[c] for c in MAPPING_COLUMNS) for r in rows], string_schema(MAPPING_COLUMNS))
    out = medallion_layer_mapping(seed, ctx).collect()
    assert [(r["target_layer"], r["layer_order"], r["is_implemented"]) for r in out] == [
        ("archive", 0, True), ("silver", 1, True), ("gold", 2, False)]
    assert len(out[0]) == 19
