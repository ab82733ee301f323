"""DuckDB oracle of the reports and tests: each check counts its failing rows
by set logic (``EXISTS``, repeated keys), one scalar at a time; a report is a
table of those scalars with statuses worked out from them."""

from __future__ import annotations

from lakestrata.oracle import fixed_values
from lakestrata.oracle.builder import TS, Registry, lines


def rows_of(table: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {table} x WHERE {where})"


def orphans(child: str, fk: str, parent: str, pk: str, nulls: bool) -> str:
    """Child rows without a parent; with ``nulls``, rows without a key too."""
    lost = f"NOT EXISTS (FROM {parent} p WHERE p.{pk} = x.{fk})"
    return rows_of(child, lost if nulls else f"x.{fk} IS NOT NULL AND {lost}")


def surplus(table: str, key: str) -> str:
    """Rows beyond one for each key; rows without a key are all beyond."""
    return f"({rows_of(table)} - (SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}) keys))"


def verdict(zero: str) -> str:
    return f"if({zero} = 0, 'PASS', 'FAIL')"


def union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def relationship_report(text: str) -> str:
    rows = []
    for line in text.splitlines():
        child, fk, parent, pk, nulls, *cardinality = line.split()
        more = f", '{' '.join(cardinality)}' AS cardinality" if cardinality else ""
        rows.append(
            f"SELECT 'silver_{child}' AS child_table, '{fk}' AS fk_column, 'silver_{parent}' AS parent_table, '{pk}' AS pk_column{more}, "
            f"{orphans(f'silver_{child}', fk, f'silver_{parent}', pk, nulls == 'count')} AS orphaned_count"
        )
    return f"SELECT *, {verdict('orphaned_count')} AS fk_status, {TS} AS checked_at FROM (\n{union(rows)}\n) checks"


def quality_report() -> str:
    """Failed and passed rows of each check; a foreign key counts a child once
    for every parent that it meets, and once where it meets none."""
    rows = []

    def row(table: str, kind: str, name: str, column: str, severity: str, passed: str, failed: str) -> None:
        rows.append(f"SELECT '{table}_{name}' AS check_id, '{table}' AS table_name, '{kind}' AS check_type, '{column}' AS checked_columns, '{severity}' AS severity, {passed} AS passed_rows, {failed} AS failed_rows")

    for table, key, filled, foreign in lines(fixed_values.GOLD_CHECKS):
        row(table, "PK_UNIQUE", "PK_UNIQUE", key, "CRITICAL", f"({rows_of(table)} - {surplus(table, key)})", surplus(table, key))
        for c in filled.split():
            row(table, "NOT_NULL", f"NN_{c}", c, "HIGH", rows_of(table, f"{c} IS NOT NULL"), rows_of(table, f"{c} IS NULL"))
        for link in filter(None, foreign.split(", ")):
            fk, parent, pk = link.split()
            met = f"(SELECT coalesce(sum(c.n * p.n), 0)::BIGINT FROM (SELECT {fk} k, count(*) n FROM {table} GROUP BY 1) c SEMI JOIN {parent} q ON q.{pk} = c.k, LATERAL (SELECT count(*) n FROM {parent} y WHERE y.{pk} = c.k) p)"
            row(table, "FK_REFERENTIAL_INTEGRITY", f"FK_{fk}", f"{fk} → {parent}.{pk}", "HIGH", met, orphans(table, fk, parent, pk, True))
    share = "passed_rows / nullif(passed_rows + failed_rows, 0)::DOUBLE * 100"
    return (
        f"SELECT check_id, table_name, check_type, checked_columns, severity, passed_rows, failed_rows, passed_rows + failed_rows AS total_rows, "
        f"round(({share})::DECIMAL(38,10), 4)::DOUBLE AS pass_percentage, {verdict('failed_rows')} AS check_status, {TS} AS report_generated_at FROM (\n{union(rows)}\n) checks"
    )


def reconciliation_report() -> str:
    keys = {line[0]: line[1] for line in lines(fixed_values.TABLES)}
    gone = lambda a, b, k: rows_of(a, f"NOT EXISTS (FROM {b} y WHERE y.{k} = x.{k})")
    rows = []
    for t in fixed_values.RECON_ORDER.split():
        s, k = f"silver_{t}", keys[t]
        rows.append(
            f"SELECT 'B2S::{t}' AS reconciliation_id, 'BRONZE_TO_SILVER' AS reconciliation_scope, '{t}' AS source_table, '{s}' AS target_table, {rows_of(t)} AS source_count, "
            f"{rows_of(s)} AS intermediate_count, NULL::BIGINT AS target_count, {gone(t, s, k)} AS missing_in_intermediate, 0 AS missing_in_target, {surplus(s, k)} AS duplicate_intermediate_keys, 0 AS duplicate_target_keys"
        )
    for line in fixed_values.TO_GOLD.splitlines():
        b, s, g, k = line.split()
        rows.append(f"SELECT 'S2G::{g}', 'SILVER_TO_GOLD', '{s}', '{g}', {rows_of(b)}, {rows_of(s)}, {rows_of(g)}, 0, {gone(s, g, k)}, {surplus(s, k)}, {surplus(g, k)}")
    # a target's own counters and the difference of its row counts must all be 0
    wrong = (
        "if(reconciliation_scope = 'BRONZE_TO_SILVER', abs(source_count - intermediate_count) + missing_in_intermediate + duplicate_intermediate_keys, "
        "abs(source_count - target_count) + missing_in_target + duplicate_target_keys)"
    )
    return f"SELECT *, {verdict(wrong)} AS reconciliation_status, {TS} AS reconciliation_ts FROM (\n{union(rows)}\n) checks"


def column_tests(text: str) -> str:
    rows = []

    def row(kind: str, model: str, column: str, failures: str) -> None:
        rows.append(f"SELECT '{kind}:{model}.{column}' AS test_id, '{model}' AS model_name, '{column}' AS column_name, '{kind}' AS test_type, {failures}::BIGINT AS failures")

    for model, unique, filled, accepted, links in lines(text):
        for c in filled.split():
            row("not_null", model, c, rows_of(model, f"{c} IS NULL"))
        for item in filter(None, accepted.split("; ")):
            c, _, values = item.partition("=")
            allowed = ", ".join(f"('{v}')" for v in values.split(","))
            row("accepted_values", model, c, f"(SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL EXCEPT FROM (VALUES {allowed}) v(a)) u)")
        if unique:
            row("unique", model, unique, f"(SELECT count(*) FROM (SELECT {unique} FROM {model} WHERE {unique} IS NOT NULL GROUP BY ALL HAVING count(*) > 1) u)")
        for link in filter(None, links.split(", ")):
            c, parent, field = link.split()
            row("relationships", model, c, orphans(model, c, parent, field, False))
    return f"SELECT *, {verdict('failures')} AS status FROM (\n{union(rows)}\n) tests"


def register_ops(r: Registry) -> None:
    r.add("silver_relationship_dq_results", relationship_report(fixed_values.FOREIGN_KEYS))
    r.add("fk_orphans_declared", relationship_report(fixed_values.DECLARED_KEYS))
    r.add("gold_data_quality_report", quality_report())
    r.add("medallion_reconciliation_report", reconciliation_report())
    tables = [f"silver_{line[0]}" for line in lines(fixed_values.TABLES)]
    codes = union([f"SELECT '{t}' AS table_name, dq_status, unnest(string_split(dq_errors, '|')) AS error_code FROM {t}" for t in tables])
    r.add("dq_summary", f"SELECT table_name, dq_status, error_code, count(*) AS row_count FROM ({codes}) c GROUP BY ALL")
    r.add("silver_schema_tests", column_tests(fixed_values.SILVER_TESTS))
    r.add("gold_schema_tests", column_tests(fixed_values.GOLD_TESTS))
    failing = "FROM {} WHERE {} = 'FAIL'"
    r.add("assert_gold_dq_no_critical", "SELECT check_id, table_name, check_type, failed_rows, severity, check_status " + failing.format("gold_data_quality_report", "severity = 'CRITICAL' AND check_status"))
    r.add("assert_reconciliation_clean", "SELECT * EXCLUDE (reconciliation_ts) " + failing.format("medallion_reconciliation_report", "reconciliation_status"))
    r.add("assert_no_fk_orphans", "SELECT child_table, fk_column, parent_table, pk_column, orphaned_count, fk_status " + failing.format("silver_relationship_dq_results", "fk_status"))
    r.add("write_layer_table", "FROM silver_accounts")
    r.add("bronze_source", "FROM transactions")
    r.add("write_partitioned", "FROM gold_transaction_360")
    r.add("write_partitioned_accounts", "FROM gold_account_financial_summary")
    r.add("partitioned_date_range", "FROM gold_transaction_360 WHERE transaction_date BETWEEN DATE '1996-03-15' AND DATE '1997-01-20'")
    routed = (("accounts", "bronze"), ("silver_accounts", "silver"), ("gold_merchant_performance", "gold"), ("gold_data_quality_report", "ops"))
    r.add("layer_routing", union([f"SELECT '{t}' AS table_name, '{layer}' AS layer, {rows_of(t)} AS row_count" for t, layer in routed]))
