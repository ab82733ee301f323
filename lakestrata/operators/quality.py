"""Data-quality checks on layer tables: PK uniqueness, NOT NULL, FK
integrity, and the gold data-quality report.

Plan: all PK and NOT NULL checks of one table run in ONE pass: the table is
grouped by its key (map-side partial counts of rows and of non-NULL values
per checked column), then summed to one row, then unpivoted with ``stack``.
Distinct keys = non-NULL groups, so there is no Expand for count-distinct.
FK checks pre-aggregate both sides by key and join the aggregates, which
reproduces the left-join row inflation of a duplicated parent key exactly
(``child_rows × parent_rows``) without materialising the fan-out.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.numeric import round_half_up, safe_divide

REPORT_COLUMNS = (
    "check_id table_name check_type checked_columns total_rows passed_rows failed_rows pass_percentage "
    "check_status severity"
).split()


@dataclass(frozen=True)
class TableChecks:
    table: str
    pk: str | None = None
    not_null: tuple[str, ...] = ()
    fks: tuple[tuple[str, str, str], ...] = field(default=())  # (fk, parent table, parent pk)


# ---------------------------------------------------------------------------
# The 20 checks of the gold data-quality report, in report
# order (per table: PK, NOT NULL columns, FKs).
# ---------------------------------------------------------------------------
GOLD_DQ_CHECKS = [
    TableChecks("gold_customer_360", "customer_id", ("full_name", "customer_status")),
    TableChecks("gold_transaction_360", "transaction_id", ("customer_id", "amount"),
                (("customer_id", "gold_customer_360", "customer_id"),
                 ("merchant_id", "gold_merchant_performance", "merchant_id"))),
    TableChecks("gold_merchant_performance", "merchant_id", ("merchant_name", "mcc_code")),
    TableChecks("gold_account_financial_summary", "account_id", ("account_status",),
                (("customer_id", "gold_customer_360", "customer_id"),)),
    TableChecks("gold_fraud_case_360", "alert_id", ("card_id", "alert_type")),
    TableChecks("gold_rewards_engagement", "reward_id", ("program_type",),
                (("customer_id", "gold_customer_360", "customer_id"),)),
]


def pk_and_not_null_many(items: list[tuple[DataFrame, str, str | None, tuple[str, ...]]], spark) -> DataFrame:
    """PK_UNIQUE and NOT_NULL rows for several ``(df, table, pk, not_null)``
    entries from ONE keyed aggregation.

    Every table contributes ``(table_no, key, non-NULL indicators…)`` rows;
    grouping by ``(table_no, key)`` (map-side partial counts) gives rows and
    non-NULL counts per key, a second tiny aggregation per table gives totals
    and distinct keys (= non-NULL key groups, no count-distinct Expand)."""
    width = max((len(nn) for _, _, _, nn in items), default=0)
    rows = []
    meta = []
    for t, (df, table, pk, nn) in enumerate(items):
        key = F.col(pk).cast("string") if pk else F.lit(None).cast("string")
        flags = [F.col(c).isNotNull().cast("long") if j < len(nn) else F.lit(0).cast("long")
                 for j, c in enumerate(list(nn) + [None] * (width - len(nn)))]
        rows.append(df.select(F.lit(t).alias("_t"), key.alias("_k"), *[f.alias(f"_nn{j}") for j, f in enumerate(flags)]))
        if pk:
            meta.append((t, -1, f"{table}_PK_UNIQUE", table, "PK_UNIQUE", pk, "CRITICAL"))
        meta += [(t, j, f"{table}_NN_{c}", table, "NOT_NULL", c, "HIGH") for j, c in enumerate(nn)]
    per_key = reduce(DataFrame.unionByName, rows).groupBy("_t", "_k").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_nn{j}").alias(f"_nn{j}") for j in range(width)]
    )
    per_table = per_key.groupBy("_t").agg(
        F.sum("_rows").alias("_rows"), F.count("_k").alias("_distinct"),
        *[F.sum(f"_nn{j}").alias(f"_nn{j}") for j in range(width)],
    )
    slots = ", ".join(["-1, _distinct"] + [f"{j}, _nn{j}" for j in range(width)])
    per_check = per_table.selectExpr("_t", "_rows", f"stack({width + 1}, {slots}) AS (_j, _passed)")
    labels = spark.createDataFrame(
        meta, "_t int, _j int, check_id string, table_name string, check_type string, checked_columns string, "
              "severity string"
    )
    j = labels.join(F.broadcast(per_check), ["_t", "_j"], "left")
    total = F.coalesce(F.col("_rows"), F.lit(0)).cast("bigint")
    passed = F.coalesce(F.col("_passed"), F.lit(0)).cast("bigint")
    return j.select(
        "check_id", "table_name", "check_type", "checked_columns", total.alias("total_rows"),
        passed.alias("passed_rows"), "severity", (total - passed).alias("failed_rows"),
    )


def pk_and_not_null(df: DataFrame, table: str, pk: str | None, not_null: tuple[str, ...]) -> DataFrame:
    """PK_UNIQUE and NOT_NULL rows for one table, from one aggregation."""
    return pk_and_not_null_many([(df, table, pk, not_null)], df.sparkSession)


def fk_integrity_many(items: list[tuple[DataFrame, str, str, DataFrame, str, str]], spark) -> DataFrame:
    """FK_REFERENTIAL_INTEGRITY rows for several ``(child, table, fk, parent,
    parent_table, pk)`` checks from ONE keyed aggregation.

    Child LEFT JOIN parent semantics without the join: per ``(check, key)``
    the child row count ``c`` and parent row count ``p`` give
    ``c × p`` matched rows (the inflation of a duplicated parent key) or ``c``
    unmatched rows; a NULL child key never matches."""
    rows, meta = [], []
    for f, (child, table, fk, parent, parent_table, pk) in enumerate(items):
        rows.append(child.select(F.lit(f).alias("_f"), F.col(fk).cast("string").alias("_k"),
                                 F.lit(1).cast("long").alias("_c"), F.lit(0).cast("long").alias("_p")))
        rows.append(parent.select(F.lit(f).alias("_f"), F.col(pk).cast("string").alias("_k"),
                                  F.lit(0).cast("long").alias("_c"), F.lit(1).cast("long").alias("_p"))
                    .where(F.col("_k").isNotNull()))
        meta.append((f, f"{table}_FK_{fk}", table, f"{fk} → {parent_table}.{pk}"))
    per_key = reduce(DataFrame.unionByName, rows).groupBy("_f", "_k").agg(
        F.sum("_c").alias("_c"), F.sum("_p").alias("_p")
    )
    matched = F.col("_p") > 0
    per_check = per_key.groupBy("_f").agg(
        F.sum(F.when(matched, F.col("_c") * F.col("_p")).otherwise(F.col("_c"))).alias("_total"),
        F.sum(F.when(matched, F.col("_c") * F.col("_p")).otherwise(F.lit(0))).alias("_passed"),
        F.sum(F.when(matched, F.lit(0)).otherwise(F.col("_c"))).alias("_failed"),
    )
    labels = spark.createDataFrame(meta, "_f int, check_id string, table_name string, checked_columns string")
    j = labels.join(F.broadcast(per_check), "_f", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return j.select(
        "check_id", "table_name", F.lit("FK_REFERENTIAL_INTEGRITY").alias("check_type"), "checked_columns",
        z("_total").alias("total_rows"), z("_passed").alias("passed_rows"), F.lit("HIGH").alias("severity"),
        z("_failed").alias("failed_rows"),
    )


def fk_integrity(child: DataFrame, table: str, fk: str, parent: DataFrame, parent_table: str, pk: str) -> DataFrame:
    """FK_REFERENTIAL_INTEGRITY row: child LEFT JOIN parent, NULL FK fails."""
    return fk_integrity_many([(child, table, fk, parent, parent_table, pk)], child.sparkSession)


def finish(rows: DataFrame) -> DataFrame:
    """pass %, PASS/FAIL status, column order."""
    return rows.select(
        "check_id", "table_name", "check_type", "checked_columns", "total_rows", "passed_rows", "failed_rows",
        round_half_up(safe_divide(F.col("passed_rows"), F.col("total_rows")) * 100, 4).alias("pass_percentage"),
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("check_status"),
        "severity",
    )


def dq_check_pk(df: DataFrame, model: str, pk: str) -> DataFrame:
    """One PK_UNIQUE report row for ``model``."""
    return finish(pk_and_not_null(df, model, pk, ()))


def dq_check_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """One NOT_NULL report row for ``model.column``."""
    return finish(pk_and_not_null(df, model, None, (column,)))


def dq_check_fk(child: DataFrame, model: str, fk: str, parent: DataFrame, parent_model: str, pk: str) -> DataFrame:
    """One FK_REFERENTIAL_INTEGRITY report row (LEFT JOIN semantics)."""
    return finish(fk_integrity(child, model, fk, parent, parent_model, pk))


def _layer(m, name: str) -> DataFrame:
    return m.gold(name) if name.startswith("gold_") else m.silver(name)


def gold_data_quality_report(m, checks: list[TableChecks] = GOLD_DQ_CHECKS) -> DataFrame:
    """The 20-check report: one keyed aggregation for all PK / NOT NULL
    checks, one for all FK checks."""
    parts = [pk_and_not_null_many([(_layer(m, c.table), c.table, c.pk, c.not_null) for c in checks], m.spark)]
    fks = [(_layer(m, c.table), c.table, fk, _layer(m, pt), pt, pk) for c in checks for fk, pt, pk in c.fks]
    if fks:
        parts.append(fk_integrity_many(fks, m.spark))
    rows = finish(reduce(DataFrame.unionByName, parts))
    rank = F.when(F.col("severity") == "CRITICAL", 1).when(F.col("severity") == "HIGH", 2).otherwise(3)
    return rows.select("*", m.ctx.ts().alias("report_generated_at")).orderBy(
        rank, F.col("check_status").desc(), "table_name", "check_id"
    )
