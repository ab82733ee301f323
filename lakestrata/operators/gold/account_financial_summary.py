"""gold_account_financial_summary: one row per account; every child table
reaches the account through the card bridge (card_id → account_id).

The six child tables are described once (:class:`Child`).  The CTE of each is
its own aggregate; the entity takes all six as one long table, so that they are
aggregated per card, meet the bridge and are added up per account together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.numeric import nullif0, round_column, round_half_up, safe_divide
from lakestrata.operators.gold.common import card_bridge, left_join_on_key, with_gold_audit, zero
from lakestrata.operators.gold.customer_360 import card_totals

#: Aggregates that give the same over rows as over the aggregates of parts of them.
MERGES = {"sum": F.sum, "min": F.min, "max": F.max}

Part = tuple[str, Column]


@dataclass(frozen=True)
class Child:
    """A child table: ``parts`` are an aggregate of ``MERGES`` and what it is
    taken of in a row; ``finish`` are the account's columns from the parts;
    ``ids`` is a child key and the name of its distinct count."""

    rows: DataFrame
    parts: dict[str, Part]
    finish: dict[str, Column]
    ids: tuple[str, str] | None = None

    @property
    def measures(self) -> DataFrame:
        return self.rows.select("card_id", *[c.alias(n) for n, (_, c) in self.parts.items()])


def _merged(rows: DataFrame, key: str, parts: dict[str, Part]) -> DataFrame:
    return rows.groupBy(key).agg(*[MERGES[how](n).alias(n) for n, (how, _) in parts.items()])


def _totals(m, measures: DataFrame, parts: dict[str, Part], finish: dict[str, Column]) -> DataFrame:
    """The finished columns by account.  Rows are aggregated per card first, so
    that a hot card comes down to one row a task before it meets the bridge."""
    per_card = _merged(measures, "card_id", parts)
    summed = _merged(per_card.join(card_bridge(m, "account_id"), "card_id"), "account_id", parts)
    return summed.select("account_id", *[c.alias(n) for n, c in finish.items()])


def _distinct_ids(m, children: list[Child]) -> DataFrame:
    """Distinct child keys by account: rows of (account, child, key) are made
    distinct first, and spread over all tasks however hot an account is."""
    counted = [c.ids for c in children if c.ids]
    rows = [c.rows.select("card_id", F.lit(i).alias("_child"), F.col(c.ids[0]).cast("string").alias("_id")) for i, c in enumerate(x for x in children if x.ids)]
    ids = reduce(DataFrame.unionByName, rows).join(card_bridge(m, "account_id"), "card_id")
    distinct = ids.groupBy("account_id", "_child", "_id").agg(F.count("_id").alias("_n"))
    return distinct.groupBy("account_id").agg(
        *[F.count_if((F.col("_child") == i) & F.col("_id").isNotNull()).alias(name) for i, (_, name) in enumerate(counted)],
    )


def _by_account(m, child: Child) -> DataFrame:
    """One row per account, a NULL account included."""
    totals = _totals(m, child.measures, child.parts, child.finish)
    if child.ids is None:
        return totals
    ids = _distinct_ids(m, [child]).withColumnRenamed("account_id", "_account")
    return totals.join(ids, F.col("account_id").eqNullSafe(F.col("_account"))).drop("_account")


def _all_by_account(m, children: list[Child]) -> list[DataFrame]:
    """Totals of all children and their distinct ids, each in one pass over one
    long table; a child's row has NULLs in the others' columns, which no
    aggregate counts."""
    parts = reduce(dict.__or__, (c.parts for c in children))
    finish = reduce(dict.__or__, (c.finish for c in children))
    measures = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (c.measures for c in children))
    return [_totals(m, measures, parts, finish), _distinct_ids(m, children)]


def _sums(**columns: Column | str) -> dict[str, Part]:
    return {n: ("sum", F.col(c) if isinstance(c, str) else c) for n, c in columns.items()}


def _counts(**conditions: Column) -> dict[str, Part]:
    return {n: ("sum", F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")) for n, c in conditions.items()}


def _money(*names: str) -> dict[str, Column]:
    return {n: round_column(n, 2) for n in names}


def _as_is(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _mean(total: str, n: str) -> Column:
    return round_half_up(safe_divide(F.col(total), F.col(n)), 2)


def _statements(m) -> Child:
    status = F.col("payment_status")
    sums = _sums(total_purchases="total_purchases", total_payments="total_payments", total_fees="total_fees",
                 total_interest="total_interest", total_outstanding_balance="closing_balance")
    counts = _counts(missed_payment_count=status == "Missed", on_time_payment_count=status == "Paid",
                     partial_payment_count=status == "Partial")
    return Child(
        m.silver("statements"), sums | counts | {"latest_statement_date": ("max", F.col("statement_date"))},
        _money(*sums) | _as_is(*counts, "latest_statement_date"), ("statement_id", "statement_count"),
    )


def _fees(m) -> Child:
    amount, waived = F.col("fee_amount"), F.col("waived")
    # NULL ``waived`` lands in neither bucket.
    sums = _sums(total_fees_charged=amount, total_fees_waived=F.when(waived, amount).otherwise(F.lit(0)),
                 total_fees_paid=F.when(~waived, amount).otherwise(F.lit(0)))
    return Child(m.silver("fees"), sums, _money(*sums), ("fee_id", "fee_event_count"))


def _rates(m) -> Child:
    def apr(kind: str) -> Column:
        return F.when((F.col("rate_type") == kind) & F.col("is_current"), F.col("apr"))

    kinds = {"purchase_apr": apr("Purchase"), "cash_advance_apr": apr("Cash Advance")}
    parts = _sums(**{f"{n}_sum": c for n, c in kinds.items()}) | _counts(**{f"{n}_n": c.isNotNull() for n, c in kinds.items()})
    return Child(m.silver("interest_rates"), parts, {n: _mean(f"{n}_sum", f"{n}_n") for n in kinds})


def _limits(m) -> Child:
    current = m.silver("credit_limit_history").where(F.col("is_current") == F.lit(True))
    sums = _sums(current_total_limit="new_limit")
    return Child(current, sums, _as_is(*sums))


def _emis(m) -> Child:
    sums = _sums(total_emi_original_amount="original_amount", total_emi_payable="total_payable")
    counts = _counts(active_emi_plans=F.col("status") == "Active")
    return Child(m.silver("emi_plans"), sums | counts, _money(*sums) | _as_is(*counts), ("emi_plan_id", "emi_plan_count"))


def _payments(m) -> Child:
    status, amount = F.col("status"), F.col("amount")
    parts = _sums(total_amount_paid="amount") | _counts(amounts=amount.isNotNull()) | {
        "min_payment_amount": ("min", amount), "max_payment_amount": ("max", amount),
        "last_payment_date": ("max", F.col("payment_date")),
    }
    counts = _counts(minimum_only_payment_count=F.col("is_minimum_only"), completed_payment_count=status == "Completed",
                     failed_payment_count=status == "Failed")
    finish = _money("total_amount_paid", "min_payment_amount", "max_payment_amount")
    finish |= {"avg_payment_amount": _mean("total_amount_paid", "amounts")} | _as_is("last_payment_date", *counts)
    return Child(m.silver("payments"), parts | counts, finish, ("payment_id", "payment_event_count"))


def g4a_cards_agg(m) -> DataFrame:
    return card_totals(m.silver("credit_cards"), "account_id", "utilisation_rate")


def g4b_stmt_agg(m) -> DataFrame:
    return _by_account(m, _statements(m))


def g4c_fees_agg(m) -> DataFrame:
    return _by_account(m, _fees(m))


def g4d_current_rate(m) -> DataFrame:
    return _by_account(m, _rates(m))


def g4e_current_limit(m) -> DataFrame:
    return _by_account(m, _limits(m))


def g4f_emi_agg(m) -> DataFrame:
    return _by_account(m, _emis(m))


def g4g_payments_agg(m) -> DataFrame:
    return _by_account(m, _payments(m))


def build(m) -> DataFrame:
    children = [_statements(m), _fees(m), _rates(m), _limits(m), _emis(m), _payments(m)]
    j = left_join_on_key(m.silver("accounts"), "account_id", [g4a_cards_agg(m), *_all_by_account(m, children)])
    missed = zero("missed_payment_count")
    out = j.select(
        "account_id", "customer_id", "account_type", "account_number", "sort_code", "currency",
        F.col("balance").alias("current_balance"), "overdraft_limit", "account_status", "opened_date",
        "closed_date",
        *[zero(c).alias(c) for c in
          "card_count total_credit_limit total_available_credit active_card_count utilisation_rate".split()],
        zero("statement_count").alias("statement_count"),
        zero("total_purchases").alias("total_purchases"),
        zero("total_payments").alias("total_payments"),
        zero("total_fees").alias("total_statement_fees"),
        zero("total_interest").alias("total_interest_charged"),
        zero("total_outstanding_balance").alias("total_outstanding_balance"),
        missed.alias("missed_payment_count"),
        zero("on_time_payment_count").alias("on_time_payment_count"),
        zero("partial_payment_count").alias("partial_payment_count"),
        "latest_statement_date",
        round_half_up(safe_divide(missed, nullif0(zero("statement_count"))), 4).alias("missed_payment_rate"),
        *[zero(c).alias(c) for c in
          "fee_event_count total_fees_charged total_fees_waived total_fees_paid".split()],
        "purchase_apr", "cash_advance_apr",
        zero("current_total_limit").alias("current_total_credit_limit"),
        *[zero(c).alias(c) for c in
          "emi_plan_count total_emi_original_amount total_emi_payable active_emi_plans payment_event_count "
          "total_amount_paid min_payment_amount max_payment_amount avg_payment_amount".split()],
        "last_payment_date",
        *[zero(c).alias(c) for c in
          "minimum_only_payment_count completed_payment_count failed_payment_count".split()],
        F.when(missed == 0, "Current")
        .when(missed.between(1, 2), "30-60 DPD")
        .when(missed.between(3, 5), "60-90 DPD")
        .otherwise("90+ DPD")
        .alias("delinquency_bucket"),
    )
    return with_gold_audit(out, "account_financial_summary", m.ctx, ["account_id", "customer_id", "account_number"])
