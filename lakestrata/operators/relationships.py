"""Referential checks between silver tables (FK orphan counts).

All checks of a report take two passes (see :func:`orphan_counts`): one narrow
keyed aggregation finds the keys without a parent, and only the children that
hold such keys are counted.  A NULL child key never meets a parent key, which
is the "counted as orphan" behaviour; checks that exclude NULLs filter them
first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.session import confirm_scratch, scratch_path


@dataclass(frozen=True)
class FkCheck:
    child: str
    fk: str
    parent: str
    pk: str
    skip_null: bool = False
    cardinality: str = "many-to-one"


# ---------------------------------------------------------------------------
# The 21 orphan checks of the silver relationship report, in
# report order; the last flag marks the three checks that ignore NULL keys.
# ---------------------------------------------------------------------------
SILVER_FK_CHECKS = [
    FkCheck("addresses", "customer_id", "customers", "customer_id"),
    FkCheck("accounts", "customer_id", "customers", "customer_id"),
    FkCheck("credit_cards", "customer_id", "customers", "customer_id"),
    FkCheck("credit_cards", "account_id", "accounts", "account_id"),
    FkCheck("credit_cards", "card_type_id", "dim_card_types", "card_type_id"),
    FkCheck("merchants", "mcc_code", "dim_merchant_categories", "mcc_code"),
    FkCheck("transactions", "card_id", "credit_cards", "card_id"),
    FkCheck("transactions", "merchant_id", "merchants", "merchant_id"),
    FkCheck("statements", "card_id", "credit_cards", "card_id"),
    FkCheck("payments", "card_id", "credit_cards", "card_id"),
    FkCheck("fraud_alerts", "transaction_id", "transactions", "transaction_id", True),
    FkCheck("disputes", "transaction_id", "transactions", "transaction_id", True),
    FkCheck("chargeback_cases", "dispute_id", "disputes", "dispute_id", True),
    FkCheck("rewards", "card_id", "credit_cards", "card_id"),
    FkCheck("reward_redemptions", "reward_id", "rewards", "reward_id"),
    FkCheck("kyc_documents", "customer_id", "customers", "customer_id"),
    FkCheck("contact_history", "customer_id", "customers", "customer_id"),
    FkCheck("emi_plans", "card_id", "credit_cards", "card_id"),
    FkCheck("notifications", "customer_id", "customers", "customer_id"),
    FkCheck("credit_limit_history", "card_id", "credit_cards", "card_id"),
    FkCheck("interest_rates", "card_id", "credit_cards", "card_id"),
]

#: Orphaned keys that may be broadcast (they are counted first); more are joined by shuffle.
BROADCAST_KEYS = 500_000


def declared_checks() -> list[FkCheck]:
    """One check per declared relationship; a NULL key is an orphan unless
    the relationship is declared nullable."""
    from lakestrata.sources.seeds import RELATIONSHIPS

    return [FkCheck(c, fk, p, pk, "nullable" in card, card) for c, fk, p, pk, card in RELATIONSHIPS]


@dataclass(frozen=True)
class Use:
    """A column of a table that holds keys of a group: a parent's, or a check's."""

    group: int
    column: str
    mark: int
    nulls: bool


def _key_rows(m, uses: dict[str, list[Use]]) -> DataFrame:
    """(group, key, mark) rows of all uses; each table is scanned once.  One
    statement, so that the union is analysed once, not once for each table."""

    def entry(u: Use) -> str:
        return f"struct({u.group} AS _g, CAST(`{u.column}` AS STRING) AS _k, {u.mark}L AS _mark, {str(u.nulls).lower()} AS _nulls)"

    branches = [f"SELECT inline(array({', '.join(map(entry, of_table))})) FROM {{{t}}}" for t, of_table in uses.items()]
    text = f"SELECT _g, _k, _mark FROM ({' UNION ALL '.join(branches)}) WHERE _k IS NOT NULL OR _nulls"
    return m.spark.sql(text, **{t: m.silver(t) for t in uses})


def key_groups(checks: list[FkCheck]) -> dict[tuple[str, str], list[int]]:
    """Numbers of the checks that point at each (parent, key)."""
    groups: dict[tuple[str, str], list[int]] = {}
    for i, c in enumerate(checks):
        groups.setdefault((c.parent, c.pk), []).append(i)
    return groups


def orphaned_keys(m, checks: list[FkCheck]) -> DataFrame:
    """(_g, _k, _mask): keys without a parent, and which checks' children hold
    them: bit ``1 + s`` for the ``s``-th check of the group.

    Parents mark a key with bit 0 and children with their own bit; ``bit_or``
    merges them map-side, so that a shuffled row is (group, key, mask) however
    many checks a group has, and a hot or NULL key is one row for each task."""
    uses: dict[str, list[Use]] = {}
    for g, ((parent, pk), members) in enumerate(key_groups(checks).items()):
        uses.setdefault(parent, []).append(Use(g, pk, 1, False))
        for s, i in enumerate(members):
            uses.setdefault(checks[i].child, []).append(Use(g, checks[i].fk, 2 << s, not checks[i].skip_null))
    masks = _key_rows(m, uses).groupBy("_g", "_k").agg(F.bit_or("_mark").alias("_mask"))
    return masks.where(F.col("_mask").bitwiseAND(1) == 0)


def orphan_counts(m, checks: list[FkCheck]) -> DataFrame:
    """``(check metadata…, orphaned_count)`` for every check, 0 included.

    The orphaned keys are written to the shared scratch folder.  What is
    collected of them is a row for each key group; the checks named there, and
    no others, have their children scanned again to count rows."""
    path = scratch_path(m.spark, "orphans")
    orphaned_keys(m, checks).write.parquet(path)
    confirm_scratch(m.spark, path)
    orphans = m.spark.read.parquet(path)
    held = {r["_g"]: r for r in orphans.groupBy("_g").agg(F.bit_or("_mask").alias("mask"), F.count("*").alias("n")).collect()}
    uses: dict[str, list[Use]] = {}
    for g, members in enumerate(key_groups(checks).values()):
        for s, i in enumerate(members):
            if g in held and held[g]["mask"] & (2 << s):
                uses.setdefault(checks[i].child, []).append(Use(g, checks[i].fk, i, not checks[i].skip_null))
    labels = [f"({i}L, 'silver_{c.child}', '{c.fk}', 'silver_{c.parent}', '{c.pk}', {str(c.skip_null).lower()}, '{c.cardinality}')" for i, c in enumerate(checks)]
    meta = m.spark.sql(f"SELECT * FROM VALUES {', '.join(labels)} AS t(_mark, child_table, fk_column, parent_table, pk_column, skip_null, cardinality)")
    if uses:
        rows = _key_rows(m, uses)
        keys = orphans.select(F.col("_g").alias("_og"), F.col("_k").alias("_ok"))
        same = (F.col("_g") == F.col("_og")) & F.col("_k").eqNullSafe(F.col("_ok"))
        if sum(r["n"] for r in held.values()) <= BROADCAST_KEYS:
            counts = rows.join(F.broadcast(keys), same, "left_semi").groupBy("_mark").agg(F.count("*").alias("_orphans"))
        else:
            rows = rows.groupBy("_g", "_k", "_mark").agg(F.count("*").alias("_n"))
            counts = rows.join(keys, same, "left_semi").groupBy("_mark").agg(F.sum("_n").alias("_orphans"))
        meta = meta.join(F.broadcast(counts), "_mark", "left")
    else:
        meta = meta.withColumn("_orphans", F.lit(0))
    return meta.select(
        "child_table", "fk_column", "parent_table", "pk_column", "skip_null", "cardinality",
        F.coalesce(F.col("_orphans"), F.lit(0)).cast("bigint").alias("orphaned_count"),
    )


def _report(counts: DataFrame, ctx, extra: list[str]) -> DataFrame:
    return counts.select(
        "child_table", "fk_column", "parent_table", "pk_column", *extra, "orphaned_count",
        F.when(F.col("orphaned_count") == 0, "PASS").otherwise("FAIL").alias("fk_status"),
        ctx.ts().alias("checked_at"),
    ).orderBy(F.col("fk_status").desc(), F.col("orphaned_count").desc())


def silver_relationship_dq_results(m) -> DataFrame:
    return _report(orphan_counts(m, SILVER_FK_CHECKS), m.ctx, [])


def fk_orphans_declared(m) -> DataFrame:
    return _report(orphan_counts(m, declared_checks()), m.ctx, ["cardinality"])
