"""Shared gold building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.hashing import record_hash


def top1(df: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """Latest row per ``key``: ``row_number() over (partition by key order by
    order... desc) = 1`` with NULLs of the first order column last.

    Expressed as ``max(struct(order..., keep...))`` per key: an aggregate with
    a map-side partial step, so a hot key never sorts its whole group in one
    task.  Ties on ``order`` are broken by the later fields (deterministic)."""
    fields = list(dict.fromkeys(order + keep))
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in keep])


def with_gold_audit(df: DataFrame, entity: str, ctx, hash_cols: list[str]) -> DataFrame:
    return df.select(
        "*",
        F.lit(entity).alias("gold_entity_name"),
        ctx.ts().alias("gold_created_ts"),
        record_hash(df, hash_cols).alias("gold_record_hash"),
    )


def zero(c: str, default=0) -> Column:
    return F.expr(f"coalesce(`{c}`, 0)") if default == 0 else F.coalesce(F.col(c), F.lit(default))


def card_bridge(m, *cols: str) -> DataFrame:
    """The card → account/customer bridge, pruned to the needed columns."""
    return m.silver("credit_cards").select("card_id", *cols)


def left_join_on_key(spine: DataFrame, key: str, sides: list[DataFrame]) -> DataFrame:
    """``spine LEFT JOIN side USING (key)`` for every side, in one scan.

    Spine rows with a NULL key can never match; they join under a key of their
    own, hashed from the row, so that a NULL key holding a large share of the
    rows spreads over all shuffle partitions."""
    own = F.concat(F.lit("\0"), F.xxhash64(*spine.columns).cast("string"))
    keyed = spine.withColumn("_key", F.coalesce(F.col(key).cast("string"), own))
    for side in sides:
        keyed = keyed.join(side.where(F.col(key).isNotNull()).withColumnRenamed(key, "_key"), "_key", "left")
    return keyed.drop("_key")
