"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """``countif``: rows where ``cond`` is true (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def string_agg_distinct(name: str, sep: str = ",") -> Column:
    """``string_agg(distinct c order by c)`` of the column ``name``: NULLs
    skipped, NULL for an all-NULL group.

    Spark plans the distinct aggregate as rows of (group, value) that are made
    distinct first, by hash aggregates that merge map-side and spill, so that
    only a group's distinct values meet in one buffer, as its result does."""
    return F.expr(f"listagg(DISTINCT `{name}`, '{sep}') WITHIN GROUP (ORDER BY `{name}`)")
