"""Quality metrics taken while a silver table is written (``Observation``).

The table's error codes are known from its spec, so that the rows of
``dq_summary`` are a fixed set of counters beside the write, and no table is
read again for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestrata.specs import TableSpec

SUMMARY_DDL = "table_name string, dq_status string, error_code string, row_count long"


@dataclass(frozen=True)
class Observed:
    """``rows`` carry the counters; they have values once an action has read all rows."""

    rows: DataFrame
    seen: Observation
    codes: list[str]


def error_codes(spec: TableSpec) -> list[str]:
    """All codes that the rows of a table can have."""
    return [f"REQUIRED_NULL:{c}" for c in spec.required] + [f"CAST_FAILED:{c}:{label}" for c, label in spec.flagged_casts]


def observed(silver: DataFrame, spec: TableSpec) -> Observed:
    codes = error_codes(spec)
    seen = Observation()
    held = F.concat(F.lit("|"), F.col("dq_errors"), F.lit("|"))
    counters = [F.count_if(F.col("dq_errors") == "").alias("passed")]
    counters += [F.count_if((F.col("dq_errors") != "") & F.contains(held, F.lit(f"|{code}|"))).alias(f"code_{i}") for i, code in enumerate(codes)]
    return Observed(silver.observe(seen, *counters), seen, codes)


def dq_summary_of(spark: SparkSession, watched: dict[str, Observed]) -> DataFrame:
    """``operators.silver.dq_summary`` of all tables, from the counters of their writes."""
    found = []
    for table, w in watched.items():
        counts = w.seen.get
        found.append((f"silver_{table}", "PASS", "", counts["passed"]))
        found += [(f"silver_{table}", "FAIL", code, counts[f"code_{i}"]) for i, code in enumerate(w.codes)]
    return spark.createDataFrame([x for x in found if x[3]], SUMMARY_DDL)
