"""Bronze provider over in-memory rows (small hand-made inputs, tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from lakestrata.specs import SPECS

# Bronze columns that arrive as native booleans.
BOOL_COLUMNS = {
    "lounge_access", "travel_insurance", "waived", "delivered", "read", "bank_liability",
}


def bronze_schema(table: str) -> StructType:
    """Bronze schema used by fixtures: cast columns as STRING (so cast
    failures can be planted), ``is_*`` and the listed flags as BOOLEAN."""
    fields = []
    for name, label in SPECS[table].columns:
        is_bool = label is None and (name.startswith("is_") or name in BOOL_COLUMNS)
        fields.append(StructField(name, BooleanType() if is_bool else StringType(), True))
    return StructType(fields)


def bronze_frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = bronze_schema(table)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


class FrameBronze:
    """``table(name)`` over given frames; unlisted tables are empty."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame | list[dict]]):
        self.spark = spark
        self.frames = {k: v if isinstance(v, DataFrame) else bronze_frame(spark, k, v) for k, v in frames.items()}

    def table(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = bronze_frame(self.spark, name, [])
        return self.frames[name]
