"""medallion_layer_mapping: the mapping seed reshaped for reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = (
    "source_layer source_object source_columns target_layer target_object target_columns mapping_category "
    "primary_key foreign_keys cast_rules dq_rules audit_rules business_purpose output_dataset dbt_model "
    "implementation"
).split()


def medallion_layer_mapping(seed: DataFrame, ctx) -> DataFrame:
    layer_order = (
        F.when(F.col("target_layer") == "silver", 1).when(F.col("target_layer") == "gold", 2).otherwise(0)
    )
    return seed.select(
        *KEPT,
        layer_order.alias("layer_order"),
        (F.col("implementation") == "Complete").alias("is_implemented"),
        ctx.ts().alias("report_generated_at"),
    ).orderBy("layer_order", "source_layer", "source_object")
