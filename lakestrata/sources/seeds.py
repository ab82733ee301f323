"""Seeds: small reference CSVs loaded as all-string tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

MAPPING_COLUMNS = (
    "source_layer source_object source_columns target_layer target_object target_columns mapping_category "
    "primary_key foreign_keys source_to_target_mapping join_rules aggregation_rules cast_rules dq_rules "
    "audit_rules transformation_logic business_purpose output_dataset dbt_model implementation"
).split()
RELATIONSHIP_COLUMNS = "child_table fk_column parent_table pk_column cardinality notes".split()


def string_schema(cols: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_seed_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A header CSV with quoted fields (commas inside quotes), every column a
    string, no type inference."""
    return spark.read.csv(path, header=True, schema=string_schema(columns), quote='"', escape='"', multiLine=False)


# ---------------------------------------------------------------------------
# The declared parent/child relationships of the card model
# (child_table, fk_column, parent_table, pk_column, cardinality), in the
# reference's seed order (F01..F37).
# ---------------------------------------------------------------------------
RELATIONSHIPS = [
    ("addresses", "customer_id", "customers", "customer_id", "many-to-one"),
    ("accounts", "customer_id", "customers", "customer_id", "many-to-one"),
    ("credit_cards", "customer_id", "customers", "customer_id", "many-to-one"),
    ("credit_cards", "account_id", "accounts", "account_id", "many-to-one"),
    ("credit_cards", "card_type_id", "dim_card_types", "card_type_id", "many-to-one"),
    ("merchants", "mcc_code", "dim_merchant_categories", "mcc_code", "many-to-one"),
    ("transactions", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("transactions", "merchant_id", "merchants", "merchant_id", "many-to-one"),
    ("transactions", "txn_type_id", "dim_transaction_types", "txn_type_id", "many-to-one"),
    ("transactions", "mcc_code", "dim_merchant_categories", "mcc_code", "many-to-one"),
    ("statements", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("payments", "statement_id", "statements", "statement_id", "many-to-one"),
    ("payments", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("fees", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("fees", "transaction_id", "transactions", "transaction_id", "many-to-one (nullable)"),
    ("fraud_alerts", "transaction_id", "transactions", "transaction_id", "many-to-one"),
    ("fraud_alerts", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("disputes", "transaction_id", "transactions", "transaction_id", "many-to-one"),
    ("disputes", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("chargeback_cases", "dispute_id", "disputes", "dispute_id", "many-to-one"),
    ("chargeback_cases", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("velocity_hits", "rule_id", "dim_velocity_rules", "rule_id", "many-to-one"),
    ("velocity_hits", "transaction_id", "transactions", "transaction_id", "many-to-one"),
    ("velocity_hits", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("merchant_blacklist", "merchant_id", "merchants", "merchant_id", "many-to-one"),
    ("rewards", "card_id", "credit_cards", "card_id", "one-to-one"),
    ("rewards", "customer_id", "customers", "customer_id", "many-to-one"),
    ("reward_redemptions", "reward_id", "rewards", "reward_id", "many-to-one"),
    ("reward_redemptions", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("reward_redemptions", "customer_id", "customers", "customer_id", "many-to-one"),
    ("kyc_documents", "customer_id", "customers", "customer_id", "many-to-one"),
    ("contact_history", "customer_id", "customers", "customer_id", "many-to-one"),
    ("emi_plans", "transaction_id", "transactions", "transaction_id", "many-to-one"),
    ("emi_plans", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("notifications", "customer_id", "customers", "customer_id", "many-to-one"),
    ("credit_limit_history", "card_id", "credit_cards", "card_id", "many-to-one"),
    ("interest_rates", "card_id", "credit_cards", "card_id", "many-to-one"),
]


def relationships_frame(spark: SparkSession) -> DataFrame:
    rows = [r + ("",) for r in RELATIONSHIPS]
    return spark.createDataFrame(rows, string_schema(RELATIONSHIP_COLUMNS))
