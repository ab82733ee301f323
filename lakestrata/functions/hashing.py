"""Record hash: hex SHA-256 of the JSON text of a struct of typed values.

NULL fields are kept in the JSON.  Doubles are rendered in scientific notation
with 15 significant digits (as many as every double keeps), NaN and infinities
as words, and timestamps as ``yyyy-MM-dd HH:mm:ss``: a text for every value,
the same in every engine, not byte-equal to an engine's default JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

DOUBLE_FORMAT = "%.14e"
_JSON_OPTS = {"ignoreNullFields": "false"}


def _hash_field(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (DoubleType, FloatType)):
        c = F.when(c.isNotNull(), F.format_string(DOUBLE_FORMAT, c.cast("double")))
    elif isinstance(dt, (TimestampType, TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.alias(name)


def record_hash(df: DataFrame, cols: list[str] | tuple[str, ...]) -> Column:
    """``sha256(to_json(struct(cols)))`` as lowercase hex, over ``df``'s columns."""
    return F.sha2(F.to_json(F.struct(*[_hash_field(df, c) for c in cols]), _JSON_OPTS), 256)


def record_hash_sql(df: DataFrame, cols: list[str] | tuple[str, ...]) -> str:
    """SQL-expression form of :func:`record_hash`."""
    fields = []
    for name in cols:
        dt = df.schema[name].dataType
        ref = f"`{name}`"
        if isinstance(dt, (DoubleType, FloatType)):
            ref = f"CASE WHEN {ref} IS NOT NULL THEN format_string('{DOUBLE_FORMAT}', CAST({ref} AS DOUBLE)) END"
        elif isinstance(dt, (TimestampType, TimestampNTZType)):
            ref = f"date_format({ref}, 'yyyy-MM-dd HH:mm:ss')"
        fields.append(f"'{name}', {ref}")
    return f"sha2(to_json(named_struct({', '.join(fields)}), map('ignoreNullFields', 'false')), 256)"
