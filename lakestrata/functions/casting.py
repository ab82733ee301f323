"""``safe_cast``: convert, NULL instead of failing.

Spark's ``try_cast`` is more permissive than the reference's casts for a few
string forms (``'2024'`` → a date, ``'1d'`` → a double, ``'10:00'`` → today
at 10:00), so string inputs go through a strict format guard first.  The guard
is a regex evaluated by the JVM inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql.types import DataType, StringType

from lakestrata.specs import SPARK_TYPES

# Accepted textual forms per target type.
INT_PATTERN = r"^\s*[+-]?\d+\s*$"
FLOAT_PATTERN = (
    r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[Nn][Aa][Nn]|[Ii][Nn][Ff]([Ii][Nn][Ii][Tt][Yy])?)\s*$"
)
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIMESTAMP_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
# A time with a zone is an instant; it becomes UTC wall-clock time.  Zones: Z or
# UTC, an offset of hours, or hours and minutes with or without a colon, or a
# region's name after a blank.
ZONED_PATTERN = (
    r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
    r"( ?(Z|UTC)|[+-]\d{1,2}(:\d{2})?|[+-]\d{4}| [A-Z][A-Za-z_]+(/[A-Z][A-Za-z0-9_+-]+)+)$"
)
# Hours without a second digit, which zone names have: +2:30 is +02:30.
SHORT_OFFSET = r"([+-])(\d(:\d{2})?)$"
# Spark reads a zone after seconds only.
NO_SECONDS = r"^(\S+[ T]\d{1,2}:\d{2})(?=[^:\d])"

GUARDS = {"INT64": INT_PATTERN, "FLOAT64": FLOAT_PATTERN, "DATE": DATE_PATTERN, "TIMESTAMP": TIMESTAMP_PATTERN}


def safe_cast_sql(col_sql: str, label: str, source_type: DataType | None = None) -> str:
    """SQL expression that casts ``col_sql`` to the reference type ``label``;
    NULL when it does not convert.

    ``source_type`` is the bronze column's type: only strings are guarded.
    Doubles converted to integers round half away from zero, as the reference
    engine does (Spark truncates).  Zoned timestamps are converted to UTC (the
    session zone is UTC) and kept as wall-clock time; an unknown region or an
    impossible offset is NULL.
    """
    target = SPARK_TYPES[label]
    if source_type is None or isinstance(source_type, StringType):
        plain = f"WHEN {col_sql} RLIKE r'{GUARDS[label]}' THEN try_cast({col_sql} AS {target})"
        if label != "TIMESTAMP":
            return f"CASE {plain} END"
        # the date's own hyphens come before a time, so that only the offset is at the end
        padded = f"regexp_replace(regexp_replace({col_sql}, r'{NO_SECONDS}', '$1:00'), r'{SHORT_OFFSET}', '$10$2')"
        return f"CASE {plain} WHEN {col_sql} RLIKE r'{ZONED_PATTERN}' THEN CAST(try_cast({padded} AS TIMESTAMP_LTZ) AS {target}) END"
    if label == "INT64" and source_type.typeName() in ("double", "float", "decimal"):
        return f"try_cast(round({col_sql}) AS {target})"
    return f"try_cast({col_sql} AS {target})"
