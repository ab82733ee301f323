"""DuckDB oracle SQL: every registered query as one statement over the driver's
tables.

Relations are named CTEs with explicit dependencies; ``statement(name)`` emits
``WITH <all transitive deps in order> SELECT * FROM name``.  Columns, checks and
tests come from ``fixed_values``, casts are guarded in DuckDB's own way, and only
the derivation of the bronze fixtures is shared with the engine.
"""

from __future__ import annotations

import re

from lakestrata.context import FIXED_AS_OF_DATE, FIXED_RUN_TS
from lakestrata.oracle import fixed_values
from lakestrata.sources.fixture_sql import BRONZE, DRIVER_TABLES, HELPERS

TS = f"TIMESTAMP '{FIXED_RUN_TS}'"
AS_OF = f"DATE '{FIXED_AS_OF_DATE}'"

#: DuckDB's forms of the fixtures' dialect names.
DIALECT = {"q_read": '"read"', "each_2": "unnest([1,2])", "each_3": "unnest([1,2,3])"}


def lines(text: str) -> list[list[str]]:
    """The fields of each line of a block of fixed values."""
    return [[x.strip() for x in line.split("|")] for line in text.splitlines() if line.strip()]


def cast(x: str, label: str) -> str:
    """The typed value of the text ``x``, NULL where it has another form."""
    if label == "INT64":
        return f"CASE WHEN regexp_full_match(trim({x}), '[-+]?[0-9]+') THEN TRY_CAST(trim({x}) AS BIGINT) END"
    if label == "DATE":
        return f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}(-[0-9][0-9]?){{2}}') THEN TRY_CAST({x} AS DATE) END"
    if label == "TIMESTAMP":
        day, time = "[0-9]{4}(-[0-9][0-9]?){2}", "[0-9][0-9]?:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
        part = lambda k: f"regexp_extract({x}, '^({day}[ T]{time}) ?([-+])?([0-9]{{1,2}}|[A-Z][A-Za-z_/+-]+)?:?([0-9]{{2}})?$', {k})"
        local, sign, hours, rest = part(1), part(5), part(6), part(7)
        minutes = f"TRY_CAST({sign} || '1' AS INT) * (60 * TRY_CAST({hours} AS INT) + coalesce(TRY_CAST({rest} AS INT), 0))"
        ahead = f"WHEN regexp_full_match({x}, '{day}[ T]{time}[-+]([0-9]{{1,2}}(:[0-9]{{2}})?|[0-9]{{4}})') THEN TRY_CAST({local} AS TIMESTAMP) - to_minutes({minutes})"
        known = f"{hours} IN (SELECT name FROM pg_timezone_names())"
        region = f"WHEN regexp_full_match({x}, '{day}[ T]{time} [A-Z][A-Za-z_]+(/[A-Z][A-Za-z_+-]+)+') THEN CASE WHEN {known} THEN timezone('UTC', timezone({hours}, TRY_CAST({local} AS TIMESTAMP))) END"
        return f"CASE {ahead} {region} WHEN regexp_full_match({x}, '{day}([ T]{time}( ?(Z|UTC))?)?') THEN TRY_CAST({x} AS TIMESTAMP) END"
    words = "'nan', 'inf', 'infinity', '+nan', '-nan', '+inf', '-inf', '+infinity', '-infinity'"
    number = "[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[-+]?[0-9]+)?"
    return f"CASE WHEN lower(trim({x})) IN ({words}) OR regexp_full_match(lower(trim({x})), '{number}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


class Registry:
    def __init__(self):
        self.sql: dict[str, str] = {}
        self.deps: dict[str, list[str]] = {}

    def add(self, name: str, sql: str, deps: list[str] | None = None) -> None:
        self.sql[name] = sql
        if deps is None:
            words = set(_NAME.findall(sql))
            deps = [d for d in self.sql if d in words and d != name]
        self.deps[name] = deps

    def order(self, name: str) -> list[str]:
        seen: list[str] = []

        def visit(n: str) -> None:
            if n in seen or n in DRIVER_TABLES:
                return
            for d in self.deps[n]:
                visit(d)
            seen.append(n)

        visit(name)
        return seen

    def statement(self, name: str, final: str | None = None) -> str:
        ctes = ",\n".join(f"{n} AS MATERIALIZED (\n{self.sql[n]}\n)" for n in self.order(name))
        return f"WITH {ctes}\n{final or f'SELECT * FROM {name}'}"


def hash_expr(cols: list[str], types: dict[str, str]) -> str:
    parts = []
    for c in cols:
        q = f'"{c}"'
        if types.get(c) == "FLOAT64":
            words = f"WHEN isnan({q}) THEN 'NaN' WHEN isinf({q}) THEN CASE WHEN {q} > 0 THEN 'Infinity' ELSE '-Infinity' END"
            q = f"CASE {words} WHEN {q} IS NOT NULL THEN printf('%.14e', {q}) END"
        elif types.get(c) == "TIMESTAMP":
            q = f"strftime({q}, '%Y-%m-%d %H:%M:%S')"
        parts.append(f"'{c}': {q}")
    return "sha256(to_json({" + ", ".join(parts) + "}))"


def silver_sql(line: list[str]) -> str:
    """Typed columns over raw ones, a list of error codes, audit columns."""
    table, _, columns, required, unflagged, hashed = line
    typed = [c.split(":") for c in columns.split()]
    labels = {c[0]: c[1] for c in typed if len(c) > 1}
    values = ", ".join(f'{cast(f"""raw."{c[0]}\"""", c[1])} AS "{c[0]}"' if len(c) > 1 else f'raw."{c[0]}"' for c in typed)
    codes = [f"CASE WHEN t.\"{c}\" IS NULL THEN 'REQUIRED_NULL:{c}' END" for c in required.split()]
    codes += [f"CASE WHEN t.\"{c}\" IS NULL AND t._raw.\"{c}\" IS NOT NULL THEN 'CAST_FAILED:{c}:{label}' END" for c, label in labels.items() if c not in unflagged.split()]
    names = ", ".join(f'"{c[0]}"' for c in typed)
    return f"""SELECT {names}, 'SYNTHETIC_CARD_PLATFORM' AS audit_source_system, '{table}' AS audit_source_table,
  {TS} AS audit_insert_ts, {TS} AS audit_update_ts, {hash_expr(hashed.split(), labels)} AS audit_record_hash, {TS} AS dq_checked_at,
  CAST(len(codes) AS INTEGER) AS dq_error_count, array_to_string(codes, '|') AS dq_errors, if(len(codes) = 0, 'PASS', 'FAIL') AS dq_status
FROM (SELECT *, list_filter([{', '.join(codes)}], lambda x: x IS NOT NULL) AS codes FROM (SELECT {values}, raw AS _raw FROM {table} raw) t) u"""


def base_registry() -> Registry:
    r = Registry()
    for name, text in (HELPERS | BRONZE).items():
        r.add(name, text.format(**{k: DIALECT.get(k, k) for k in re.findall(r"\{(\w+)\}", text)}))
    for line in lines(fixed_values.TABLES):
        r.add(f"silver_{line[0]}", silver_sql(line), deps=[line[0]])
    return r
