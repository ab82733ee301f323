"""Property: the guarded cast gives the same value in Spark and in the DuckDB
oracle for arbitrary short strings (each engine has its own guard)."""

import math

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.functions.casting import safe_cast_sql
from lakestrata.oracle.builder import cast

ALPHABET = "0123456789+-.eE x,/:NaIifn"
texts = st.one_of(
    st.text(alphabet=ALPHABET, max_size=8),
    st.from_regex(r"\A(19|20)\d{2}-[01]?\d-[0-3]?\d( \d{2}:\d{2}:\d{2})?\Z"),
    st.from_regex(r"\A20\d{2}-[01]\d-[0-2]\d[ T]\d{2}:\d{2}(:\d{2})?(Z| UTC|[+-]0\d:[0-5]\d)?\Z"),
    st.from_regex(r"\A\s?[+-]?\d{1,6}(\.\d{0,3})?\s?\Z"),
)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


@settings(max_examples=8, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_guarded_cast_agrees_with_oracle(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    con = duckdb.connect()
    for label in ("INT64", "FLOAT64", "DATE", "TIMESTAMP"):
        got = {r["i"]: r["y"] for r in df.select("i", F.expr(safe_cast_sql("x", label)).alias("y")).collect()}
        for i, v in enumerate(values):
            want = con.execute(f"SELECT {cast('x', label)} FROM (SELECT ?::VARCHAR AS x)", [v]).fetchone()[0]
            assert _same(got[i], want), (label, v, got[i], want)
