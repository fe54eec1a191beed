"""Property tests: operators against brute-force references on random inputs.

Each example is one Spark job over a whole batch of random rows.
"""

import re
import unicodedata
from decimal import Decimal

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import exact_sum, round_half_away, safe_name
from ledgerline.operators import dedup

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

prices = st.floats(min_value=0.0, max_value=1e7, allow_nan=False, allow_infinity=False)
quantities = st.integers(min_value=0, max_value=10_000)


@SETTINGS
@given(st.lists(st.tuples(prices, quantities), min_size=1, max_size=300))
def test_round_half_away_equals_sql_round(spark, rows):
    df = spark.createDataFrame(rows, "price double, q long")
    got = [r[0] for r in df.select(round_half_away(F.col("price") * F.col("q"), 2)).collect()]
    pdf = pd.DataFrame(rows, columns=["price", "q"])
    want = duckdb.sql("SELECT ROUND(price * q, 2) FROM pdf").fetchall()
    assert got == [w[0] for w in want]


@SETTINGS
@given(st.lists(st.decimals(min_value=-1e9, max_value=1e9, places=2, allow_nan=False), min_size=0, max_size=300))
def test_exact_sum_equals_decimal_sum(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = df.repartition(5).agg(exact_sum("x").alias("s")).first()["s"]
    if not values:
        assert got is None
    else:
        assert got == float(sum(Decimal(str(float(v))) for v in values))


def _python_safe_name(s):
    folded = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^A-Za-z0-9_.-]", "_", folded)


@SETTINGS
@given(st.lists(st.text(max_size=40), min_size=1, max_size=200))
def test_safe_name_equals_python_rule(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(safe_name("n")).collect()]
    assert got == [_python_safe_name(n) for n in names]


keys = st.integers(min_value=0, max_value=15)
maybe_int = st.one_of(st.none(), st.integers(min_value=-50, max_value=50))
statuses = st.one_of(st.none(), st.sampled_from(["instock", "outofstock", "onbackorder"]))


@SETTINGS
@given(st.lists(st.tuples(keys, maybe_int, statuses), min_size=1, max_size=200))
def test_max_per_key_equals_pandas(spark, rows):
    df = spark.createDataFrame(rows, "k long, q long, s string")
    got = {r["k"]: (r["q"], r["s"]) for r in dedup.max_per_key(df, "k", ["q", "s"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "q", "s"])
    want = {}
    for k, g in pdf.groupby("k"):
        q = g["q"].dropna()
        s = g["s"].dropna()
        want[k] = (int(q.max()) if len(q) else None, s.max() if len(s) else None)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 999).map(str))), min_size=1, max_size=200))
def test_min_link_orderings(spark, rows):
    df = spark.createDataFrame(rows, "k long, t string")
    text = {r["k"]: r["t"] for r in dedup.min_link(df, "k", "t", "text").collect()}
    num = {r["k"]: r["t"] for r in dedup.min_link(df, "k", "t", "numeric").collect()}
    groups = {}
    for k, t in rows:
        groups.setdefault(k, []).append(t)
    for k, ts in groups.items():
        vals = [t for t in ts if t is not None]
        assert text[k] == (min(vals) if vals else None)
        assert num[k] == (min(vals, key=int) if vals else None)


@SETTINGS
@given(
    st.lists(
        st.tuples(keys, st.one_of(st.none(), st.integers(0, 20)), st.sampled_from(["product", "other"])),
        min_size=1,
        max_size=200,
    )
)
def test_latest_per_key_equals_brute_force(spark, rows):
    data = [(k, t, p, i) for i, (k, t, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, t long, p string, id long")
    out = dedup.latest_per_key(df, "k", "t", tie_breakers=["id"], where=F.col("p") == "product")
    got = {r["k"]: r["id"] for r in out.collect()}
    want = {}
    for k, t, p, i in data:
        if p != "product":
            continue
        best = want.get(k)
        rank = (t is not None, t if t is not None else 0, i)
        if best is None or rank > best[0]:
            want[k] = (rank, i)
    assert got == {k: v[1] for k, v in want.items()}
