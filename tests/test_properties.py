"""Property-based checks (hypothesis) of the exact mean and the bucketed
previous-row operator against straightforward definitions."""

from collections import Counter
from datetime import datetime, timedelta
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from ampere.functions.numeric import exact_sum, half_even_quotient
from ampere.operators.join import asof_nearest
from ampere.operators.ordered import previous_row

T0 = datetime(2024, 1, 1)
SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

cents = st.integers(min_value=-10_000_000, max_value=10_000_000)


@settings(**SETTINGS)
@given(st.lists(st.lists(cents, min_size=1, max_size=40), min_size=1, max_size=4),
       st.sampled_from([0, 2, 6, 10]))
def test_exact_mean_matches_decimal(spark, groups, digits):
    rows = [(g, c / 100.0) for g, vals in enumerate(groups) for c in vals]
    df = spark.createDataFrame(rows, "g int, v double").repartition(3)
    agg = df.groupBy("g").agg(exact_sum("v").alias("s"), F.count("v").alias("n"))
    got = {r.g: r.m for r in agg.select("g", half_even_quotient("s", "n", digits).alias("m")).collect()}
    q = Decimal(1).scaleb(-digits)
    for g, vals in enumerate(groups):
        exp = (sum(Decimal(c) / 100 for c in vals) / len(vals)).quantize(q, ROUND_HALF_EVEN)
        assert got[g] == float(exp)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5 * 24 * 3600)), min_size=1, max_size=120,
                unique_by=lambda t: t), st.sampled_from([60, 900, 3600, 86400]))
def test_previous_row_matches_lag(spark, pts, bucket):
    rows = [("K%d" % k, T0 + timedelta(seconds=s), float(i)) for i, (k, s) in enumerate(pts)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    got = previous_row(df, "k", "ts", ["v"], bucket_seconds=bucket)
    exp = df.withColumn("lag", F.lag("v").over(Window.partitionBy("k").orderBy("ts")))
    j = got.join(exp, ["k", "ts"])
    assert j.count() == len(rows)
    assert j.where(~F.col("prev_v").eqNullSafe(F.col("lag"))).count() == 0


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 72).map(lambda k: k * 300), st.integers(0, 1)),
                min_size=1, max_size=60),
       st.lists(st.tuples(st.integers(0, 1), st.integers(0, 72).map(lambda k: k * 300),
                          st.one_of(st.none(), st.integers(0, 3))), min_size=0, max_size=40),
       st.sampled_from([600, 1800, 3600]), st.sampled_from([60, 900, 7200]))
def test_asof_matches_brute_force(spark, left, right, tol, bucket):
    """Repeated left rows stay, readings at the same time and ties in distance occur, values are null."""
    g = spark.createDataFrame([("K%d" % k, T0 + timedelta(seconds=s), float(v)) for k, s, v in left],
                              "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    wx = [("K%d" % k, T0 + timedelta(seconds=s), None if v is None else float(v)) for k, s, v in right]
    w = spark.createDataFrame(wx, "iso_code string, timestamp_utc timestamp_ntz, temperature double")
    got = Counter(map(tuple, asof_nearest(g, w, tolerance_seconds=tol, value_cols=["temperature"],
                                          bucket_seconds=bucket).collect()))
    want = Counter()
    for k, s, v in left:
        t = T0 + timedelta(seconds=s)
        cands = sorted(((abs((wt - t).total_seconds()), wt, wv is not None, wv or 0.0) for wk, wt, wv in wx
                        if wk == "K%d" % k and abs((wt - t).total_seconds()) <= tol))
        want[("K%d" % k, t, float(v), (cands[0][3] if cands[0][2] else None) if cands else None)] += 1
    assert got == want
