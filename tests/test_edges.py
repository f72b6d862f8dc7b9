"""FIXTURES.md section 4 edge cases, per operator."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
from pyspark.sql import Window, functions as F

from ampere.functions.numeric import exact_sum, half_even_quotient, round_half_even
from ampere.functions.timeparse import local_to_utc, parse_mixed_timestamp
from ampere.operators import forecast as fc
from ampere.operators import anomaly as an
from ampere.operators import service as sv
from ampere.operators import validate as vl
from ampere.operators.join import asof_nearest
from ampere.operators.ordered import previous_row
from ampere.operators.quantile import exact_quantiles

T0 = datetime(2024, 3, 1, 12, 0, 0)
G = "iso_code string, timestamp_utc timestamp_ntz, load_mw double"
WX = "iso_code string, timestamp_utc timestamp_ntz, temperature double, wind_speed double, humidity double"


def _asof(spark, grid_rows, wx_rows):
    g = spark.createDataFrame(grid_rows, G)
    w = spark.createDataFrame(wx_rows, WX)
    out = asof_nearest(g, w, value_cols=["temperature", "wind_speed", "humidity"])
    return {(r.iso_code, r.timestamp_utc): r for r in out.collect()}


def test_asof_edges(spark):
    us = timedelta(microseconds=1)
    grid = [("A", T0, 1.0),                                  # exact match
            ("A", T0 + timedelta(hours=5), 2.0),             # tie: 30 min before / after
            ("A", T0 + timedelta(hours=10), 3.0),            # gap of exactly 60 min
            ("A", T0 + timedelta(hours=20), 4.0),            # 60 min + 1 us: no match
            ("A", T0 + timedelta(hours=30), 5.0),            # two weather rows at one instant
            ("A", T0 + timedelta(hours=40), 6.0),            # matched row with null temperature
            ("B", T0, 7.0)]                                  # key without weather
    wx = [("A", T0, 10.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=5, minutes=-30), 11.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=5, minutes=30), 12.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=9), 13.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=19) - us, 14.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=30, minutes=10), 16.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=30, minutes=10), 15.0, 1.0, 50.0),
          ("A", T0 + timedelta(hours=40, minutes=5), None, 2.0, 60.0)]
    m = _asof(spark, grid, wx)
    assert m[("A", T0)].temperature == 10.0
    assert m[("A", T0 + timedelta(hours=5))].temperature == 11.0       # earlier row wins the tie
    assert m[("A", T0 + timedelta(hours=10))].temperature == 13.0      # tolerance inclusive
    assert m[("A", T0 + timedelta(hours=20))].temperature is None      # just outside
    assert m[("A", T0 + timedelta(hours=30))].temperature == 15.0      # fixed tie key: values
    r = m[("A", T0 + timedelta(hours=40))]
    assert r.temperature is None and r.wind_speed == 2.0               # null kept, row matched
    assert m[("B", T0)].temperature is None and len(m) == 7


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    grid = [("K%d" % rnd.randint(0, 2), T0 + timedelta(seconds=rnd.randint(0, 86400 * 3)), float(i))
            for i in range(400)]
    grid = list({(k, t): (k, t, v) for k, t, v in grid}.values())
    wx = [("K%d" % rnd.randint(0, 2), T0 + timedelta(seconds=rnd.randint(0, 86400 * 3)),
           float(i), 1.0, 1.0) for i in range(120)]
    got = _asof(spark, grid, wx)
    for k, t, _ in grid:
        cands = [(abs((wt - t).total_seconds()), wt, temp) for wk, wt, temp, *_ in wx
                 if wk == k and abs((wt - t).total_seconds()) <= 3600]
        exp = min(cands)[2] if cands else None
        assert got[(k, t)].temperature == exp


def test_previous_row_equals_lag(spark):
    rnd = random.Random(3)
    rows = [("K%d" % rnd.randint(0, 3), T0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), float(i))
            for i in range(600)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())
    df = spark.createDataFrame(rows, G).repartition(7)
    got = previous_row(df, "iso_code", "timestamp_utc", ["load_mw"], bucket_seconds=1800)
    exp = df.withColumn("lag", F.lag("load_mw").over(Window.partitionBy("iso_code").orderBy("timestamp_utc")))
    j = got.join(exp, ["iso_code", "timestamp_utc"])
    assert j.where(~F.col("prev_load_mw").eqNullSafe(F.col("lag"))).count() == 0
    assert j.count() == len(rows)


def test_forecast_edges(spark):
    # ISO "S" has < 24 rows (skipped); ISO "A": 30 rows in one day (no
    # prior-day rows -> trend 1.0), one hour seen once (null std), most
    # future slots unseen (ISO mean).
    rows = [("S", T0 + timedelta(hours=i), 100.0) for i in range(10)]
    rows += [("A", T0 + timedelta(minutes=30 * i), 1000.0 + i) for i in range(30)]
    out = fc.seasonal_forecast(spark.createDataFrame(rows, G), lookback_hours=None).collect()
    assert {r.iso_code for r in out} == {"A"} and len(out) == 24
    mean = sum(1000.0 + i for i in range(30)) / 30
    by_ts = {r.timestamp_utc: r for r in out}
    last = T0 + timedelta(minutes=30 * 29)
    unseen = by_ts[last + timedelta(hours=20)]   # 2024-03-02 ~02:30, a Saturday slot never seen
    assert abs(unseen.forecasted_load_mw - mean) < 1e-6
    assert abs(unseen.ci_lower - mean * 0.9) < 1e-6 and abs(unseen.ci_upper - mean * 1.1) < 1e-6
    assert all(r.model_version == "simple_v1" and r.confidence == 0.95 for r in out)


def test_anomaly_edges(spark):
    few = [("F", T0 + timedelta(hours=i), 100.0) for i in range(49)]                 # < 50 rows
    const = [("C", T0 + timedelta(hours=i), 500.0) for i in range(60)]               # std 0
    df = spark.createDataFrame(few + const, G).withColumn("temperature", F.lit(None).cast("double"))
    scored = an.score_rows(df, use_forest=False).collect()
    assert {r.iso_code for r in scored} == {"C"}
    assert not any(r.is_statistical_outlier for r in scored)
    first = min(scored, key=lambda r: r.timestamp_utc)
    assert first.load_change_pct is None and not first.is_rapid_change


def test_isolation_forest_properties(spark):
    from ampere.operators.forest import isolation_forest_flags
    rnd = random.Random(1)
    rows = [("A", T0 + timedelta(hours=i), 1000.0 + rnd.gauss(0, 30)) for i in range(600)]
    rows += [("A", T0 + timedelta(hours=600 + i), 5000.0 + i) for i in range(5)]
    df = spark.createDataFrame(rows, G).withColumns({"hour_of_day": F.hour("timestamp_utc"),
                                                     "day_of_week": F.weekday("timestamp_utc")})
    a = isolation_forest_flags(df).select("timestamp_utc", "is_isolation_anomaly", "anomaly_score")
    b = isolation_forest_flags(df.repartition(5)).select("timestamp_utc", "is_isolation_anomaly",
                                                         "anomaly_score")
    ra = {r.timestamp_utc: r for r in a.collect()}
    rb = {r.timestamp_utc: r for r in b.collect()}
    assert ra.keys() == rb.keys()
    assert all(ra[k].is_isolation_anomaly == rb[k].is_isolation_anomaly for k in ra)   # partition free
    share = sum(r.is_isolation_anomaly for r in ra.values()) / len(ra)
    assert 0.03 <= share <= 0.06
    spikes = [ra[T0 + timedelta(hours=600 + i)] for i in range(5)]
    assert all(s.is_isolation_anomaly for s in spikes)


def test_local_to_utc_dst(spark):
    cases = [(datetime(2025, 3, 9, 2, 30), datetime(2025, 3, 9, 7, 0)),     # gap -> transition
             (datetime(2025, 11, 2, 1, 30), None),                          # ambiguous -> null
             (datetime(2025, 3, 9, 1, 30), datetime(2025, 3, 9, 6, 30)),
             (datetime(2025, 3, 9, 3, 30), datetime(2025, 3, 9, 7, 30)),
             (datetime(2025, 11, 2, 0, 30), datetime(2025, 11, 2, 4, 30)),
             (datetime(2025, 11, 2, 2, 30), datetime(2025, 11, 2, 7, 30)),
             (datetime(2025, 6, 1, 12, 0), datetime(2025, 6, 1, 16, 0))]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t timestamp_ntz")
    got = [r.u for r in df.select(local_to_utc("t", "America/New_York").alias("u")).collect()]
    assert got == [b for _, b in cases]


def test_parse_mixed_timestamp(spark):
    def run(vals):
        df = spark.createDataFrame([(v,) for v in vals], "x string")
        return [r.t for r in df.select(parse_mixed_timestamp(df, "x").alias("t")).collect()]
    assert run(["2024-01-02 03:04:05", "junk"]) == [datetime(2024, 1, 2, 3, 4, 5), None]
    assert run(["45292.5", "45293"]) == [datetime(2024, 1, 1, 12, 0), datetime(2024, 1, 2)]   # Excel days
    assert run(["1704067200000"]) == [datetime(2024, 1, 1)]                                     # epoch ms
    assert run(["1704067200", "x"]) == [datetime(2024, 1, 1), None]                              # epoch s
    assert run(["junk", "more junk"]) == [None, None]


def test_counter_reset_inside_window(spark):
    t = datetime(2024, 1, 1, 0, 0, 0)
    rows = [(t + timedelta(seconds=s), "api", v, i) for i, (s, v) in
            enumerate([(0, 10.0), (60, 15.0), (120, 3.0), (180, 8.0), (400, 9.0)])]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, endpoint string, c double, id long")
    out = {r.window_start: r.increase for r in sv.counter_increase(df, "endpoint", "ts", "c", tie=("id",)).collect()}
    assert out[t] == 5.0 + 3.0 + 5.0                      # 10->15, reset to 3, 3->8
    assert out[t + timedelta(minutes=5)] == 1.0           # 8 -> 9 across the window edge


def test_validation_edges(spark):
    empty = spark.createDataFrame([], "load_mw double")
    rep = {r.check: r for r in vl.check_table(empty, "t", vl.SILVER_GRID_CHECKS).collect()}
    assert not rep["non_empty"].passed and rep["null_ratio"].value is None and not rep["null_ratio"].passed
    rows = [(None,)] + [(1.0,)] * 9                     # ratio exactly 0.10
    df = spark.createDataFrame(rows, "temperature double")
    r = vl.check_table(df, "t", [vl.Check("null_ratio", "temperature", 0.10)]).collect()[0]
    assert r.value == 0.1 and r.passed


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(5)
    vals = np.round(rnd.normal(100, 20, 997), 2)
    df = spark.createDataFrame([("k", float(v)) for v in vals], "k string, v double")
    q = exact_quantiles(df, "k", "v", [0.05, 0.25, 0.5, 0.75], ["a", "b", "c", "d"]).collect()[0]
    for name, p in zip("abcd", [5, 25, 50, 75]):
        assert abs(getattr(q, name) - np.percentile(vals, p)) < 1e-9


def test_half_even_quotient(spark):
    rows = [(k, v) for k, vs in {"a": [49.90, 49.91], "b": [0.01, 0.02, 0.03], "c": [1.005, 2.0]}.items()
            for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    g = df.groupBy("k").agg(exact_sum("v").alias("s"), F.count("v").alias("n"))
    out = {r.k: r.m for r in g.select("k", half_even_quotient("s", "n", 2).alias("m")).collect()}
    for k, vs in {"a": [49.90, 49.91], "b": [0.01, 0.02, 0.03], "c": [1.005, 2.0]}.items():
        exp = (sum(Decimal(str(v)) for v in vs) / len(vs)).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
        assert out[k] == float(exp)
    for x in (2.675, 0.125, 1.005, 49.905, -3.335):
        assert spark.range(1).select(round_half_even(F.lit(x), 2)).first()[0] == float(np.round(x, 2))


def test_exact_quantiles_refinement_passes(spark):
    # force several refinement passes with a tiny direct_max / bucket count
    rnd = np.random.default_rng(11)
    vals = rnd.normal(0, 1, 3000)
    vals[:500] = 0.25                                    # heavy ties
    rows = [("a", float(v)) for v in vals] + [("b", 7.0)] * 50 + [("c", 1.0), ("c", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    q = {r.k: r for r in exact_quantiles(df, "k", "v", [0.05, 0.5, 0.95], ["a", "b", "c"],
                                         buckets=8, direct_max=40).collect()}
    for name, p in zip("abc", [5, 50, 95]):
        assert abs(getattr(q["a"], name) - np.percentile(vals, p)) < 1e-12
        assert getattr(q["b"], name) == 7.0
        assert abs(getattr(q["c"], name) - np.percentile([1.0, 2.0], p)) < 1e-12


def test_forecast_api_shapes(spark):
    rows = [(iso, T0 + timedelta(hours=i), 100.0 + i + (5 if iso == "B" else 0))
            for iso in ("A", "B") for i in range(72)]
    f = fc.seasonal_forecast(spark.createDataFrame(rows, G), lookback_hours=None)
    wide = {r.hours_ahead: r for r in fc.forecast_compare_wide(f, 3).collect()}
    assert sorted(wide) == [1, 2, 3]
    assert sorted(wide[1].forecasts.keys()) == ["A", "B"]
    nested = fc.with_ci_struct(fc.forecast_by_iso(f, "a", 5)).collect()
    assert len(nested) == 5 and all(r.confidence_interval.lower <= r.forecasted_load_mw
                                    <= r.confidence_interval.upper for r in nested)
