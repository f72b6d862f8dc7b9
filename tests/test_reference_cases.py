"""The reference's unit cases (literal frames), run through our operators.

Two reference expectations are wrong by construction and are replaced by
the correct value (see FIXTURES.md): the daily count is computed here, and
a 5-point sample cannot reach |z| > 3 (max (n-1)/sqrt(n) = 1.79)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ampere.functions.timecols import time_features
from ampere.operators import aggregate as agg
from ampere.operators import anomaly as an
from ampere.operators import clean as cl
from ampere.operators.ordered import with_change

T0 = datetime(2025, 11, 22, 14, 0, 0)


def test_timestamp_parsing(spark):
    df = spark.createDataFrame([("2025-11-22 14:00:00", 1000), ("2025-11-22 15:00:00", 1100)],
                               "timestamp string, load int")
    out = cl.coerce_types(df, {"timestamp": "timestamp"})
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"
    assert out.where(F.col("timestamp").isNotNull()).count() == 2


def test_load_range(spark):
    rows = [(T0 + timedelta(hours=i), "CAISO", float(v))
            for i, v in enumerate([1000, -50, 1100, 2000000, 1050])]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, iso_code string, load_mw double")
    kept = cl.clean_grid(df).collect()
    assert len(kept) == 3
    assert all(0 < r.load_mw < 1_000_000 for r in kept)


def test_duplicate_removal(spark):
    rows = [("CAISO", T0, 1000.0, 0, 1), ("CAISO", T0, 1010.0, 0, 2), ("CAISO", T0, 1005.0, 0, 3)]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double, seq int, id long")
    out = cl.dedup_grid(df).collect()
    assert len(out) == 1 and out[0].load_mw == 1000.0  # first in read order


def test_missing_load(spark):
    rows = [(T0 + timedelta(hours=i), v) for i, v in enumerate([1000.0, None, 1100.0, None, 1050.0])]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, load_mw double")
    assert cl.drop_missing(df, ["load_mw"]).count() == 3


def _enriched(spark, rows):
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    return df.withColumns({"temperature": F.lit(None).cast("double"), "wind_speed": F.lit(None).cast("double"),
                           "humidity": F.lit(None).cast("double"),
                           "hour": F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz")})


def test_hourly_aggregation(spark):
    rows = [("CAISO", T0 + timedelta(minutes=5 * i), 20000.0 + i * 100) for i in range(12)]
    h = agg.hourly_metrics(_enriched(spark, rows)).collect()
    assert len(h) == 1 and h[0].data_points == 12
    assert h[0].avg_temperature is None  # all-null weather stays null


def test_daily_aggregation(spark):
    rows = [("CAISO", datetime(2025, 11, 22) + timedelta(hours=i), 20000.0 + i * 100) for i in range(24)]
    d = agg.daily_metrics(_enriched(spark, rows)).collect()
    assert len(d) == 1 and d[0].data_points == 24
    assert d[0].total_load_mwh == sum(20000.0 + i * 100 for i in range(24))
    assert d[0].day_name == "Saturday" and d[0].day_of_week == 5 and d[0].is_weekend == 1


def test_time_features(spark):
    rows = [(datetime(2025, 11, 22) + timedelta(hours=i),) for i in range(48)]
    t = time_features(spark.createDataFrame(rows, "timestamp_utc timestamp_ntz")).collect()
    assert {r.hour_of_day for r in t} == set(range(24))
    assert all(0 <= r.day_of_week <= 6 for r in t)
    assert {r.is_weekend for r in t} <= {0, 1}
    # 2025-11-22 is a Saturday (Monday = 0 convention)
    assert t[0].day_of_week == 5 and t[0].is_weekend == 1


def test_rate_of_change(spark):
    rows = [("CAISO", T0 + timedelta(hours=i), v) for i, v in enumerate([20000.0, 21000.0, 20500.0, 19000.0, 19500.0])]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    out = with_change(df).orderBy("timestamp_utc").collect()
    assert out[0].load_change is None and out[0].load_change_pct is None
    assert out[1].load_change == 1000.0
    assert abs(out[1].load_change_pct - 5.0) < 1e-12


def test_z_score_small_sample(spark):
    rows = [("CAISO", T0 + timedelta(hours=i), v) for i, v in enumerate([20000.0, 21000.0, 20500.0, 19500.0, 40000.0])]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    z = an.zscore_flags(df).collect()
    assert max(r.z_score for r in z) < 1.79  # (n-1)/sqrt(n) bound for n = 5
    assert sum(r.is_statistical_outlier for r in z) == 0


def test_rapid_change(spark):
    rows = [("CAISO", T0 + timedelta(hours=i), v) for i, v in enumerate([20000.0, 21000.0, 30000.0, 31000.0, 30500.0])]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    out = an.rapid_change_flags(with_change(df)).orderBy("timestamp_utc").collect()
    assert [r.is_rapid_change for r in out] == [False, False, True, False, False]


def test_load_profile(spark):
    rows = [("CAISO", datetime(2025, 11, 10) + timedelta(hours=i), 20000.0 + (i % 24) * 50) for i in range(336)]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double")
    p = agg.load_profile(df).collect()
    assert len(p) <= 168 and all(r.mean_load_mw is not None for r in p)


def test_confidence_interval():
    from ampere.operators.forecast import Z_95
    mean, sd = 20000.0, 2000.0
    lo, hi = mean - Z_95 * sd, mean + Z_95 * sd
    assert abs((hi - lo) - 2 * 1.96 * sd) < 1e-9
