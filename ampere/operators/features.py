"""Feature and report operators the reference documents but never built
(lags, rolling statistics, IQR outliers, quality flags, calendar, Fourier
terms, interactions, price features, grid stability, anomaly windows,
nearest station, retention, idempotent landing, forecast error)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ampere.functions.numeric import EXACT_DEC, MEAN_DIGITS, half_even_quotient
from ampere.functions.timecols import epoch_us
from ampere.operators.ordered import previous_row
from ampere.operators.quantile import exact_quantiles
from ampere.operators.rolling import rolling_stats
from ampere.operators.attach import attach

# Fixed values from the documentation.
LAG_HOURS = [1, 3, 6, 12, 24, 48, 168]
ROLLING_HOURS = {"6h": 6, "24h": 24, "7d": 168, "30d": 720}
FOURIER_PERIODS_S = {"daily": 86400.0, "weekly": 604800.0, "annual": 365.25 * 86400.0}
FOURIER_HARMONICS = 8
FREQ_NOMINAL_HZ = 60.0
FREQ_VALID = (59.5, 60.5)
ANOMALY_WINDOWS_H = {"1h": 1, "6h": 6, "24h": 24, "7d": 168}
EARTH_RADIUS_KM = 6371.0
# ISO region centres (lat, lon), fixed values of the weather adapter.
ISO_CENTRES = {
    "CAISO": (34.0522, -118.2437),
    "ISONE": (42.3601, -71.0589),
    "NYISO": (40.7128, -74.0060),
    "SPP": (35.4676, -97.5164),
    "MISO": (41.8781, -87.6298),
}


def lag_features(hourly: DataFrame, value: str = "avg_load_mw",
                 lags: Sequence[int] = LAG_HOURS) -> DataFrame:
    """Value n hours earlier (gap safe: an equi join on hour - n, not a
    row lag).  The past side is replicated once per lag and joined on
    (iso, hour); a fixed-list pivot turns lags into columns."""
    cur = hourly.select("iso_code", "hour", value)
    past = hourly.select("iso_code", "hour", F.col(value).alias("_v"),
                         F.explode(F.array(*[F.lit(n) for n in lags])).alias("lag_h"))
    past = past.select("iso_code", (F.col("hour") + F.make_dt_interval(hours=F.col("lag_h"))).alias("hour"),
                       "lag_h", "_v")
    j = cur.join(past, ["iso_code", "hour"], "left")
    p = j.groupBy("iso_code", "hour", value).pivot("lag_h", list(lags)).agg(F.max("_v"))
    return p.select("iso_code", "hour", value, *[F.col(str(n)).alias(f"lag_{n}h") for n in lags])


def rolling_features(hourly: DataFrame, value: str = "avg_load_mw",
                     windows: dict[str, int] = ROLLING_HOURS) -> DataFrame:
    """mean / std / min / max over the trailing (t - N h, t] window per ISO
    (time-range frames, so gaps shrink the window instead of stretching it),
    merged from block summaries: no task holds a whole ISO."""
    t = rolling_stats(hourly.select("iso_code", "hour", value), ["iso_code"], "hour", value, windows)
    order = ["iso_code", "hour", value] + [f"{s}_{label}" for label in windows
                                           for s in ("mean", "std", "min", "max")]
    return t.select(*order)


def iqr_outliers(df: DataFrame, key: str = "iso_code", col: str = "load_mw", k: float = 1.5) -> DataFrame:
    """Rows outside [Q1 - k*IQR, Q3 + k*IQR] of their key (exact quartiles)."""
    q = exact_quantiles(df, key, col, [0.25, 0.75], ["q1", "q3"])
    q = q.withColumns({"lower_fence": F.col("q1") - k * (F.col("q3") - F.col("q1")),
                       "upper_fence": F.col("q3") + k * (F.col("q3") - F.col("q1"))})
    j = attach(df, q.select(key, "q1", "q3", "lower_fence", "upper_fence"), key)
    return j.withColumn("is_iqr_outlier",
                        (F.col(col) < F.col("lower_fence")) | (F.col(col) > F.col("upper_fence")))


# Rule ids of the row-level quality checks.
QUALITY_RULES = {
    1: "timestamp missing",
    2: "load missing or not numeric",
    3: "load not positive",
    4: "load above 1,000,000 MW",
    5: "iso code missing",
}


def quality_flags(df: DataFrame) -> DataFrame:
    """Failed rule ids per row (ascending) and a 0-100 score =
    100 * passed rules / all rules."""
    ld = F.col("load_mw")
    checks = {
        1: F.col("timestamp_utc").isNull(),
        2: ld.isNull(),
        3: F.coalesce(ld <= 0, F.lit(False)),
        4: F.coalesce(ld >= 1_000_000, F.lit(False)),
        5: F.col("iso_code").isNull() | (F.col("iso_code") == ""),
    }
    # concatenation of one-element / empty arrays: ascending ids, no lambda
    empty = F.array().cast("array<int>")
    flags = F.concat(*[F.when(c, F.array(F.lit(i))).otherwise(empty) for i, c in checks.items()])
    out = df.withColumn("validation_flags", flags)
    return out.withColumn("data_quality_score",
                          F.lit(100.0) * (F.lit(len(checks)) - F.size("validation_flags")) / F.lit(len(checks)))


def _nth_weekday(year: Column, month: int, weekday_mon0: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    off = (F.lit(weekday_mon0) - F.weekday(first) + 7) % 7
    return F.date_add(first, (off + 7 * (n - 1)).cast("int"))


def _last_weekday(year: Column, month: int, weekday_mon0: int) -> Column:
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    off = (F.weekday(last) - F.lit(weekday_mon0) + 7) % 7
    return F.date_sub(last, off.cast("int"))


def us_holidays(years: DataFrame) -> DataFrame:
    """US federal holidays (actual dates, no observed shift) for every year
    in ``years`` (column ``year``): a rule per holiday, no stored list."""
    y = F.col("year")
    fixed = lambda m, d: F.make_date(y, F.lit(m), F.lit(d))
    rules = {
        "New Year's Day": fixed(1, 1),
        "Martin Luther King Jr. Day": _nth_weekday(y, 1, 0, 3),
        "Presidents' Day": _nth_weekday(y, 2, 0, 3),
        "Memorial Day": _last_weekday(y, 5, 0),
        "Juneteenth": fixed(6, 19),
        "Independence Day": fixed(7, 4),
        "Labor Day": _nth_weekday(y, 9, 0, 1),
        "Columbus Day": _nth_weekday(y, 10, 0, 2),
        "Veterans Day": fixed(11, 11),
        "Thanksgiving": _nth_weekday(y, 11, 3, 4),
        "Christmas Day": fixed(12, 25),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("holiday"), v.alias("date")) for k, v in rules.items()])
    return years.select(F.explode(rows).alias("h")).select("h.*")


def calendar_features(df: DataFrame, ts: str = "hour") -> DataFrame:
    """year, quarter, month, ISO week, day, hour, weekday (Mon=0),
    weekend and holiday flags.  Holidays come from ``us_holidays`` over the
    distinct years present (a tiny table; the planner broadcasts it)."""
    d = df.withColumn("_date", F.to_date(ts))
    years = d.select(F.year("_date").alias("year")).distinct()
    hol = us_holidays(years).select(F.col("date").alias("_date"), F.lit(1).alias("_hol")).distinct()
    d = attach(d, hol, "_date", "left")
    return d.select(*df.columns,
                    F.year(ts).alias("year"), F.quarter(ts).alias("quarter"), F.month(ts).alias("month"),
                    F.weekofyear(ts).alias("week"), F.dayofmonth(ts).alias("day"),
                    F.hour(ts).alias("hour_of_day"), F.weekday(ts).alias("day_of_week"),
                    (F.weekday(ts) >= 5).cast("int").alias("is_weekend"),
                    F.coalesce(F.col("_hol"), F.lit(0)).alias("is_holiday"))


def fourier_features(df: DataFrame, ts: str = "hour", harmonics: int = FOURIER_HARMONICS,
                     periods: dict[str, float] = FOURIER_PERIODS_S) -> DataFrame:
    """sin / cos of k * 2 pi t / period, k = 1..harmonics, per period."""
    t = epoch_us(ts) / F.lit(1e6)
    cols = {}
    for name, period in periods.items():
        for k in range(1, harmonics + 1):
            phase = t * F.lit(2 * math.pi * k / period)
            cols[f"{name}_sin_{k}"] = F.sin(phase)
            cols[f"{name}_cos_{k}"] = F.cos(phase)
    return df.withColumns(cols)


def interaction_features(hourly: DataFrame) -> DataFrame:
    """Weather x load interactions on the hourly table."""
    return hourly.select(
        "iso_code", "hour",
        (F.col("avg_temperature") * F.col("avg_load_mw")).alias("temp_x_load"),
        (F.col("avg_wind_speed") * F.col("avg_load_mw")).alias("wind_x_load"),
        (F.col("avg_humidity") * F.col("avg_load_mw")).alias("humidity_x_load"),
        (F.col("avg_temperature") * F.col("avg_temperature")).alias("temp_squared"))


def price_features(prices: DataFrame) -> DataFrame:
    """Per location and day: congestion ratio, price spread, volatility."""
    return prices.groupBy("location", F.to_date("timestamp").cast("timestamp_ntz").alias("day")).agg(
        F.try_divide(F.avg("congestion"), F.avg("lmp")).alias("congestion_ratio"),
        (F.max("lmp") - F.min("lmp")).alias("price_spread"),
        F.stddev_samp("lmp").alias("price_volatility"),
        F.count(F.lit(1)).alias("samples"))


def grid_stability(freq: DataFrame, key: str = "iso_code", ts: str = "timestamp_utc",
                   col: str = "frequency_hz") -> DataFrame:
    """Deviation from 60 Hz, its rate of change per second against the
    previous sample of the key, and the 59.5-60.5 Hz validity flag."""
    p = previous_row(freq, key, ts, [col, ts], tie=["id"] if "id" in freq.columns else [])
    dt = (epoch_us(ts) - epoch_us(f"prev_{ts}")) / F.lit(1e6)
    dev = F.col(col) - F.lit(FREQ_NOMINAL_HZ)
    prev_dev = F.col(f"prev_{col}") - F.lit(FREQ_NOMINAL_HZ)
    return p.select(*freq.columns, dev.alias("freq_deviation_hz"),
                    F.try_divide(dev - prev_dev, dt).alias("freq_rate_hz_per_s"),
                    F.col(col).between(*FREQ_VALID).alias("freq_valid"))


def anomaly_windows(anoms: DataFrame, as_of: Column,
                    windows: dict[str, int] = ANOMALY_WINDOWS_H) -> DataFrame:
    """Anomalies in the last 1h / 6h / 24h / 7d before ``as_of`` per ISO,
    with the mean signed deviation from the expected load in %."""
    w = F.explode(F.array(*[F.struct(F.lit(k).alias("window"), F.lit(v).alias("hours"))
                            for k, v in windows.items()]))
    x = anoms.select("*", w.alias("_w")).where(
        F.col("timestamp_utc") >= as_of - F.make_dt_interval(hours=F.col("_w.hours")))
    dev = F.try_divide(F.col("load_mw") - F.col("expected_load"), F.col("expected_load")) * 100
    return x.groupBy(F.col("_w.window").alias("window"), "iso_code").agg(
        F.count(F.lit(1)).alias("anomalies"), F.avg(dev).alias("mean_deviation_pct"))


def _haversine(lat1: Column, lon1: Column, lat2: float, lon2: float) -> Column:
    p1, p2 = F.radians(lat1), F.lit(math.radians(lat2))
    dphi = F.lit(math.radians(lat2)) - p1
    dlmb = F.lit(math.radians(lon2)) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def nearest_station(stations: DataFrame, centres: dict[str, tuple[float, float]] = ISO_CENTRES) -> DataFrame:
    """Nearest station (great-circle) to every ISO centre.

    The centres are a fixed handful, so each is a column expression and one
    grouped pass takes ``min_by`` per centre - no join of centres x stations.
    Ties go to the smaller station id."""
    aggs = []
    for iso, (lat, lon) in centres.items():
        d = _haversine(F.col("lat"), F.col("lon"), lat, lon)
        aggs.append(F.min_by(F.struct(F.col("station"), d.alias("distance_km")),
                             F.struct(d, F.col("station"))).alias(iso))
    a = stations.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(iso).alias("iso_code"), F.col(iso).alias("s")) for iso in centres])
    return a.select(F.explode(rows).alias("r")).select("r.iso_code", "r.s.station", "r.s.distance_km")


def retain_recent(df: DataFrame, days: int, ts: str = "timestamp_utc") -> DataFrame:
    """Keep the last ``days`` days before the newest row (retention)."""
    newest = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_dt_interval(days=F.lit(days)))


def drop_expired(table: DataFrame, days: int, path: str, ts: str = "timestamp_utc", day: str = "day") -> str:
    """Retention of a table partitioned by ``day``: partitions that ended before
    the limit are not opened, the day of the limit is cut by time, and what stays
    is written to ``path``, a new one (the old table is never changed)."""
    limit = table.select(F.max(ts)).first()[0] - timedelta(days=days)
    kept = table.where((F.col(day) >= F.lit(limit.date())) & (F.col(ts) >= F.lit(limit).cast("timestamp_ntz")))
    kept.hint("rebalance", day).write.mode("errorifexists").partitionBy(day).parquet(path)
    return path
