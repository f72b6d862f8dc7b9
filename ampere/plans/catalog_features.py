"""Registered queries: service-metric rollups (L*) and the documented-only
feature operators (M*)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ampere.functions.numeric import round_half_even
from ampere.operators import anomaly as an
from ampere.operators import features as ft
from ampere.operators import forecast as fcst
from ampere.operators import service as sv
from ampere.plans import medallion as md
from ampere.plans.catalog_clean import CLEANED, COERCED, SGRID
from ampere.plans.catalog_ml import AN_CTES, FC_CTES
from ampere.plans.registry import register
from ampere.plans.sqlparts import ENRICHED, HOURLY, hq, r
from ampere.session import new_path
from ampere.sources import fixtures as fx

W = fx.sql_with
E = ("enriched", ENRICHED)
H = ("hourly", HOURLY)


def _r6(df, cols):
    return df.withColumns({c: round_half_even(c, 6) for c in cols})


def _w5(ts="ts", seconds=300):
    return f"make_timestamp(CAST(floor(epoch_us({ts}) / {seconds * 1_000_000}) * {seconds * 1_000_000} AS BIGINT))"


# ---------------------------------------------------------------- L

@register("l1_request_rate_5m", W() + f"""
    SELECT {_w5()} AS window_start, endpoint, count(*) AS requests, count(*) / 300.0 AS rate_per_s
    FROM request_log GROUP BY 1, 2""")
def l1(spark, d):
    """Requests per second per endpoint in 5-minute windows."""
    return sv.request_rate(fx.request_log(spark, d))


@register("l2_counter_increase", W() + f"""
    SELECT {_w5()} AS window_start, endpoint,
           {r('CAST(sum(CAST(inc AS DECIMAL(28,8))) AS DOUBLE)', 6)} AS increase, count(*) AS samples FROM (
      SELECT ts, endpoint, CASE WHEN prev IS NULL THEN 0.0 WHEN latency < prev THEN latency
                                ELSE latency - prev END AS inc
      FROM (SELECT *, lag(latency) OVER (PARTITION BY endpoint ORDER BY ts, id) AS prev FROM request_log))
    GROUP BY 1, 2""")
def l2(spark, d):
    """Reset-aware increase of a cumulative sample series per window."""
    x = sv.counter_increase(fx.request_log(spark, d), "endpoint", "ts", "latency", tie=("id",))
    return _r6(x, ["increase"])


_BOUNDS = ", ".join(str(b) for b in sv.LATENCY_BUCKETS)
_NB = len(sv.LATENCY_BUCKETS)


@register("l3_latency_p95_histogram", W(("hb", f"""
        SELECT {_w5()} AS window_start,
               coalesce(list_position(list_transform([{_BOUNDS}], lambda b: latency <= b), true), {_NB + 1}) AS bucket
        FROM request_log"""), ("hc", """
        SELECT window_start, bucket, count(*) AS n FROM hb GROUP BY 1, 2"""), ("hcum", """
        SELECT *, sum(n) OVER (PARTITION BY window_start ORDER BY bucket
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               sum(n) OVER (PARTITION BY window_start) * 0.95 AS rnk FROM hc"""), ("pick", """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY bucket) AS rn
                       FROM hcum WHERE cum >= rnk) WHERE rn = 1""")) + f"""
    SELECT window_start, {r(f"""CASE WHEN bucket > {_NB} THEN [{_BOUNDS}][{_NB}]
                ELSE (CASE WHEN bucket = 1 THEN 0.0 ELSE [{_BOUNDS}][bucket - 1] END)
                     + ([{_BOUNDS}][bucket] - CASE WHEN bucket = 1 THEN 0.0 ELSE [{_BOUNDS}][bucket - 1] END)
                       * (rnk - (cum - n)) / n END""", 9)} AS p95_latency_s
    FROM pick""")
def l3(spark, d):
    """p95 latency per 5-minute window from a cumulative histogram."""
    q = sv.latency_quantile(fx.request_log(spark, d), 0.95)
    return q.withColumn("p95_latency_s", round_half_even("p95_latency_s", 9))


@register("l4_error_ratio", W() + f"""
    SELECT {_w5()} AS window_start, count(*) FILTER (WHERE status >= 500) AS errors,
           count(*) AS requests,
           CAST(count(*) FILTER (WHERE status >= 500) AS DOUBLE) / count(*) AS error_ratio
    FROM request_log GROUP BY 1""")
def l4(spark, d):
    """Share of 5xx responses per 5-minute window."""
    return sv.error_ratio(fx.request_log(spark, d))


@register("l5_status_breakdown_1h", W() + f"""
    SELECT {_w5('ts', 3600)} AS window_start, status, count(*) AS requests
    FROM request_log GROUP BY 1, 2""")
def l5(spark, d):
    return sv.status_breakdown(fx.request_log(spark, d))


@register("l6_threshold_alert_for", W(("er", f"""
        SELECT {_w5()} AS window_start,
               CAST(count(*) FILTER (WHERE status >= 500) AS DOUBLE) / count(*) AS error_ratio
        FROM request_log GROUP BY 1"""), ("fl", """
        SELECT window_start, floor(epoch_us(window_start) / 300000000) AS i FROM er
        WHERE coalesce(error_ratio > 0.25, false)"""), ("g", """
        SELECT window_start, i - row_number() OVER (ORDER BY window_start) AS grp FROM fl""")) + """
    SELECT min(window_start) AS start, max(window_start) + INTERVAL 300 SECOND AS "end", count(*) AS steps
    FROM g GROUP BY grp HAVING count(*) >= 3""")
def l6(spark, d):
    """Alert intervals: 5xx share above 25% for at least 15 minutes."""
    er = sv.error_ratio(fx.request_log(spark, d))
    return sv.threshold_alert(er, "error_ratio", 0.25, 3, 300)


@register("l8_mean_latency", W() + f"""
    SELECT {_w5()} AS window_start, {hq("sum(CAST(latency AS DECIMAL(28,8)))", "count(latency)", 9)}
             AS mean_latency_s
    FROM request_log GROUP BY 1""")
def l8(spark, d):
    return sv.mean_latency(fx.request_log(spark, d))


# ---------------------------------------------------------------- M

_LAGS = ft.LAG_HOURS


@register("m_lags", W(E, H) + "SELECT h.iso_code, h.hour, h.avg_load_mw, " + ", ".join(
    f"l{n}.avg_load_mw AS lag_{n}h" for n in _LAGS) + " FROM hourly h " + " ".join(
    f"LEFT JOIN hourly l{n} ON l{n}.iso_code = h.iso_code AND l{n}.hour = h.hour - INTERVAL {n} HOUR"
    for n in _LAGS))
def m_lags(spark, d):
    """Hourly load 1, 3, 6, 12, 24, 48 and 168 hours earlier."""
    return ft.lag_features(md.hourly(spark, d))


def _roll_sql():
    parts = []
    for label, h in ft.ROLLING_HOURS.items():
        w = (f"OVER (PARTITION BY iso_code ORDER BY epoch(hour) "
             f"RANGE BETWEEN {h * 3600 - 1} PRECEDING AND CURRENT ROW)")
        mean = hq(f"sum(CAST(avg_load_mw AS DECIMAL(28,8))) {w}", f"count(avg_load_mw) {w}", 10)
        parts += [f"{r(mean, 6)} AS mean_{label}",
                  f"{r(f'stddev_samp(avg_load_mw) {w}', 6)} AS std_{label}",
                  f"min(avg_load_mw) {w} AS min_{label}", f"max(avg_load_mw) {w} AS max_{label}"]
    return ", ".join(parts)


@register("m_rolling", W(E, H) + f"SELECT iso_code, hour, avg_load_mw, {_roll_sql()} FROM hourly")
def m_rolling(spark, d):
    """Trailing 6h / 24h / 7d / 30d mean, std, min, max of hourly load."""
    x = ft.rolling_features(md.hourly(spark, d))
    return _r6(x, [f"{s}_{k}" for k in ft.ROLLING_HOURS for s in ("mean", "std")])


@register("m_iqr", W(E, ("qq", """
        SELECT iso_code, count(load_mw) AS n, quantile_cont(load_mw, 0.25) AS q1,
               quantile_cont(load_mw, 0.75) AS q3 FROM enriched GROUP BY iso_code""")) + f"""
    SELECT q.iso_code, q.n, {r('q1', 6)} AS q1, {r('q3', 6)} AS q3,
           {r('q1 - 1.5 * (q3 - q1)', 6)} AS lower_fence, {r('q3 + 1.5 * (q3 - q1)', 6)} AS upper_fence,
           count(*) FILTER (WHERE e.load_mw < q1 - 1.5 * (q3 - q1) OR e.load_mw > q3 + 1.5 * (q3 - q1))
             AS outliers
    FROM qq q JOIN enriched e ON e.iso_code = q.iso_code
    GROUP BY q.iso_code, q.n, q.q1, q.q3""")
def m_iqr(spark, d):
    """Exact quartiles, Tukey fences and the outlier count per ISO."""
    o = ft.iqr_outliers(md.load_history(spark, d))
    q = o.groupBy("iso_code").agg(
        F.count("load_mw").alias("n"), *[F.first(c).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")],
        F.count_if("is_iqr_outlier").alias("outliers"))
    return _r6(q, ["q1", "q3", "lower_fence", "upper_fence"])


@register("m_quality_flags", W(COERCED) + """
    SELECT iso_code, timestamp_utc, load_mw, seq, id,
           list_filter([CASE WHEN timestamp_utc IS NULL THEN 1 END,
                        CASE WHEN load_mw IS NULL THEN 2 END,
                        CASE WHEN coalesce(load_mw <= 0, false) THEN 3 END,
                        CASE WHEN coalesce(load_mw >= 1000000, false) THEN 4 END,
                        CASE WHEN iso_code IS NULL OR iso_code = '' THEN 5 END], lambda x: x IS NOT NULL)
             AS validation_flags,
           100.0 * (5 - len(list_filter([CASE WHEN timestamp_utc IS NULL THEN 1 END,
                        CASE WHEN load_mw IS NULL THEN 2 END,
                        CASE WHEN coalesce(load_mw <= 0, false) THEN 3 END,
                        CASE WHEN coalesce(load_mw >= 1000000, false) THEN 4 END,
                        CASE WHEN iso_code IS NULL OR iso_code = '' THEN 5 END], lambda x: x IS NOT NULL))) / 5
             AS data_quality_score
    FROM coerced""")
def m_quality_flags(spark, d):
    """Failed rule ids and a 0-100 quality score per raw row."""
    from ampere.plans.catalog_clean import _coerced
    return ft.quality_flags(_coerced(spark, d))


def _nth(y, m, wd, n):
    first = f"make_date({y}, {m}, 1)"
    return f"({first} + CAST((({wd} - (isodow({first}) - 1) + 7) % 7) + {7 * (n - 1)} AS INTEGER))"


def _lastwd(y, m, wd):
    last = f"last_day(make_date({y}, {m}, 1))"
    return f"({last} - CAST(((isodow({last}) - 1 - {wd} + 7) % 7) AS INTEGER))"


_HOL = " UNION ALL ".join(f"SELECT {e} AS d FROM yrs" for e in [
    "make_date(year, 1, 1)", _nth("year", 1, 0, 3), _nth("year", 2, 0, 3), _lastwd("year", 5, 0),
    "make_date(year, 6, 19)", "make_date(year, 7, 4)", _nth("year", 9, 0, 1), _nth("year", 10, 0, 2),
    "make_date(year, 11, 11)", _nth("year", 11, 3, 4), "make_date(year, 12, 25)"])


@register("m_calendar", W(E, H, ("yrs", "SELECT DISTINCT CAST(year(hour) AS INTEGER) AS year FROM hourly"),
                          ("hol", _HOL)) + """
    SELECT iso_code, hour, CAST(year(hour) AS INTEGER) AS year, CAST(quarter(hour) AS INTEGER) AS quarter,
           CAST(month(hour) AS INTEGER) AS month, CAST(weekofyear(hour) AS INTEGER) AS week,
           CAST(day(hour) AS INTEGER) AS day, CAST(hour(hour) AS INTEGER) AS hour_of_day,
           CAST(isodow(hour) - 1 AS INTEGER) AS day_of_week,
           CAST(CASE WHEN isodow(hour) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
           CAST(CASE WHEN CAST(hour AS DATE) IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS INTEGER) AS is_holiday
    FROM hourly""")
def m_calendar(spark, d):
    """Calendar features incl. US federal holidays (rule based)."""
    h = md.hourly(spark, d).select("iso_code", "hour")
    return ft.calendar_features(h)


def _fourier_sql():
    parts = []
    for name, period in ft.FOURIER_PERIODS_S.items():
        for k in range(1, ft.FOURIER_HARMONICS + 1):
            ph = f"(epoch_us(hour) / 1e6) * {repr(2 * math.pi * k / period)}"
            parts += [f"{r(f'sin({ph})', 6)} AS {name}_sin_{k}", f"{r(f'cos({ph})', 6)} AS {name}_cos_{k}"]
    return ", ".join(parts)


@register("m_fourier", W(E, H) + f"SELECT iso_code, hour, {_fourier_sql()} FROM hourly")
def m_fourier(spark, d):
    """Daily / weekly / annual sin-cos terms, 8 harmonics each."""
    h = md.hourly(spark, d).select("iso_code", "hour")
    f = ft.fourier_features(h)
    return _r6(f, [c for c in f.columns if "_sin_" in c or "_cos_" in c])


@register("m_interactions", W(E, H) + f"""
    SELECT iso_code, hour, {r('avg_temperature * avg_load_mw', 6)} AS temp_x_load,
           {r('avg_wind_speed * avg_load_mw', 6)} AS wind_x_load,
           {r('avg_humidity * avg_load_mw', 6)} AS humidity_x_load,
           {r('avg_temperature * avg_temperature', 6)} AS temp_squared FROM hourly""")
def m_interactions(spark, d):
    x = ft.interaction_features(md.hourly(spark, d))
    return _r6(x, ["temp_x_load", "wind_x_load", "humidity_x_load", "temp_squared"])


@register("m_price_features", W() + f"""
    SELECT location, CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS day,
           {r('CASE WHEN avg(lmp) = 0 THEN NULL ELSE avg(congestion) / avg(lmp) END', 6)} AS congestion_ratio,
           {r('max(lmp) - min(lmp)', 6)} AS price_spread, {r('stddev_samp(lmp)', 6)} AS price_volatility,
           count(*) AS samples
    FROM prices GROUP BY 1, 2""")
def m_price_features(spark, d):
    """Congestion ratio, spread and volatility of LMP per location-day."""
    x = ft.price_features(fx.prices(spark, d))
    return _r6(x, ["congestion_ratio", "price_spread", "price_volatility"])


@register("m_grid_stability", W() + f"""
    SELECT iso_code, timestamp_utc, id, frequency_hz, {r('frequency_hz - 60.0', 6)} AS freq_deviation_hz,
           {r("CASE WHEN dt = 0 THEN NULL ELSE ((frequency_hz - 60.0) - (pf - 60.0)) / dt END", 6)}
             AS freq_rate_hz_per_s,
           frequency_hz BETWEEN 59.5 AND 60.5 AS freq_valid
    FROM (SELECT *, lag(frequency_hz) OVER w AS pf,
                 (epoch_us(timestamp_utc) - epoch_us(lag(timestamp_utc) OVER w)) / 1e6 AS dt
          FROM frequency WINDOW w AS (PARTITION BY iso_code ORDER BY timestamp_utc, id))""")
def m_grid_stability(spark, d):
    """Frequency deviation from 60 Hz, its rate of change, validity."""
    x = ft.grid_stability(fx.frequency(spark, d))
    return _r6(x, ["freq_deviation_hz", "freq_rate_hz_per_s"])


@register("m_anomaly_window", W(E, *AN_CTES, ("wins", """
        SELECT * FROM (VALUES ('1h', 1), ('6h', 6), ('24h', 24), ('7d', 168)) t("window", hours)""")) + f"""
    SELECT w."window", a.iso_code, count(*) AS anomalies,
           {r('avg(CASE WHEN a.expected_load = 0 THEN NULL ELSE (a.load_mw - a.expected_load) / a.expected_load END * 100)', 6)}
             AS mean_deviation_pct
    FROM anoms a JOIN wins w
      ON a.timestamp_utc >= (SELECT max(timestamp_utc) FROM enriched) - w.hours * INTERVAL 1 HOUR
    GROUP BY w."window", a.iso_code""")
def m_anomaly_window(spark, d):
    """Anomalies of the last 1h / 6h / 24h / 7d per ISO with deviation %."""
    e = md.load_history(spark, d)
    x = ft.anomaly_windows(md.anomalies(spark, d), e.select(F.max("timestamp_utc")).scalar())
    return _r6(x, ["mean_deviation_pct"])


def _geo_sql():
    parts = []
    for iso, (lat, lon) in ft.ISO_CENTRES.items():
        dist = (f"2 * {ft.EARTH_RADIUS_KM} * asin(sqrt(pow(sin((radians({lat}) - radians(lat)) / 2), 2) + "
                f"cos(radians(lat)) * cos(radians({lat})) * pow(sin((radians({lon}) - radians(lon)) / 2), 2)))")
        parts.append(f"""SELECT '{iso}' AS iso_code, station, {r(dist, 6)} AS distance_km FROM (
            SELECT station, lat, lon, row_number() OVER (ORDER BY {dist}, station) AS rn FROM stations)
            WHERE rn = 1""")
    return " UNION ALL ".join(parts)


@register("m_geo_nearest", W() + _geo_sql())
def m_geo_nearest(spark, d):
    """Nearest weather station to each ISO centre (great-circle km)."""
    return _r6(ft.nearest_station(fx.stations(spark, d)), ["distance_km"])


@register("m_retention", W(COERCED, CLEANED, SGRID) + """
    SELECT iso_code, count(*) AS rows_kept, min(timestamp_utc) AS oldest_kept FROM sgrid
    WHERE timestamp_utc >= (SELECT max(timestamp_utc) FROM sgrid) - INTERVAL 7 DAY GROUP BY iso_code""")
def m_retention(spark, d):
    """Rows kept by a 7-day retention of the silver grid, per ISO: written by
    day, copied to a new path without the expired days, read back."""
    table = new_path(spark, "silver_by_day")
    (md.silver_grid(spark, d).withColumn("day", F.to_date("timestamp_utc")).hint("rebalance", "day")
     .write.partitionBy("day").parquet(table))
    kept = ft.drop_expired(spark.read.parquet(table), 7, new_path(spark, "silver_retained"))
    k = spark.read.parquet(kept)
    return k.groupBy("iso_code").agg(F.count(F.lit(1)).alias("rows_kept"),
                                     F.min("timestamp_utc").alias("oldest_kept"))


@register("m_idempotent_ingest", W(COERCED, CLEANED, SGRID) + """
    SELECT (SELECT count(*) FROM bronze_grid) AS landed_once, (SELECT count(*) FROM bronze_grid) AS landed_twice,
           (SELECT count(*) FROM sgrid) AS rows_once, (SELECT count(*) FROM sgrid) AS rows_twice""")
def m_idempotent_ingest(spark, d):
    """A raw batch landed in two folders, in one of them twice (the second run
    replaces its partitions): the raw rows that lie there, and the silver rows read back, are the same."""
    from ampere.operators import clean as cl
    from ampere.sources import sinks as sk
    b = fx.bronze_grid(spark, d)
    root = new_path(spark, "bronze_landed")
    counts = None
    for name, runs in (("once", 1), ("twice", 2)):
        for _ in range(runs):
            sk.write_partitioned(b, f"{root}/{name}")
        raw = spark.read.parquet(f"{root}/{name}")
        for what, rows in ((f"landed_{name}", raw), (f"rows_{name}", cl.silver_grid(raw))):
            one = rows.select(F.lit(what).alias("what"))
            counts = one if counts is None else counts.unionByName(one)
    return counts.agg(*[F.count_if(F.col("what") == w).alias(w)
                        for w in ("landed_once", "landed_twice", "rows_once", "rows_twice")])


_BT = [("hist", """SELECT iso_code, timestamp_utc, load_mw FROM enriched
                   WHERE timestamp_utc < (SELECT max(timestamp_utc) FROM enriched) - INTERVAL 24 HOUR""")] + FC_CTES[1:]


@register("m_forecast_error", W(E, H, *_BT) + f"""
    SELECT f.iso_code, f.timestamp_utc, {r('f.forecasted_load_mw', 6)} AS forecasted_load_mw,
           {r('h.avg_load_mw', 6)} AS actual_load_mw,
           {r('f.forecasted_load_mw - h.avg_load_mw', 6)} AS forecast_error_mw
    FROM fc f JOIN hourly h ON h.iso_code = f.iso_code AND h.hour = date_trunc('hour', f.timestamp_utc)""")
def m_forecast_error(spark, d):
    """Back-test: forecast from history up to 24 h before the end, minus
    the hourly actual of the forecast hour."""
    e = md.load_history(spark, d)
    hist = e.where(F.col("timestamp_utc") < e.select(F.max("timestamp_utc")).scalar()
                   - F.make_dt_interval(hours=F.lit(24)))
    fc = fcst.seasonal_forecast(hist, 24, lookback_hours=None)
    from ampere.functions.timecols import floor_hour
    h = md.hourly_load(spark, d).select("iso_code", "hour", F.col("avg_load_mw").alias("actual_load_mw"))
    j = fc.withColumn("hour", floor_hour("timestamp_utc")).join(h, ["iso_code", "hour"])
    x = j.select("iso_code", "timestamp_utc", "forecasted_load_mw", "actual_load_mw",
                 (F.col("forecasted_load_mw") - F.col("actual_load_mw")).alias("forecast_error_mw"))
    return _r6(x, ["forecasted_load_mw", "actual_load_mw", "forecast_error_mw"])


@register("k11_evaluate_backtest", W(E, H, *_BT) + f"""
    SELECT {r('sqrt(avg((f.forecasted_load_mw - h.avg_load_mw) * (f.forecasted_load_mw - h.avg_load_mw)))', 6)}
             AS rmse,
           {r('avg(abs(f.forecasted_load_mw - h.avg_load_mw))', 6)} AS mae, count(*) AS test_rows
    FROM fc f JOIN hourly h ON h.iso_code = f.iso_code AND h.hour = date_trunc('hour', f.timestamp_utc)""")
def k11_backtest(spark, d):
    """The model-evaluation formulas (RMSE, MAE) applied to the forecast
    back-test, whose predictions are reproducible in SQL."""
    from ampere.operators.model import evaluate
    e = md.load_history(spark, d)
    hist = e.where(F.col("timestamp_utc") < e.select(F.max("timestamp_utc")).scalar()
                   - F.make_dt_interval(hours=F.lit(24)))
    fc = fcst.seasonal_forecast(hist, 24, lookback_hours=None)
    from ampere.functions.timecols import floor_hour
    h = md.hourly_load(spark, d).select("iso_code", "hour", F.col("avg_load_mw").alias("load_mw"))
    preds = fc.withColumn("hour", floor_hour("timestamp_utc")).join(h, ["iso_code", "hour"]) \
              .withColumnRenamed("forecasted_load_mw", "prediction")
    return _r6(evaluate(preds), ["rmse", "mae"])
