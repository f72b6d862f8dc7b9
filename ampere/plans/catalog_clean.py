"""Registered queries: cleaning (B*), range lookups (F1-F3, E4),
validation (I*) and the insight report (D17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere.functions.timeparse import local_to_utc, parse_mixed_timestamp
from ampere.operators import aggregate as agg
from ampere.operators import anomaly as an
from ampere.operators import clean as cl
from ampere.operators import lookup as lk
from ampere.operators import validate as vl
from ampere.operators.attach import small_side
from ampere.plans import medallion as md
from ampere.plans.catalog_ml import AN_CTES
from ampere.plans.registry import register
from ampere.plans.sqlparts import DAILY, ENRICHED, HOURLY, SUMMARY, xmean
from ampere.session import new_path
from ampere.sources import fixtures as fx

W = fx.sql_with
E = ("enriched", ENRICHED)
H = ("hourly", HOURLY)
D = ("daily", DAILY)

COERCED = ("coerced", """SELECT iso_code, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp_utc,
                                TRY_CAST(load AS DOUBLE) AS load_mw, seq, id FROM bronze_grid""")
CLEANED = ("cleaned", """SELECT * FROM coerced WHERE iso_code IS NOT NULL AND iso_code <> ''
                         AND timestamp_utc IS NOT NULL AND load_mw IS NOT NULL
                         AND load_mw > 0 AND load_mw < 1000000""")
SGRID = ("sgrid", """SELECT iso_code, timestamp_utc, load_mw FROM (
                       SELECT *, row_number() OVER (PARTITION BY iso_code, timestamp_utc
                                                    ORDER BY seq, id) AS rn FROM cleaned) WHERE rn = 1""")
SWEATHER = ("sweather", """SELECT iso_code, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp_utc,
                                  temperature, wind_speed, humidity FROM bronze_weather
                           WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL
                             AND (temperature IS NULL OR temperature BETWEEN -50 AND 60)
                             AND (humidity IS NULL OR humidity BETWEEN 0 AND 100)
                             AND (wind_speed IS NULL OR wind_speed BETWEEN 0 AND 200)""")


def _coerced(spark, d):
    b = fx.bronze_grid(spark, d)
    r_ = cl.resolve_columns(b, {"timestamp_utc": cl.GRID_TS_CANDIDATES,
                                "load_mw": cl.GRID_LOAD_CANDIDATES})
    return cl.coerce_types(r_, {"timestamp_utc": "timestamp", "load_mw": "double"})


@register("b2_coerce_types", W(COERCED) + "SELECT * FROM coerced")
def b2(spark, d):
    """Raw grid feed with resolved names (B1) and lenient casts (B2)."""
    return _coerced(spark, d)


@register("b3_clean_grid", W(COERCED, CLEANED) + "SELECT * FROM cleaned")
def b3(spark, d):
    return cl.clean_grid(_coerced(spark, d))


@register("b5_dedup_grid", W(COERCED, CLEANED, SGRID) + "SELECT * FROM sgrid")
def b5(spark, d):
    """Silver grid_clean: one row per (iso, ts), first in read order."""
    return md.silver_grid(spark, d)


@register("b4_clean_weather", W(SWEATHER) + "SELECT * FROM sweather")
def b4(spark, d):
    return md.silver_weather(spark, d)


@register("b6_dedup_weather_recent", W() + """
    SELECT iso_code, timestamp_utc, station, temperature, wind_speed, humidity FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code, timestamp_utc ORDER BY station, id) AS rn
      FROM weather_stations
      WHERE timestamp_utc >= (SELECT max(timestamp_utc) FROM weather_stations) - INTERVAL 48 HOUR)
    WHERE rn = 1""")
def b6(spark, d):
    """Station observations of the last 48 h, one per (iso, hour)."""
    ws = fx.weather_stations(spark, d)
    as_of = ws.select(F.max("timestamp_utc")).scalar()
    return cl.dedup_weather_recent(ws, as_of, 48, order=["station", "id"]).drop("id")


@register("b7_quality_counters", W(COERCED, CLEANED, SGRID, SWEATHER, E) + f"""
    SELECT 'grid' AS feed, (SELECT count(*) FROM bronze_grid) AS rows_read,
           (SELECT count(*) FROM sgrid) AS rows_cleaned,
           (SELECT count(*) FROM bronze_grid) - (SELECT count(*) FROM sgrid) AS rows_dropped,
           (SELECT count(*) FROM sgrid) * 100.0 / (SELECT count(*) FROM bronze_grid) AS quality_pct
    UNION ALL
    SELECT 'weather', (SELECT count(*) FROM bronze_weather), (SELECT count(*) FROM sweather),
           (SELECT count(*) FROM bronze_weather) - (SELECT count(*) FROM sweather),
           (SELECT count(*) FROM sweather) * 100.0 / (SELECT count(*) FROM bronze_weather)
    UNION ALL
    SELECT 'enriched', (SELECT count(*) FROM grid), (SELECT count(*) FROM enriched),
           (SELECT count(*) FROM grid) - (SELECT count(*) FROM enriched),
           (SELECT count(*) FROM enriched) * 100.0 / (SELECT count(*) FROM grid)""")
def b7(spark, d):
    """Rows read / cleaned / dropped per feed, and the enriched row count
    (every grid row is kept by the left as-of join)."""
    g = cl.quality_counters(fx.bronze_grid(spark, d), md.silver_grid(spark, d), "grid")
    w = cl.quality_counters(fx.bronze_weather(spark, d), md.silver_weather(spark, d), "weather")
    e = cl.quality_counters(fx.grid(spark, d), md.enriched(spark, d), "enriched")
    return g.unionByName(w).unionByName(e)


@register("b8_sanitize_timestamps", W() + """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""")
def b8(spark, d):
    """Timestamp-typed columns normalised to UTC text (no named match)."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return cl.sanitize_timestamps(o)


@register("b9_sanitize_load", W() + "SELECT event_id, value AS load FROM events")
def b9(spark, d):
    """First load-like column (``value``) renamed to numeric ``load``."""
    return cl.sanitize_load(fx.table(spark, d, "events").select("event_id", "value"))


_B11_SRC = """
    SELECT o_orderkey,
           strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS iso_text,
           CAST((epoch_us(o_orderdate + to_seconds(o_orderkey % 86400))
                 - epoch_us(TIMESTAMP '1899-12-30 00:00:00')) / 86400000000.0 AS VARCHAR) AS excel_text,
           CAST(epoch_us(o_orderdate + to_seconds(o_orderkey % 86400)) // 1000 AS VARCHAR) AS ms_text
    FROM orders"""


@register("b11_parse_mixed_timestamp", W(("src", _B11_SRC)) + """
    SELECT o_orderkey, TRY_CAST(iso_text AS TIMESTAMP) AS ts_from_text,
           make_timestamp(CAST(round(CAST(excel_text AS DOUBLE) * 86400000000.0) AS BIGINT)
                          + epoch_us(TIMESTAMP '1899-12-30 00:00:00')) AS ts_from_excel,
           make_timestamp(CAST(round(CAST(ms_text AS DOUBLE) * 1000.0) AS BIGINT)) AS ts_from_ms
    FROM src""")
def b11(spark, d):
    """Text, Excel-serial and epoch-ms columns, unit found per column."""
    o = fx.table(spark, d, "orders")
    t = (F.col("o_orderdate").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)")))
    tus = F.unix_micros(t.cast("timestamp"))
    src = o.select(
        "o_orderkey",
        F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("iso_text"),
        ((tus - F.unix_micros(F.lit("1899-12-30 00:00:00").cast("timestamp"))) / F.lit(86400000000.0))
        .cast("string").alias("excel_text"),
        F.floor(tus / 1000).cast("string").alias("ms_text"))
    return src.select("o_orderkey",
                      parse_mixed_timestamp(src, "iso_text").alias("ts_from_text"),
                      parse_mixed_timestamp(src, "excel_text").alias("ts_from_excel"),
                      parse_mixed_timestamp(src, "ms_text").alias("ts_from_ms"))


@register("b12_local_to_utc", W(("loc", """
        SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) + INTERVAL 30 MINUTE AS local_ts
        FROM orders"""), ("conv", """
        SELECT o_orderkey, local_ts,
               CAST(timezone('UTC', timezone('America/New_York', local_ts)) AS TIMESTAMP) AS u
        FROM loc""")) + """
    SELECT o_orderkey, local_ts,
           CASE WHEN local_ts IS NULL THEN NULL
                WHEN timezone('America/New_York', timezone('UTC', u + INTERVAL 1 HOUR)) = local_ts
                  OR timezone('America/New_York', timezone('UTC', u - INTERVAL 1 HOUR)) = local_ts THEN NULL
                WHEN timezone('America/New_York', timezone('UTC', u)) <> local_ts THEN date_trunc('hour', u)
                ELSE u END AS utc_ts
    FROM conv""")
def b12(spark, d):
    """New York wall times (incl. DST gaps / overlaps) to UTC."""
    o = fx.table(spark, d, "orders")
    loc = o.select("o_orderkey", (F.col("o_orderdate").cast("timestamp_ntz")
                                  + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
                                  + F.expr("INTERVAL 30 MINUTES")).alias("local_ts"))
    return loc.withColumn("utc_ts", local_to_utc("local_ts", "America/New_York"))


@register("b13_drop_missing", W() + "SELECT * FROM bronze_weather WHERE temperature IS NOT NULL")
def b13(spark, d):
    return cl.drop_missing(fx.bronze_weather(spark, d), ["temperature"])


@register("b14_require_weather", W(E) + """
    SELECT iso_code, timestamp_utc, load_mw, temperature, wind_speed, humidity FROM enriched
    WHERE temperature IS NOT NULL AND wind_speed IS NOT NULL AND humidity IS NOT NULL""")
def b14(spark, d):
    """Training rows: all three weather values present."""
    return cl.require_weather(md.enriched(spark, d)).select(
        "iso_code", "timestamp_utc", "load_mw", "temperature", "wind_speed", "humidity")


@register("b15_min_history_gate", W() + """
    SELECT station, count(*) AS rows FROM weather_stations
    WHERE station IN (SELECT station FROM weather_stations GROUP BY station HAVING count(*) >= 10)
    GROUP BY station""")
def b15(spark, d):
    """Keys (stations) with at least 10 rows, and their row counts."""
    g = cl.min_history_gate(fx.weather_stations(spark, d), 10, key="station")
    return g.groupBy("station").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- lookups

@register("f1_hourly_range", W(E, H) + """
    SELECT iso_code, hour, avg_load_mw FROM hourly
    WHERE iso_code = 'CLICK' AND hour >= TIMESTAMP '2024-01-10' AND hour < TIMESTAMP '2024-01-20'
    ORDER BY hour DESC LIMIT 100""")
def f1(spark, d):
    """Newest 100 hours of one ISO inside [start, end)."""
    return lk.hourly_range(lk.hourly_demand_view(md.hourly(spark, d)), "click",
                           "2024-01-10", "2024-01-20", 100)


@register("f2_daily_range", W(E, D) + """
    SELECT iso_code, date AS day, avg_load_mw FROM daily
    WHERE iso_code = 'VIEW' AND date < TIMESTAMP '2024-01-25' ORDER BY date DESC LIMIT 365""")
def f2(spark, d):
    return lk.daily_range(lk.daily_demand_view(md.daily(spark, d)), "view", None, "2024-01-25", 365)


@register("f3_enriched_range", W(E, H) + """
    SELECT iso_code, hour, avg_load_mw AS load_mw, avg_temperature AS temperature,
           avg_wind_speed AS wind_speed, avg_humidity AS humidity FROM hourly
    WHERE iso_code = 'ERROR' AND hour >= TIMESTAMP '2024-01-05' ORDER BY hour DESC LIMIT 200""")
def f3(spark, d):
    return lk.enriched_range(lk.hourly_enriched_view(md.hourly(spark, d)), "error",
                             "2024-01-05", None, 200)


@register("e4_peak_hour", W(E, H) + """
    SELECT iso_code, hour, hour_of_day, avg_load_mw FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY avg_load_mw DESC, hour) AS rn
      FROM hourly) WHERE rn = 1""")
def e4(spark, d):
    """Hour of the highest average load per ISO."""
    return lk.peak_hour(md.hourly(spark, d))


# ---------------------------------------------------------------- validation

def _report_sql(table, src, checks):
    parts = []
    for c in checks:
        if c.kind == "non_empty":
            parts.append(f"SELECT '{table}' AS table_name, 'non_empty' AS check, CAST(NULL AS VARCHAR) AS column_name, "
                         f"CAST(count(*) AS DOUBLE) AS value, CAST(0.0 AS DOUBLE) AS threshold, count(*) > 0 AS passed FROM {src}")
        elif c.kind == "null_ratio":
            v = (f"CASE WHEN count(*) = 0 THEN NULL ELSE "
                 f"CAST(count(*) FILTER (WHERE {c.column} IS NULL) AS DOUBLE) / count(*) END")
            parts.append(f"SELECT '{table}', 'null_ratio', '{c.column}', {v}, CAST({float(c.threshold)} AS DOUBLE), "
                         f"coalesce({v} <= {float(c.threshold)}, false) FROM {src}")
        else:
            bad = f"count(*) FILTER (WHERE {c.column} < {c.lo} OR {c.column} > {c.hi})"
            parts.append(f"SELECT '{table}', 'range', '{c.column}', CAST({bad} AS DOUBLE), CAST(0.0 AS DOUBLE), "
                         f"{bad} = 0 FROM {src}")
    return "\nUNION ALL\n".join(parts)


_TABLES = [
    ("silver.grid_clean", "sgrid", vl.SILVER_GRID_CHECKS),
    ("silver.weather_clean", "sweather", vl.SILVER_WEATHER_CHECKS),
    ("silver.grid_weather_enriched", "enriched", vl.ENRICHED_CHECKS),
    ("gold.hourly_metrics", "hourly", vl.GOLD_CHECKS),
    ("gold.daily_metrics", "daily", vl.GOLD_CHECKS),
]


@register("i4_validation_report", W(COERCED, CLEANED, SGRID, SWEATHER, E, H, D) +
          "\nUNION ALL\n".join(_report_sql(t, s, c) for t, s, c in _TABLES))
def i4(spark, d):
    """All checks (I1-I3) of every layer, one aggregation per table."""
    e = md.enriched(spark, d)
    srcs = {"sgrid": md.silver_grid(spark, d), "sweather": md.silver_weather(spark, d),
            "enriched": e, "hourly": agg.hourly_metrics(e), "daily": agg.daily_metrics(e)}
    return vl.validation_report({t: (srcs[s], c) for t, s, c in _TABLES})


@register("i4b_validation_incremental", W(COERCED, CLEANED, SGRID) +
          _report_sql("silver.grid_clean", "sgrid", vl.SILVER_GRID_CHECKS))
def i4b(spark, d):
    """The silver grid landed in two batches: the second run reads the files of the second batch only,
    and its report is that of all rows."""
    grid = md.silver_grid(spark, d)
    root, states = new_path(spark, "silver_landed"), new_path(spark, "validation_states")
    late = F.pmod(F.xxhash64("iso_code", "timestamp_utc"), F.lit(2)) == 1
    for part, rows in (("first", ~late), ("second", late)):
        grid.where(rows).write.parquet(f"{root}/batch={part}")
        rep, _ = vl.validate_new_files(spark, root, "silver.grid_clean", vl.SILVER_GRID_CHECKS, states)
    return rep


@register("i6_overall_status", W(COERCED, CLEANED, SGRID, SWEATHER, E, H, D, *AN_CTES) + """,
    rep AS (""" + "\nUNION ALL\n".join(_report_sql(t, s, c) for t, s, c in _TABLES) + """),
    comp AS (SELECT 'validation' AS component,
                    CASE WHEN bool_and(passed) THEN 'healthy' ELSE 'unhealthy' END AS status FROM rep
             UNION ALL
             SELECT 'data', CASE WHEN count(*) > 0 THEN 'healthy' ELSE 'no_data' END FROM enriched
             UNION ALL
             SELECT 'ml_predictions', CASE WHEN EXISTS (SELECT iso_code FROM enriched GROUP BY iso_code
                                                        HAVING count(*) >= 24)
                                           THEN 'healthy' ELSE 'not_found' END),
    moments AS (SELECT 'before_detector' AS moment, 'not_run' AS status
                UNION ALL SELECT 'after_detector', 'healthy'),
    every AS (SELECT m.moment, c.status FROM comp c CROSS JOIN moments m
              UNION ALL SELECT moment, status FROM moments),
    found AS (SELECT count(*) AS n, count(*) FILTER (WHERE severity >= 3) AS critical FROM anoms)
    SELECT e.moment, CASE WHEN bool_and(e.status = 'healthy') THEN 'healthy'
                          WHEN bool_or(e.status = 'unhealthy') THEN 'degraded' ELSE 'operational' END AS overall_status,
           count(*) AS components,
           CASE WHEN e.moment = 'after_detector' THEN any_value(f.n) ELSE 0 END AS total_anomalies,
           CASE WHEN e.moment = 'after_detector' THEN any_value(f.critical) ELSE 0 END AS critical_anomalies
    FROM every e CROSS JOIN found f GROUP BY e.moment""")
def i6(spark, d):
    """Overall status from the validation, data, forecast and anomaly components, with the anomaly totals
    (critical = severity >= 3): before the detector has run, and after it has written its table."""
    from ampere.plans.catalog_ml import forecast_df
    e = md.load_history(spark, d)
    fc = forecast_df(spark, d)
    fixed = small_side(
        i4(spark, d).agg(F.when(F.bool_and("passed"), "healthy").otherwise("unhealthy").alias("status"))
        .select(F.lit("validation").alias("component"), "status")
        .unionByName(e.agg(F.when(F.count(F.lit(1)) > 0, "healthy").otherwise("no_data").alias("status"))
                     .select(F.lit("data").alias("component"), "status"))
        .unionByName(fc.agg(F.when(F.count(F.lit(1)) > 0, "healthy").otherwise("not_found").alias("status"))
                     .select(F.lit("ml_predictions").alias("component"), "status")))
    table = new_path(spark, "anomaly_table")
    out = _moment(spark, fixed, table, "before_detector")
    md.anomalies(spark, d).write.parquet(table)
    return out.unionByName(_moment(spark, fixed, table, "after_detector"))


def _moment(spark, fixed, table: str, name: str):
    """The overall status as it is now, with what the detector has left at ``table``."""
    status, found = vl.detector_status(spark, table)
    total = critical = F.lit(0).cast("long")
    if found is not None:
        total = found.select(F.count(F.lit(1))).scalar()
        critical = found.select(F.count_if(F.col("severity") >= 3)).scalar()
    return vl.overall_status(fixed.unionByName(status)).select(
        F.lit(name).alias("moment"), "*", total.alias("total_anomalies"), critical.alias("critical_anomalies"))


@register("i5_freshness_status", W(COERCED) + """,
    landed AS (SELECT iso_code, date_trunc('day', timestamp_utc) AS day, max(timestamp_utc) AS modified
               FROM coerced WHERE timestamp_utc IS NOT NULL GROUP BY 1, 2),
    newest AS (SELECT iso_code, max(modified) AS newest, count(*) AS total_files FROM landed GROUP BY iso_code),
    aged AS (SELECT *, CAST(epoch_us((SELECT max(modified) FROM landed)) - epoch_us(newest) AS DOUBLE) / 3.6e9 AS age
             FROM newest)
    SELECT iso_code, CASE WHEN age < 2 THEN 'healthy' ELSE 'stale' END AS status,
           round_even(age * 10, 0) / 10 AS latest_update_hours_ago, total_files FROM aged""")
def i5(spark, d):
    """Freshness of each ISO's raw feed (limit 2 h) at the moment of the newest row of all: a listing of one
    file a day and ISO, each as old as its last row."""
    raw = _coerced(spark, d)
    files = raw.where("timestamp_utc is not null").groupBy("iso_code", F.to_date("timestamp_utc").alias("day")).agg(
        F.max("timestamp_utc").alias("file_modification_time")).select(
        "iso_code", F.concat_ws("/", "iso_code", F.col("day").cast("string")).alias("file_path"),
        "file_modification_time")
    files = small_side(files)
    return vl.freshness_status(files, files.select(F.max("file_modification_time")).scalar(), 2.0, by="iso_code")


# ---------------------------------------------------------------- insights

# The texts of the insight lines.
D17_SQL = W(E, H, D, ("summary", SUMMARY)) + f"""
    SELECT printf('  • %s: Peak load at hour %d:00 (%d MW)', iso_code, hour_of_day,
                  CAST(round(avg_load_mw) AS BIGINT)) AS insight
    FROM (SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY avg_load_mw DESC, hour) AS rn
          FROM hourly) WHERE rn = 1
    UNION ALL
    SELECT printf('  • %s: Weekday load %+.1f%% vs weekend', iso_code, (wd - we) / we * 100)
    FROM (SELECT iso_code, {xmean('CASE WHEN is_weekend = 0 THEN avg_load_mw END')} AS wd,
                 {xmean('CASE WHEN is_weekend = 1 THEN avg_load_mw END')} AS we
          FROM daily GROUP BY iso_code) WHERE wd IS NOT NULL AND we IS NOT NULL AND we <> 0
    UNION ALL
    SELECT printf('  • %s: Temperature correlation = %.3f', iso_code, corr(avg_temperature, avg_load_mw))
    FROM hourly WHERE avg_temperature IS NOT NULL AND avg_load_mw IS NOT NULL
    GROUP BY iso_code HAVING count(*) > 10
    UNION ALL
    SELECT printf('  • %s: Coefficient of variation = %.1f%%', iso_code, std_load_mw / avg_load_mw * 100)
    FROM summary"""


@register("d17_insights", D17_SQL)
def d17(spark, d):
    """Text insights: peak hour, weekday vs weekend, temperature
    correlation and variability per ISO (rows of one string column)."""
    e = md.enriched(spark, d)
    hourly, daily, summary = agg.hourly_metrics(e), agg.daily_metrics(e), agg.iso_summary(e)
    peak = lk.peak_hour(hourly).select(F.format_string(
        "  • %s: Peak load at hour %d:00 (%.0f MW)", "iso_code", "hour_of_day", "avg_load_mw").alias("insight"))
    wd = agg.weekday_weekend_diff(daily).select(F.format_string(
        "  • %s: Weekday load %+.1f%% vs weekend", "iso_code", "weekday_vs_weekend_pct").alias("insight"))
    corr = agg.temp_load_correlation(hourly).select(F.format_string(
        "  • %s: Temperature correlation = %.3f", "iso_code", "temp_load_corr").alias("insight"))
    cv = agg.load_cv(summary).select(F.format_string(
        "  • %s: Coefficient of variation = %.1f%%", "iso_code", "load_cv_pct").alias("insight"))
    return peak.unionByName(wd).unionByName(corr).unionByName(cv)


@register("l7_anomaly_gauge", W(E, *AN_CTES) + """
    SELECT iso_code, severity, count(*) AS anomalies,
           CASE WHEN count(*) >= 5 THEN 'red' WHEN count(*) >= 1 THEN 'yellow' ELSE 'green' END AS color
    FROM anoms GROUP BY iso_code, severity""")
def l7(spark, d):
    """Current anomalies by ISO and severity, with the panel colour."""
    from ampere.operators.service import anomaly_gauge
    return anomaly_gauge(md.anomalies(spark, d))

