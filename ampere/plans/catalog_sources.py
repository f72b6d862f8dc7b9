"""Registered queries: sources and sinks (A*, B10).

Each query lands data that Spark derives from the given tables into a
fresh folder under the shared ``spark.checkpoint.dir`` and reads it back
through the operator under test, so the round trip is what gets checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere.functions.numeric import round_half_even
from ampere.operators import aggregate as agg
from ampere.plans import medallion as md
from ampere.plans.catalog_clean import D17_SQL
from ampere.plans.catalog_ml import AN_CTES, FC_CTES, forecast_df
from ampere.plans.registry import register
from ampere.plans.sqlparts import ENRICHED, HOURLY, r
from ampere.session import materialize, new_path
from ampere.sources import bronze as br
from ampere.sources import fixtures as fx
from ampere.sources import landing as ld
from ampere.sources import sinks as sk

W = fx.sql_with
E = ("enriched", ENRICHED)
H = ("hourly", HOURLY)
def _day():
    return F.to_date(F.try_to_timestamp(F.col("timestamp")))


@register("a1_scan_bronze_grid", W() + """
    SELECT iso_code, timestamp, TRY_CAST(load AS DOUBLE) AS load_value, seq, id FROM bronze_grid""")
def a1(spark, d):
    """Land the raw grid feed as iso/date folders, scan it back recursively
    (ISO from the path)."""
    b = fx.bronze_grid(spark, d)
    root = br.write_bronze_dated(b, new_path(spark, "bronze_grid"), br.run_day(b, F.try_to_timestamp("timestamp")))
    # the raw text of a number is engine specific; compare the parsed value
    return br.scan_bronze(spark, root).select(
        "iso_code", "timestamp", F.col("load").try_cast("double").alias("load_value"), "seq", "id")


@register("a2_scan_bronze_weather", W() + """
    SELECT iso_code, timestamp, temperature, wind_speed,
           CASE WHEN id % 20 = 0 THEN NULL ELSE humidity END AS humidity, id FROM bronze_weather""")
def a2(spark, d):
    """Weather landed in two shapes (with / without humidity files), merged
    by name on the scan."""
    bw = fx.bronze_weather(spark, d)
    root = new_path(spark, "bronze_weather")
    # every 20th observation arrives from a station without a humidity sensor
    with_h = bw.where(F.col("id") % 20 != 0)
    no_h = bw.where(F.col("id") % 20 == 0).drop("humidity")
    day = br.first_day(bw, F.try_to_timestamp("timestamp"))   # weather lands under its first day
    br.write_bronze_dated(with_h, root, day)
    br.write_bronze_dated(no_h, root, day)
    s = br.scan_bronze(spark, root)
    return s.select("iso_code", "timestamp", "temperature", "wind_speed", "humidity", "id")


@register("a2b_absent_weather_root", W(("e2", """
    SELECT iso_code, timestamp_utc, load_mw, id, CAST(NULL AS DOUBLE) AS temperature,
           CAST(NULL AS DOUBLE) AS wind_speed, CAST(NULL AS DOUBLE) AS humidity,
           date_trunc('hour', timestamp_utc) AS hour,
           CAST(NULL AS DOUBLE) AS solar_irradiance_proxy FROM grid""")) + "SELECT * FROM e2")
def a2b(spark, d):
    """No weather landed yet: the scan finds no root and the enrichment
    takes the no-weather branch (typed null weather, same schema)."""
    from ampere.operators.join import enrich_with_weather
    wx = br.scan_bronze(spark, new_path(spark, "bronze_weather_absent"))
    return enrich_with_weather(fx.grid(spark, d), wx)


@register("a3_scan_silver_enriched", W(E) + "SELECT * FROM enriched")
def a3(spark, d):
    """Silver enriched written by ISO partition and scanned back typed."""
    path = sk.write_partitioned(md.enriched(spark, d), new_path(spark, "silver_enriched"))
    return br.scan_silver(spark, path)


@register("a5_land_load_csv", W() + """
    SELECT iso_code, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') AS timestamp, load_mw AS load
    FROM grid""")
def a5(spark, d):
    """ISO CSV payload (local New York time, 'Current demand' column)
    landed to UTC text."""
    g = fx.grid(spark, d)
    local = F.from_utc_timestamp(F.col("timestamp_utc").cast("timestamp"), "America/New_York")
    csv = g.select("iso_code", F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Time"),
                   F.col("load_mw").alias("Current demand"))
    path = new_path(spark, "iso_csv")
    csv.write.option("header", "true").partitionBy("iso_code").csv(path)
    return ld.land_load_csv(spark, path, "America/New_York")


@register("a6_land_load_table", W() + """
    SELECT iso_code, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') AS timestamp, load_mw AS load
    FROM grid""")
def a6(spark, d):
    """Library-style frame with a ``time_utc`` text column and ``load``."""
    g = fx.grid(spark, d).select("iso_code", F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                                 .alias("time_utc"), F.col("load_mw").alias("load"))
    return ld.land_load_table(g, "UTC")


@register("a7_land_weather_geojson", W() + """
    SELECT iso_code, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') AS timestamp,
           temperature, wind_speed, humidity FROM weather""")
def a7(spark, d):
    """Weather-service FeatureCollections (one per ISO-day) flattened."""
    docs = ld.weather_to_geojson(fx.weather(spark, d))
    path = new_path(spark, "geojson")
    docs.write.partitionBy("iso_code").text(path)
    return ld.land_weather_geojson(spark.read.text(path))


@register("a8_land_prices", W() + """
    SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, location, lmp, lmp AS energy,
           coalesce(congestion, 0.0) AS congestion, coalesce(loss, 0.0) AS loss
    FROM prices WHERE lmp IS NOT NULL AND timestamp IS NOT NULL""")
def a8(spark, d):
    """LMP feed normalised: energy defaults to lmp, missing parts to 0."""
    return ld.land_prices(fx.prices(spark, d).drop("id", "line"))


@register("a9_write_partitioned", W(E, H) + "SELECT * FROM hourly")
def a9(spark, d):
    """Gold hourly metrics written per ISO (dynamic overwrite), read back."""
    path = sk.write_partitioned(md.hourly(spark, d), new_path(spark, "gold_hourly"))
    return spark.read.parquet(path)


@register("a10_write_bronze_dated", W() + """
    SELECT iso_code, CAST(CAST(TRY_CAST(timestamp AS TIMESTAMP) AS DATE) AS VARCHAR) AS ingest_date,
           count(*) AS rows
    FROM bronze_grid GROUP BY 1, 2""")
def a10(spark, d):
    """Rows per (ISO, ingest date) folder after landing the raw grid feed
    in daily batches (each batch lands under its run day)."""
    root = br.write_bronze_dated(fx.bronze_grid(spark, d), new_path(spark, "bronze_dated"), _day())
    s = spark.read.parquet(root)
    return s.groupBy("iso_code", F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("a11_write_latest", W(E, *FC_CTES) + f"""
    SELECT iso_code, timestamp_utc, {r('forecasted_load_mw', 6)} AS forecasted_load_mw,
           {r('ci_lower', 6)} AS ci_lower, {r('ci_upper', 6)} AS ci_upper,
           forecast_generated_at, model_version, confidence FROM fc""")
def a11(spark, d):
    """Latest forecast snapshot published over an older one and read back."""
    path = new_path(spark, "latest_forecast")
    fc = materialize(forecast_df(spark, d), "forecast")
    sk.write_latest(fc.withColumn("forecasted_load_mw", F.lit(0.0)), path)
    sk.write_latest(fc, path)
    x = sk.read_latest(spark, path)
    return x.withColumns({c: round_half_even(c, 6) for c in ("forecasted_load_mw", "ci_lower", "ci_upper")})


@register("a12_write_text_report", "SELECT insight AS value FROM (" + D17_SQL + ")")
def a12(spark, d):
    """Insight lines written as a text report and read back."""
    from ampere.plans.catalog_clean import d17
    path = sk.write_text_report(d17(spark, d), new_path(spark, "insights_txt"))
    return spark.read.text(path)


@register("a12b_alert_summary_report", W(E, *AN_CTES) + """,
    crit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY timestamp_utc DESC) AS rn
                            FROM anoms WHERE severity >= 3) WHERE rn = 1)
    SELECT printf('Total Anomalies: %d', count(*)) AS value FROM anoms
    UNION ALL SELECT iso_code || ':' FROM anoms GROUP BY iso_code
    UNION ALL SELECT printf('  Anomalies: %d', count(*)) FROM anoms GROUP BY iso_code
    UNION ALL SELECT printf('    Severity %d: %d', severity, count(*)) FROM anoms GROUP BY iso_code, severity
    UNION ALL SELECT '  Most recent critical:' FROM crit
    UNION ALL SELECT '    Time: ' || strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S.%f') FROM crit
    UNION ALL SELECT printf('    Load: %d MW', CAST(round(load_mw) AS BIGINT)) FROM crit
    UNION ALL SELECT '    Type: ' || anomaly_type FROM crit""")
def a12b(spark, d):
    """Anomaly alert summary written as an ordered text report and read
    back (line order kept by sorting on (iso, line_no) before the write)."""
    from ampere.operators.anomaly import alert_summary_lines
    # the few anomalous rows are written once and read by every part of the report
    lines = alert_summary_lines(materialize(md.anomalies(spark, d), "anomalies"))
    path = new_path(spark, "alert_summary_txt")
    sk.write_text_report(lines.orderBy("iso_code", "line_no"), path, col="line")
    return spark.read.text(path)


@register("a13_append_run", W(E) + """
    SELECT r.run_ts, d.iso_code, count(*) AS rows
    FROM (SELECT DISTINCT iso_code, CAST(timestamp_utc AS DATE) AS day FROM enriched) d
    JOIN (SELECT '20240131T000000' AS run_ts UNION ALL SELECT '20240131T010000') r ON true
    GROUP BY 1, 2""")
def a13(spark, d):
    """Two runs of the daily metrics appended as run_ts partitions."""
    path = new_path(spark, "runs")
    # computed once, appended as two runs
    daily = materialize(agg.daily_metrics(md.enriched(spark, d)), "daily")
    sk.append_run(daily, path, "20240131T000000")
    sk.append_run(daily, path, "20240131T010000")
    x = spark.read.parquet(path)
    return x.groupBy("run_ts", "iso_code").agg(F.count(F.lit(1)).alias("rows"))


@register("b10_sanitize_rewrite", W() + """
    SELECT iso_code, count(*) AS rows, count(TRY_CAST(load AS DOUBLE)) AS numeric_load,
           min(timestamp) AS first_text, max(timestamp) AS last_text, CAST(1 AS BIGINT) AS skipped_files
    FROM bronze_grid GROUP BY iso_code""")
def b10(spark, d):
    """Raw files (one unreadable, which is counted) rewritten with normalised
    timestamp text and numeric load into a new folder."""
    root = br.write_bronze_dated(fx.bronze_grid(spark, d), new_path(spark, "bronze_dirty"), _day())
    with open_text(spark, f"{root}/iso_code=CORRUPT/ingest_date=2024-01-01/broken.parquet") as f:
        f.write("not a parquet file")
    out = br.sanitize_rewrite(spark, root, new_path(spark, "bronze_sanitized"))
    skipped = br.unread_files(spark, root, br.scan_bronze(spark, root, ignore_corrupt=True))
    return out.groupBy("iso_code").agg(
        F.count(F.lit(1)).alias("rows"), F.count("load").alias("numeric_load"),
        F.min("timestamp").alias("first_text"), F.max("timestamp").alias("last_text")).withColumn(
        "skipped_files", skipped.select(F.count(F.lit(1))).scalar())


class open_text:
    """Write a small text file through the Hadoop file system of the
    session (works for local and shared cluster folders)."""

    def __init__(self, spark, path):
        self.spark, self.path, self.buf = spark, path, []

    def __enter__(self):
        return self

    def write(self, s):
        self.buf.append(s)

    def __exit__(self, *exc):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(p, True)
        out.write(bytearray("".join(self.buf).encode()))
        out.close()
        return False
