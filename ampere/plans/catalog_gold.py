"""Registered queries: joins and gold aggregations (C*, D*, G1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere.functions.numeric import round_half_even
from ampere.operators import aggregate as agg
from ampere.operators import join as jn
from ampere.plans import medallion as md
from ampere.plans.registry import register
from ampere.plans.sqlparts import (DAILY, ENRICHED, HOURLY, SUMMARY, div, r, xavg, xmean)
from ampere.sources import fixtures as fx

W = fx.sql_with
E = ("enriched", ENRICHED)
H = ("hourly", HOURLY)
D = ("daily", DAILY)
S = ("summary", SUMMARY)


@register("c1_asof_nearest_weather", W(E) + "SELECT * FROM enriched")
def c1(spark, d):
    """Every grid row with the nearest weather row within 60 minutes."""
    return md.enriched(spark, d)


@register("c2_enrich_without_weather", W(("e2", """
    SELECT iso_code, timestamp_utc, load_mw, id, CAST(NULL AS DOUBLE) AS temperature,
           CAST(NULL AS DOUBLE) AS wind_speed, CAST(NULL AS DOUBLE) AS humidity,
           date_trunc('hour', timestamp_utc) AS hour,
           CAST(NULL AS DOUBLE) AS solar_irradiance_proxy FROM grid""")) + "SELECT * FROM e2")
def c2(spark, d):
    """The no-weather branch: same schema, typed null weather."""
    return jn.enrich_with_weather(fx.grid(spark, d), None)


@register("d1_hourly_metrics", W(E, H) + "SELECT * FROM hourly")
def d1(spark, d):
    """Gold hourly metrics per (iso, hour)."""
    return md.hourly(spark, d)


@register("d2_daily_metrics", W(E, D) + "SELECT * FROM daily")
def d2(spark, d):
    return md.daily(spark, d)


@register("d3_iso_summary", W(E, S) + "SELECT * FROM summary")
def d3(spark, d):
    """ISO summary incl. completeness (D4), span days (D5), capacity."""
    return md.summary(spark, d)


@register("d7_clean_summary", fx.sql_with() + f"""
    SELECT iso_code, min(timestamp_utc) AS ts_min, max(timestamp_utc) AS ts_max,
           count(timestamp_utc) AS ts_count, {xavg('load_mw')} AS mean_load_mw
    FROM grid GROUP BY iso_code""")
def d7(spark, d):
    return agg.clean_summary(fx.grid(spark, d))


@register("d8_load_profile", W(E) + f"""
    SELECT iso_code, CAST(hour(timestamp_utc) AS INTEGER) AS hour_of_day,
           CAST(isodow(timestamp_utc) - 1 AS INTEGER) AS day_of_week,
           {r(xmean('load_mw'), 6)} AS mean_load_mw, {r('stddev_samp(load_mw)', 6)} AS std_load_mw,
           count(load_mw) AS samples
    FROM enriched GROUP BY 1, 2, 3""")
def d8(spark, d):
    p = agg.load_profile(md.enriched(spark, d))
    return p.withColumns({"mean_load_mw": round_half_even("mean_load_mw", 6),
                          "std_load_mw": round_half_even("std_load_mw", 6)})


_LATEST = """
    api AS (SELECT iso_code, hour AS timestamp_utc, avg_load_mw AS total_load_mw,
                   CAST(NULL AS DOUBLE) AS renewables_mw, CAST(NULL AS DOUBLE) AS lmp_avg
            FROM hourly),
    latest AS (SELECT iso_code, max(timestamp_utc) AS ts FROM api GROUP BY iso_code),
    curr AS (SELECT g.* FROM api g JOIN latest l
             ON l.iso_code = g.iso_code AND l.ts = g.timestamp_utc)
"""


@register("c4_latest_row_per_key", W(E, H) + "," + _LATEST + "SELECT * FROM curr")
def c4(spark, d):
    """Rows at the newest hour of every ISO (ties kept)."""
    return jn.latest_rows(agg.api_hourly_enriched(md.hourly(spark, d)))


@register("d9_grid_totals", W(E, H) + "," + _LATEST + f"""
    SELECT count(*) AS iso_count,
           coalesce(CAST(sum(CAST(total_load_mw AS DECIMAL(28,8))) AS DOUBLE), 0.0) AS total_load_mw,
           coalesce(CAST(sum(CAST(renewables_mw AS DECIMAL(28,8))) AS DOUBLE), 0.0) AS renewables_mw,
           coalesce({xmean('lmp_avg')}, 0.0) AS avg_price, max(timestamp_utc) AS as_of_utc
    FROM curr""")
def d9(spark, d):
    """The API summary totals over the latest row per ISO."""
    return agg.grid_totals(jn.latest_rows(agg.api_hourly_enriched(md.hourly(spark, d))))


@register("c5_daily_vs_hourly", W(E, ("ds", """
    SELECT iso_code, CAST(CAST(timestamp_utc AS DATE) AS TIMESTAMP) AS date,
           sum(CAST(load_mw AS DECIMAL(28,8))) AS dsum FROM enriched GROUP BY 1, 2"""), ("hs", """
    SELECT iso_code, CAST(CAST(hour AS DATE) AS TIMESTAMP) AS date, sum(s) AS hsum
    FROM (SELECT iso_code, hour, sum(CAST(load_mw AS DECIMAL(28,8))) AS s FROM enriched GROUP BY 1, 2)
    GROUP BY 1, 2""")) + """
    SELECT count(*) AS days_checked,
           count(*) FILTER (WHERE coalesce(abs(d.dsum - h.hsum) > 1e-6, false)) AS mismatches
    FROM (SELECT iso_code, date, dsum + CASE WHEN day(date) % 7 = 3 THEN 10 ELSE 0 END AS dsum
          FROM ds WHERE day(date) % 11 <> 5) d LEFT JOIN hs h ON d.iso_code = h.iso_code AND d.date = h.date""")
def c5(spark, d):
    """A daily table with wrong days (+10 where day % 7 = 3) and missing ones
    (day % 11 = 5) against sums recomputed from hourly data."""
    e = md.load_history(spark, d)
    day = F.dayofmonth("date")
    daily = agg.daily_sums(e).where(day % 11 != 5).withColumn(
        "sum_load_mw", F.col("sum_load_mw") + F.when(day % 7 == 3, F.lit(10)).otherwise(F.lit(0)))
    return jn.daily_vs_hourly(daily, agg.hourly_sums(e))


@register("d10_temp_load_correlation", W(E, H) + f"""
    SELECT iso_code, {r('corr(avg_temperature, avg_load_mw)', 6)} AS temp_load_corr,
           count(*) AS pairs
    FROM hourly WHERE avg_temperature IS NOT NULL AND avg_load_mw IS NOT NULL
    GROUP BY iso_code HAVING count(*) > 10""")
def d10(spark, d):
    c = agg.temp_load_correlation(md.hourly(spark, d))
    return c.withColumn("temp_load_corr", round_half_even("temp_load_corr", 6))


@register("d11_weekday_weekend_diff", W(E, D) + f"""
    SELECT iso_code, {r('wd', 6)} AS weekday_avg, {r('we', 6)} AS weekend_avg,
           {r(div('wd - we', 'we') + ' * 100', 6)} AS weekday_vs_weekend_pct
    FROM (SELECT iso_code, {xmean('CASE WHEN is_weekend = 0 THEN avg_load_mw END')} AS wd,
                 {xmean('CASE WHEN is_weekend = 1 THEN avg_load_mw END')} AS we
          FROM daily GROUP BY iso_code)
    WHERE wd IS NOT NULL AND we IS NOT NULL""")
def d11(spark, d):
    x = agg.weekday_weekend_diff(md.daily(spark, d))
    return x.withColumns({c: round_half_even(c, 6) for c in
                          ("weekday_avg", "weekend_avg", "weekday_vs_weekend_pct")})


@register("d12_load_cv", W(E, S) + f"""
    SELECT iso_code, {r(div('std_load_mw', 'avg_load_mw') + ' * 100', 6)} AS load_cv_pct
    FROM summary""")
def d12(spark, d):
    return agg.load_cv(md.summary(spark, d)).withColumn(
        "load_cv_pct", round_half_even("load_cv_pct", 6))


@register("d18_weather_join_rate", W(E) + f"""
    SELECT count(temperature) AS with_weather, count(*) AS enriched_rows,
           {r("coalesce(" + div('count(temperature) * 100.0', 'count(*)') + ", 0.0)", 6)} AS join_rate_pct
    FROM enriched""")
def d18(spark, d):
    return agg.weather_join_rate(md.enriched(spark, d)).withColumn(
        "join_rate_pct", round_half_even("join_rate_pct", 6))


@register("g1_union_by_name", fx.sql_with() + """
    SELECT * FROM grid UNION ALL BY NAME SELECT * FROM weather""")
def g1(spark, d):
    """Concatenate feeds with different columns; missing columns are null."""
    return fx.grid(spark, d).unionByName(fx.weather(spark, d), allowMissingColumns=True)


@register("d7b_silver_grid_from_bronze", fx.sql_with() + f"""
    SELECT iso_code, min(timestamp_utc) AS ts_min, max(timestamp_utc) AS ts_max,
           count(timestamp_utc) AS ts_count, {xavg('load_mw')} AS mean_load_mw
    FROM (SELECT iso_code, timestamp_utc, load_mw FROM (
            SELECT iso_code, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp_utc,
                   TRY_CAST(load AS DOUBLE) AS load_mw,
                   row_number() OVER (PARTITION BY iso_code, TRY_CAST(timestamp AS TIMESTAMP)
                                      ORDER BY seq, id) AS rn
            FROM bronze_grid
            WHERE iso_code IS NOT NULL AND iso_code <> ''
              AND TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL
              AND TRY_CAST(load AS DOUBLE) > 0 AND TRY_CAST(load AS DOUBLE) < 1000000)
          WHERE rn = 1)
    GROUP BY iso_code""")
def d7b(spark, d):
    """D7 on the grid cleaned from the raw feed (B1-B3, B5 end to end)."""
    return agg.clean_summary(md.silver_grid(spark, d))
