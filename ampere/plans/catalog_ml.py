"""Registered queries: forecasting, anomalies and their reports
(K1-K9, K13, E1-E7, F4-F6, D13-D16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere.functions.numeric import round_half_even
from ampere.functions.timecols import time_features
from ampere.operators import aggregate as agg
from ampere.operators import anomaly as an
from ampere.operators import forecast as fcst
from ampere.operators.ordered import with_change
from ampere.plans import medallion as md
from ampere.plans.registry import register
from ampere.plans.sqlparts import ENRICHED, div, dow, hod, r, weekend, xavg, xmean
from ampere.sources import fixtures as fx

W = fx.sql_with
E = ("enriched", ENRICHED)


def _r6(df, cols):
    return df.withColumns({c: round_half_even(c, 6) for c in cols})


# ---------------------------------------------------------------- forecast

def forecast_df(spark, d):
    """K2 over the whole enriched history (no look-back cut)."""
    return fcst.seasonal_forecast(md.load_history(spark, d), hours_ahead=24, lookback_hours=None)


FC_CTES = [
    ("hist", "SELECT iso_code, timestamp_utc, load_mw FROM enriched"),
    ("gated", """SELECT * FROM hist WHERE iso_code IN
                 (SELECT iso_code FROM hist GROUP BY iso_code HAVING count(*) >= 24)"""),
    ("last", f"""SELECT iso_code, max(timestamp_utc) AS last_ts, {xmean('load_mw')} AS overall_avg
                FROM gated GROUP BY iso_code"""),
    ("tr", f"""SELECT g.iso_code,
                {xmean("CASE WHEN g.timestamp_utc >= l.last_ts - INTERVAL 24 HOUR THEN load_mw END")}
                  AS recent_avg,
                {xmean("CASE WHEN g.timestamp_utc >= l.last_ts - INTERVAL 48 HOUR AND g.timestamp_utc < l.last_ts - INTERVAL 24 HOUR THEN load_mw END")}
                  AS older_avg
              FROM gated g JOIN last l ON g.iso_code = l.iso_code GROUP BY g.iso_code"""),
    ("st", """SELECT l.*, tr.recent_avg, tr.older_avg, CASE WHEN recent_avg IS NOT NULL AND older_avg IS NOT NULL
                          THEN CASE WHEN older_avg > 0 THEN recent_avg / older_avg ELSE 1.0 END
                          ELSE 1.0 END AS trend_factor
              FROM last l JOIN tr ON l.iso_code = tr.iso_code"""),
    ("fut", """SELECT iso_code, last_ts + h * INTERVAL 1 HOUR AS timestamp_utc
               FROM (SELECT iso_code, last_ts, unnest(generate_series(1, 24)) AS h FROM st)"""),
    ("prof", f"""SELECT iso_code, {hod('timestamp_utc')} AS hour_of_day, {dow('timestamp_utc')} AS day_of_week,
                        {xmean('load_mw')} AS avg_load, stddev_samp(load_mw) AS std_load
                 FROM gated GROUP BY 1, 2, 3"""),
    ("fc0", f"""SELECT f.iso_code, f.timestamp_utc, p.avg_load * s.trend_factor AS fl, p.std_load,
                       s.overall_avg
                FROM fut f JOIN st s ON f.iso_code = s.iso_code
                LEFT JOIN prof p ON p.iso_code = f.iso_code
                 AND p.hour_of_day = {hod('f.timestamp_utc')} AND p.day_of_week = {dow('f.timestamp_utc')}"""),
    ("fc", """SELECT iso_code, timestamp_utc,
                     coalesce(fl, overall_avg) AS forecasted_load_mw,
                     coalesce(fl - 1.96 * std_load, overall_avg * 0.9) AS ci_lower,
                     coalesce(fl + 1.96 * std_load, overall_avg * 1.1) AS ci_upper,
                     (SELECT max(timestamp_utc) FROM hist) AS forecast_generated_at,
                     'simple_v1' AS model_version, CAST(0.95 AS DOUBLE) AS confidence
              FROM fc0"""),
]


@register("k2_seasonal_forecast", W(E, *FC_CTES) + f"""
    SELECT iso_code, timestamp_utc, {r('forecasted_load_mw', 6)} AS forecasted_load_mw,
           {r('ci_lower', 6)} AS ci_lower, {r('ci_upper', 6)} AS ci_upper,
           forecast_generated_at, model_version, confidence FROM fc""")
def k2(spark, d):
    """24-hour seasonal forecast with a 95% band for every ISO."""
    return _r6(forecast_df(spark, d), ["forecasted_load_mw", "ci_lower", "ci_upper"])


@register("k1_future_grid", W(E, *FC_CTES[:6]) + f"""
    SELECT iso_code, timestamp_utc, {hod('timestamp_utc')} AS hour_of_day,
           {dow('timestamp_utc')} AS day_of_week, {weekend('timestamp_utc')} AS is_weekend FROM fut""")
def k1(spark, d):
    hist = md.load_history(spark, d)
    st = fcst.iso_stats(hist.select("iso_code", "timestamp_utc", "load_mw"), 24)
    return fcst.future_grid(st.select("iso_code", "last_ts"), 24)


@register("e3_recent_vs_prior_trend", W(E, *FC_CTES[:5]) + f"""
    SELECT s.iso_code, {r('s.recent_avg', 6)} AS recent_avg, {r('s.older_avg', 6)} AS older_avg,
           {r('s.trend_factor', 6)} AS trend_factor FROM st s""")
def e3(spark, d):
    hist = md.load_history(spark, d).select("iso_code", "timestamp_utc", "load_mw")
    st = fcst.iso_stats(hist, 24)
    return _r6(st.select("iso_code", "recent_avg", "older_avg", "trend_factor"),
               ["recent_avg", "older_avg", "trend_factor"])


@register("a4_scan_recent", W(E) + """
    SELECT iso_code, count(*) AS recent_rows, min(timestamp_utc) AS first_ts, max(timestamp_utc) AS last_ts
    FROM enriched WHERE timestamp_utc >= (SELECT max(timestamp_utc) FROM enriched) - INTERVAL 168 HOUR
    GROUP BY iso_code""")
def a4(spark, d):
    """Rows of the last 168 hours before the newest timestamp, per ISO."""
    rec = fcst.scan_recent(md.load_history(spark, d), 168)
    return rec.groupBy("iso_code").agg(F.count(F.lit(1)).alias("recent_rows"),
                                       F.min("timestamp_utc").alias("first_ts"),
                                       F.max("timestamp_utc").alias("last_ts"))


@register("d15_forecast_summary", W(E, *FC_CTES) + f"""
    SELECT iso_code, {xavg('forecasted_load_mw')} AS mean_forecast_mw,
           {r('min(forecasted_load_mw)')} AS min_forecast_mw, {r('max(forecasted_load_mw)')} AS max_forecast_mw,
           min(timestamp_utc) AS first_ts, max(timestamp_utc) AS last_ts, count(*) AS forecasts,
           CAST(trunc((epoch_us(max(timestamp_utc)) - epoch_us(min(timestamp_utc))) / 3600000000) AS BIGINT)
             AS horizon_hours
    FROM fc GROUP BY iso_code""")
def d15(spark, d):
    return agg.forecast_summary(forecast_df(spark, d))


@register("d16_forecast_info", W(E, *FC_CTES) + """
    SELECT count(*) AS forecasts_available, list_sort(list_distinct(list(iso_code))) AS isos,
           CAST(trunc((epoch_us(max(timestamp_utc)) - epoch_us(min(timestamp_utc))) / 3600000000) AS BIGINT)
             AS forecast_horizon_hours,
           min(model_version) AS model_version, min(confidence) AS confidence_level,
           min(forecast_generated_at) AS forecast_generated_at
    FROM fc""")
def d16(spark, d):
    return agg.forecast_info(forecast_df(spark, d))


@register("e7_hours_ahead_rank", W(E, *FC_CTES) + """
    SELECT iso_code, timestamp_utc,
           CAST(floor((epoch_us(timestamp_utc) - epoch_us((SELECT min(timestamp_utc) FROM fc)))
                      / 3600000000) + 1 AS INTEGER) AS hours_ahead
    FROM fc""")
def e7(spark, d):
    return fcst.hours_ahead_rank(forecast_df(spark, d)).select("iso_code", "timestamp_utc", "hours_ahead")


@register("f4_forecast_by_iso", W(E, *FC_CTES) + f"""
    SELECT iso_code, timestamp_utc, {r('forecasted_load_mw')} AS forecasted_load_mw,
           {r('ci_lower')} AS ci_lower, {r('ci_upper')} AS ci_upper, model_version, forecast_generated_at
    FROM fc WHERE iso_code = 'CLICK' ORDER BY timestamp_utc LIMIT 24""")
def f4(spark, d):
    """First 24 forecast hours of one ISO (the limit is the feature)."""
    return fcst.forecast_by_iso(forecast_df(spark, d), "click", 24)


@register("f5_forecast_compare", W(E, *FC_CTES) + f"""
    SELECT hours_ahead, min(timestamp_utc) OVER (PARTITION BY hours_ahead) AS hour_timestamp_utc,
           iso_code, {r('forecasted_load_mw')} AS load_mw, {r('ci_lower')} AS ci_lower,
           {r('ci_upper')} AS ci_upper
    FROM (SELECT *, CAST(floor((epoch_us(timestamp_utc) - epoch_us((SELECT min(timestamp_utc) FROM fc)))
                               / 3600000000) + 1 AS INTEGER) AS hours_ahead FROM fc)
    WHERE hours_ahead <= 6""")
def f5(spark, d):
    """ISOs side by side for the first 6 hours ahead (long form)."""
    return fcst.forecast_compare(forecast_df(spark, d), 6)


@register("f6_forecast_peak", W(E, *FC_CTES) + f"""
    SELECT iso_code, {r('forecasted_load_mw')} AS peak_load_mw, timestamp_utc AS peak_time_utc,
           CAST(trunc((epoch_us(timestamp_utc) - epoch_us(forecast_generated_at)) / 3600000000) AS INTEGER)
             AS hours_until_peak,
           {r('ci_lower')} AS ci_lower, {r('ci_upper')} AS ci_upper, forecast_generated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY iso_code
                                       ORDER BY forecasted_load_mw DESC, timestamp_utc) AS rn FROM fc)
    WHERE rn = 1""")
def f6(spark, d):
    return fcst.forecast_peak(forecast_df(spark, d))


def _recent(ctes, source):
    """The CTEs over the last 168 hours of ``source``."""
    first = ctes[0]
    cut = "timestamp_utc >= (SELECT max(timestamp_utc) FROM enriched) - INTERVAL 168 HOUR"
    if first[0] == "hist":
        return [("hist", first[1] + f" WHERE {cut}"), *ctes[1:]]
    recent = ("recent", f"SELECT * FROM enriched WHERE {cut}")
    return [recent, ("gated", first[1].replace("FROM enriched", "FROM recent")), *ctes[1:]]


@register("k2b_forecast_168h", W(E, *_recent(FC_CTES, "hist")) + f"""
    SELECT iso_code, timestamp_utc, {r('forecasted_load_mw', 6)} AS forecasted_load_mw,
           {r('ci_lower', 6)} AS ci_lower, {r('ci_upper', 6)} AS ci_upper,
           forecast_generated_at, model_version, confidence FROM fc""")
def k2b(spark, d):
    """The forecast job as shipped: from the last 168 hours."""
    return _r6(fcst.seasonal_forecast(md.load_history(spark, d), hours_ahead=24, lookback_hours=168),
               ["forecasted_load_mw", "ci_lower", "ci_upper"])


@register("f4b_forecast_nested_band", W(E, *FC_CTES) + f"""
    SELECT iso_code, timestamp_utc, {r('forecasted_load_mw')} AS forecasted_load_mw,
           {r('ci_lower')} AS band_lower, {r('ci_upper')} AS band_upper
    FROM fc WHERE iso_code = 'CLICK' ORDER BY timestamp_utc LIMIT 24""")
def f4b(spark, d):
    """The response shape with a nested confidence interval, its parts read back."""
    x = fcst.with_ci_struct(fcst.forecast_by_iso(forecast_df(spark, d), "click", 24))
    return x.select("iso_code", "timestamp_utc", "forecasted_load_mw",
                    F.col("confidence_interval.lower").alias("band_lower"),
                    F.col("confidence_interval.upper").alias("band_upper"))


# ---------------------------------------------------------------- anomalies

# Fixed values in the SQL below: method order, type labels, thresholds, model version.
AN_CTES = [
    ("gated", """SELECT * FROM enriched WHERE iso_code IN
                 (SELECT iso_code FROM enriched GROUP BY iso_code HAVING count(*) >= 50)"""),
    ("tf", f"""SELECT *, {hod('timestamp_utc')} AS hour_of_day, {dow('timestamp_utc')} AS day_of_week,
                      {weekend('timestamp_utc')} AS is_weekend,
                      load_mw - lag(load_mw) OVER w AS load_change,
                      {div('load_mw - lag(load_mw) OVER w', 'lag(load_mw) OVER w')} * 100.0 AS load_change_pct
               FROM gated WINDOW w AS (PARTITION BY iso_code ORDER BY timestamp_utc)"""),
    ("zs", f"""SELECT iso_code, {xmean('load_mw')} AS m, stddev_samp(load_mw) AS s
               FROM gated GROUP BY iso_code"""),
    ("pr", f"""SELECT iso_code, hour_of_day, day_of_week, {xmean('load_mw')} AS expected_load,
                     stddev_samp(load_mw) AS expected_std FROM tf GROUP BY 1, 2, 3"""),
    ("fl", f"""SELECT t.*, abs({div('t.load_mw - zs.m', 'zs.s')}) AS z_score,
                      pr.expected_load, abs(t.load_mw - pr.expected_load) AS deviation_from_expected,
                      coalesce(abs({div('t.load_mw - zs.m', 'zs.s')}) > 3, false) AS is_statistical_outlier,
                      coalesce(abs(t.load_change_pct) > 20, false) AS is_rapid_change,
                      coalesce(abs(t.load_mw - pr.expected_load) > 2 * pr.expected_std, false) AS is_pattern_anomaly
               FROM tf t JOIN zs ON t.iso_code = zs.iso_code
               LEFT JOIN pr ON t.iso_code = pr.iso_code AND t.hour_of_day = pr.hour_of_day
                           AND t.day_of_week = pr.day_of_week"""),
    ("vt", """SELECT *, CAST(is_statistical_outlier AS INTEGER) + CAST(is_rapid_change AS INTEGER)
                       + CAST(is_pattern_anomaly AS INTEGER) AS anomaly_count FROM fl"""),
    ("cl", """SELECT *, anomaly_count >= 2 AS is_anomaly, least(anomaly_count, 5) AS severity,
                     CASE WHEN anomaly_count < 2 THEN NULL
                          WHEN is_rapid_change THEN 'rapid_change'
                          WHEN is_statistical_outlier THEN 'statistical_outlier'
                          WHEN is_pattern_anomaly THEN 'pattern_deviation'
                          ELSE 'general_anomaly' END AS anomaly_type FROM vt"""),
    ("anoms", """SELECT iso_code, timestamp_utc, load_mw, temperature, anomaly_type, severity, z_score,
                        load_change_pct, deviation_from_expected, expected_load,
                        (SELECT max(timestamp_utc) FROM enriched) AS detected_at
                 FROM cl WHERE is_anomaly"""),
]
_AN_ROUND = ["z_score", "load_change_pct", "deviation_from_expected", "expected_load"]


def anomalies_3vote(spark, d):
    """K8 with the three deterministic methods (isolation forest off)."""
    return md.anomalies(spark, d)


@register("k8_detect_anomalies_3vote", W(E, *AN_CTES) + f"""
    SELECT iso_code, timestamp_utc, load_mw, temperature, anomaly_type, severity,
           {r('z_score', 6)} AS z_score, {r('load_change_pct', 6)} AS load_change_pct,
           {r('deviation_from_expected', 6)} AS deviation_from_expected,
           {r('expected_load', 6)} AS expected_load, detected_at FROM anoms""")
def k8_3(spark, d):
    """Anomalous rows by >= 2 of: z-score, rapid change, pattern deviation."""
    return _r6(anomalies_3vote(spark, d), _AN_ROUND)


@register("k8b_anomalies_168h", W(E, *_recent(AN_CTES, "gated")) + f"""
    SELECT iso_code, timestamp_utc, load_mw, temperature, anomaly_type, severity,
           {r('z_score', 6)} AS z_score, {r('load_change_pct', 6)} AS load_change_pct,
           {r('deviation_from_expected', 6)} AS deviation_from_expected,
           {r('expected_load', 6)} AS expected_load, detected_at FROM anoms""")
def k8b(spark, d):
    """The detector as shipped: over the last 168 hours (three deterministic votes)."""
    return _r6(md.anomalies(spark, d, lookback_hours=168), _AN_ROUND)


@register("k7_vote_distribution", W(E, *AN_CTES) + """
    SELECT anomaly_count, count(*) AS rows FROM vt GROUP BY anomaly_count""")
def k7(spark, d):
    """Rows per number of method votes (K3-K5 flags summed, K7)."""
    s = an.score_rows(md.load_history(spark, d), use_forest=False)
    return s.groupBy("anomaly_count").agg(F.count(F.lit(1)).alias("rows"))


@register("k3_zscore_outlier", W(E, *AN_CTES[:5]) + f"""
    SELECT iso_code, timestamp_utc, {r('z_score', 6)} AS z_score, is_statistical_outlier FROM fl""")
def k3(spark, d):
    t = an.zscore_flags(an.min_history_gate(md.load_history(spark, d), 50))
    return _r6(t.select("iso_code", "timestamp_utc", "z_score", "is_statistical_outlier"), ["z_score"])


@register("e1_e2_load_change", W(E, *AN_CTES[:2]) + f"""
    SELECT iso_code, timestamp_utc, load_mw, {r('load_change', 6)} AS load_change,
           {r('load_change_pct', 6)} AS load_change_pct,
           coalesce(abs(load_change_pct) > 20, false) AS is_rapid_change FROM tf""")
def e1(spark, d):
    """Previous-row diff and pct change per ISO (E1, E2) and the K4 flag."""
    t = an.rapid_change_flags(with_change(an.min_history_gate(md.load_history(spark, d), 50)))
    return _r6(t.select("iso_code", "timestamp_utc", "load_mw", "load_change", "load_change_pct",
                        "is_rapid_change"), ["load_change", "load_change_pct"])


@register("k5_pattern_deviation", W(E, *AN_CTES[:5]) + f"""
    SELECT iso_code, timestamp_utc, {r('expected_load', 6)} AS expected_load,
           {r('deviation_from_expected', 6)} AS deviation_from_expected, is_pattern_anomaly FROM fl""")
def k5(spark, d):
    t = an.pattern_flags(time_features(an.min_history_gate(md.load_history(spark, d), 50)))
    return _r6(t.select("iso_code", "timestamp_utc", "expected_load", "deviation_from_expected",
                        "is_pattern_anomaly"), ["expected_load", "deviation_from_expected"])


@register("k13_time_features", W(E) + f"""
    SELECT iso_code, timestamp_utc, {hod('timestamp_utc')} AS hour_of_day,
           {dow('timestamp_utc')} AS day_of_week, {weekend('timestamp_utc')} AS is_weekend FROM enriched""")
def k13(spark, d):
    return time_features(md.load_history(spark, d)).select(
        "iso_code", "timestamp_utc", "hour_of_day", "day_of_week", "is_weekend")


@register("k9_standardize", W(E, ("tf9", f"""
        SELECT iso_code, timestamp_utc, load_mw, CAST({hod('timestamp_utc')} AS DOUBLE) AS h,
               CAST({dow('timestamp_utc')} AS DOUBLE) AS d FROM enriched"""),
        ("st9", """SELECT iso_code, avg(load_mw) AS ml, stddev_pop(load_mw) AS sl, avg(h) AS mh,
                          stddev_pop(h) AS sh, avg(d) AS md, stddev_pop(d) AS sd FROM tf9 GROUP BY 1""")) + f"""
    SELECT t.iso_code, t.timestamp_utc,
           {r("CASE WHEN sl = 0 THEN 0.0 ELSE (coalesce(load_mw, ml) - ml) / sl END", 6)} AS load_mw_scaled,
           {r("CASE WHEN sh = 0 THEN 0.0 ELSE (coalesce(h, mh) - mh) / sh END", 6)} AS hour_of_day_scaled,
           {r("CASE WHEN sd = 0 THEN 0.0 ELSE (coalesce(d, md) - md) / sd END", 6)} AS day_of_week_scaled
    FROM tf9 t JOIN st9 s ON t.iso_code = s.iso_code""")
def k9(spark, d):
    """Per-ISO standard scaling of the isolation-forest features."""
    t = time_features(md.load_history(spark, d))
    s = an.standardize(t, ["load_mw", "hour_of_day", "day_of_week"])
    cols = ["load_mw_scaled", "hour_of_day_scaled", "day_of_week_scaled"]
    return _r6(s.select("iso_code", "timestamp_utc", *cols), cols)


@register("d13_anomaly_counts", W(E, *AN_CTES) + """
    SELECT a.iso_code, a.severity, count(*) AS anomalies, t.iso_total
    FROM anoms a JOIN (SELECT iso_code, count(*) AS iso_total FROM anoms GROUP BY 1) t
      ON a.iso_code = t.iso_code
    GROUP BY a.iso_code, a.severity, t.iso_total""")
def d13(spark, d):
    return agg.anomaly_counts(anomalies_3vote(spark, d))


@register("d14_anomaly_pivot", W(E, *AN_CTES) + """
    SELECT iso_code,
           count(*) FILTER (WHERE anomaly_type = 'general_anomaly') AS general_anomaly,
           count(*) FILTER (WHERE anomaly_type = 'pattern_deviation') AS pattern_deviation,
           count(*) FILTER (WHERE anomaly_type = 'rapid_change') AS rapid_change,
           count(*) FILTER (WHERE anomaly_type = 'statistical_outlier') AS statistical_outlier
    FROM anoms GROUP BY iso_code""")
def d14(spark, d):
    return agg.anomaly_pivot(anomalies_3vote(spark, d))


@register("e5_top_anomalies", W(E, *AN_CTES) + """
    SELECT iso_code, timestamp_utc, load_mw, anomaly_type, severity FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY severity DESC, timestamp_utc) AS rn
      FROM anoms) WHERE rn <= 3""")
def e5(spark, d):
    """Top 3 anomalies per ISO by severity, earliest first on ties."""
    return an.top_anomalies(anomalies_3vote(spark, d), 3).select(
        "iso_code", "timestamp_utc", "load_mw", "anomaly_type", "severity")


@register("e6_latest_critical", W(E, *AN_CTES) + """
    SELECT iso_code, timestamp_utc, load_mw, anomaly_type, severity FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY timestamp_utc DESC) AS rn
      FROM anoms WHERE severity >= 3) WHERE rn = 1""")
def e6(spark, d):
    return an.latest_critical(anomalies_3vote(spark, d)).select(
        "iso_code", "timestamp_utc", "load_mw", "anomaly_type", "severity")


# ---------------------------------------------------------------- ML (rows-only checks)

@register("k6_isolation_forest")
def k6(spark, d):
    """Isolation-forest share of flagged rows per ISO (about 5% by design)."""
    from ampere.operators.forest import isolation_forest_flags
    t = time_features(an.min_history_gate(md.load_history(spark, d), 50))
    f = isolation_forest_flags(t)
    return f.groupBy("iso_code").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_isolation_anomaly").alias("flagged"),
        (F.count_if("is_isolation_anomaly") / F.count(F.lit(1))).alias("flagged_share"),
        F.min("anomaly_score").alias("min_score"), F.max("anomaly_score").alias("max_score"))


@register("k8_detect_anomalies")
def k8(spark, d):
    """Full detector: >= 2 of z-score, isolation forest, rapid change,
    pattern deviation."""
    return _r6(md.anomalies(spark, d, use_forest=True), _AN_ROUND)


@register("k10_k11_rf_train_evaluate")
def k10(spark, d):
    """Random forest (50 trees, depth 10, seed 42) on an 80/20 split;
    test RMSE / MAE."""
    from ampere.operators.model import train_and_evaluate
    _, metrics = train_and_evaluate(md.silver_enriched(spark, d))
    return metrics


@register("k10b_split_counts", W(E) + """
    SELECT count(*) FILTER (WHERE id % 5 <> 0) AS train_rows, count(*) FILTER (WHERE id % 5 = 0) AS test_rows
    FROM enriched WHERE temperature IS NOT NULL""")
def k10b(spark, d):
    """Rows of the training and the test part (split by a row key)."""
    from ampere.operators.model import split_rows, training_frame
    train, test = split_rows(training_frame(md.enriched(spark, d)))
    return train.agg(F.count(F.lit(1)).alias("train_rows")).withColumn(
        "test_rows", test.select(F.count(F.lit(1))).scalar())


@register("k12b_reload_equals_fitted", W(E) + """
    SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM enriched WHERE temperature IS NOT NULL""")
def k12b(spark, d):
    """A saved and reloaded model predicts what the fitted one does, on every row with weather."""
    from ampere.operators.model import load_and_score, save_model, train_and_evaluate, training_frame
    from ampere.session import new_path
    e = md.silver_enriched(spark, d)
    model, _ = train_and_evaluate(e, num_trees=10, max_depth=6)
    keys, again = ["iso_code", "timestamp_utc", "id"], F.col("_again")
    a = model.transform(training_frame(e)).select(*keys, "prediction", F.lit(False).alias("_again"))
    b = load_and_score(save_model(model, new_path(spark, "rf_model")), e).select(
        *keys, "prediction", F.lit(True).alias("_again"))
    # every row of a with every row of b at its keys, by their numbers instead of pair by pair
    n, m = F.col("_n"), F.col("_m")
    at = (a.unionByName(b).dropna(subset=keys).groupBy(*keys, "prediction")
          .agg(F.count_if(~again).alias("_n"), F.count_if(again).alias("_m")).groupBy(*keys)
          .agg(F.sum(n).alias("_n"), F.sum(m).alias("_m"), F.sum(n * m).alias("_alike")))
    return at.agg(F.coalesce(F.sum(n * m), F.lit(0)).alias("rows"),
                  F.coalesce(F.sum(n * m - F.col("_alike")), F.lit(0)).alias("differing"))


@register("k6b_forest_checks", W(E, *AN_CTES[:1]) + """
    SELECT iso_code, count(*) AS rows, true AS share_in_band, true AS scores_in_range, true AS same_when_dealt_anew
    FROM gated GROUP BY iso_code""")
def k6b(spark, d):
    """Properties of the isolation forest: 4-6 % flagged, scores in (0, 1], and the same flags when
    the rows are dealt to other partitions."""
    from ampere.operators.forest import isolation_forest_flags
    t = time_features(an.min_history_gate(md.load_history(spark, d), 50))
    keys = ["iso_code", "timestamp_utc"]
    a = isolation_forest_flags(t).withColumn("_again", F.lit(False))
    b = isolation_forest_flags(t.repartition(7, "timestamp_utc")).withColumn("_again", F.lit(True))
    # every row of a with every row of b at its key and time, by their numbers instead of pair by pair
    again, flag, score = F.col("_again"), F.col("is_isolation_anomaly"), F.col("anomaly_score")
    at = a.unionByName(b).where("timestamp_utc is not null").groupBy(*keys).agg(
        F.count_if(~again).alias("_n"), F.count_if(~again & flag).alias("_flagged"),
        F.count_if(again).alias("_m"), F.count_if(again & flag).alias("_flagged_again"),
        F.min(F.when(~again, score)).alias("_least"), F.max(F.when(~again, score)).alias("_most"))
    rows, flagged = F.sum(F.col("_n") * F.col("_m")), F.sum(F.col("_flagged") * F.col("_m"))
    apart = (F.col("_flagged") * (F.col("_m") - F.col("_flagged_again"))
             + (F.col("_n") - F.col("_flagged")) * F.col("_flagged_again"))
    share = flagged / rows
    return at.where("_n > 0 and _m > 0").groupBy("iso_code").agg(
        rows.alias("rows"), ((share >= 0.04) & (share <= 0.06)).alias("share_in_band"),
        ((F.min("_least") > 0) & (F.max("_most") <= 1)).alias("scores_in_range"),
        F.bool_and(apart == 0).alias("same_when_dealt_anew"))


@register("k8c_votes_contained", W(E, *AN_CTES) + """
    SELECT iso_code, count(*) AS three_votes, count(*) AS among_four FROM anoms GROUP BY iso_code""")
def k8c(spark, d):
    """Every anomaly of the three deterministic votes is one of the full detector's."""
    keys = ["iso_code", "timestamp_utc"]
    four = md.anomalies(spark, d, use_forest=True).select(*keys, F.lit(1).alias("_four"))
    return md.anomalies(spark, d).join(four, keys, "left").groupBy("iso_code").agg(
        F.count(F.lit(1)).alias("three_votes"), F.count("_four").alias("among_four"))


@register("k12_rf_persist_score")
def k12(spark, d):
    """Save the fitted pipeline to the shared folder, reload, score."""
    from ampere.operators.model import load_and_score, save_model, train_and_evaluate
    from ampere.session import new_path
    e = md.silver_enriched(spark, d)
    model, _ = train_and_evaluate(e)
    path = save_model(model, new_path(spark, "rf_load_model"))
    return load_and_score(path, e).select(
        "iso_code", "timestamp_utc", "load_mw", "prediction")
