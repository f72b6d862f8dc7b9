"""Gold-layer aggregations.

All are grouped hash aggregates with map-side partial aggregation, keyed
by (iso, hour) / (iso, date) / iso.  Ratios are computed from unrounded
inputs, then every fractional column is rounded half-even to 2 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ampere.functions.numeric import (exact_mean_aggs, exact_sum, finish_mean, half_even_quotient,
                                     round_all, round_half_even)
from ampere.functions.timecols import (day_name, epoch_us, hour_of_day,
                                       weekday_mon0, weekend_flag)


_MEAN_COLS = {"avg_load_mw": "load_mw", "avg_temperature": "temperature",
              "avg_wind_speed": "wind_speed", "avg_humidity": "humidity"}


def _load_weather_aggs(with_sum: bool = False):
    """Aggregates of the hourly / daily tables.  Means are kept twice: a
    double (input of the ratio columns) and an exact decimal sum plus a
    count, from which ``_finish`` derives the reported, exactly rounded
    mean (see ``half_even_quotient``)."""
    aggs = [
        F.avg("load_mw").alias("_avg_load_raw"),
        F.min("load_mw").alias("min_load_mw"),
        F.max("load_mw").alias("max_load_mw"),
        F.stddev_samp("load_mw").alias("std_load_mw"),
        F.count("load_mw").alias("data_points"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.max("wind_speed").alias("max_wind_speed"),
    ]
    for out, src in _MEAN_COLS.items():
        aggs += [exact_sum(src).alias(f"_s_{out}"), F.count(src).alias(f"_n_{out}")]
    return aggs


def _finish(df, with_sum: bool = False, order: list[str] | None = None):
    cols = {out: half_even_quotient(f"_s_{out}", f"_n_{out}") for out in _MEAN_COLS}
    if with_sum:
        # pandas sums an all-null group to 0
        cols["total_load_mwh"] = F.coalesce(half_even_quotient("_s_avg_load_mw", None), F.lit(0.0))
    df = df.withColumns(cols)
    drop = [f"_{k}_{out}" for out in _MEAN_COLS for k in ("s", "n")] + ["_avg_load_raw"]
    return df.select(*(order or [c for c in df.columns if c not in drop]))


_BASE_ORDER = ["avg_load_mw", "min_load_mw", "max_load_mw", "std_load_mw"]
_WX_ORDER = ["data_points", "avg_temperature", "min_temperature", "max_temperature",
             "avg_wind_speed", "max_wind_speed", "avg_humidity"]


def hourly_metrics(enriched: DataFrame) -> DataFrame:
    """Per (iso_code, hour)."""
    h = enriched.groupBy("iso_code", "hour").agg(*_load_weather_aggs())
    h = h.withColumn("load_variability",
                     round_half_even(F.try_divide(F.col("std_load_mw"), F.col("_avg_load_raw")) * 100))
    h = h.withColumns({"hour_of_day": hour_of_day("hour"), "day_of_week": weekday_mon0("hour")})
    h = h.withColumn("is_weekend", weekend_flag(F.col("day_of_week")))
    h = _finish(h, order=["iso_code", "hour", *_BASE_ORDER, *_WX_ORDER, "load_variability",
                          "hour_of_day", "day_of_week", "is_weekend"])
    return round_all(h)


def hourly_sums(enriched: DataFrame) -> DataFrame:
    """Exact (decimal) per-hour load sums (input of the C5 consistency check)."""
    return enriched.groupBy("iso_code", "hour").agg(exact_sum("load_mw").alias("sum_load_mw"))


def daily_metrics(enriched: DataFrame) -> DataFrame:
    """Per (iso_code, date)."""
    # the date is kept as a midnight timestamp, like the reference's frame
    d = enriched.groupBy("iso_code", F.to_date("timestamp_utc").cast("timestamp_ntz").alias("date")) \
                .agg(*_load_weather_aggs(with_sum=True))
    d = d.withColumns({
        "peak_to_avg_ratio": round_half_even(F.try_divide(F.col("max_load_mw"), F.col("_avg_load_raw"))),
        "load_factor": round_half_even(F.try_divide(F.col("_avg_load_raw"), F.col("max_load_mw")) * 100),
        "day_of_week": weekday_mon0("date"),
    })
    d = d.withColumns({"is_weekend": weekend_flag(F.col("day_of_week")),
                       "day_name": day_name("date")})
    d = _finish(d, with_sum=True, order=["iso_code", "date", *_BASE_ORDER, "total_load_mwh", *_WX_ORDER,
                                         "peak_to_avg_ratio", "load_factor", "day_of_week",
                                         "is_weekend", "day_name"])
    return round_all(d)


def daily_sums(enriched: DataFrame) -> DataFrame:
    """Exact (decimal) load sum per (iso, day): the consistency-check side."""
    return enriched.groupBy("iso_code", F.to_date("timestamp_utc").cast("timestamp_ntz").alias("date")) \
                   .agg(exact_sum("load_mw").alias("sum_load_mw"))


def iso_summary(enriched: DataFrame) -> DataFrame:
    """D3 with D4 (completeness), D5 (span days) and D6 (capacity)."""
    s = enriched.groupBy("iso_code").agg(
        F.min("timestamp_utc").alias("data_start"),
        F.max("timestamp_utc").alias("data_end"),
        F.count("timestamp_utc").alias("total_observations"),
        F.avg("load_mw").alias("avg_load_mw"),
        F.min("load_mw").alias("min_load_mw"),
        F.max("load_mw").alias("max_load_mw"),
        F.stddev_samp("load_mw").alias("std_load_mw"),
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.avg("humidity").alias("avg_humidity"),
        F.count("temperature").alias("_with_temp"),
        F.count(F.lit(1)).alias("_rows"),
        *[x for out, src in _MEAN_COLS.items()
          for x in (exact_sum(src).alias(f"_s_{out}"), F.count(src).alias(f"_n_{out}"))],
    )
    s = s.withColumns({
        "data_completeness": round_half_even(F.col("_with_temp") / F.col("_rows") * 100),
        "data_span_days": round_half_even(
            (epoch_us("data_end") - epoch_us("data_start")) / F.lit(1e6) / F.lit(86400.0), 1),
        "estimated_capacity_mw": round_half_even(F.col("max_load_mw") * 1.1, 0),
    })
    s = s.withColumn("avg_capacity_factor", round_half_even(
        F.try_divide(F.col("avg_load_mw"), F.col("estimated_capacity_mw")) * 100))
    s = s.withColumns({out: half_even_quotient(f"_s_{out}", f"_n_{out}") for out in _MEAN_COLS})
    s = s.drop("_with_temp", "_rows", *[f"_{k}_{out}" for out in _MEAN_COLS for k in ("s", "n")])
    return round_all(s)


def clean_summary(grid: DataFrame) -> DataFrame:
    """Per iso first/last/count timestamp and mean load (2 dp)."""
    a = grid.groupBy("iso_code").agg(
        F.min("timestamp_utc").alias("ts_min"),
        F.max("timestamp_utc").alias("ts_max"),
        F.count("timestamp_utc").alias("ts_count"),
        exact_sum("load_mw").alias("_s"), F.count("load_mw").alias("_n"))
    return a.withColumn("mean_load_mw", half_even_quotient("_s", "_n")).drop("_s", "_n")


def load_profile(df: DataFrame, key: str = "iso_code") -> DataFrame:
    """Mean / sample std / count of load by (key, hour_of_day, day_of_week)."""
    p = df.groupBy(key, hour_of_day("timestamp_utc").alias("hour_of_day"),
                   weekday_mon0("timestamp_utc").alias("day_of_week")).agg(
        *exact_mean_aggs("load_mw", "mean_load_mw"),
        F.stddev_samp("load_mw").alias("std_load_mw"),
        F.count("load_mw").alias("samples"))
    return finish_mean(p, "mean_load_mw").select(key, "hour_of_day", "day_of_week", "mean_load_mw",
                                                 "std_load_mw", "samples")


def api_hourly_enriched(hourly: DataFrame) -> DataFrame:
    """The API's ``grid_iso_hourly_enriched`` shape over gold hourly metrics.

    ``renewables_mw`` and ``lmp_avg`` are not produced by any feed (the
    reference has no writer for them either): typed nulls."""
    return hourly.select(
        "iso_code", F.col("hour").alias("timestamp_utc"),
        F.col("avg_load_mw").alias("total_load_mw"),
        F.lit(None).cast("double").alias("renewables_mw"),
        F.lit(None).cast("double").alias("lmp_avg"))


def grid_totals(latest: DataFrame) -> DataFrame:
    """Totals over the latest row of every ISO (input: C4 output)."""
    # exact (decimal) sums, as the SQL numeric type of the original query
    a = latest.agg(
        F.count(F.lit(1)).alias("iso_count"),
        F.coalesce(exact_sum("total_load_mw").cast("double"), F.lit(0.0)).alias("total_load_mw"),
        F.coalesce(exact_sum("renewables_mw").cast("double"), F.lit(0.0)).alias("renewables_mw"),
        *exact_mean_aggs("lmp_avg", "avg_price"),
        F.max("timestamp_utc").alias("as_of_utc"))
    a = finish_mean(a, "avg_price")
    return a.select("iso_count", "total_load_mw", "renewables_mw",
                    F.coalesce(F.col("avg_price"), F.lit(0.0)).alias("avg_price"), "as_of_utc")


def temp_load_correlation(hourly: DataFrame, min_rows: int = 10) -> DataFrame:
    """Per ISO Pearson r of hourly avg temperature vs load, nulls
    dropped, reported only with more than ``min_rows`` pairs."""
    pairs = hourly.where(F.col("avg_temperature").isNotNull() & F.col("avg_load_mw").isNotNull())
    return pairs.groupBy("iso_code").agg(
        F.corr("avg_temperature", "avg_load_mw").alias("temp_load_corr"),
        F.count(F.lit(1)).alias("pairs")).where(F.col("pairs") > min_rows)


def weekday_weekend_diff(daily: DataFrame) -> DataFrame:
    """Mean of daily averages, weekday vs weekend, in % of weekend."""
    a = daily.groupBy("iso_code").agg(
        *exact_mean_aggs(F.when(F.col("is_weekend") == 0, F.col("avg_load_mw")), "weekday_avg"),
        *exact_mean_aggs(F.when(F.col("is_weekend") == 1, F.col("avg_load_mw")), "weekend_avg"))
    a = finish_mean(finish_mean(a, "weekday_avg"), "weekend_avg")
    a = a.where(F.col("weekday_avg").isNotNull() & F.col("weekend_avg").isNotNull())
    return a.withColumn("weekday_vs_weekend_pct", F.try_divide(
        F.col("weekday_avg") - F.col("weekend_avg"), F.col("weekend_avg")) * 100)


def load_cv(summary: DataFrame) -> DataFrame:
    """Coefficient of variation per ISO from the (rounded) summary."""
    return summary.select("iso_code", (F.try_divide(F.col("std_load_mw"), F.col("avg_load_mw")) * 100)
                          .alias("load_cv_pct"))


def weather_join_rate(enriched: DataFrame) -> DataFrame:
    """Enriched rows with temperature, count and % (0 when empty)."""
    a = enriched.agg(F.count("temperature").alias("with_weather"),
                     F.count(F.lit(1)).alias("enriched_rows"))
    return a.withColumn("join_rate_pct", F.coalesce(
        F.try_divide(F.col("with_weather") * 100.0, F.col("enriched_rows")), F.lit(0.0)))


ANOMALY_TYPES = ["general_anomaly", "pattern_deviation", "rapid_change", "statistical_outlier"]


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Per ISO and severity count, with the ISO total on every row."""
    per = anomalies.groupBy("iso_code", "severity").agg(F.count(F.lit(1)).alias("anomalies"))
    # the total sums the few counts of an ISO, not its rows again
    return per.withColumn("iso_total", F.sum("anomalies").over(Window.partitionBy("iso_code")))


def anomaly_pivot(anomalies: DataFrame) -> DataFrame:
    """Iso x anomaly type counts, 0 filled (fixed type list: no
    driver-side distinct)."""
    p = anomalies.groupBy("iso_code").pivot("anomaly_type", ANOMALY_TYPES).count()
    return p.fillna(0, subset=ANOMALY_TYPES)


def forecast_summary(fc: DataFrame) -> DataFrame:
    """Per ISO mean/min/max forecast (2 dp), first/last ts and span."""
    s = fc.groupBy("iso_code").agg(
        exact_sum("forecasted_load_mw").alias("_s"), F.count("forecasted_load_mw").alias("_n"),
        round_half_even(F.min("forecasted_load_mw")).alias("min_forecast_mw"),
        round_half_even(F.max("forecasted_load_mw")).alias("max_forecast_mw"),
        F.min("timestamp_utc").alias("first_ts"),
        F.max("timestamp_utc").alias("last_ts"),
        F.count(F.lit(1)).alias("forecasts"))
    s = s.withColumn("mean_forecast_mw", half_even_quotient("_s", "_n")).drop("_s", "_n")
    return s.select("iso_code", "mean_forecast_mw", "min_forecast_mw", "max_forecast_mw", "first_ts",
                    "last_ts", "forecasts",
                    ((epoch_us("last_ts") - epoch_us("first_ts")) / F.lit(3_600_000_000))
                    .cast("long").alias("horizon_hours"))


def forecast_info(fc: DataFrame) -> DataFrame:
    """Count, sorted distinct ISOs, horizon hours, version, confidence."""
    return fc.agg(
        F.count(F.lit(1)).alias("forecasts_available"),
        F.array_sort(F.collect_set("iso_code")).alias("isos"),
        ((epoch_us(F.max("timestamp_utc")) - epoch_us(F.min("timestamp_utc")))
         / F.lit(3_600_000_000)).cast("long").alias("forecast_horizon_hours"),
        F.min("model_version").alias("model_version"),
        F.min("confidence").alias("confidence_level"),
        F.min("forecast_generated_at").alias("forecast_generated_at"))
