"""Seasonal-profile load forecast (K1, K2) and helpers.

All ISOs are forecast in one plan (the reference loops per ISO).  Per-ISO
and per-(ISO, hour, weekday) statistics are small grouped aggregates; the
planner broadcasts them by size when joining back.  "Now" is an explicit
``as_of`` column expression; the default is the newest timestamp in the
data, evaluated as a scalar subquery (no wall clock, no driver collect).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ampere.functions.numeric import exact_mean_aggs, finish_mean
from ampere.functions.timecols import hour_of_day, weekday_mon0, weekend_flag
from ampere.operators.attach import small_side

# Fixed values of the reference forecast.
MODEL_VERSION = "simple_v1"
CONFIDENCE = 0.95
Z_95 = 1.96
FALLBACK_LOWER = 0.9
FALLBACK_UPPER = 1.1


def newest(df: DataFrame, ts: str = "timestamp_utc") -> Column:
    """max(ts) over the whole frame as a scalar subquery expression."""
    return df.select(F.max(ts)).scalar()


def hours(n) -> Column:
    return F.make_dt_interval(hours=F.lit(n) if not isinstance(n, Column) else n)


def scan_recent(df: DataFrame, hours_back: int | None = 168, as_of: Column | None = None,
                ts: str = "timestamp_utc") -> DataFrame:
    """A4: rows with ts >= as_of - hours_back (all rows if ``hours_back`` is None)."""
    if hours_back is None:
        return df
    as_of = newest(df, ts) if as_of is None else as_of
    return df.where(F.col(ts) >= as_of - hours(hours_back))


def future_grid(last: DataFrame, hours_ahead: int = 24) -> DataFrame:
    """K1: per ISO, last ts + 1..H hours with hour / weekday / weekend."""
    f = last.select("iso_code", F.explode(F.sequence(F.lit(1), F.lit(hours_ahead))).alias("h"),
                    "last_ts")
    f = f.select("iso_code", (F.col("last_ts") + hours(F.col("h"))).alias("timestamp_utc"))
    f = f.withColumns({"hour_of_day": hour_of_day("timestamp_utc"),
                       "day_of_week": weekday_mon0("timestamp_utc")})
    return f.withColumn("is_weekend", weekend_flag(F.col("day_of_week")))


def iso_stats(hist: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Per ISO: newest ts, row count, mean load and the 24h/24h trend (E3);
    ISOs with fewer than ``min_rows`` rows are dropped (B15).

    The trend compares mean load in [last-24h, last] with [last-48h,
    last-24h); 1.0 when either window is empty or the older mean <= 0.
    Two grouped passes: the per-ISO summary (which is also the history
    gate: dropping a whole ISO changes no other ISO's numbers), then
    conditional averages after joining it back (size-checked broadcast)."""
    last = finish_mean(hist.groupBy("iso_code").agg(
        F.max("timestamp_utc").alias("last_ts"), F.count(F.lit(1)).alias("n_rows"),
        *exact_mean_aggs("load_mw", "overall_avg")), "overall_avg")
    if min_rows:
        last = last.where(F.col("n_rows") >= min_rows)
    last = small_side(last)
    j = hist.select("iso_code", "timestamp_utc", "load_mw").join(
        last.select("iso_code", "last_ts"), "iso_code")
    ts, lt = F.col("timestamp_utc"), F.col("last_ts")
    recent = ts >= lt - hours(24)
    older = (ts >= lt - hours(48)) & (ts < lt - hours(24))
    tr = j.groupBy("iso_code").agg(
        *exact_mean_aggs(F.when(recent, F.col("load_mw")), "recent_avg"),
        *exact_mean_aggs(F.when(older, F.col("load_mw")), "older_avg"))
    tr = finish_mean(finish_mean(tr, "recent_avg"), "older_avg")
    trend = (F.when(F.col("recent_avg").isNotNull() & F.col("older_avg").isNotNull(),
                    F.when(F.col("older_avg") > 0, F.col("recent_avg") / F.col("older_avg"))
                    .otherwise(F.lit(1.0)))
             .otherwise(F.lit(1.0)))
    return last.join(tr, "iso_code").withColumn("trend_factor", trend)


def slot_profile(hist: DataFrame) -> DataFrame:
    """Mean / sample std / count of load per (ISO, hour, weekday)."""
    p = hist.groupBy("iso_code", hour_of_day("timestamp_utc").alias("hour_of_day"),
                     weekday_mon0("timestamp_utc").alias("day_of_week")).agg(
        *exact_mean_aggs("load_mw", "avg_load"), F.stddev_samp("load_mw").alias("std_load"),
        F.count("load_mw").alias("count"))
    return finish_mean(p, "avg_load")


def seasonal_forecast(hist: DataFrame, hours_ahead: int = 24, min_rows: int = 24,
                      lookback_hours: int | None = 168, as_of: Column | None = None) -> DataFrame:
    """K2: profile mean x trend, 95% band from the slot std.

    Missing forecast (unseen slot) -> ISO mean; missing band bounds are
    filled independently -> mean*0.9 / mean*1.1 (so a one-sample slot keeps
    its forecast but gets the fallback band).  ISOs with fewer than
    ``min_rows`` rows are skipped.  ``forecast_generated_at`` = as_of.
    """
    hist = hist.select("iso_code", "timestamp_utc", "load_mw")
    as_of = newest(hist) if as_of is None else as_of
    hist = scan_recent(hist, lookback_hours, as_of)
    # the gate lives in iso_stats; profiles of gated-out ISOs join nothing
    st = iso_stats(hist, min_rows)
    fut = future_grid(st.select("iso_code", "last_ts"), hours_ahead)
    fc = fut.join(slot_profile(hist), ["iso_code", "hour_of_day", "day_of_week"], "left") \
            .join(st.select("iso_code", "trend_factor", "overall_avg"), "iso_code")
    f = F.col("avg_load") * F.col("trend_factor")
    lo = f - Z_95 * F.col("std_load")
    hi = f + Z_95 * F.col("std_load")
    m = F.col("overall_avg")
    return fc.select(
        "iso_code", "timestamp_utc",
        F.coalesce(f, m).alias("forecasted_load_mw"),
        F.coalesce(lo, m * FALLBACK_LOWER).alias("ci_lower"),
        F.coalesce(hi, m * FALLBACK_UPPER).alias("ci_upper"),
        as_of.alias("forecast_generated_at"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.lit(CONFIDENCE).alias("confidence"),
    )


def hours_ahead_rank(fc: DataFrame) -> DataFrame:
    """Whole hours from the earliest forecast timestamp, plus one."""
    first = fc.select(F.min("timestamp_utc")).scalar()
    return fc.withColumn("hours_ahead", (F.floor(
        (F.unix_micros(F.col("timestamp_utc").cast("timestamp")) - F.unix_micros(first.cast("timestamp")))
        / F.lit(3_600_000_000)) + 1).cast("int"))


def forecast_by_iso(fc: DataFrame, iso: str, n_hours: int = 24) -> DataFrame:
    """first ``n_hours`` (1..168) forecasts of one ISO, 2 dp."""
    from ampere.functions.numeric import round_half_even
    if not 1 <= n_hours <= 168:
        raise ValueError("hours must be within 1..168")
    x = fc.where(F.col("iso_code") == iso.upper()).orderBy("timestamp_utc").limit(n_hours)
    return x.select("iso_code", "timestamp_utc",
                    round_half_even("forecasted_load_mw").alias("forecasted_load_mw"),
                    round_half_even("ci_lower").alias("ci_lower"),
                    round_half_even("ci_upper").alias("ci_upper"),
                    "model_version", "forecast_generated_at")


def forecast_compare(fc: DataFrame, n_hours: int = 1) -> DataFrame:
    """all ISOs side by side per hour ahead (1..24), long form: one row
    per (hours_ahead, iso) with the hour's first timestamp."""
    from ampere.functions.numeric import round_half_even
    if not 1 <= n_hours <= 24:
        raise ValueError("hours must be within 1..24")
    r = hours_ahead_rank(fc).where(F.col("hours_ahead") <= n_hours)
    w = Window.partitionBy("hours_ahead")
    return r.select(
        "hours_ahead", F.min("timestamp_utc").over(w).alias("hour_timestamp_utc"), "iso_code",
        round_half_even("forecasted_load_mw").alias("load_mw"),
        round_half_even("ci_lower").alias("ci_lower"),
        round_half_even("ci_upper").alias("ci_upper"))


def with_ci_struct(df: DataFrame) -> DataFrame:
    """The API's nested band: ``confidence_interval`` {lower, upper}."""
    return df.withColumn("confidence_interval", F.struct(F.col("ci_lower").alias("lower"),
                                                         F.col("ci_upper").alias("upper"))) \
             .drop("ci_lower", "ci_upper")


def forecast_compare_wide(fc: DataFrame, n_hours: int = 1) -> DataFrame:
    """F5 side by side: one row per hour ahead with a map ISO -> {load_mw,
    ci_lower, ci_upper}.  The map collects one entry per ISO of that hour
    (a group bounded by the number of ISOs)."""
    long = forecast_compare(fc, n_hours)
    return long.groupBy("hours_ahead", "hour_timestamp_utc").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            "iso_code", F.struct("load_mw", "ci_lower", "ci_upper"))))).alias("forecasts"))


def forecast_peak(fc: DataFrame, as_of: Column | None = None) -> DataFrame:
    """peak forecast row per ISO (earliest on ties) and whole hours
    from ``as_of`` until it (truncated toward zero)."""
    from ampere.functions.numeric import round_half_even
    as_of = F.col("forecast_generated_at") if as_of is None else as_of
    p = fc.groupBy("iso_code").agg(F.max_by(
        F.struct("timestamp_utc", "forecasted_load_mw", "ci_lower", "ci_upper", "forecast_generated_at"),
        F.struct(F.col("forecasted_load_mw"), -F.unix_micros(F.col("timestamp_utc").cast("timestamp")))
    ).alias("p")).select("iso_code", "p.*")
    until = (F.unix_micros(F.col("timestamp_utc").cast("timestamp"))
             - F.unix_micros(as_of.cast("timestamp"))) / F.lit(3_600_000_000)
    return p.select(
        "iso_code", round_half_even("forecasted_load_mw").alias("peak_load_mw"),
        F.col("timestamp_utc").alias("peak_time_utc"),
        F.when(until >= 0, F.floor(until)).otherwise(F.ceil(until)).cast("int").alias("hours_until_peak"),
        round_half_even("ci_lower").alias("ci_lower"), round_half_even("ci_upper").alias("ci_upper"),
        "forecast_generated_at")
