"""Time helpers.  Timestamps in and out are TIMESTAMP_NTZ (naive UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c: Column | str) -> Column:
    return _c(c).cast("timestamp_ntz")


def epoch_us(c: Column | str) -> Column:
    """Microseconds since the epoch of a naive-UTC timestamp."""
    return F.unix_micros(_c(c).cast("timestamp"))


def floor_hour(c: Column | str) -> Column:
    # date_trunc returns TIMESTAMP; cast back so the column stays naive UTC
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz")


def hour_of_day(c: Column | str) -> Column:
    return F.hour(_c(c))


def weekday_mon0(c: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6 (the pipeline convention)."""
    return F.weekday(_c(c))


def weekday_sun1(c: Column | str) -> Column:
    """Sunday = 1 ... Saturday = 7 (the training-feature convention)."""
    return F.dayofweek(_c(c))


def weekend_flag(dow_mon0: Column) -> Column:
    return (dow_mon0 >= 5).cast("int")


def day_name(c: Column | str) -> Column:
    return F.date_format(_c(c), "EEEE")


def time_features(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """hour_of_day, day_of_week (Mon=0) and is_weekend."""
    return df.withColumns({
        "hour_of_day": hour_of_day(ts),
        "day_of_week": weekday_mon0(ts),
    }).withColumn("is_weekend", weekend_flag(F.col("day_of_week")))
