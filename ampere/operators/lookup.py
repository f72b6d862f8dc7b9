"""API range lookups re-aimed as DataFrame queries.

``iso`` is upper-cased as the API does; ``start`` is inclusive and ``end``
exclusive; newest first; the limit is the feature (a page of rows).
Filters on ``iso_code`` / time reach the parquet scan as pushed filters
(and prune ``iso_code=`` partitions on partitioned gold tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _range(df: DataFrame, time_col: str, iso: str, start: str | None, end: str | None,
           limit: int, cols: list[str]) -> DataFrame:
    if not 1 <= limit <= 10000:
        raise ValueError("limit must be within 1..10000")
    x = df.where(F.col("iso_code") == iso.upper())
    if start:
        x = x.where(F.col(time_col) >= F.lit(start).cast(df.schema[time_col].dataType))
    if end:
        x = x.where(F.col(time_col) < F.lit(end).cast(df.schema[time_col].dataType))
    return x.select(*cols).orderBy(F.col(time_col).desc()).limit(limit)


def hourly_demand_view(hourly: DataFrame) -> DataFrame:
    """``grid_iso_hourly_demand(iso_code, hour, avg_load_mw)``."""
    return hourly.select("iso_code", "hour", "avg_load_mw")


def daily_demand_view(daily: DataFrame) -> DataFrame:
    """``grid_iso_daily_demand(iso_code, day, avg_load_mw)``."""
    return daily.select("iso_code", F.col("date").alias("day"), "avg_load_mw")


def hourly_enriched_view(hourly: DataFrame) -> DataFrame:
    """``grid_iso_hourly_enriched(iso_code, hour, load_mw, weather...)``."""
    return hourly.select("iso_code", "hour", F.col("avg_load_mw").alias("load_mw"),
                         F.col("avg_temperature").alias("temperature"),
                         F.col("avg_wind_speed").alias("wind_speed"),
                         F.col("avg_humidity").alias("humidity"))


def hourly_range(view: DataFrame, iso: str, start=None, end=None, limit: int = 100) -> DataFrame:
    """F1."""
    return _range(view, "hour", iso, start, end, limit, ["iso_code", "hour", "avg_load_mw"])


def daily_range(view: DataFrame, iso: str, start=None, end=None, limit: int = 365) -> DataFrame:
    """F2."""
    return _range(view, "day", iso, start, end, limit, ["iso_code", "day", "avg_load_mw"])


def enriched_range(view: DataFrame, iso: str, start=None, end=None, limit: int = 200) -> DataFrame:
    """F3."""
    return _range(view, "hour", iso, start, end, limit,
                  ["iso_code", "hour", "load_mw", "temperature", "wind_speed", "humidity"])


def peak_hour(hourly: DataFrame) -> DataFrame:
    """Per ISO the hourly row with the highest average load (earliest
    hour on ties).  A grouped ``max_by``; no per-ISO window."""
    best = F.max_by(F.struct("hour", "hour_of_day", "avg_load_mw"),
                    F.struct(F.col("avg_load_mw"), -F.unix_micros(F.col("hour").cast("timestamp"))))
    return hourly.groupBy("iso_code").agg(best.alias("p")).select(
        "iso_code", "p.hour", "p.hour_of_day", "p.avg_load_mw")
