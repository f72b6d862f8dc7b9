"""Joins: nearest as-of (C1), null enrichment (C2), latest row per key (C4) and the daily-vs-hourly consistency join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ampere.functions.timecols import epoch_us, floor_hour
from ampere.operators.attach import small_side
from ampere.operators.ordered import SPLIT_ROWS, slices

WEATHER_COLS = ("temperature", "wind_speed", "humidity")


def asof_nearest(left: DataFrame, right: DataFrame, by: str = "iso_code",
                 on: str = "timestamp_utc", tolerance_seconds: int = 3600,
                 value_cols: Sequence[str] | None = None,
                 bucket_seconds: int = 900, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Left as-of join: for every left row the right row of the same ``by``
    key nearest in ``on``, if within the tolerance (inclusive).

    Ties at equal distance go to the earlier right row; of right rows at the
    same instant the smallest values count (a fixed, documented tie key).
    Every left row stays, repeated ones too; rows without a key or a time
    match nothing.

    Plan: a sort-merge as-of, linear in both sides.  The right side is reduced
    to one row per (by, instant); both sides are put in one column of time and
    cut into buckets, and a bucket of many rows into slices (``ordered.slices``;
    rows of one instant stay together); inside a slice the nearest right row
    before and after is the last / first non-null one in time order.  What lies
    beyond its edges comes from a table of one row a slice.  No pairs are formed,
    and the tolerance decides nothing about the tasks.
    """
    if value_cols is None:
        value_cols = [c for c in right.columns if c not in (by, on)]
    value_cols = list(value_cols)
    tol_us = int(tolerance_seconds) * 1_000_000
    width = F.lit(int(bucket_seconds) * 1_000_000)
    bucket = F.floor(F.col("_t") / width).cast("long")
    lt = left.select(F.col(by).alias("_by"), epoch_us(on).alias("_t"), F.struct(*left.columns).alias("_l"))
    r = (right.select(F.col(by).alias("_by"), epoch_us(on).alias("_t"),
                      F.struct(*[F.col(c) for c in value_cols]).alias("_v"))
         .where(F.col("_by").isNotNull() & F.col("_t").isNotNull())
         .groupBy("_by", "_t").agg(F.min("_v").alias("_v"))
         .select("_by", "_t", F.struct("_t", "_v").alias("_r")))
    rows = (lt.select("_by", "_t", "_l", F.lit(None).cast(r.schema["_r"].dataType).alias("_r"))
            .unionAll(r.select("_by", "_t", F.lit(None).cast(lt.schema["_l"].dataType), "_r"))
            .withColumn("_b", bucket))
    rows, table = slices(rows, ["_by", "_b"], ["_t"], {
        "_lo": F.min_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))),
        "_hi": F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t")))}, split_rows)
    # a frame up to the end is computed anew for every row, so what lies ahead is what has been met in
    # descending order: one step a row in both directions
    inside = Window.partitionBy("_by", "_b", "_sub")
    upto, ahead = (inside.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow)
                   for o in (F.col("_t"), F.col("_t").desc()))
    near = rows.withColumns({"_p": F.last("_r", ignorenulls=True).over(upto),
                             "_n": F.last("_r", ignorenulls=True).over(ahead)})
    # the last reading before a slice and the first one after it, in time order of the slices
    along = Window.partitionBy("_by")
    earlier, later = (along.orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
                      for o in (("_b", "_sub"), (F.col("_b").desc(), F.col("_sub").desc())))
    edges = table.where(F.col("_by").isNotNull()).select(
        F.col("_by").alias("_eby"), F.col("_b").alias("_eb"), F.col("_sub").alias("_esub"),
        F.last("_hi", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_lo", ignorenulls=True).over(later).alias("_after"))
    j = near.where("_l is not null").join(
        small_side(edges), (F.col("_by") == F.col("_eby")) & (F.col("_b") == F.col("_eb"))
        & (F.col("_sub") == F.col("_esub")), "left")
    before, after = F.coalesce("_p", "_before"), F.coalesce("_n", "_after")
    ago, until = F.col("_t") - before["_t"], after["_t"] - F.col("_t")
    best = (F.when((ago <= tol_us) & (until.isNull() | (ago <= until)), before["_v"])
            .when(until <= tol_us, after["_v"]))
    return j.select("_l", best.alias("_m")).select(
        *[F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_m")[c].alias(c) for c in value_cols])


def enrich_with_weather(grid: DataFrame, weather: DataFrame | None,
                        tolerance_seconds: int = 3600) -> DataFrame:
    """Silver enrichment: as-of weather (or typed nulls), floor hour and the
    always-null solar proxy column."""
    if weather is None:
        e = enrich_without_weather(grid)
    else:
        w = weather.select("iso_code", "timestamp_utc", *WEATHER_COLS)
        e = asof_nearest(grid, w, tolerance_seconds=tolerance_seconds,
                         value_cols=list(WEATHER_COLS))
    return e.withColumn("hour", floor_hour("timestamp_utc")) \
            .withColumn("solar_irradiance_proxy", F.lit(None).cast("double"))


def enrich_without_weather(grid: DataFrame) -> DataFrame:
    """Same schema as the as-of result, weather columns typed nulls."""
    return grid.withColumns({c: F.lit(None).cast("double") for c in WEATHER_COLS})


def latest_rows(df: DataFrame, key: str = "iso_code", ts: str = "timestamp_utc") -> DataFrame:
    """C4: all rows at the newest ``ts`` of each key (ties kept).

    Max per key is a tiny partial aggregate; the equi join back is
    broadcast by the planner when the per-key table is small.
    """
    from ampere.operators.attach import attach
    m = df.groupBy(F.col(key).alias("_k")).agg(F.max(ts).alias("_mx"))
    return attach(df, m, (F.col(key) == F.col("_k")) & (F.col(ts) == F.col("_mx")), "left_semi")


def daily_vs_hourly(daily_sums: DataFrame, hourly_sums: DataFrame,
                    tolerance: float = 1e-6) -> DataFrame:
    """Recompute day sums from hourly sums, left join to the daily sums,
    count |diff| > tolerance.  A day without hourly rows (null diff) is not
    a mismatch.  Sums are exact decimals, so a mismatch is a real one.
    One output row: days_checked, mismatches."""
    h = hourly_sums.groupBy("iso_code", F.to_date("hour").cast("timestamp_ntz").alias("date")) \
                   .agg(F.sum("sum_load_mw").alias("_hsum"))
    j = daily_sums.join(h, on=["iso_code", "date"], how="left")
    bad = F.abs(F.col("sum_load_mw") - F.col("_hsum")) > F.lit(tolerance)
    return j.agg(F.count(F.lit(1)).alias("days_checked"),
                 F.count_if(F.coalesce(bad, F.lit(False))).alias("mismatches"))
