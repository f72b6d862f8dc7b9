"""The batch medallion flow as lazy DataFrames: bronze -> silver -> gold.

Nothing here triggers an action; files between layers are optional
(see ``sources.sinks``), not required hand-offs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampere.functions.timecols import floor_hour
from ampere.operators import aggregate as agg
from ampere.operators import clean
from ampere.operators.join import asof_nearest, enrich_with_weather
from ampere.sources import fixtures as fx


def silver_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned grid from the raw (bronze) feed: B1, B2, B3, B5."""
    return clean.silver_grid(fx.bronze_grid(spark, sf_dir))


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned weather from the raw feed: B2, B4."""
    return clean.silver_weather(fx.bronze_weather(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ``grid_weather_enriched`` over the stand-in clean feeds."""
    return enrich_with_weather(fx.grid(spark, sf_dir), fx.weather(spark, sf_dir))


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean grid feed alone, for what needs load and time only: no
    weather is scanned and nothing is written first."""
    return fx.grid(spark, sf_dir).withColumn("hour", floor_hour("timestamp_utc"))


def hourly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly metrics of the load columns (weather columns null)."""
    return agg.hourly_metrics(enrich_with_weather(fx.grid(spark, sf_dir), None))


def anomalies(spark: SparkSession, sf_dir: str, use_forest: bool = False,
              lookback_hours: int | None = None) -> DataFrame:
    """K8 on the load history; the few anomalous rows then take their weather."""
    from ampere.operators import anomaly as an
    from ampere.operators.forecast import scan_recent
    found = an.detect_anomalies(scan_recent(load_history(spark, sf_dir), lookback_hours), use_forest=use_forest)
    return asof_nearest(found.drop("temperature"), fx.weather(spark, sf_dir),
                        value_cols=["temperature"]).select(*found.columns)


def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched silver table, written once as Parquet in the shared
    folder for queries that read it many times: the forecast, the anomaly
    detector and model training would otherwise redo the as-of join for
    every statistic they join back.  In the batch pipeline this is the
    silver write of the bronze -> silver step."""
    from ampere.session import materialize
    return materialize(enriched(spark, sf_dir), "silver_enriched")


def hourly(spark, sf_dir) -> DataFrame:
    return agg.hourly_metrics(enriched(spark, sf_dir))


def daily(spark, sf_dir) -> DataFrame:
    return agg.daily_metrics(enriched(spark, sf_dir))


def summary(spark, sf_dir) -> DataFrame:
    return agg.iso_summary(enriched(spark, sf_dir))
