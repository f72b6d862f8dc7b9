"""Source adapters: payloads of the ISO / weather / price services re-aimed
as files Spark reads (A5-A8).  Column choice is made from the header /
schema on the driver (metadata only); every row is handled on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ampere.functions import timetext
from ampere.functions.timeparse import market_time_to_utc, parse_mixed_timestamp

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", "true")
            .option("recursiveFileLookup", "false").csv(path))


def landing_report(raw: DataFrame, time_col: str, value_col: str) -> DataFrame:
    """What became of the rows of a landed frame: per form of the time text (``unparsed`` and null
    are lost, ``number`` counts only in a column of numbers) the rows and those without a number
    in ``value_col``."""
    value = F.col(f"`{value_col}`").try_cast("double")
    return raw.groupBy(timetext.fits_as(F.col(f"`{time_col}`")).alias("format")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("without_value"))


def land_load_csv(spark: SparkSession, path: str, tz: str, iso: str | None = None,
                  time_first: str | None = None, load_first: str | None = None) -> DataFrame:
    """A5: CSV with a header; time column = first name starting with
    "time" (else the first column); load column = first name containing
    "demand" or "load" (else the last column).  Times are UTC text; aware
    ones keep their instant, naive ones are local.  Exact names of a market
    come first: ``time_first`` / ``load_first``.  The ISO is ``iso`` or, for a folder of ``iso_code=`` partitions, the
    partition value of each file (all strings: no type inference)."""
    raw = _csv(spark, path)
    cols = [c for c in raw.columns if c != "iso_code"]
    tcol = time_first if time_first in cols else next((c for c in cols if c.lower().startswith("time")), cols[0])
    lcol = load_first if load_first in cols else next(
        (c for c in cols if "demand" in c.lower() or "load" in c.lower()), cols[-1])
    ts = market_time_to_utc(raw, tcol, tz)
    iso_c = F.lit(iso.upper()) if iso else F.upper(F.col("iso_code").cast("string"))
    out = raw.select(iso_c.alias("iso_code"),
                     F.date_format(ts, TS_TEXT).alias("timestamp"),
                     F.col(f"`{lcol}`").try_cast("double").alias("load"))
    return out.dropna(subset=["timestamp", "load"])


def land_nyiso_csv(spark: SparkSession, path: str, iso: str | None = "NYISO") -> DataFrame:
    """A5, the New York file: ``Time Stamp`` else the first column, ``Load``
    else the last one; New York wall time."""
    cols = [c for c in _csv(spark, path).columns if c != "iso_code"]
    return land_load_csv(spark, path, "America/New_York", iso,
                         time_first="Time Stamp" if "Time Stamp" in cols else cols[0],
                         load_first="Load" if "Load" in cols else cols[-1])


def land_miso_csv(spark: SparkSession, path: str, iso: str | None = "MISO") -> DataFrame:
    """A5, the Midwest file: the last column named like an interval's start, GMT
    or time, and the last one named like a value, load or MW; else the first and
    second column.  Times are UTC."""
    raw = _csv(spark, path)
    cols = [c for c in raw.columns if c != "iso_code"]
    has = lambda c, *words: any(w in c.lower() for w in words)
    tcol = ([c for c in cols if has(c, "interval") and has(c, "start", "gmt", "time")] or cols[:1])[-1]
    lcol = ([c for c in cols if has(c, "value", "load", "mw")] or cols[1:2] or cols[:1])[-1]
    iso_c = F.lit(iso.upper()) if iso else F.upper(F.col("iso_code").cast("string"))
    ts = parse_mixed_timestamp(raw, tcol)
    out = raw.select(iso_c.alias("iso_code"), F.date_format(ts, TS_TEXT).alias("timestamp"),
                     F.col(f"`{lcol}`").try_cast("double").alias("load"))
    return out.dropna(subset=["timestamp", "load"])


def land_load_table(df: DataFrame, tz: str, iso: str | None = None, mixed: bool = False) -> DataFrame:
    """Frames with ``time_utc`` (UTC, mixed formats) or ``time`` / first
    column plus a ``load`` column.  Of the latter, aware times keep their
    instant and naive ones are local wall time; with ``mixed`` (the markets
    whose frames are UTC in any format) they go through the mixed-format parser
    too.  The ISO is ``iso`` or the frame's ``iso_code`` column."""
    lower = {c.lower(): c for c in df.columns}
    if "time_utc" in lower:
        ts = parse_mixed_timestamp(df, lower["time_utc"])
    else:
        tcol = lower.get("time") or [c for c in df.columns if c != "iso_code"][0]
        ts = parse_mixed_timestamp(df, tcol) if mixed else market_time_to_utc(df, tcol, tz)
    lcol = lower.get("load") or "Load"
    iso_c = F.lit(iso.upper()) if iso else F.upper(F.col("iso_code"))
    out = df.select(iso_c.alias("iso_code"), F.date_format(ts, TS_TEXT).alias("timestamp"),
                    F.col(lcol).try_cast("double").alias("load"))
    return out.dropna(subset=["timestamp", "load"])


GEOJSON_SCHEMA = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
    T.StructField("properties", T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("temperature", T.StructType([T.StructField("value", T.DoubleType())])),
        T.StructField("windSpeed", T.StructType([T.StructField("value", T.DoubleType())])),
        T.StructField("relativeHumidity", T.StructType([T.StructField("value", T.DoubleType())])),
    ]))])))])


def land_weather_geojson(docs: DataFrame, text_col: str = "value", iso_col: str = "iso_code") -> DataFrame:
    """One GeoJSON FeatureCollection per row -> one row per feature:
    timestamp (UTC text), temperature, wind_speed, humidity (missing ->
    null); rows without a timestamp are dropped."""
    parsed = docs.select(iso_col, F.from_json(F.col(text_col), GEOJSON_SCHEMA).alias("fc"))
    feats = parsed.select(iso_col, F.explode("fc.features").alias("f"))
    ts = F.try_to_timestamp(F.col("f.properties.timestamp"))
    out = feats.select(
        F.col(iso_col).alias("iso_code"),
        F.date_format(ts.cast("timestamp_ntz"), TS_TEXT).alias("timestamp"),
        F.col("f.properties.temperature.value").alias("temperature"),
        F.col("f.properties.windSpeed.value").alias("wind_speed"),
        F.col("f.properties.relativeHumidity.value").alias("humidity"))
    return out.dropna(subset=["timestamp"])


def weather_to_geojson(weather: DataFrame) -> DataFrame:
    """Group observations into one FeatureCollection text per (ISO, hour):
    the service's payload shape.  The group is one station-hour of
    readings, bounded by the sensor rate, never a whole day or feed."""
    feat = F.struct(F.struct(
        F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.struct(F.col("temperature").alias("value")).alias("temperature"),
        F.struct(F.col("wind_speed").alias("value")).alias("windSpeed"),
        F.struct(F.col("humidity").alias("value")).alias("relativeHumidity")).alias("properties"))
    g = weather.groupBy("iso_code", F.date_trunc("hour", "timestamp_utc").alias("hour")).agg(
        F.collect_list(feat).alias("features"))
    return g.select("iso_code", F.to_json(F.struct("features")).alias("value"))


# Candidate names of the price adapters, in preference order.
PRICE_CANDIDATES = {
    "timestamp": ["timestamp", "Time", "interval_start", "Interval Start", "time", "interval_start_utc"],
    "location": ["location", "Location", "Node", "node"],
    "lmp": ["lmp", "LMP", "Price", "price"],
    "energy": ["energy", "Energy"],
    "congestion": ["congestion", "Congestion"],
    "loss": ["loss", "Loss"],
}


def land_prices(df: DataFrame, default_location: str = "SYSTEM") -> DataFrame:
    """Normalise an LMP frame: the first present candidate of every
    field (coalesced when several are present); location defaults to
    ``default_location``, energy to lmp, congestion and loss to 0; rows
    without timestamp or lmp are dropped.  A frame without any time column is
    an error."""
    if not set(PRICE_CANDIDATES["timestamp"]).intersection(df.columns):
        raise KeyError(f"no time column among {df.columns}")

    def pick(field, cast):
        present = [c for c in PRICE_CANDIDATES[field] if c in df.columns]
        if not present:
            return F.lit(None).cast(cast or "string")
        return F.coalesce(*[F.col(f"`{c}`").try_cast(cast) if cast else F.col(f"`{c}`") for c in present])

    times = [parse_mixed_timestamp(df, c) for c in PRICE_CANDIDATES["timestamp"] if c in df.columns]
    ts = F.coalesce(*times)
    lmp = pick("lmp", "double")
    out = df.select(
        F.date_format(ts, TS_TEXT).alias("timestamp"),
        F.coalesce(pick("location", "string"), F.lit(default_location)).alias("location"),
        lmp.alias("lmp"),
        F.coalesce(pick("energy", "double"), lmp).alias("energy"),
        F.coalesce(pick("congestion", "double"), F.lit(0.0)).alias("congestion"),
        F.coalesce(pick("loss", "double"), F.lit(0.0)).alias("loss"))
    return out.dropna(subset=["timestamp", "lmp"])
