"""Stand-in feeds derived from the driver's read-only tables.

The reference lands live ISO / weather / price feeds that are not shipped.
These views re-create their schemas from ``events``, ``lineitem`` and
``orders`` (see FIXTURES.md section 3).  Every view is a pure projection /
filter of a whole table, so its size grows with the input.  Each Spark
definition has a twin SQL definition (``SQL_VIEWS``) used by the DuckDB
oracle; the two must stay expression-for-expression identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean grid load: iso_code, timestamp_utc, load_mw, id.

    ISO codes are upper case, like real ISO codes (CAISO, MISO ...).
    """
    e = _events(spark, sf_dir)
    return e.select(
        F.upper("event_type").alias("iso_code"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp_utc"),
        F.col("value").alias("load_mw"),
        F.col("event_id").alias("id"),
    )


def _reading_time():
    """When an event's weather is read: stations report in the first hour of every four, so an
    event's place in its four hours becomes its place in that hour."""
    us = F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    inside = us % F.lit(14_400_000_000)
    return F.timestamp_micros(us - inside + F.floor(inside / 4).cast("long")).cast("timestamp_ntz")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean weather: iso_code, timestamp_utc, temperature, wind_speed, humidity."""
    e = _events(spark, sf_dir)
    return e.select(
        F.upper("event_type").alias("iso_code"),
        _reading_time().alias("timestamp_utc"),
        (F.col("value") % 60).alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("wind_speed"),
        (F.col("event_id") % 101).cast("double").alias("humidity"),
    )


def weather_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly station observations: several stations (user_id) per ISO and
    hour, the shape the weather adapter de-duplicates (B6); ``id`` orders a
    station's own repeats."""
    e = _events(spark, sf_dir)
    return e.select(
        F.upper("event_type").alias("iso_code"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp_utc"),
        F.col("user_id").alias("station"),
        (F.col("value") % 60).alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("wind_speed"),
        (F.col("event_id") % 101).cast("double").alias("humidity"),
        F.col("event_id").alias("id"),
    )


def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid frequency samples per ISO: 59.4 + (value % 120) / 100 Hz, so
    both sides of the 59.5-60.5 Hz band occur."""
    g = grid(spark, sf_dir)
    return g.select("iso_code", "timestamp_utc", "id",
                    (F.lit(59.4) + (F.col("load_mw") % 120) / 100).alias("frequency_hz"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather stations: one per distinct events.user_id, placed over the
    continental US by a fixed rule."""
    u = _events(spark, sf_dir).select(F.col("user_id").alias("station")).distinct()
    return u.select("station",
                    (F.lit(25.0) + (F.col("station") * 37 % 2400) / 100.0).alias("lat"),
                    (F.lit(-124.0) + (F.col("station") * 53 % 5700) / 100.0).alias("lon"))


def _load_text(v, idc):
    return (F.when(idc % 97 == 0, F.lit("bad"))
            .otherwise(F.when(idc % 89 == 0, -v)
                       .when(idc % 83 == 0, v * F.lit(1e7))
                       .otherwise(v).cast("string")))


def bronze_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw grid feed: text timestamp and load, with junk and re-sent rows.

    Columns: iso_code, timestamp (string), load (string), seq (0 original,
    1 re-sent copy), id.  ``(seq, id)`` is the read order used by dedup.
    """
    g = grid(spark, sf_dir)
    orig = g.select("iso_code", "timestamp_utc", "load_mw", "id", F.lit(0).alias("seq"))
    resent = g.where(F.col("id") % 50 == 1).select(
        "iso_code", "timestamp_utc", (F.col("load_mw") + 1).alias("load_mw"), "id",
        F.lit(1).alias("seq"))
    u = orig.unionByName(resent)
    return u.select(
        "iso_code",
        F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        _load_text(F.col("load_mw"), F.col("id")).alias("load"),
        "seq", "id",
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather feed: text timestamp, values on both sides of every bound."""
    e = _events(spark, sf_dir)
    idc = F.col("event_id")
    return e.select(
        F.upper("event_type").alias("iso_code"),
        F.date_format(_reading_time(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(idc % 70 == 0, F.lit(None).cast("double"))
         .otherwise((F.col("value") % 120) - 55).alias("temperature"),
        (F.get_json_object("props", "$.k").cast("double") * 3 - 10).alias("wind_speed"),
        ((idc % 131) - 10).cast("double").alias("humidity"),
        idc.alias("id"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LMP feed from lineitem: timestamp, location, lmp, congestion, loss."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_returnflag").alias("location"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("lmp"),
        F.col("l_discount").alias("congestion"),
        F.col("l_tax").alias("loss"),
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API request log: ts, endpoint, status, latency (seconds), user_id, id."""
    e = _events(spark, sf_dir)
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 100).alias("latency"),
        F.col("user_id"),
        F.col("event_id").alias("id"),
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second time series: iso_code = o_orderpriority, ts = o_orderdate."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("iso_code"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp_utc"),
        F.col("o_totalprice").alias("load_mw"),
        F.col("o_orderkey").alias("id"),
    )


# ---- twin SQL definitions for the DuckDB oracle ---------------------------

_READ_SQL = ("make_timestamp(epoch_us(CAST(ts AS TIMESTAMP)) - epoch_us(CAST(ts AS TIMESTAMP)) % 14400000000 "
             "+ (epoch_us(CAST(ts AS TIMESTAMP)) % 14400000000) // 4)")

SQL_VIEWS = {
    "grid": """
        SELECT upper(event_type) AS iso_code, CAST(ts AS TIMESTAMP) AS timestamp_utc,
               value AS load_mw, event_id AS id
        FROM events""",
    "weather": """
        SELECT upper(event_type) AS iso_code, {READ} AS timestamp_utc,
               value % 60 AS temperature,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind_speed,
               CAST(event_id % 101 AS DOUBLE) AS humidity
        FROM events""".replace("{READ}", _READ_SQL),
    "weather_stations": """
        SELECT upper(event_type) AS iso_code, date_trunc('hour', CAST(ts AS TIMESTAMP)) AS timestamp_utc,
               user_id AS station, value % 60 AS temperature,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind_speed,
               CAST(event_id % 101 AS DOUBLE) AS humidity, event_id AS id
        FROM events""",
    "frequency": """
        SELECT iso_code, timestamp_utc, id, 59.4 + (load_mw % 120) / 100 AS frequency_hz FROM grid""",
    "stations": """
        SELECT station, 25.0 + (station * 37 % 2400) / 100.0 AS lat,
               -124.0 + (station * 53 % 5700) / 100.0 AS lon
        FROM (SELECT DISTINCT user_id AS station FROM events)""",
    "bronze_grid": """
        SELECT iso_code, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') AS timestamp,
               CASE WHEN id % 97 = 0 THEN 'bad'
                    ELSE CAST(CASE WHEN id % 89 = 0 THEN -load_mw
                                   WHEN id % 83 = 0 THEN load_mw * 1e7
                                   ELSE load_mw END AS VARCHAR) END AS load,
               seq, id
        FROM (SELECT iso_code, timestamp_utc, load_mw, id, 0 AS seq FROM grid
              UNION ALL
              SELECT iso_code, timestamp_utc, load_mw + 1, id, 1 AS seq FROM grid
              WHERE id % 50 = 1) u""",
    "bronze_weather": """
        SELECT upper(event_type) AS iso_code,
               strftime({READ}, '%Y-%m-%d %H:%M:%S') AS timestamp,
               CASE WHEN event_id % 70 = 0 THEN NULL ELSE (value % 120) - 55 END AS temperature,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) * 3 - 10 AS wind_speed,
               CAST((event_id % 131) - 10 AS DOUBLE) AS humidity,
               event_id AS id
        FROM events""".replace("{READ}", _READ_SQL),
    "prices": """
        SELECT CAST(l_shipdate AS TIMESTAMP) AS timestamp, l_returnflag AS location,
               CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS lmp,
               l_discount AS congestion, l_tax AS loss, l_orderkey AS id, l_linenumber AS line
        FROM lineitem""",
    "request_log": """
        SELECT CAST(ts AS TIMESTAMP) AS ts, event_type AS endpoint,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
               value / 100 AS latency, user_id, event_id AS id
        FROM events""",
    "order_feed": """
        SELECT o_orderpriority AS iso_code, CAST(o_orderdate AS TIMESTAMP) AS timestamp_utc,
               o_totalprice AS load_mw, o_orderkey AS id
        FROM orders""",
}

# dependency order for WITH clauses
_SQL_ORDER = ["grid", "weather", "weather_stations", "frequency", "stations", "bronze_grid", "bronze_weather", "prices",
              "request_log", "order_feed"]


def sql_with(*extra: tuple[str, str], views: tuple[str, ...] | None = None) -> str:
    """A WITH clause holding the fixture views plus extra (name, sql) CTEs."""
    names = _SQL_ORDER if views is None else [v for v in _SQL_ORDER if v in views]
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names]
    parts += [f"{n} AS ({s})" for n, s in extra]
    return "WITH " + ",\n".join(parts) + "\n"
