"""Registered queries: feeds that differ from file to file - column types (A1, A2), forms of time
text (A5, A6) and zones (B12)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from ampere.functions.timeparse import local_to_utc
from ampere.plans.registry import register
from ampere.session import new_path
from ampere.sources import bronze as br
from ampere.sources import fixtures as fx
from ampere.sources import landing as ld

W = fx.sql_with
ISO_TEXT = "'%Y-%m-%d %H:%M:%S'"


@register("a1b_scan_mixed_types", W() + """
    SELECT iso_code, timestamp,
           CASE id % 4 WHEN 1 THEN floor(TRY_CAST(load AS DOUBLE)) ELSE TRY_CAST(load AS DOUBLE) END AS load_value,
           CASE WHEN id % 4 = 3 THEN NULL ELSE seq END AS seq, id FROM bronze_grid""")
def a1b(spark, d):
    """The raw grid feed landed in four batches - load as text, as bigint, as double, and as double
    without ``seq`` - and scanned as one table."""
    b = fx.bronze_grid(spark, d)
    day = br.run_day(b, F.try_to_timestamp("timestamp"))
    number = F.col("load").try_cast("double")
    shapes = [b, b.withColumn("load", F.floor(number).cast("bigint")), b.withColumn("load", number),
              b.withColumn("load", number).drop("seq")]
    root = new_path(spark, "bronze_mixed")
    for k, batch in enumerate(shapes):
        br.write_bronze_dated(batch.where(F.col("id") % 4 == k), root, day)
    return br.scan_bronze(spark, root).select(
        "iso_code", "timestamp", F.col("load").try_cast("double").alias("load_value"), "seq", "id")


@register("a2c_scan_mixed_weather", W() + """
    SELECT iso_code, CAST(timestamp AS TIMESTAMP) AS timestamp_utc, temperature, wind_speed,
           CASE WHEN id % 3 = 2 THEN NULL ELSE humidity END AS humidity, id FROM bronze_weather""")
def a2c(spark, d):
    """Weather landed with time as text or timestamp, humidity as double or int or not at all."""
    w = fx.bronze_weather(spark, d)
    day = br.first_day(w, F.try_to_timestamp("timestamp"))
    as_time = w.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    shapes = [w, as_time.withColumn("humidity", F.col("humidity").cast("int")), as_time.drop("humidity")]
    root = new_path(spark, "bronze_weather_mixed")
    for k, batch in enumerate(shapes):
        br.write_bronze_dated(batch.where(F.col("id") % 3 == k), root, day)
    s = br.scan_bronze(spark, root)
    return s.select("iso_code", F.try_to_timestamp(F.col("timestamp")).cast("timestamp_ntz").alias("timestamp_utc"),
                    "temperature", "wind_speed", "humidity", "id")


#: time text of one market each: pattern, and the precision it keeps
FORMS = [
    ("MM/dd/yyyy hh:mm:ss a", "second"), ("MM/dd/yyyy", "day"), ("MM-dd-yyyy", "day"), ("MMM d yyyy HH:mm", "minute"),
    ("yyyyMMdd HH:mm", "minute"), ("d-MMM-yy H:mm", "minute"), ("dd/MM/yyyy HH:mm:ss", "second"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "second"), ("yyyy/M/d H:mm", "minute"), ("MMMM d, yyyy h:mm a", "minute"),
    ("yyyyMMddHHmmss", "second"), ("EEE, dd MMM yyyy HH:mm:ss", "second")]

CSV_FORMS = [FORMS[k] for k in (0, 2, 3, 6, 7)]


def forms_sql(forms: list[tuple[str, str]]) -> str:
    cut = " ".join(f"WHEN {k} THEN date_trunc('{p}', timestamp_utc)" for k, (_, p) in enumerate(forms))
    return f"""
    SELECT CAST(id % {len(forms)} AS INTEGER) AS form, iso_code,
           strftime(CASE id % {len(forms)} {cut} END, {ISO_TEXT}) AS timestamp, load_mw AS load
    FROM grid"""


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


@register("a6b_landing_forms", W() + forms_sql(FORMS))
def a6b(spark, d):
    """Twelve markets' frames, each with its own form of time text, landed to UTC text."""
    g = fx.grid(spark, d)
    out = []
    for k, (pattern, _) in enumerate(FORMS):
        frame = g.where(F.col("id") % len(FORMS) == k).select(
            "iso_code", F.date_format("timestamp_utc", pattern).alias("time_utc"), F.col("load_mw").alias("load"))
        out.append(ld.land_load_table(frame, "UTC").select(F.lit(k).alias("form"), "*"))
    return _union(out)


@register("a5b_landing_forms_csv", W() + forms_sql(CSV_FORMS))
def a5b(spark, d):
    """CSV files in New York wall time, each folder with its own form (the ISO form keeps its offset)."""
    g = fx.grid(spark, d)
    local = F.from_utc_timestamp(F.col("timestamp_utc").cast("timestamp"), "America/New_York").cast("timestamp_ntz")
    out = []
    for k, (pattern, precision) in enumerate(CSV_FORMS):
        # a market that tells days only tells UTC days
        wall = F.col("timestamp_utc") if pattern.endswith("'Z'") or precision == "day" else local
        path = new_path(spark, "forms_csv")
        (g.where(F.col("id") % len(CSV_FORMS) == k)
         .select("iso_code", F.date_format(wall, pattern).alias("Time"), F.col("load_mw").alias("Load"))
         .write.option("header", "true").partitionBy("iso_code").csv(path))
        tz = "UTC" if precision == "day" else "America/New_York"
        out.append(ld.land_load_csv(spark, path, tz).select(F.lit(k).alias("form"), "*"))
    return _union(out)


@register("a6c_landing_report", W() + """
    SELECT CASE id % 7 WHEN 0 THEN 'iso' WHEN 1 THEN CASE WHEN day(timestamp_utc) <= 12 THEN 'figures' ELSE 'month/day' END
                       WHEN 2 THEN 'unparsed' WHEN 3 THEN NULL WHEN 4 THEN 'named month' WHEN 5 THEN 'number'
                       ELSE CASE WHEN day(timestamp_utc) <= 12 THEN 'figures' ELSE 'day/month' END END AS format,
           count(*) AS rows, count(*) FILTER (WHERE id % 11 = 0) AS without_value
    FROM grid GROUP BY 1""")
def a6c(spark, d):
    """A column of mixed time text: rows by the form they fit, lost ones reported."""
    k, ts = F.col("id") % 7, F.col("timestamp_utc")
    text = (F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(ts, "MM/dd/yyyy HH:mm"))
            .when(k == 2, F.lit("n/a")).when(k == 4, F.date_format(ts, "MMM d yyyy"))
            .when(k == 5, F.lit("45293.5")).when(k == 6, F.date_format(ts, "dd/MM/yyyy HH:mm")))
    raw = fx.grid(spark, d).select(text.alias("time_utc"), F.when(F.col("id") % 11 == 0, F.lit("-")).otherwise(
        F.col("load_mw").cast("string")).alias("load"))
    return ld.landing_report(raw, "time_utc", "load")


ZONES = ["Australia/Lord_Howe", "America/Santiago", "America/Havana", "Europe/London", "Asia/Kolkata", "America/New_York"]

# offsets two days before and after bound those a wall time can have; a gap's end is found in quarter hours
ZONES_SQL = f"""
    WITH loc AS (
        SELECT o_orderkey, z.tz, o_orderdate + to_minutes(15 * (o_orderkey % 96)) AS local_ts
        FROM orders, (SELECT unnest([{', '.join(repr(z) for z in ZONES)}]) AS tz) z),
    tried AS (
        SELECT o_orderkey, tz, local_ts, s, w, list_distinct([w - o1, w - o2]) AS us FROM (
            SELECT *, timezone(tz, timezone('UTC', w - INTERVAL 36 HOUR)) - (w - INTERVAL 36 HOUR) AS o1,
                   timezone(tz, timezone('UTC', w + INTERVAL 36 HOUR)) - (w + INTERVAL 36 HOUR) AS o2
            FROM (SELECT *, local_ts + to_minutes(15 * s) AS w FROM loc, (SELECT unnest(range(0, 9)) AS s)))),
    valid AS (
        SELECT o_orderkey, tz, local_ts, s,
               list_sort(list_filter(us, lambda u: timezone(tz, timezone('UTC', u)) = w)) AS ok FROM tried),
    first AS (SELECT o_orderkey, tz, min(s) AS s FROM valid WHERE len(ok) > 0 GROUP BY ALL)
    SELECT v.o_orderkey, v.tz, v.local_ts, CASE WHEN len(v.ok) = 1 OR v.s > 0 THEN v.ok[1] END AS utc_ts
    FROM valid v JOIN first f USING (o_orderkey, tz, s)"""


@register("b12b_local_to_utc_any_zone", ZONES_SQL)
def b12b(spark, d):
    """Wall times of zones whose clocks move by half an hour, at midnight, or not at all, to UTC."""
    o = fx.table(spark, d, "orders")
    loc = o.select("o_orderkey", (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        mins=(F.col("o_orderkey") % 96 * 15).cast("int"))).alias("local_ts"))
    return _union([loc.select("o_orderkey", F.lit(z).alias("tz"), "local_ts", local_to_utc("local_ts", z).alias("utc_ts"))
                   for z in ZONES])
