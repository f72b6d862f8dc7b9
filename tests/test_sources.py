"""Source adapters and layouts on small literal inputs."""

import json
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ampere.sources import bronze as br
from ampere.sources import landing as ld
from ampere.sources import sinks as sk


def test_csv_header_guess_and_local_time(spark):
    d = tempfile.mkdtemp(prefix="ampere-test-csv-")
    with open(f"{d}/demand.csv", "w") as f:
        f.write("Timestamp (local),Zone,Current demand\n")
        f.write("2025-03-09 01:30:00,A,100.5\n")      # EST
        f.write("2025-03-09 02:30:00,A,101.5\n")      # DST gap -> transition instant
        f.write("2025-11-02 01:30:00,A,102.5\n")      # ambiguous -> dropped
        f.write("junk,A,103\n")                       # junk time -> dropped
        f.write("2025-06-01 12:00:00,A,n/a\n")        # junk load -> dropped
    out = ld.land_load_csv(spark, d, "America/New_York", iso="nyiso").orderBy("timestamp").collect()
    assert [(r.iso_code, r.timestamp, r.load) for r in out] == [
        ("NYISO", "2025-03-09 06:30:00", 100.5), ("NYISO", "2025-03-09 07:00:00", 101.5)]


def test_load_table_time_utc_numeric(spark):
    df = spark.createDataFrame([("1704067200000", 5.0), ("1704070800000", 6.0)], "time_utc string, load double")
    out = ld.land_load_table(df, "UTC", iso="spp").orderBy("timestamp").collect()
    assert [r.timestamp for r in out] == ["2024-01-01 00:00:00", "2024-01-01 01:00:00"]


def test_geojson_missing_fields(spark):
    doc = {"features": [
        {"properties": {"timestamp": "2024-01-01T00:00:00+00:00", "temperature": {"value": 3.5},
                        "windSpeed": {"value": None}}},
        {"properties": {"timestamp": "2024-01-01T01:00:00-05:00", "relativeHumidity": {"value": 80.0}}},
        {"properties": {"temperature": {"value": 1.0}}}]}
    df = spark.createDataFrame([("CAISO", json.dumps(doc))], "iso_code string, value string")
    out = ld.land_weather_geojson(df).orderBy("timestamp").collect()
    assert [(r.timestamp, r.temperature, r.wind_speed, r.humidity) for r in out] == [
        ("2024-01-01 00:00:00", 3.5, None, None), ("2024-01-01 06:00:00", None, None, 80.0)]


def test_prices_defaults(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 30.0), (datetime(2024, 1, 1, 1), None)],
                               "`Interval Start` timestamp, LMP double")
    out = ld.land_prices(df, default_location="HUB").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.location, r.lmp, r.energy, r.congestion, r.loss) == ("HUB", 30.0, 30.0, 0.0, 0.0)


def test_dated_layout_iso_from_grandparent(spark):
    root = tempfile.mkdtemp(prefix="ampere-test-bronze-")
    df = spark.createDataFrame([("CAISO", "2024-01-01 00:00:00", "5"), ("MISO", "2024-01-02 00:00:00", "6")],
                               "iso_code string, timestamp string, load string")
    br.write_bronze_dated(df, root, F.to_date(F.col("timestamp")))
    s = br.scan_bronze(spark, root)
    assert sorted((r.iso_code, r.load) for r in s.collect()) == [("CAISO", "5"), ("MISO", "6")]
    assert br.scan_bronze(spark, root + "/missing") is None


def test_partitioned_overwrite_is_dynamic(spark):
    path = tempfile.mkdtemp(prefix="ampere-test-gold-") + "/t"
    a = spark.createDataFrame([("A", 1), ("B", 2)], "iso_code string, v int")
    sk.write_partitioned(a, path)
    sk.write_partitioned(spark.createDataFrame([("A", 9)], "iso_code string, v int"), path)
    got = sorted((r.iso_code, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("A", 9), ("B", 2)]     # B untouched, A replaced


def _csv(text):
    d = tempfile.mkdtemp(prefix="ampere-test-csv-")
    with open(f"{d}/x.csv", "w") as f:
        f.write(text)
    return d


def _rows(df):
    return sorted((r.iso_code, r.timestamp, r.load) for r in df.collect())


def test_aware_local_times_keep_their_instant(spark):
    d = _csv("Time,Load\n2025-01-10T00:00:00-05:00,1\n2025-01-10 00:00:00,2\n2025-07-10 00:00:00Z,3\n")
    assert _rows(ld.land_load_csv(spark, d, "America/New_York", iso="x")) == [
        ("X", "2025-01-10 05:00:00", 1.0), ("X", "2025-01-10 05:00:00", 2.0), ("X", "2025-07-10 00:00:00", 3.0)]
    aware = spark.createDataFrame([("2025-01-10 05:00:00", 1.0)], "t string, Load double").select(
        F.to_timestamp("t").alias("Time"), "Load")
    naive = aware.select(F.lit("2025-01-10 00:00:00").cast("timestamp_ntz").alias("Time"), "Load")
    for df in (aware, naive):
        assert _rows(ld.land_load_table(df, "America/New_York", iso="x")) == [("X", "2025-01-10 05:00:00", 1.0)]


def test_mixed_format_time_of_a_market_frame(spark):
    df = spark.createDataFrame([("1736467200000", 5.0)], "time string, load double")
    assert _rows(ld.land_load_table(df, "America/Chicago", iso="spp", mixed=True)) == [
        ("SPP", "2025-01-10 00:00:00", 5.0)]
    df = spark.createDataFrame([("2025-01-10 00:00:00", 5.0)], "first string, Load double")
    assert _rows(ld.land_load_table(df, "America/New_York", iso="isone", mixed=True)) == [
        ("ISONE", "2025-01-10 00:00:00", 5.0)]


def test_midwest_csv(spark):
    d = _csv("Load_Interval,Interval Start GMT,Interval Time,Note,Total MW\n1,2025-01-10 00:00:00,2025-01-10 01:00:00,a,7\n")
    assert _rows(ld.land_miso_csv(spark, d)) == [("MISO", "2025-01-10 01:00:00", 7.0)]      # the last match wins
    d = _csv("when,amount\n2025-01-10 02:00:00,8\n")
    assert _rows(ld.land_miso_csv(spark, d)) == [("MISO", "2025-01-10 02:00:00", 8.0)]      # first and second column


def test_new_york_csv(spark):
    d = _csv("Timezone,Time Stamp,Name,PTID,Load,Loaded\nEST,01/10/2025 00:00:00,W,1,5,9\n")
    assert _rows(ld.land_nyiso_csv(spark, d)) == [("NYISO", "2025-01-10 05:00:00", 5.0)]
    d = _csv("Timezone,Time Stamp,Name,PTID,Load,Loaded\nEST,2025-01-10 00:00:00,W,1,5,9\n")
    assert _rows(ld.land_nyiso_csv(spark, d)) == [("NYISO", "2025-01-10 05:00:00", 5.0)]
    d = _csv("a,b,c\n2025-01-10 00:00:00,x,6\n")
    assert _rows(ld.land_nyiso_csv(spark, d)) == [("NYISO", "2025-01-10 05:00:00", 6.0)]


def test_prices_of_interval_start(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 10), 30.0)], "interval_start timestamp, LMP double")
    assert [(r.timestamp, r.lmp) for r in ld.land_prices(df).collect()] == [("2025-01-10 00:00:00", 30.0)]
    with pytest.raises(KeyError):
        ld.land_prices(spark.createDataFrame([(1, 30.0)], "x int, LMP double"))


def test_iso_filter_prunes_files(spark):
    root = tempfile.mkdtemp(prefix="ampere-test-bronze-") + "/b"
    df = spark.createDataFrame([("CAISO", "2024-01-01", "5"), ("MISO", "2024-01-02", "6")],
                               "iso_code string, timestamp string, load string")
    br.write_bronze_dated(df, root, F.to_date(F.col("timestamp")))
    s = br.scan_bronze(spark, root, schema="timestamp string, load string, iso_code string, ingest_date string")
    one = s.where("iso_code = 'MISO'")
    assert [r.load for r in one.collect()] == ["6"] and len(one.inputFiles()) == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(iso_code" in plan


def test_unread_files_are_named(spark):
    root = tempfile.mkdtemp(prefix="ampere-test-bronze-") + "/b"
    df = spark.createDataFrame([("CAISO", "2024-01-01", "5")], "iso_code string, timestamp string, load string")
    br.write_bronze_dated(df, root, F.to_date(F.col("timestamp")))
    import os
    os.makedirs(f"{root}/iso_code=X/ingest_date=2024-01-01")
    with open(f"{root}/iso_code=X/ingest_date=2024-01-01/bad.parquet", "w") as f:
        f.write("not parquet")
    bad = br.unread_files(spark, root, br.scan_bronze(spark, root, ignore_corrupt=True)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in bad] == ["bad.parquet"]


def test_files_follow_partitions(spark):
    path = tempfile.mkdtemp(prefix="ampere-test-gold-") + "/t"
    df = spark.range(0, 4000, 1, 16).selectExpr("concat('I', id % 5) AS iso_code", "id")
    sk.write_partitioned(df, path)
    assert len(spark.read.parquet(path).inputFiles()) <= 10
