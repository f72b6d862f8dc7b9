"""Files whose column types differ, forms of time text, zones."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from ampere.functions import timetext as tt
from ampere.functions.timeparse import local_to_utc, market_time_to_utc
from ampere.session import new_path
from ampere.sources import bronze as br
from ampere.sources import landing as ld
from ampere.sources import schemas as sc


def land(spark, root, iso, day, df):
    df.withColumns({"iso_code": F.lit(iso), "ingest_date": F.lit(day)}).write.mode("append").partitionBy(
        "iso_code", "ingest_date").parquet(root)


def test_scan_of_conflicting_types(spark):
    root = new_path(spark, "types")
    base = spark.range(4).withColumn("load", F.col("id") + 1)
    land(spark, root, "A", "2024-01-01", base)
    land(spark, root, "A", "2024-01-02", base.withColumn("load", F.col("load").cast("double")).withColumn("seq", F.lit(1)))
    got = br.scan_bronze(spark, root)
    assert dict(got.dtypes) == {"id": "bigint", "load": "double", "seq": "int", "iso_code": "string"}
    assert got.agg(F.sum("load")).first()[0] == 20.0 and got.where("seq is null").count() == 4
    land(spark, root, "B", "2024-01-01", base.withColumn("load", F.lit("12.5 MW")))
    got = br.scan_bronze(spark, root)
    assert dict(got.dtypes)["load"] == "string" and got.where("load = '12.5 MW'").count() == 4
    assert "PartitionFilters: [isnotnull(iso_code" in got.where("iso_code = 'A'")._jdf.queryExecution().toString()
    grid = br.scan_bronze_grid(spark, root) if "timestamp" in got.columns else None
    assert grid is None


def test_scan_of_plain_folders_with_conflicting_types(spark):
    root = new_path(spark, "plain")
    spark.range(3).selectExpr("id as load").write.parquet(f"{root}/ISO1/2024-01-01")
    spark.range(3).selectExpr("cast(id as string) as load", "true as ok").write.parquet(f"{root}/ISO2/2024-01-01")
    got = br.scan_bronze(spark, root)
    assert sorted((r.iso_code, r.load, r.ok) for r in got.collect()) == sorted(
        [("ISO1", str(k), None) for k in range(3)] + [("ISO2", str(k), True) for k in range(3)])


def test_broken_files_beside_conflicting_types(spark):
    root = new_path(spark, "broken")
    land(spark, root, "A", "2024-01-01", spark.range(2).selectExpr("id as load"))
    land(spark, root, "B", "2024-01-01", spark.range(2).selectExpr("cast(id as string) as load"))
    groups, broken = sc.schema_groups(spark, root)
    assert len(groups) == 2 and broken == []
    from ampere.plans.catalog_sources import open_text
    with open_text(spark, f"{root}/iso_code=C/ingest_date=2024-01-01/x.parquet") as f:
        f.write("no parquet")
    groups, broken = sc.schema_groups(spark, root)
    assert len(groups) == 2 and len(broken) == 1 and broken[0].endswith("x.parquet")


def test_footers_from_content(spark):
    root = new_path(spark, "content")
    spark.range(2).selectExpr("id", "cast(1.5 as decimal(9,2)) as x", "timestamp_ntz'2024-01-01' as t").write.parquet(root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    by_path = {r.schema for r in sc.file_schemas(files).collect()}
    assert by_path == {r.schema for r in sc.content_schemas(files).collect()}
    assert [f.dataType.simpleString() for f in T.StructType.fromJson(__import__("json").loads(by_path.pop())).fields] == [
        "bigint", "decimal(9,2)", "timestamp_ntz"]


def test_type_lattice():
    i, l, f, d, s = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType(10, 2)
    for a, b, want in [(i, l, l), (l, d, d), (f, i, d), (f, d, d), (l, s, s), (dec, i, T.DecimalType(12, 2)), (dec, d, d),
                       (dec, T.DecimalType(12, 6), T.DecimalType(14, 6)), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
                       (T.BooleanType(), l, s), (T.NullType(), d, d), (T.DecimalType(38, 0), T.DecimalType(38, 20), d)]:
        assert sc.widen(a, b) == want and sc.widen(b, a) == want
    merged = sc.merge_fields([T.StructType([T.StructField("a", i), T.StructField("n", T.StructType([T.StructField("x", i)]))]),
                              T.StructType([T.StructField("A", d), T.StructField("n", T.StructType([T.StructField("y", s)]))])])
    assert [(x.name, x.dataType.simpleString()) for x in merged.fields] == [("a", "double"), ("n", "struct<x:int,y:string>")]


# text -> month-first value, day-first value, offset, form
TEXTS = [
    ("01/10/2025 05:00:00 PM", datetime(2025, 1, 10, 17), datetime(2025, 10, 1, 17), None, "figures"),
    ("01/10/2025", datetime(2025, 1, 10), datetime(2025, 10, 1), None, "figures"),
    ("01-10-2025", datetime(2025, 1, 10), datetime(2025, 10, 1), None, "figures"),
    ("Jan 10 2025 05:00", datetime(2025, 1, 10, 5), datetime(2025, 1, 10, 5), None, "named month"),
    ("20250110 05:00", datetime(2025, 1, 10, 5), datetime(2025, 1, 10, 5), None, "compact"),
    ("202501100500", datetime(2025, 1, 10, 5), datetime(2025, 1, 10, 5), None, "compact"),
    ("2025-01-10T05:00:00.5Z", datetime(2025, 1, 10, 5, 0, 0, 500000), datetime(2025, 1, 10, 5, 0, 0, 500000), 0, "iso"),
    ("2025-01-10 05:00:00-05:00", datetime(2025, 1, 10, 5), datetime(2025, 1, 10, 5), -18000, "iso"),
    ("01/10/2025 05:00 +0530", datetime(2025, 1, 10, 5), datetime(2025, 10, 1, 5), 19800, "figures"),
    ("13/01/2025 12:00 AM", None, datetime(2025, 1, 13), None, "day/month"),
    ("01/13/2025 12:30 p.m.", datetime(2025, 1, 13, 12, 30), None, None, "month/day"),
    ("Fri, 10 Jan 2025 5:30 pm", datetime(2025, 1, 10, 17, 30), datetime(2025, 1, 10, 17, 30), None, "named month"),
    ("10-Jan-69", datetime(1969, 1, 10), datetime(1969, 1, 10), None, "named month"),
    ("2025-02-30", None, None, None, "unparsed"), ("2025-01-10 25:00", None, None, None, "unparsed"),
    ("", None, None, None, "unparsed"), ("junk 2025", None, None, None, "unparsed"), ("45293.5", None, None, None, "number"),
    (None, None, None, None, None)]


def test_forms_of_time_text(spark):
    df = spark.createDataFrame([(k, x[0]) for k, x in enumerate(TEXTS)], "k int, t string")
    got = df.select("k", tt.wall_time("t"), tt.wall_time("t", True), tt.offset_seconds("t"), tt.fits_as("t")).collect()
    for r in sorted(got):
        assert tuple(r)[1:] == TEXTS[r.k][1:], TEXTS[r.k]


def test_order_of_figures_is_the_columns(spark):
    for texts, first in ((["01/02/2025", "13/02/2025"], datetime(2025, 2, 1)), (["01/02/2025", "02/13/2025"], datetime(2025, 1, 2)),
                         (["01/02/2025"], datetime(2025, 1, 2))):
        df = spark.createDataFrame([(t, "1") for t in texts], "time_utc string, load string").coalesce(1)
        got = [r.timestamp for r in ld.land_load_table(df, "UTC", iso="x").collect()]
        assert len(got) == len(texts) and str(first) in got


def test_lost_rows_are_reported(spark):
    df = spark.createDataFrame([("01/10/2025", "1"), ("soon", "2"), (None, "3"), ("2025-01-10", "x")], "t string, v string")
    got = {r.format: (r.rows, r.without_value) for r in ld.landing_report(df, "t", "v").collect()}
    assert got == {"figures": (1, 0), "unparsed": (1, 0), None: (1, 0), "iso": (1, 1)}


@pytest.mark.parametrize("zone, wall, want", [
    ("Australia/Lord_Howe", "2025-10-05 02:15:00", "2025-10-04 15:30:00"),      # gap of half an hour
    ("Australia/Lord_Howe", "2025-04-06 01:45:00", None),                       # overlap of half an hour
    ("Australia/Lord_Howe", "2025-04-06 02:00:00", "2025-04-05 15:30:00"),
    ("Pacific/Apia", "2011-12-30 05:00:00", "2011-12-30 10:00:00"),             # a day that is not there
    ("America/Havana", "2025-03-09 00:30:00", "2025-03-09 05:00:00"),           # gap at midnight
    ("America/Santiago", "2025-04-05 23:30:00", None),                          # overlap before midnight
    ("America/New_York", "2050-07-01 00:00:00", "2050-07-01 04:00:00"),
    ("Asia/Kolkata", "2025-01-01 05:30:00", "2025-01-01 00:00:00"),
])
def test_wall_time_of_any_zone(spark, zone, wall, want):
    df = spark.createDataFrame([(wall,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    q = df.select(local_to_utc("t", zone).cast("string"))
    assert q.first()[0] == want
    assert "Python" not in q._jdf.queryExecution().executedPlan().toString()


def test_market_time_keeps_offsets(spark):
    df = spark.createDataFrame([("01-10-2025",), ("01-10-2025 05:00 -0500",), ("01-10-2025 05:00",)], "t string")
    got = [str(r[0]) for r in df.select(market_time_to_utc(df, "t", "America/New_York")).collect()]
    assert got == ["2025-01-10 05:00:00", "2025-01-10 10:00:00", "2025-01-10 10:00:00"]
