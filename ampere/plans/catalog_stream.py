"""Registered queries: streaming runs (N1-N3) read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere.functions.numeric import half_even_quotient
from ampere.plans.catalog_clean import CLEANED, COERCED
from ampere.plans.registry import register
from ampere.plans.sqlparts import hq
from ampere.session import new_path
from ampere.sources import fixtures as fx
from ampere.streaming import incremental as inc

W = fx.sql_with
def _day():
    return F.to_date(F.try_to_timestamp(F.col("timestamp")))


def _land(spark, d, seq: int | None = None):
    """Land the raw grid feed (optionally one ``seq`` only) as files per
    ingest day, keeping iso_code inside the files."""
    root = new_path(spark, "stream_bronze")
    b = fx.bronze_grid(spark, d)
    if seq is not None:
        b = b.where(F.col("seq") == seq)
    (b.withColumn("ingest_date", _day().cast("string")).hint("rebalance", "ingest_date")
     .write.partitionBy("ingest_date").parquet(root))
    return root


@register("n1_stream_clean", W(COERCED, CLEANED) + "SELECT iso_code, timestamp_utc, load_mw, seq, id FROM cleaned")
def n1(spark, d):
    """Incremental bronze -> cleaned grid (AvailableNow), equal to batch."""
    root = _land(spark, d)
    s = inc.clean_stream(inc.bronze_stream(spark, root, max_files=4))
    out = inc.run_available_now(s.select("iso_code", "timestamp_utc", "load_mw", "seq", "id"),
                                new_path(spark, "stream_clean"), new_path(spark, "ckpt_clean"))
    return spark.read.parquet(out)


_ROLLUP_SQL = W(COERCED, CLEANED) + f"""
    SELECT iso_code, date_trunc('hour', timestamp_utc) AS hour, count(load_mw) AS data_points,
           {hq('sum(CAST(load_mw AS DECIMAL(28,8)))', 'count(load_mw)')} AS avg_load_mw,
           min(load_mw) AS min_load_mw, max(load_mw) AS max_load_mw
    FROM cleaned
    WHERE date_trunc('hour', timestamp_utc) + INTERVAL 1 HOUR
          <= (SELECT max(timestamp_utc) FROM cleaned) - INTERVAL 2 HOUR
    GROUP BY 1, 2"""


@register("n2_stream_hourly_rollup", _ROLLUP_SQL)
def n2(spark, d):
    """Hourly rollup in several micro-batches: every window closed for 2 h, late rows included."""
    root = _land(spark, d)
    s = inc.clean_stream(inc.bronze_stream(spark, root, max_files=16))
    out = inc.run_batches(s, inc.hourly_partials, new_path(spark, "stream_hourly"), new_path(spark, "ckpt_hourly"))
    x = inc.hourly_rollup(inc.read_batches(spark, out))
    return x.withColumn("avg_load_mw", half_even_quotient("sum_load_mw", "data_points")).select(
        "iso_code", "hour", "data_points", "avg_load_mw", "min_load_mw", "max_load_mw")


@register("n2b_stream_compacted", _ROLLUP_SQL)
def n2b(spark, d):
    """The same with the log of batches compacted between two runs and after them."""
    root = new_path(spark, "stream_bronze")
    out, ckpt = new_path(spark, "stream_hourly"), new_path(spark, "ckpt_hourly")
    b = fx.bronze_grid(spark, d).withColumn("ingest_date", _day().cast("string"))
    for seq in (0, 1):
        (b.where(F.col("seq") == seq).hint("rebalance", "ingest_date").write.mode("append")
         .partitionBy("ingest_date").parquet(root))
        s = inc.clean_stream(inc.bronze_stream(spark, root, max_files=8))
        inc.run_batches(s, inc.hourly_partials, out, ckpt)
        inc.compact(spark, out, inc.merge_partials)
    x = inc.hourly_rollup(inc.read_batches(spark, out))
    return x.withColumn("avg_load_mw", half_even_quotient("sum_load_mw", "data_points")).select(
        "iso_code", "hour", "data_points", "avg_load_mw", "min_load_mw", "max_load_mw")


@register("n3_stream_dedup", W(COERCED, CLEANED) + """
    SELECT iso_code, timestamp_utc, load_mw, seq, id FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code, timestamp_utc ORDER BY seq, id) AS rn
      FROM cleaned) WHERE rn = 1""")
def n3(spark, d):
    """Originals first, re-sent copies in a later run: one row per key, the smallest (seq, id)."""
    first = _land(spark, d, seq=0)
    ckpt, out = new_path(spark, "ckpt_dedup"), new_path(spark, "stream_dedup")
    cols = ["iso_code", "timestamp_utc", "load_mw", "seq", "id"]
    s = inc.clean_stream(inc.bronze_stream(spark, first, max_files=16)).select(*cols)
    inc.run_batches(s, inc.first_rows, out, ckpt)
    # the re-sent copies land in the same folder and a second run picks
    # up only the new files
    b = fx.bronze_grid(spark, d).where(F.col("seq") == 1)
    (b.withColumn("ingest_date", _day().cast("string")).hint("rebalance", "ingest_date")
     .write.mode("append").partitionBy("ingest_date").parquet(first))
    s2 = inc.clean_stream(inc.bronze_stream(spark, first, max_files=16)).select(*cols)
    inc.run_batches(s2, inc.first_rows, out, ckpt)
    return inc.first_rows(inc.read_batches(spark, out)).select(*cols)
