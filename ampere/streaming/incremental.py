"""Structured Streaming versions of the cleaning and hourly rollup.

The reference only has hourly batch jobs; these run the same operators
incrementally over a landing folder.  Sources are parquet file streams
with an explicit schema; sinks are parquet folders with checkpoints in the
shared folder, so a restarted job resumes exactly where it stopped.
``Trigger.AvailableNow`` processes what has landed and stops (the hourly
cron of the reference becomes a scheduled catch-up run).  Rollup and dedup
write what a micro-batch contributes and merge on read, so neither keeps state
nor loses late rows; compaction merges old batches, so a read opens a bounded
number of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ampere.operators import clean as cl
from ampere.sources import files as fl

BRONZE_GRID_SCHEMA = T.StructType([
    T.StructField("iso_code", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("load", T.StringType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("id", T.LongType()),
])


def bronze_stream(spark: SparkSession, root: str, schema: T.StructType = BRONZE_GRID_SCHEMA,
                  max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(root)


def clean_stream(raw: DataFrame) -> DataFrame:
    """B1-B3 on a stream (stateless, so every micro-batch is final)."""
    r = cl.resolve_columns(raw, {"timestamp_utc": cl.GRID_TS_CANDIDATES, "load_mw": cl.GRID_LOAD_CANDIDATES})
    c = cl.coerce_types(r, {"timestamp_utc": "timestamp", "load_mw": "double"})
    return cl.clean_grid(c)


def hourly_partials(clean: DataFrame) -> DataFrame:
    """N2, one micro-batch: partial sums per (ISO, hour).  Sums are exact decimals, as in batch."""
    return clean.groupBy("iso_code", F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz").alias("hour")).agg(
        F.count("load_mw").alias("data_points"),
        F.sum(F.col("load_mw").cast("decimal(28,8)")).alias("sum_load_mw"),
        F.min("load_mw").alias("min_load_mw"), F.max("load_mw").alias("max_load_mw"),
        F.max("timestamp_utc").alias("newest"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """N2, partial sums of several batches as one row a window."""
    return partials.groupBy("iso_code", "hour").agg(
        F.sum("data_points").alias("data_points"), F.sum("sum_load_mw").cast("decimal(38,8)").alias("sum_load_mw"),
        F.min("min_load_mw").alias("min_load_mw"), F.max("max_load_mw").alias("max_load_mw"),
        F.max("newest").alias("newest"))


def hourly_rollup(partials: DataFrame, closed_after: str = "2 hours") -> DataFrame:
    """N2, merged on read: the windows that ended at least ``closed_after`` before the newest row.

    Partial sums of one window add up whichever batch they came in, so a row
    that arrives late counts like any other, and the order in which files were
    taken does not matter.  ``parts`` is the number of batches a window came in."""
    newest = partials.select(F.max("newest")).scalar()
    end = F.col("hour") + F.expr("INTERVAL 1 HOUR")
    return (partials.groupBy("iso_code", "hour").agg(
        F.sum("data_points").alias("data_points"), F.sum("sum_load_mw").cast("decimal(38,8)").alias("sum_load_mw"),
        F.min("min_load_mw").alias("min_load_mw"), F.max("max_load_mw").alias("max_load_mw"),
        F.count(F.lit(1)).alias("parts")).where(end <= newest - F.expr(f"INTERVAL {closed_after}")))


def first_rows(rows: DataFrame) -> DataFrame:
    """Per (ISO, timestamp) the row with the smallest (seq, id) - of one micro-batch when it is
    written, and of all batches when the log is read.  Nothing is dropped for being late, and the
    choice does not depend on the order in which files were taken."""
    rest = [c for c in rows.columns if c not in ("iso_code", "timestamp_utc")]
    return (rows.groupBy("iso_code", "timestamp_utc")
            .agg(F.min_by(F.struct(*rest), F.struct("seq", "id")).alias("_r"))
            .select("iso_code", "timestamp_utc", *[F.col(f"_r.{c}").alias(c) for c in rest]))


def run_batches(df: DataFrame, per_batch: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> str:
    """Process everything that has landed: ``per_batch`` of each micro-batch is written to
    ``out/batch=<number>``.  A batch that is run again after a failure replaces its own folder."""
    def write(batch: DataFrame, number: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out


def live_folders(spark: SparkSession, out: str) -> tuple[str | None, list[int]]:
    """The compacted folder (if any) and the numbers of the batches that it does not hold."""
    names = fl.children(spark, out)
    manifests = [n for n in names if n.startswith("_manifest-")]
    upto, folder = -1, None
    if manifests:
        upto = int(manifests[-1].rpartition("-")[2])
        folder = f"{out}/{fl.read_text(spark, f'{out}/{manifests[-1]}')}"
    batches = sorted(int(n.rpartition("=")[2]) for n in names if n.startswith("batch="))
    return folder, [n for n in batches if n > upto]


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """What the compacted folder and the batches after it hold."""
    folder, batches = live_folders(spark, out)
    paths = ([folder] if folder else []) + [f"{out}/batch={n}" for n in batches]
    return spark.read.parquet(*paths)


def compact(spark: SparkSession, out: str, merge: Callable[[DataFrame], DataFrame], least: int = 2) -> bool:
    """Merge all live batches but the newest (which a restart may write again) and the compacted
    folder before them into one folder, so that what a read opens does not grow with the runs.

    The new folder counts from the moment its manifest is renamed into place; a compaction that is
    killed before leaves only files that nothing reads.  Folders that only the manifest before the
    last one needed are removed, those of the last one stay for readers that have them open.  Returns
    whether there were ``least`` batches to merge."""
    folder, batches = live_folders(spark, out)
    old = batches[:-1]
    if len(old) < least:
        return False
    paths = ([folder] if folder else []) + [f"{out}/batch={n}" for n in old]
    name = f"_compact-{old[-1]:010d}"            # readers of the plain folder do not see it
    merge(spark.read.parquet(*paths)).write.mode("overwrite").parquet(f"{out}/{name}")
    before = [n for n in fl.children(spark, out) if n.startswith("_manifest-")]
    fl.write_once(spark, f"{out}/_manifest-{old[-1]:010d}", name)
    if before:
        covered = int(before[-1].rpartition("-")[2])
        for n in fl.children(spark, out):
            kind, _, number = n.rpartition("=" if n.startswith("batch=") else "-")
            stale = (kind == "batch" and int(number) <= covered) or (
                kind in ("_compact", "_manifest") and int(number) < covered)
            if stale:
                fl.remove(spark, f"{out}/{n}")
    return True


def run_available_now(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> str:
    """Process everything that has landed, write to ``out``, stop."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out
