"""Data-quality checks.

The reference runs one ``count()`` per check (18 scans).  Here every check
on a table is an aggregate expression of ONE global aggregation; the
results are unpivoted into report rows.  ``validate_new_files`` keeps the
counts of each file, so that a later run reads new files only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ampere.session import materialize
from ampere.sources.bronze import path_exists
from ampere.sources.sinks import read_latest, write_latest


@dataclass(frozen=True)
class Check:
    kind: str            # non_empty | null_ratio | range
    column: str | None = None
    threshold: float | None = None   # max null ratio
    lo: float | None = None
    hi: float | None = None


def _agg_exprs(checks: list[Check]):
    exprs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(checks):
        if c.kind == "null_ratio":
            exprs.append(F.count_if(F.col(c.column).isNull()).alias(f"_c{i}"))
        elif c.kind == "range":
            col = F.col(c.column)
            exprs.append(F.count_if((col < c.lo) | (col > c.hi)).alias(f"_c{i}"))
    return exprs


def check_table(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """One pass over ``df``; one report row per check:
    (table_name, check, column_name, value, threshold, passed).

    non_empty: value = rows, passed = rows > 0.
    null_ratio: value = nulls / rows; zero rows -> value null, not passed.
    range: value = rows outside [lo, hi] (nulls pass), passed = value == 0.
    """
    return report(df.agg(*_agg_exprs(checks)), table, checks)


def report(a: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """The report rows from one row of counts: ``_n`` rows and ``_c<i>`` of each check that counts."""
    n = F.col("_n")
    rows = []
    for i, c in enumerate(checks):
        if c.kind == "non_empty":
            v, thr, ok = n.cast("double"), F.lit(0.0), n > 0
        elif c.kind == "null_ratio":
            v = F.try_divide(F.col(f"_c{i}").cast("double"), n.cast("double"))
            thr = F.lit(float(c.threshold))
            ok = F.coalesce(v <= thr, F.lit(False))
        elif c.kind == "range":
            v, thr, ok = F.col(f"_c{i}").cast("double"), F.lit(0.0), F.col(f"_c{i}") == 0
        else:
            raise ValueError(c.kind)
        rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(c.kind).alias("check"),
                             F.lit(c.column).cast("string").alias("column_name"),
                             v.alias("value"), thr.alias("threshold"), ok.alias("passed")))
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# The reference's validation suite (bounds differ from the
# cleaner's on purpose; each operator keeps its own defaults).
SILVER_GRID_CHECKS = [Check("non_empty"), Check("null_ratio", "load_mw", 0.01)]
SILVER_WEATHER_CHECKS = [Check("non_empty"),
                         Check("null_ratio", "temperature", 0.10),
                         Check("null_ratio", "wind_speed", 0.10),
                         Check("null_ratio", "humidity", 0.10),
                         Check("range", "temperature", lo=-40.0, hi=130.0),
                         Check("range", "humidity", lo=0.0, hi=100.0)]
ENRICHED_CHECKS = [Check("non_empty"), Check("null_ratio", "load_mw", 0.0)]
GOLD_CHECKS = [Check("non_empty")]


def validation_report(tables: dict[str, tuple[DataFrame, list[Check]]]) -> DataFrame:
    """I4: the report rows of every table, one aggregation per table."""
    out = None
    for name, (df, checks) in tables.items():
        r = check_table(df, name, checks)
        out = r if out is None else out.unionByName(r)
    return out


def overall_status(components: DataFrame) -> DataFrame:
    """(component, status) rows -> one row: healthy when all healthy,
    degraded when any unhealthy, operational otherwise."""
    return components.agg(
        F.when(F.bool_and(F.col("status") == "healthy"), "healthy")
         .when(F.bool_or(F.col("status") == "unhealthy"), "degraded")
         .otherwise("operational").alias("overall_status"),
        F.count(F.lit(1)).alias("components"))


def freshness_status(files: DataFrame, as_of, healthy_hours: float, by: str | None = None) -> DataFrame:
    """Newest file age in hours relative to ``as_of``: healthy below
    ``healthy_hours`` else stale; file count.  ``files`` has
    ``file_path`` and ``file_modification_time`` (from ``_metadata``, see ``list_files``);
    ``by`` names a column for one row a feed.  Without files: no_data (with ``by``: no row)."""
    a = files.groupBy(*([by] if by else [])).agg(
        F.max("file_modification_time").alias("newest"), F.count_distinct("file_path").alias("total_files"))
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) \
        / F.lit(3.6e9)
    return a.select(
        *([by] if by else []),
        F.when(F.col("total_files") == 0, "no_data")
         .when(age < healthy_hours, "healthy").otherwise("stale").alias("status"),
        (F.rint(age * 10) / 10).alias("latest_update_hours_ago"), "total_files")


def detector_status(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame | None]:
    """The anomaly component of I6, (component, status) in one row, and the detector's table:
    ``not_run`` and None where nothing was ever written at ``table``, else ``healthy``."""
    found = path_exists(spark, table)
    status = spark.range(1).select(F.lit("anomaly_detection").alias("component"),
                                   F.lit("healthy" if found else "not_run").alias("status"))
    return status, spark.read.parquet(table) if found else None


# ---------------------------------------------------------------- incremental

def list_files(spark: SparkSession, root: str) -> DataFrame:
    """file_path, path, length, file_modification_time of the Parquet files below ``root``; contents are
    not read.  ``file_path`` is written as ``_metadata`` has it, ``path`` as a reader takes it."""
    f = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
         .option("recursiveFileLookup", "true").load(root))
    return f.select("_metadata.file_path", "path", "length", F.col("modificationTime").alias("file_modification_time"))


def _suite(checks: list[Check]) -> str:
    return json.dumps([[c.kind, c.column, c.threshold, c.lo, c.hi] for c in checks])


def file_states(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Mergeable state of the checks for each file that ``df`` scans: file_path, rows, and one count a check
    (rows for ``non_empty``, else nulls or rows out of range).  Sums of states are the state of the files together."""
    n, *counts = _agg_exprs(checks)
    g = df.select("*", F.col("_metadata.file_path").alias("_state_file")).groupBy("_state_file").agg(n, *counts)
    each = [F.col("_n") if c.kind == "non_empty" else F.col(f"_c{i}") for i, c in enumerate(checks)]
    return g.select(F.col("_state_file").alias("file_path"), F.col("_n").alias("rows"), F.array(*each).alias("counts"))


def merged_report(states: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """The report of all files from their states; equal to ``check_table`` over the files."""
    total = [F.coalesce(F.sum(F.get("counts", F.lit(i))), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))]
    return report(states.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_n"), *total), table, checks)


def validate_new_files(spark: SparkSession, root: str, table: str, checks: list[Check],
                       state_path: str) -> tuple[DataFrame, int]:
    """I1-I4 over the Parquet files below ``root``, reading only files that no earlier run has read.

    A file's state is kept under ``state_path`` with its length, modification time and the suite of checks.
    Files that are new, were replaced, or were read for another suite are scanned, in one pass; states of
    files that are gone are left out.  The new states become the latest version by a marker renamed into
    place, so a run that dies leaves the states of the one before, and the next run repeats its files.
    Returns the report (as ``check_table`` over all files) and the number of files read.  A root without
    files gives the report of an empty table.  Names of new files pass the driver, where Spark's own file
    index holds them too; rows and states do not.  A file that is replaced by one of the same length and
    modification time is not noticed."""
    suite = _suite(checks)
    now = list_files(spark, root) if path_exists(spark, root) else None
    if now is None:
        none = spark.createDataFrame([], "rows long, counts array<bigint>")
        return merged_report(none, table, checks), 0
    # the listing as it is at this moment: files that land meanwhile wait for the next run
    now = materialize(now, "validation_listing")
    known = read_latest(spark, state_path)
    if known is None:
        known = now.limit(0).select("file_path", "length", "file_modification_time").withColumns({
            "suite": F.lit(""), "rows": F.lit(0).cast("long"), "counts": F.array().cast("array<bigint>")})
    same = ["file_path", "length", "file_modification_time"]
    kept = known.where(F.col("suite") == suite).join(now.select(*same), same, "left_semi")
    new = now.join(kept.select(*same), same, "left_anti")
    paths = [r["path"] for r in new.select("path").toLocalIterator()]
    if paths:
        fresh = file_states(spark.read.option("basePath", root).parquet(*paths), checks)
        empty = F.array_repeat(F.lit(0).cast("long"), len(checks))      # a file without rows is known from now on
        states = new.select(*same).join(fresh, "file_path", "left").select(
            *same, F.lit(suite).alias("suite"), F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("counts", empty).alias("counts"))
        kept = kept.select(*same, "suite", "rows", "counts").unionByName(states)
    write_latest(kept, state_path)
    return merged_report(read_latest(spark, state_path), table, checks), len(paths)
