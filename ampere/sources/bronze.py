"""Bronze / silver file layouts: scans (A1-A3), dated landing (A10) and
the sanitising rewrite (B10).

Layout: ``<root>/iso_code=<ISO>/ingest_date=<date>/part-*.parquet`` (Hive
style, written by ``partitionBy``); the scanners also accept the plain
``<root>/<ISO>/<date>/file.parquet`` layout.  The ISO is always taken from
the *grandparent* directory of each file (the reference read the parent,
the date folder, by mistake).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ampere.operators import clean as cl
from ampere.sources import schemas as sc


def iso_from_path(path: Column) -> Column:
    """Grandparent folder of a file path, without a ``key=`` prefix."""
    seg = F.element_at(F.split(path, "/"), -3)
    return F.regexp_replace(seg, r"^[^=/]*=", "")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def run_day(df: DataFrame, ts: Column) -> Column:
    """The landing day of a grid / price batch: the run day.  No wall
    clock: the newest observation day of the batch (a scalar subquery)."""
    return df.select(F.max(F.to_date(ts))).scalar()


def first_day(df: DataFrame, ts: Column) -> Column:
    """The landing day of a weather batch: its first observation day."""
    return df.select(F.min(F.to_date(ts))).scalar()


def write_bronze_dated(df: DataFrame, root: str, date_col: Column, mode: str = "append") -> str:
    """A10: land a feed as ``iso_code=/ingest_date=`` partitions, rebalanced
    on them first (files per partition follow its size, not the task count)."""
    (df.withColumn("ingest_date", date_col.cast("date").cast("string"))
     .hint("rebalance", "iso_code", "ingest_date")
     .write.mode(mode).partitionBy("iso_code", "ingest_date").parquet(root))
    return root


def has_partitions(spark: SparkSession, root: str, key: str = "iso_code") -> bool:
    """Whether the folders under ``root`` are ``key=`` partitions (from the listing of one level)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(s.getPath().getName().startswith(f"{key}=") for s in fs.listStatus(p))


def scan_bronze(spark: SparkSession, root: str, ignore_corrupt: bool = False,
                schema: StructType | str | None = None) -> DataFrame | None:
    """A1 / A2: scan of every parquet file under ``root``; files with
    different columns are merged by name (missing -> null), and where a column's
    types differ too, by schema groups on a type lattice (``schemas``); the ISO
    comes from the path.  ``None`` when the root is absent (the "no weather" branch).

    A ``iso_code=`` layout is read by partition discovery, so a filter on the
    ISO opens only its files; the plain layout is read recursively.  With a
    ``schema`` no footer is read to find the columns."""
    if not path_exists(spark, root):
        return None
    r = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower()).option("pathGlobFilter", "*.parquet")
    r = r.schema(schema) if schema is not None else r.option("mergeSchema", "true")
    parted = has_partitions(spark, root)
    iso = F.col("iso_code").cast("string") if parted else iso_from_path(F.col("_metadata.file_path"))
    try:
        df = (r.option("basePath", root) if parted else r.option("recursiveFileLookup", "true")).parquet(root)
        return df.withColumn("iso_code", iso).drop("ingest_date") if parted else df.withColumn("iso_code", iso)
    except Exception as e:                      # a Spark or a bare JVM exception, by version
        if "CANNOT_MERGE" not in str(e):
            raise
    groups, broken = sc.schema_groups(spark, root)
    if broken and not ignore_corrupt:
        raise ValueError(f"no Parquet footer in {broken[:5]} ({len(broken)} files)")
    options = {"ignoreCorruptFiles": str(ignore_corrupt).lower(), **({"basePath": root} if parted else {})}
    return sc.scan_groups(spark, groups, options, [iso.alias("iso_code")], ("iso_code", "ingest_date") if parted else
                          ("iso_code",))


def unread_files(spark: SparkSession, root: str, read: DataFrame) -> DataFrame:
    """Paths of the parquet files under ``root`` that gave no row to ``read``: unreadable or empty."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))
    seen = read.select(F.col("_metadata.file_path").alias("path")).distinct()
    return files.join(seen, "path", "left_anti")


def scan_bronze_grid(spark: SparkSession, root: str) -> DataFrame | None:
    """A1 then B1/B2: canonical (iso_code, timestamp_utc, load_mw, ...)."""
    raw = scan_bronze(spark, root)
    if raw is None:
        return None
    r = cl.resolve_columns(raw, {"timestamp_utc": cl.GRID_TS_CANDIDATES,
                                 "load_mw": cl.GRID_LOAD_CANDIDATES})
    return cl.coerce_types(r, {"timestamp_utc": "timestamp", "load_mw": "double"})


def scan_silver(spark: SparkSession, root: str) -> DataFrame:
    """A3: partition-discovered scan of a silver table with its timestamp
    columns typed (``iso_code=`` partitions are pruned by filters)."""
    df = spark.read.option("basePath", root).parquet(root)
    casts = {c: F.col(c).cast("timestamp_ntz") for c in ("timestamp_utc", "hour") if c in df.columns}
    return df.withColumns(casts)


def sanitize_rewrite(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Read every bronze file (unreadable ones skipped; ``unread_files``
    names them), normalise timestamp text (B8) and the load column (B9), write
    snappy parquet to a NEW path (never in place), return the rewritten table."""
    raw = scan_bronze(spark, root, ignore_corrupt=True)
    s = cl.sanitize_load(cl.sanitize_timestamps(raw))
    s.hint("rebalance", "iso_code").write.mode("overwrite").option("compression", "snappy").partitionBy("iso_code").parquet(out)
    return spark.read.parquet(out)
