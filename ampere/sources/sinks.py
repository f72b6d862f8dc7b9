"""Sinks (A9, A11-A13).  Every write goes to the shared folder named by the
cluster (``spark.checkpoint.dir``) or a caller-given path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ampere.sources import files as fl


def write_partitioned(df: DataFrame, path: str, by: str = "iso_code") -> str:
    """Parquet per ``iso_code=`` with dynamic partition overwrite (only
    the partitions present in ``df`` are replaced).  Rows are rebalanced on
    the partition column first: few files a partition, large ones split."""
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(path))
    return path


def write_latest(df: DataFrame, path: str, keep: int = 2) -> str:
    """Consolidated latest snapshot, in a path of its own beside the partitioned history.

    Each write is a new folder ``version=<number>``, and becomes the latest one by a marker file that
    is renamed into place last; until then, and if the write fails, ``read_latest`` finds the one
    before, whole.  The newest ``keep`` published versions stay for readers that have them open.  One
    writer at a time.  Returns the folder of the new version."""
    spark = df.sparkSession
    done = published(spark, path)
    number = max([n for n, _ in done] + [_number(c) for c in fl.children(spark, path) if c.startswith("version=")],
                 default=0) + 1
    folder = f"{path}/version={number:08d}"
    df.write.mode("errorifexists").parquet(folder)
    fl.write_once(spark, f"{path}/_published-{number:08d}", folder.rpartition("/")[2])
    for n, old in (done[:-(keep - 1)] if keep > 1 else done):
        fl.remove(spark, f"{path}/_published-{n:08d}")
        fl.remove(spark, old)
    return folder


def _number(name: str) -> int:
    return int(name.rpartition("=")[2])


def published(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of the published versions, oldest first."""
    names = [c for c in fl.children(spark, path) if c.startswith("_published-")]
    return [(int(c.rpartition("-")[2]), f"{path}/version={c.rpartition('-')[2]}") for c in names]


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest published snapshot; None if there is none."""
    done = published(spark, path)
    return spark.read.parquet(done[-1][1]) if done else None


def write_text_report(lines: DataFrame, path: str, col: str = "insight") -> str:
    """One text line per row (row set computed on the cluster)."""
    lines.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def append_run(df: DataFrame, path: str, run_ts: str, by: str = "iso_code") -> str:
    """Append one run as ``run_ts=<stamp>/iso_code=<ISO>/`` files."""
    (df.hint("rebalance", by).withColumn("run_ts", F.lit(run_ts))
     .write.mode("append").partitionBy("run_ts", by).parquet(path))
    return path
