"""Session construction and shared-folder helpers.

Everything time related runs in UTC.  The scratch folder used for
checkpoints and landed files is always taken from the cluster's
``spark.checkpoint.dir``; only when that is unset and the master is local
(tests) do we point it at a fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that results depend on: set, read back, and an error if they do not hold.
EXACT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}
# Settings for speed only; a cluster may hold others.  Shuffle partition
# counts are left to the cluster (AQE coalesces them at run time).
CORE_CONF = EXACT_CONF | {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of whole texts: a batch is held by the JVM and by the Python worker at once
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, app: str = "ampere",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings, check that they hold, and ship the package to the workers."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)
    for k, v in EXACT_CONF.items():
        if (now := spark.conf.get(k)) != v:
            raise RuntimeError(f"{k} is {now!r}; the results need {v!r}")
    ship_package(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext; None in a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, so that it is found there
    from whatever folder the driver was started in."""
    sc = _context(spark)
    holder = sc if sc is not None else spark
    if getattr(holder, "_ampere_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ampere-package-")) / f"ampere-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"ampere/{f.relative_to(root)}")
    if sc is not None:
        sc.addPyFile(str(archive))     # served to the executors by the driver
    else:
        spark.addArtifacts(str(archive), pyfile=True)
    holder._ampere_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master, where driver and executors are one process, an
    unset folder is replaced by a new temp folder; elsewhere that is an error,
    since no other machine would see it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="ampere-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    holder = _context(spark) or spark
    holder.__dict__.setdefault("_ampere_scratch", []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this session has written under the shared folder so far.

    For the caller, once the results that read them are stored or done with."""
    sc = spark.sparkContext
    paths = sc.__dict__.pop("_ampere_scratch", [])
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    shared_dir(spark)
    return df.checkpoint(eager=True)


def materialize(df, name: str, spark: SparkSession | None = None):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For big intermediate tables (the silver layer, scored rows): a written
    table cuts the lineage like ``checkpoint()`` but is columnar and
    compressed, so later reads prune columns, push filters down and give
    the planner real size statistics."""
    spark = spark or df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def local_test_session(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return build_session(
        master=f"local[{cpus}]", app="ampere-test", shuffle_partitions=partitions,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g",
               "spark.ui.showConsoleProgress": "false",
               "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)})
