"""Small file operations: ranged reads inside tasks (footers, records at an offset), and folders,
markers and short texts through the session's own file systems on the driver."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def open_file(path: str):
    """A seekable file of a path as Spark names it (``file:/...``, ``hdfs://...``, ``s3a://...``).

    Raises ``OSError`` or ``ValueError`` where this process has no client for the store;
    callers then read the file through Spark."""
    from pyarrow import fs
    scheme = urlparse(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(urlparse(path).path))
    uri = path.replace("s3a://", "s3://", 1) if scheme == "s3a" else path
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    store, p = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(p)) if store.exists(p) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A short text file that must not exist yet: written beside and renamed, so it is there whole or not at all."""
    store, p = _store(spark, path)
    if store.exists(p):
        raise FileExistsError(path)
    _, part = _store(spark, f"{path.rpartition('/')[0]}/_writing-{path.rpartition('/')[2]}")
    out = store.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(part, p):
        raise OSError(f"could not publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    store, p = _store(spark, path)
    stream = store.open(p)
    size = store.getFileStatus(p).getLen()
    out = bytes(stream.readNBytes(int(size)))
    stream.close()
    return out.decode()


def remove(spark: SparkSession, path: str) -> None:
    store, p = _store(spark, path)
    store.delete(p, True)
