"""Token-ID output: length-delimited binary records with an offset index (operator 3).

File format.  A file is a run of records, one a document, in ascending doc_id
order within and across files (``part-<number>``):

    u64  length of the payload
    u32  masked checksum of those eight bytes
    payload:  u8 flags (bit 0: a document id follows, bit 1: ids are 4 bytes wide)
              i64 document id (0 without one)
              ids, u16 or u32 each
    u32  masked checksum of the payload
    u8   0x0A, end of record

All numbers are little-endian; a checksum is CRC-32, rotated right by 15 and
increased by 0xa282ead8, so that checksums of data that holds checksums stay
sound.  The end byte is the line end of Spark's text writer, through which
records go: commits, retries and any file system Spark can write come with it.

The index is a separate Parquet table (path, record number, doc_id, offset,
bytes, n_tokens, start), so that a shuffled reader fetches single records by
ranged reads.  It
is made by reading the files back and checking every frame.

Files are bounded: the table is dealt by ranges of (doc_id, hash of text, place
in the scan) into as many parts as its text needs, ``FILE_BYTES`` of text each on
average, so rows of one id, a null one included, and copies fill several files.

Defined results: null text = empty = the end id alone; a null id sorts first
and is kept as null; rows that share an id are ordered by the hash of the
text; repeated rows are written each; an empty table gives no records; other
columns are not read; a frame that does not check raises.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import read_table
from ampere.llm.registry import query
from ampere.llm.wordbpe import blocks, default_path, encoder
from ampere.session import materialize, new_path
from ampere.sources.files import open_file

END_ID = 2
FILE_BYTES = 24 << 20        # text that one file's records come from, on average
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<Bq")
_CRC = struct.Struct("<I")


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its end byte."""
    n = struct.pack("<Q", len(payload))
    return b"".join((n, _CRC.pack(masked(n)), payload, _CRC.pack(masked(payload))))


def parse(data: bytes):
    """(offset, bytes, payload) of every record; raises where a frame does not check."""
    at = 0
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError(f"cut record at byte {at}")
        n, crc = _HEAD.unpack_from(data, at)
        if masked(data[at:at + 8]) != crc:
            raise ValueError(f"wrong length checksum at byte {at}")
        lo = at + _HEAD.size
        end = lo + n + _CRC.size + 1
        if end > len(data):
            raise ValueError(f"cut record at byte {at}")
        payload = data[lo:lo + n]
        if masked(payload) != _CRC.unpack_from(data, lo + n)[0] or data[end - 1] != 10:
            raise ValueError(f"wrong payload checksum at byte {at}")
        yield at, end - at, payload
        at = end


def serialize(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    flags = (doc_id is not None) + 2 * wide
    return _ID.pack(flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def deserialize(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = _ID.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=_ID.size)
    return (doc_id if flags & 1 else None), ids.astype("<u4")


def write_files(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None,
                file_bytes: int = FILE_BYTES) -> None:
    """Encode (doc_id, text) and write the record files."""
    tokenizer = tokenizer or default_path()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumns({"h": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("copy")]
    dealt = docs.repartitionByRange(max(1, -(-size // file_bytes)), *order)

    def run(batches):
        enc = encoder(tokenizer)
        wide = enc.size > 1 << 16
        tail = np.array([end_id], np.int32)
        for b in batches:
            names, done = b.column(0).to_pylist(), 0
            for part in blocks(b.column(1)):
                ids, at = enc.encode(part)
                records = [frame(serialize(names[done + k], np.concatenate((ids[at[k]:at[k + 1]], tail)), wide))
                           for k in range(len(part))]
                done += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    (dealt.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, "record binary")
     .select(F.col("record").cast("string").alias("value"))
     .write.mode("errorifexists").text(path, lineSep="\n"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files, frames checked: path, part, record, doc_id, offset, bytes, n_tokens,
    ids_crc32, before (ids of the records before it in its file)."""
    files = (spark.read.format("binaryFile").load(path)
             .select("path", "content").where("length > 0"))

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows, before = [], 0
                for k, (at, size, payload) in enumerate(parse(data.as_py())):
                    doc_id, ids = deserialize(payload)
                    rows.append((name, k, doc_id, at, size, len(ids), zlib.crc32(ids.tobytes()), before))
                    before += len(ids)
                cols = list(zip(*rows)) or [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(cols)],
                    names=["path", "record", "doc_id", "offset", "bytes", "n_tokens", "ids_crc32", "before"])

    rows = files.mapInArrow(run, "path string, record bigint, doc_id bigint, offset bigint, bytes bigint, "
                                 "n_tokens bigint, ids_crc32 bigint, before bigint")
    return rows.withColumn("part", F.regexp_extract("path", "part-(\\d+)[^/]*$", 1).cast("long"))


def write_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """Read the files back, write the offset index, and return it (with ids_crc32).

    ``start`` needs the tokens of the files before: a table of one row a file, summed in file order."""
    records = read_files(spark, path)
    records.write.mode("errorifexists").parquet(f"{index}-records")
    records = spark.read.parquet(f"{index}-records")
    files = records.groupBy("part").agg(F.sum("n_tokens").alias("in_file"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("in_file").over(ahead), F.lit(0)).alias("base"))
    (records.join(files, "part")
     .select("path", "part", "record", "doc_id", "offset", "bytes", "n_tokens", "ids_crc32",
             (F.col("base") + F.col("before")).alias("start"))
     .write.mode("errorifexists").parquet(index))
    return spark.read.parquet(index)


def read_records(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of chosen index rows (path, offset, bytes): a shuffled read.

    Wanted rows are grouped by file and read at their offsets, nothing else of the files.  Where
    a task has no client for the store, the row comes back unread and the whole file is read
    through Spark for these rows; paths may lie in any folders."""
    def at_offsets(batches):
        name, file = None, None
        for b in batches:
            got = []
            for path, at, size in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    if path != name:
                        name, file = path, open_file(path)
                    got.append(file.read_at(size, at))
                except (OSError, ValueError, ImportError):
                    name = None
                    got.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())],
                                             names=["path", "offset", "bytes", "body"])

    def decoded(batches):
        for b in batches:
            got = []
            for body in b.column(0).to_pylist():
                (_, _, payload), = parse(body)
                got.append(deserialize(payload))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1].astype(np.int64) for g in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    rows = wanted.select("path", F.col("offset").cast("long").alias("offset"), F.col("bytes").cast("long").alias("bytes"))
    cut = materialize(rows.repartition("path").sortWithinPartitions("path", "offset").mapInArrow(
        at_offsets, "path string, offset bigint, bytes bigint, body binary"), "op3-cut")
    bodies = cut.where("body is not null").select("body")
    unread = cut.where("body is null").select("path", "offset", "bytes")
    folders = [r[0] for r in unread.select(F.regexp_extract("path", "^(.*)/", 1)).distinct().collect()]
    if folders:                                      # one row a folder of record files
        files = spark.read.format("binaryFile").load(folders).select(F.col("path").alias("p"), "content")
        bodies = bodies.unionAll(unread.join(files, F.col("path") == F.col("p")).select(
            F.expr("substring(content, cast(offset + 1 as int), cast(bytes as int))")))
    return bodies.mapInArrow(decoded, "doc_id bigint, ids array<bigint>")


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as record files, read them back, and return what the files hold."""
    path = new_path(spark, "op3-files")
    write_files(read_table(spark, sf_dir, "documents"), path)
    return write_index(spark, path, new_path(spark, "op3-index")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "path", "offset", "bytes")
