"""Parquet files whose column types differ (A1, A2): schema groups on a type lattice.

Spark merges file schemas by name but stops where one file holds a column as
``bigint`` and the next as ``double`` or text.  Here the footers are read in a
distributed pass (only the footers, a few kilobytes a file), files with the same
schema form a group, each column is widened to the least type that holds all its
groups' types, and every group is one scan, cast and united by name.

The lattice, from narrow to wide: tinyint < smallint < int < bigint < double,
float < double, integers and decimals to a decimal that holds both, date <
timestamp_ntz, structs field by field, arrays by element; anything else meets in
string (``to_json`` for nested values).  A bigint next to a double loses digits
beyond 2^53, as a mixed column of the source's tools does.

The driver holds the paths (as any file scan does) and one row a distinct schema.
"""

from __future__ import annotations

import functools
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def _shape(t: T.DataType) -> tuple[int, int] | None:
    """Digits and decimal places of a decimal or whole number."""
    if isinstance(t, T.DecimalType):
        return t.precision, t.scale
    digits = _DIGITS.get(t.simpleString())
    return (digits, 0) if digits else None


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE.index(x) > _WHOLE.index(y) else b
    numbers = {*_WHOLE, "float", "double"}
    if x in numbers and y in numbers:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        if {x, y} & {"float", "double"}:
            return T.DoubleType()
        p, q = _shape(a), _shape(b)
        if p and q:
            scale, whole = max(p[1], q[1]), max(p[0] - p[1], q[0] - q[1])
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if {x, y} <= {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if {x, y} <= {"date", "timestamp_ntz", "timestamp"}:
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_fields([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    return T.StringType()


def merge_fields(schemas: list[T.StructType]) -> T.StructType:
    """Fields of all schemas by name (case-insensitive, first spelling), each widened."""
    found: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            old = found.get(f.name.lower())
            found[f.name.lower()] = T.StructField(
                old.name if old else f.name, widen(old.dataType, f.dataType) if old else f.dataType)
    return T.StructType(list(found.values()))


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` cast up the lattice."""
    if have == want:
        return c
    if isinstance(want, T.StructType):
        mine = {f.name.lower(): f for f in have.fields}
        parts = [as_type(c[mine[f.name.lower()].name], mine[f.name.lower()].dataType, f.dataType).alias(f.name)
                 if f.name.lower() in mine else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


def _spark_type(t: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type
    unsigned = {"uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(),
                "uint64": T.DecimalType(20, 0)}          # as Spark's own reader takes them
    if str(t) in unsigned:
        return unsigned[str(t)]
    if pa.types.is_dictionary(t):
        return _spark_type(t.value_type)
    return from_arrow_type(t, prefer_timestamp_ntz=True)


def footer_schema(source) -> str:
    """The schema of a Parquet file (path to open or bytes of the whole file) as Spark's JSON."""
    import pyarrow.parquet as pq
    schema = pq.read_schema(source)
    kept = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if kept:                                             # written by Spark: its own types
        return kept.decode()
    return T.StructType([T.StructField(f.name, _spark_type(f.type)) for f in schema]).json()


def file_schemas(files: DataFrame) -> DataFrame:
    """``path``, ``schema`` (JSON; null if there is no footer), ``opened`` of the listed files.

    ``opened`` is false where a task has no client for the store (``content_schemas`` reads those)."""
    def by_path(batches):
        from ampere.sources.files import open_file
        for b in batches:
            out = []
            for path in b.column(0).to_pylist():
                try:
                    with open_file(path) as f:
                        out.append((footer_schema(f), True))
                except pa.ArrowInvalid:                  # opened, but no Parquet file
                    out.append((None, True))
                except (OSError, ValueError, ImportError):
                    out.append((None, False))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out])],
                names=["path", "schema", "opened"])

    return files.select("path").mapInArrow(by_path, "path string, schema string, opened boolean")


def content_schemas(files: DataFrame) -> DataFrame:
    """``path``, ``schema`` from (path, content): for stores that only Spark reads."""
    def run(batches):
        for b in batches:
            out = []
            for data in b.column(1):
                try:
                    out.append(footer_schema(pa.BufferReader(data.as_buffer())))
                except pa.ArrowInvalid:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["path", "schema"])

    return files.select("path", "content").mapInArrow(run, "path string, schema string")


def schema_groups(spark: SparkSession, root: str) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    """(schema, paths) of every distinct file schema under ``root``, and the unreadable files."""
    from ampere.session import materialize
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(root))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = materialize(file_schemas(listed.select("path").repartition(parts)), "file-schemas")
    known = first.where("opened").select("path", "schema")
    rest = first.where("not opened").select("path")
    if rest.take(1):
        known = known.unionAll(content_schemas(listed.join(rest, "path", "left_semi")))
    groups = known.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    broken = [p for g in groups if g["schema"] is None for p in g["paths"]]
    read = [(T.StructType.fromJson(json.loads(g["schema"])), g["paths"]) for g in groups if g["schema"] is not None]
    return sorted(read, key=lambda g: g[1][0]), broken


def scan_groups(spark: SparkSession, groups: list[tuple[T.StructType, list[str]]], options: dict[str, str],
                extra: list[Column], skip: tuple[str, ...] = ()) -> DataFrame:
    """One scan a schema group, cast to the widened schema and united by name.

    ``extra`` columns are taken from every scan as they are (partition values, the file's path);
    columns of the files named in ``skip`` are not read."""
    def kept(s):
        return T.StructType([f for f in s.fields if f.name not in skip])

    groups = [(kept(s), paths) for s, paths in groups]
    whole = merge_fields([s for s, _ in groups])
    out = []
    for schema, paths in groups:
        mine = {f.name.lower(): f for f in schema.fields}
        df = spark.read.options(**options).schema(schema).parquet(*paths)
        out.append(df.select(*[
            (as_type(F.col(f"`{mine[f.name.lower()].name}`"), mine[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in whole.fields], *extra))
    return functools.reduce(DataFrame.unionByName, out)
