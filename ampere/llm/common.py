"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

#: ASCII white space as the contracts name it: space and 0x09-0x0D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(col: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(col, F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order.

    Only the first and the last piece of the split can be empty."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def schema_plus(df: DataFrame, name: str, kind: str) -> StructType:
    """The schema of ``df`` with one more column at the end."""
    return StructType(list(df.schema.fields)).add(name, DataType.fromDDL(kind))


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` with the condition's columns computed once, before the filter.

    A filter is otherwise pushed below the projections, where every use of a
    column becomes its whole expression again, inside lambdas once per element.
    Spark leaves a filter above a projection that numbers its rows."""
    row, = fresh(df, "_row")
    return (df.withColumn(row, F.monotonically_increasing_id())
            .where(condition & (F.col(row) >= 0)).drop(row))
