"""Document fingerprints: bottom-k sketches of shingle hashes (operator 2, native).

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a
text's five-word shingles (a text of fewer words is one shingle; no words, an
empty sketch).  Sketches of parts merge into the sketch of the union, and two
sketches estimate resemblance, containment and distinct shingle counts, all by
array functions inside generated plans; no Python.

The query also fingerprints an edited text, made from the next document in
descending id order.  The order of all ids is built over range partitions
(neighbours inside a partition by a window, across partitions by a table of one
row per partition), and the neighbour's prefix and sketch come by equi-join on
the id, so no task holds more than its share and no text is sorted globally.

Defined results: null text = empty text; an empty text has an empty sketch and
the fingerprint ''; two empty sketches resemble 1.0, an empty and a full one
0.0; rows repeated exactly are one document; rows that share an id but not the
text are ordered by the hash of the text; a null id comes last in the
descending order; the only document of a table is its own next; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import read_table, whole_text, words_of
from ampere.llm.registry import query
from ampere.session import materialize

K = 128          # hashes kept in a sketch: standard error of a resemblance at most 0.045
SHINGLE = 5
_SPAN = float(2 ** 64)


def shingle_hashes(words: Column, width: int = SHINGLE) -> Column:
    n = F.size(words)
    return F.when(n >= width, F.transform(
        F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    ).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    """Bottom-k sketch of an array of hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches describe."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity (exact when both sets have at most k/2 shingles)."""
    both = F.size(merge(a, b, k))
    hit = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    return F.when(both == 0, F.lit(1.0)).otherwise(hit / both)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k-1) / (k-th hash as a share)."""
    kth = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(_SPAN / 2)) / F.lit(_SPAN)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: r (|A|+|B|) / ((1+r) |A|), within 0..1."""
    r = resemblance(a, b, k)
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), r * (na + nb) / ((1 + r) * na)))


def as_text(a: Column) -> Column:
    """A sketch as lower-case hex, 16 digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def fingerprint(df: DataFrame, out: str, text: Column, k: int = K) -> DataFrame:
    """``df`` plus ``out``: the sketch of ``text``."""
    w = f"{out}_words"
    return df.withColumn(w, words_of(text)).withColumn(out, bottom(shingle_hashes(F.col(w)), k)).drop(w)


def next_keys(keys: DataFrame, spark: SparkSession) -> DataFrame:
    """``keys`` (id, h, n; distinct) plus next_id, next_h in descending (id, h) order, cyclic."""
    order = [F.col("id").desc_nulls_last(), F.col("h").desc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(
        keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "op2-order")
    inside = Window.partitionBy("part").orderBy(*order)
    here = F.struct("id", "h")
    local = dealt.withColumn("nx", F.lead(here).over(inside))
    # one row per range partition: its first key, and the first key of the partition after it
    firsts = dealt.groupBy("part").agg(F.min_by(here, F.struct(
        F.col("id").isNull(), -F.col("id").cast("decimal(38,0)"), -F.col("h").cast("decimal(38,0)"))).alias("first"))
    across = Window.orderBy("part")
    firsts = firsts.withColumns({
        "after": F.lead("first").over(across),
        "wrap": F.first("first").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    nx = F.coalesce(F.col("nx"), F.col("after"), F.col("wrap"))
    return (local.join(firsts, "part")
            .select("id", "h", "n", nx["id"].alias("next_id"), nx["h"].alias("next_h")))


def with_neighbour(docs: DataFrame, spark: SparkSession, k: int = K) -> DataFrame:
    """doc_id, text, and of the next document in descending id order ``head`` (its first
    floor(n_chars/3) code points, n_chars being this document's) and ``next_sketch``."""
    base = docs.select(F.col("doc_id").alias("id"), whole_text(F.col("text")).alias("txt"))
    base = base.withColumn("h", F.xxhash64("txt"))
    rows = base.groupBy("id", "h").agg(F.max(F.length("txt")).alias("n"), F.count(F.lit(1)).alias("copies"))
    rows = materialize(rows, "op2-keys")
    if rows.where("copies > 1").take(1):
        base = base.dropDuplicates(["id", "h"])
    links = next_keys(rows.drop("copies"), spark).withColumnsRenamed(
        {"id": "to_id", "h": "to_h", "n": "to_n"})
    links = materialize(links, "op2-links")
    same = F.col("id").eqNullSafe(F.col("next_id")) & (F.col("h") == F.col("next_h"))
    given = base.join(links, same).select(
        "to_id", "to_h", F.col("txt"), F.floor(F.col("to_n") / 3).cast("int").alias("m"))
    given = fingerprint(given, "next_sketch", F.col("txt"), k).select(
        "to_id", "to_h", "next_sketch", F.substring("txt", F.lit(1), F.col("m")).alias("head"))
    mine = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("h") == F.col("to_h"))
    return base.join(given, mine).select(
        F.col("id").alias("doc_id"), F.col("txt").alias("text"), "head", "next_sketch")


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likeness."""
    df = with_neighbour(read_table(spark, sf_dir, "documents").select("doc_id", "text"), spark)
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), F.col("head"))
    df = df.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_sketch")
    df = fingerprint(df, "a", F.col("text"))
    df = fingerprint(df, "b", F.col("edited"))
    return df.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b")).alias("near_edited"),
        resemblance(F.col("a"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("a"), F.col("b")).alias("contained_in_edited"),
        distinct_shingles(F.col("a")).alias("est_shingles"))
