"""Connected components of an edge table by alternating stars, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.session import materialize


SALTS = 64     # parts that the edges of one node are spread over


def _with_least(asked: DataFrame, told: DataFrame) -> DataFrame:
    """Rows (u, v) of ``asked`` with m, the smallest v of u in ``told``.

    ``told`` has the rows of ``asked`` with ``ask`` true, and others.  Both sides meet by (u, salt of v), so
    the edges of a node of any degree are spread over ``SALTS`` tasks; what goes to one task for a node
    is one minimum a salt."""
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    parts = told.withColumn("s", salt).groupBy("u", "s").agg(F.min("v").alias("m"), F.bool_or("ask").alias("ask"))
    low = parts.groupBy("u").agg(F.min("m").alias("m"), F.collect_list(F.when(F.col("ask"), F.col("s"))).alias("ss"))
    low = low.select("u", "m", F.explode("ss").alias("s"))
    return asked.withColumn("s", salt).join(low, ["u", "s"]).drop("s")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node but the roots.

    ``edges`` has columns a and b.  Large and small stars in turn (each node's
    neighbours are linked to its smallest one) until nothing changes; every round
    is a written table, and a node of any degree is spread over tasks.  Rounds grow
    with the logarithm of a component's diameter.  Loops and repeated edges change
    nothing; no edges give an empty table."""
    e = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), name)
    last = None
    while True:
        # large star: larger neighbours of a node go to the smallest neighbour (or the node itself)
        out = e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        both = out.withColumn("ask", F.lit(True)).unionAll(
            e.select(F.col("hi").alias("u"), F.col("lo").alias("v"), F.lit(False).alias("ask")))
        large = _with_least(out, both).select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        small = _with_least(large, large.withColumn("ask", F.lit(True)))
        e = materialize(
            small.select(F.explode(F.array(F.struct(F.col("v").alias("hi"), F.col("m").alias("lo")),
                                           F.struct(F.col("u").alias("hi"), F.col("m").alias("lo")))).alias("x"))
            .select("x.*").where("hi <> lo").distinct(), name)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == last or not now[0]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        last = now
