"""Row-order operators (previous row, change, gaps and islands).

Few keys (five ISOs) must not mean five tasks, and one key may hold a third
of all rows.  So a "previous row within key" is computed in time buckets:
the window runs over (key, bucket) partitions and the first row of each
bucket takes the last row of the nearest earlier non-empty bucket of the
same key ("carry-in").  The carry table has one row per (key, bucket), so it
is small next to the data, and its own window runs over it only.  A bucket that
holds too many rows (a burst of one key) is cut into slices at sampled bounds,
and the slices take the place of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ampere.functions.timecols import epoch_us
from ampere.operators.attach import attach, small_side

SPLIT_ROWS = 200_000     # rows of a bucket above which it is cut into slices
PER_SLICE = 32           # sampled rows a slice: slices differ by about a fifth


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def time_bucket(ts: str, seconds: int) -> Column:
    return F.floor(epoch_us(ts) / F.lit(seconds * 1_000_000)).cast("long")


def slices(df: DataFrame, by: Sequence[str], order: Sequence[str], summary: dict[str, Column],
           split_rows: int = SPLIT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cut the buckets of ``df`` (columns ``by``, the last of them the bucket number) that hold more
    than ``split_rows`` rows into slices along ``order``.

    Returns ``df`` with ``_sub``, the number of a row's slice in its bucket, and a written table of one
    row a slice: by, _sub, _n (rows) and the ``summary`` aggregates.  The buckets are counted in the
    pass that summarises them; where one is too large, its bounds are quantiles of a sample of its
    rows (about ``PER_SLICE`` a slice), and rows find their slice by comparing with the bucket's own
    bounds.  Rows equal in all of ``order`` share a slice."""
    aggs = [F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in summary.items()]]
    base = small_side(df.groupBy(*by).agg(*aggs))
    hot = base.where(F.col("_n") > split_rows)
    if not hot.take(1):
        return df.withColumn("_sub", F.lit(0)), base.withColumn("_sub", F.lit(0))
    at = F.struct(*[F.col(c) for c in order])
    wanted = F.ceil(F.col("_n") / F.lit(split_rows)).cast("int")
    chance = F.least(F.lit(1.0), wanted * PER_SLICE / F.col("_n"))
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # drawn before the join, so that a row's number does not depend on its plan
    sample = (df.select(*by, at.alias("_at")).withColumn("_draw", draw)
              .join(hot.select(*by, wanted.alias("_k"), chance.alias("_p")), list(by)).where(F.col("_draw") < F.col("_p")))
    bounds = small_side(sample.groupBy(*by, "_k").agg(F.sort_array(F.collect_list("_at")).alias("_s")).select(
        *by, F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("_k") - 1), lambda j: F.get(
            F.col("_s"), (j * F.size("_s") / F.col("_k")).cast("int")))).alias("_bounds")))
    cut = df.join(bounds, list(by), "left").withColumn("_sub", F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_bounds", lambda x: x <= at)))).drop("_bounds")
    calm = base.join(bounds.select(*by), list(by), "left_anti").withColumn("_sub", F.lit(0))
    again = cut.join(bounds.select(*by), list(by), "left_semi").groupBy(*by, "_sub").agg(*aggs)
    return cut, small_side(calm.unionByName(again))


def previous_row(df: DataFrame, keys: str | Sequence[str], ts: str,
                 cols: Sequence[str], tie: Sequence[str] = (),
                 bucket_seconds: int = 3600, prefix: str = "prev_",
                 split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` in the previous row of the same key.

    Order is (ts, *tie).  Equivalent to ``lag(c)`` over
    ``partitionBy(keys).orderBy(ts, *tie)`` but parallel over time, and inside a
    bucket of many rows too (``slices``).
    """
    keys = _as_list(keys)
    order = [ts] + list(tie)
    b = df.withColumn("_bk", time_bucket(ts, bucket_seconds))
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    b, table = slices(b, [*keys, "_bk"], order, {"_last": last}, split_rows)
    w = Window.partitionBy(*keys, "_bk", "_sub").orderBy(*order)
    lagged = b.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in cols}) \
              .withColumn("_first", F.row_number().over(w) == 1)
    # the last row of the slice before, in a table of one row a slice
    carry = table.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bk", "_sub"))
    ).select(*keys, "_bk", "_sub", "_carry")
    # size-checked broadcast, else a shuffle join
    j = attach(lagged, carry, [*keys, "_bk", "_sub"], "left")
    out = j.withColumns({
        f"{prefix}{c}": F.when(F.col("_first"), F.col(f"_carry.{c}"))
                         .otherwise(F.col(f"_lag_{c}"))
        for c in cols
    })
    return out.drop("_bk", "_sub", "_first", "_carry", *[f"_lag_{c}" for c in cols])


def with_change(df: DataFrame, keys="iso_code", ts="timestamp_utc", col="load_mw",
                tie: Sequence[str] = (), bucket_seconds: int = 3600) -> DataFrame:
    """E1 + E2: ``load_change`` (diff) and ``load_change_pct`` (pct_change*100).

    The first row of a key has nulls; a zero previous value gives null
    rather than pandas' inf (impossible after cleaning, load > 0).
    """
    p = previous_row(df, keys, ts, [col], tie=tie, bucket_seconds=bucket_seconds)
    prev = F.col(f"prev_{col}")
    return p.withColumns({
        "load_change": F.col(col) - prev,
        "load_change_pct": F.try_divide(F.col(col) - prev, prev) * F.lit(100.0),
    }).drop(f"prev_{col}")


def islands(df: DataFrame, keys: str | Sequence[str], ts: str, flag: str,
            step_seconds: int, bucket_steps: int = 4096) -> DataFrame:
    """Gaps and islands over a regular series: consecutive ``flag`` rows.

    Returns one row per run of true flags: keys, start, end (last step start
    + step), steps.  Input is one row per (keys, ts) step (already reduced).

    Runs are found inside buckets of ``bucket_steps`` steps, so one key (or none)
    is as many tasks as it has buckets.  Only runs that touch an edge of their
    bucket, two a bucket at most, go to a second pass by key, which stitches
    those that meet; all others are done.
    """
    keys = _as_list(keys)
    step_us = step_seconds * 1_000_000
    t = df.where(F.col(flag)).withColumn("_i", F.floor(epoch_us(ts) / F.lit(step_us)).cast("long"))
    t = t.withColumn("_bk", F.floor(F.col("_i") / F.lit(bucket_steps)).cast("long"))
    w = Window.partitionBy(*keys, "_bk").orderBy("_i")
    runs = t.withColumn("_grp", F.col("_i") - F.row_number().over(w)).groupBy(*keys, "_bk", "_grp").agg(
        F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.min(ts).alias("start"), F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("steps"))
    edge = (F.pmod("_lo", F.lit(bucket_steps)) == 0) | (F.pmod("_hi", F.lit(bucket_steps)) == bucket_steps - 1)
    runs = small_side(runs.withColumn("_edge", edge).drop("_bk", "_grp"))
    along = Window.partitionBy(*keys).orderBy("_lo")
    apart = (F.col("_lo") != F.lag("_hi").over(along) + 1).cast("int")
    stitched = (runs.where("_edge").withColumn("_new", F.coalesce(apart, F.lit(1)))
                .withColumn("_run", F.sum("_new").over(along)).groupBy(*keys, "_run")
                .agg(F.min("start").alias("start"), F.max("_last").alias("_last"), F.sum("steps").alias("steps")))
    whole = runs.where("not _edge").select(*keys, "start", "_last", "steps").unionByName(
        stitched.select(*keys, "start", "_last", "steps"))
    return whole.select(*keys, "start",
                        (F.col("_last") + F.make_dt_interval(secs=F.lit(step_seconds))).alias("end"),
                        "steps")


def top_k_per_key(df: DataFrame, keys, order: Sequence[Column], k: int) -> DataFrame:
    """Top-k rows per key (row_number <= k; Spark pushes the group limit)."""
    w = Window.partitionBy(*_as_list(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")

