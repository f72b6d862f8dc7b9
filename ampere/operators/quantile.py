"""Exact quantiles per key, without gathering a group into one buffer.

``percentile`` keeps every value of a group in one aggregation buffer, and
a window over a key's values puts the whole key in one task; a hot key (a
third of all rows) allows neither.  Instead the rank of interest is found
by histogram refinement:

1. per key: n, min, max (one aggregate); the wanted order statistics are
   the ranks floor(p (n-1)) and the next one (numpy / DuckDB
   ``quantile_cont`` interpolation);
2. while any rank's bracket [lo, hi] still holds more than ``direct_max``
   rows: count the bracket's rows in ``buckets`` equal-width buckets (a
   grouped count over the broadcast bracket table), keep the bucket that
   contains the rank, and shrink the bracket to that bucket's actual min
   and max - each pass divides the bracket by about ``buckets``;
3. rank the few rows left in each bracket with a window over
   (key, target) only, or take lo directly when lo == hi.

Every pass is one scan of (key, value); the driver only loops over passes
and reads a one-row summary.  Bracket tables are tiny and persisted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ampere.operators.attach import small_side
from ampere.session import cut_lineage


def _keep(df: DataFrame) -> DataFrame:
    """Tiny per-key tables (stats, brackets) are computed once; a reliable
    checkpoint also keeps the plan of the refinement loop flat."""
    return cut_lineage(df)


def exact_quantiles(df: DataFrame, key: str | Sequence[str], col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    buckets: int = 4096, direct_max: int = 200_000) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    glob = not keys
    if glob:  # one global group: a constant key keeps every join an equi-join
        df, keys = df.withColumn("_g", F.lit(0)), ["_g"]
    base = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_v"))

    stats = _keep(base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    # two targets per probability: ranks floor(p (n-1)) and the next one
    tgt = []
    for i, p in enumerate(probs):
        r = F.floor(F.lit(float(p)) * (F.col("_n") - 1)).cast("long")
        tgt += [F.struct(F.lit(2 * i).alias("_t"), r.alias("_rank")),
                F.struct(F.lit(2 * i + 1).alias("_t"), F.least(r + 1, F.col("_n") - 1).alias("_rank"))]
    targets = stats.select(*keys, "_n", "_min", "_max", F.explode(F.array(*tgt)).alias("x")).select(
        *keys, "x._t", "x._rank", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"),
        F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_cnt"))
    targets = _keep(targets)

    def in_bracket(t):
        # the bracket table has 2 x len(probs) rows per key: size-checked
        # broadcast, else a shuffle join on the keys with a range residual
        t = small_side(t)
        cond = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        for k in keys:
            cond = cond & (base[k] == t[k])
        return base.join(t, cond).drop(*[t[k] for k in keys])

    open_ = (F.col("_cnt") > direct_max) & (F.col("_lo") < F.col("_hi"))
    left = None
    while True:
        now = targets.where(open_).agg(F.count(F.lit(1)), F.sum("_cnt"), F.sum(F.col("_hi") - F.col("_lo"))).first()
        if not now[0]:
            break
        if now == left:     # a pass that shrinks no bracket would run for ever
            raise RuntimeError(f"{now[0]} quantile brackets of {now[1]} rows do not shrink")
        left = now
        todo = targets.where(open_)
        j = in_bracket(todo)
        width = (F.col("_hi") - F.col("_lo")) / F.lit(float(buckets))
        b = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(buckets - 1)).cast("int")
        h = j.groupBy(*keys, "_t", "_rank", "_below", b.alias("_b")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
        w = Window.partitionBy(*keys, "_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        h = h.withColumn("_cb", F.sum("_c").over(w) - F.col("_c"))
        pos = F.col("_below") + F.col("_cb")
        hit = h.where((pos <= F.col("_rank")) & (F.col("_rank") < pos + F.col("_c"))).select(
            *keys, "_t", "_rank", F.col("_mn").alias("_lo"), F.col("_mx").alias("_hi"),
            pos.alias("_below"), F.col("_c").alias("_cnt"))
        targets = _keep(targets.where(~open_).unionByName(hit))

    # resolve: constant brackets directly, the rest by a bounded rank
    const = targets.where(F.col("_lo") == F.col("_hi")).select(*keys, "_t", F.col("_lo").alias("_val"))
    rest = targets.where(F.col("_lo") < F.col("_hi"))
    j = in_bracket(rest)
    w = Window.partitionBy(*keys, "_t").orderBy("_v")
    ranked = j.withColumn("_rn", F.row_number().over(w) - 1 + F.col("_below"))
    picked = ranked.where(F.col("_rn") == F.col("_rank")).select(*keys, "_t", F.col("_v").alias("_val"))
    vals = const.unionByName(picked)

    aggs = []
    for i, name in enumerate(names):
        aggs += [F.max(F.when(F.col("_t") == 2 * i, F.col("_val"))).alias(f"_{name}_a"),
                 F.max(F.when(F.col("_t") == 2 * i + 1, F.col("_val"))).alias(f"_{name}_b")]
    a = vals.groupBy(*keys).agg(*aggs).join(stats.select(*keys, F.col("_n").alias("n")), keys)
    out = []
    for p, name in zip(probs, names):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        frac = pos - F.floor(pos)
        out.append((F.col(f"_{name}_a") + frac * (F.col(f"_{name}_b") - F.col(f"_{name}_a"))).alias(name))
    res = a.select(*keys, "n", *out)
    return res.drop("_g") if glob else res
