"""Trailing time windows (t - W, t] as merges of block summaries.

A window per key would put a whole key into one task.  Here time is cut into
blocks that divide W, so that a frame is three parts: the block of t up to t,
the whole blocks between, and the block W earlier after t - W.  The first and
last are running aggregates inside (key, block) groups; the middle is read from
a table of one row a block.  The parts are merged exactly: counts and decimal
sums add up, extremes compare, and squared deviations merge pairwise (Chan et al.).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ampere.functions.numeric import EXACT_DEC, MEAN_DIGITS, half_even_quotient
from ampere.functions.timecols import epoch_us
from ampere.operators.attach import attach, small_side

BLOCK_HOURS = 24
_STATE = ("n", "total", "mean", "m2", "low", "high")


def block_hours(hours: int, most: int = BLOCK_HOURS) -> int:
    """The widest block of whole hours that divides a window of ``hours`` and is no wider than ``most``."""
    return max(b for b in range(1, min(hours, most) + 1) if hours % b == 0)


def _state(value: str, over=None) -> Column:
    """Count, exact sum, mean, squared deviations and extremes of ``value`` as one struct."""
    v = F.col(value)
    aggs = {"n": F.count(v), "total": F.sum(v.cast(EXACT_DEC)), "mean": F.avg(v), "m2": F.var_pop(v) * F.count(v),
            "low": F.min(v), "high": F.max(v)}
    if over is not None:
        aggs = {"n": F.count(v).over(over), "total": F.sum(v.cast(EXACT_DEC)).over(over), "mean": F.avg(v).over(over),
                "m2": F.var_pop(v).over(over) * F.count(v).over(over),
                "low": F.min(v).over(over), "high": F.max(v).over(over)}
    return F.struct(*[aggs[s].alias(s) for s in _STATE])


def merge(a: Column, b: Column) -> Column:
    """The state of two disjoint row sets from their states; a null or empty state adds nothing."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"), (a["total"] + b["total"]).cast("decimal(38,8)").alias("total"),
        (a["mean"] + apart * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"))
    return (F.when(a.isNull() | (a["n"] == 0), b).when(b.isNull() | (b["n"] == 0), a).otherwise(both))


def rolling_stats(df: DataFrame, keys: Sequence[str], ts: str, value: str, windows: dict[str, int],
                  most_hours: int = BLOCK_HOURS) -> DataFrame:
    """``df`` with mean / std / min / max of ``value`` over the trailing (t - W hours, t] of each row's
    key, for every label and W of ``windows``; columns ``mean_<label>`` and so on.

    Gaps shrink a window instead of stretching it; rows of equal time see each other; null values are
    left out (none left: null; std of one value: null); null keys form a key; rows without a time get
    nulls.  A task holds (key, block) groups of at most ``most_hours`` of one key, never a whole key, and
    a state of a row is shifted once for each window, so the work is rows x windows.  Double means
    are rounded from exact sums, so they do not depend on the order of rows."""
    keys = list(keys)
    t = df.withColumn("_us", epoch_us(ts))
    by_width: dict[int, list[str]] = {}
    for label, hours in windows.items():
        by_width.setdefault(block_hours(hours, most_hours), []).append(label)
    for width, labels in by_width.items():
        t = _one_width(t, keys, value, width * 3_600_000_000, {x: windows[x] // width for x in labels})
    out = {}
    for label in windows:
        s = F.when(F.col("_us").isNotNull(), F.col(f"_f_{label}"))
        t = t.withColumns({f"_n_{label}": s["n"], f"_t_{label}": s["total"]})
        out[f"mean_{label}"] = half_even_quotient(f"_t_{label}", f"_n_{label}", MEAN_DIGITS)
        out[f"std_{label}"] = F.when(s["n"] > 1, F.sqrt(s["m2"] / (s["n"] - 1)))
        out[f"min_{label}"], out[f"max_{label}"] = s["low"], s["high"]
    return t.withColumns(out).select(*df.columns, *out)


def _one_width(t: DataFrame, keys: list[str], value: str, width: int, spans: dict[str, int]) -> DataFrame:
    """``t`` with the merged state ``_f_<label>`` of each window of ``spans`` (in blocks of ``width``)."""
    t = t.withColumn("_bk", F.floor(F.col("_us") / F.lit(width)).cast("long"))
    group = Window.partitionBy(*keys, "_bk")
    up = group.orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # from the last row backwards, so that the frame grows row by row
    down = group.orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumns({"_head": _state(value, up), "_tail": _state(value, down)})

    # a row's tail is what the block has from that row on: the first shifted row after t holds the part
    # of the window that lies in the block W earlier
    plain = t.select(*t.columns, F.lit(None).cast("string").alias("_of"))
    rows = plain
    for label, blocks in spans.items():
        shifted = t.where("_us is not null").select(
            *keys, (F.col("_us") + blocks * width).alias("_us"), (F.col("_bk") + blocks).alias("_bk"), "_tail",
            F.lit(label).alias("_of"))
        rows = rows.unionByName(shifted, allowMissingColumns=True)
    after = group.orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        f"_e_{label}": F.last(F.when(F.col("_of") == label, F.col("_tail")), ignorenulls=True).over(after)
        for label in spans}).where("_of is null").drop("_of", "_tail")

    # whole blocks between: one row a block, at most W / width of them in a list
    wide = {label: blocks for label, blocks in spans.items() if blocks > 1}
    if wide:
        table = small_side(t.groupBy(*keys, "_bk").agg(_state(value).alias("_s")))
        along = Window.partitionBy(*keys).orderBy("_bk")
        none = F.lit(None).cast(table.schema["_s"].dataType)
        table = table.withColumns({
            f"_w_{label}": F.aggregate(F.collect_list("_s").over(along.rangeBetween(1 - blocks, -1)), none, merge)
            for label, blocks in wide.items()}).drop("_s")
        named = table.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bk").alias("_kb"),
                             *[f"_w_{label}" for label in wide])
        same = F.col("_bk") == F.col("_kb")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        rows = attach(rows, named, same, "left").drop("_kb", *[f"_k{i}" for i in range(len(keys))])
    none = F.lit(None).cast(t.schema["_head"].dataType)
    for label in spans:
        parts = [f"_e_{label}", *([f"_w_{label}"] if label in wide else []), "_head"]
        rows = rows.withColumn(f"_f_{label}", F.aggregate(F.array(*parts), none, merge))
    return rows.drop("_bk", "_head", *[f"_e_{x}" for x in spans], *[f"_w_{x}" for x in wide])
