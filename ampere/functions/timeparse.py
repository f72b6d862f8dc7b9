"""Timestamp landing helpers: mixed-format parsing (B11), local wall time
to UTC with DST rules (B12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ampere.functions import timetext
from ampere.functions.zones import to_utc

# Fixed values of the reference's numeric-timestamp heuristic.
EXCEL_MIN, EXCEL_MAX = 30000.0, 60000.0      # median in (30000, 60000): Excel serial days
MS_ABOVE = 1e11                              # median above: epoch milliseconds
S_ABOVE = 1e9                                # median above: epoch seconds
EXCEL_EPOCH = "1899-12-30 00:00:00"


def parse_mixed_timestamp(df: DataFrame, col: str) -> Column:
    """Text timestamps of any form (``timetext``; aware ones in UTC); if NO
    value of the whole column parses as text, read it as numbers whose unit is
    decided by the column median.

    How the column's values parse is counted first (one row a form to the
    driver); only a column without any text time has its exact median computed,
    on the cluster, as a scalar subquery.
    """
    from ampere.operators.quantile import exact_quantiles
    kind = df.schema[col].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.col(f"`{col}`").cast("timestamp_ntz")
    found = timetext.choose(df, col)
    if found["parsed"]:
        return utc_text(F.col(f"`{col}`"), found["day_first"])
    col = f"`{col}`"
    num = F.col(col).try_cast("double")
    finite = F.when(~F.isnan(num) & (F.abs(num) != F.lit(float("inf"))), num)
    med = exact_quantiles(df.select(finite.alias("_x")), [], "_x", [0.5], ["_m"]).select("_m").scalar()
    micros = F.round(num * F.lit(1e6)).cast("long")
    excel = F.timestamp_micros(F.round(num * F.lit(86400e6)).cast("long")
                               + F.unix_micros(F.lit(EXCEL_EPOCH).cast("timestamp")))
    numeric = (F.when((med > EXCEL_MIN) & (med < EXCEL_MAX), excel)
               .when(med > MS_ABOVE, F.timestamp_micros(F.round(num * F.lit(1e3)).cast("long")))
               .when(med > S_ABOVE, F.timestamp_micros(micros)))
    return numeric.cast("timestamp_ntz")


def utc_text(c: Column, day_first: bool = False) -> Column:
    """The UTC time of a text: its offset taken off, a naive time as it is."""
    shift = F.make_dt_interval(secs=F.coalesce(timetext.offset_seconds(c), F.lit(0)).cast("decimal(18,6)"))
    return timetext.wall_time(c, day_first) - shift


def market_time_to_utc(df: DataFrame, col: str, tz: str) -> Column:
    """B12 on a landed column: an aware time (a TIMESTAMP, or text that carries
    an offset) keeps its instant; a naive one is wall time in ``tz``.  Text may
    have any form of ``timetext``; the order of figures is the column's."""
    c = F.col(f"`{col}`")
    kind = df.schema[col].dataType.typeName()
    if kind == "timestamp":
        return c.cast("timestamp_ntz")
    if kind in ("timestamp_ntz", "date"):
        return local_to_utc(c.cast("timestamp_ntz"), tz)
    day_first = timetext.choose(df, col)["day_first"]
    return F.when(timetext.offset_seconds(c).isNotNull(), utc_text(c, day_first)).otherwise(
        local_to_utc(timetext.wall_time(c, day_first), tz))


def local_to_utc(c: Column | str, tz: str) -> Column:
    """Naive local wall time in ``tz`` -> naive UTC, by the zone's transitions.

    * non-existent times (a gap of any length) move to the first valid instant;
    * ambiguous times (an overlap of any length) become null.
    """
    return to_utc(F.col(c) if isinstance(c, str) else c, tz)
