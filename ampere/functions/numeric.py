from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """numpy-style rounding: scale, round half to even, unscale.

    ``F.round`` rounds half up and ``F.bround`` rounds the decimal value;
    pandas ``round`` (and DuckDB ``round_even(x*10^d, 0)/10^d``) do
    ``rint(x * 10^d) / 10^d`` on the binary double, which this mirrors.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def round_all(df: DataFrame, digits: int = 2, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every fractional column (integers are left alone, as in pandas)."""
    cols = {
        f.name: round_half_even(F.col(f.name), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, _FRACTIONAL) and f.name not in skip
    }
    return df.withColumns(cols) if cols else df


# Exact, order-independent means and sums -----------------------------------
#
# A double sum depends on the order rows arrive in, and a mean of 2-decimal
# loads often lands exactly on a rounding midpoint (49.90 and 49.91 average
# to 49.905), so the half-even result would depend on the partitioning.
# Values are summed as DECIMAL(28,8) (exact, order independent) and the
# quotient sum / n is rounded half-even with integer arithmetic.

EXACT_DEC = "decimal(28,8)"


def exact_sum(c: Column | str) -> Column:
    """Aggregate: exact decimal sum of a double column.  ``EXACT_DEC`` bounds it: values are taken at
    8 decimals, and one of 1e20 or more is an error under ANSI (loads end at 1e6)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(EXACT_DEC))


def half_even_quotient(sum_col: str, n_col: str | None, digits: int = 2) -> Column:
    """sum / n rounded half to even at ``digits`` places (0..12), exactly,
    as a double.  ``sum_col`` is an exact decimal sum (see ``exact_sum``),
    ``n_col`` a count (None: plain rounding of the sum).  Null when the sum
    is null or n is 0.  |sum / n| must stay below 9.2e18 / 10^digits."""
    up, down = 10 ** max(0, digits - 8), 10 ** max(0, 8 - digits)
    num = f"CAST(abs(CAST(`{sum_col}` AS DECIMAL(38,8))) * {10 ** 8 * up} AS DECIMAL(38,0))"
    nn = f"CAST(`{n_col}` AS DECIMAL(38,0))" if n_col else "CAST(1 AS DECIMAL(38,0))"
    den = f"({nn} * {down})"
    q = F.expr(f"{num} div {den}")
    rem = F.expr(f"{num} - ({num} div {den}) * {den}")
    den_c = F.expr(den)
    units = q + F.when(rem * 2 > den_c, F.lit(1)).when(rem * 2 == den_c, q % 2).otherwise(F.lit(0))
    ok = F.col(sum_col).isNotNull() & (F.expr(nn) != 0)
    return F.when(ok, F.signum(F.col(sum_col)) * units / F.lit(float(10 ** digits)))


MEAN_DIGITS = 10


def exact_mean_aggs(c: Column | str, name: str) -> list[Column]:
    """Aggregates for ``finish_mean``: exact decimal sum and count of ``c``."""
    c = F.col(c) if isinstance(c, str) else c
    return [exact_sum(c).alias(f"_s_{name}"), F.count(c).alias(f"_n_{name}")]


def finish_mean(df, name: str, digits: int = MEAN_DIGITS, keep: bool = False):
    """Add ``name`` = exact mean rounded half-even at ``digits`` (default
    10 places: a double identical on every engine and partitioning)."""
    out = df.withColumn(name, half_even_quotient(f"_s_{name}", f"_n_{name}", digits))
    return out if keep else out.drop(f"_s_{name}", f"_n_{name}")
