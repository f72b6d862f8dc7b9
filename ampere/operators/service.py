"""Service-metric rollups over a request log.

The reference's dashboard and alert expressions run on a metrics store;
here they are windowed aggregates over the request log itself.  Windows are
tumbling ``window(ts, ...)`` groups (hash aggregation, parallel over time);
series keys are endpoint / status.  Definitions are exact (no
extrapolation to window edges).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ampere.functions.numeric import exact_sum, half_even_quotient
from ampere.operators.ordered import islands, previous_row

# The default latency histogram buckets (seconds) of the
# metrics client library, plus +Inf.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def _win(ts: str, width: str):
    return F.window(ts, width).start.cast("timestamp_ntz")


def request_rate(log: DataFrame, width: str = "5 minutes", seconds: int = 300,
                 by: tuple[str, ...] = ("endpoint",)) -> DataFrame:
    """L1: per window and series, requests and per-second rate."""
    return log.groupBy(_win("ts", width).alias("window_start"), *by).agg(
        F.count(F.lit(1)).alias("requests")).withColumn(
        "rate_per_s", F.col("requests") / F.lit(float(seconds)))


def counter_increase(samples: DataFrame, series: str, ts: str, value: str,
                     width: str = "5 minutes", tie: tuple[str, ...] = ()) -> DataFrame:
    """L2: increase of a cumulative counter per window, reset aware.

    Each sample contributes cur - prev, or cur when the counter went down
    (a reset); the previous sample may sit in an earlier window.  The first
    sample of a series contributes nothing."""
    p = previous_row(samples, series, ts, [value], tie=tie)
    prev = F.col(f"prev_{value}")
    inc = (F.when(prev.isNull(), F.lit(0.0))
           .when(F.col(value) < prev, F.col(value))
           .otherwise(F.col(value) - prev))
    # exact decimal sum: the total does not depend on row order
    return p.groupBy(_win(ts, width).alias("window_start"), series).agg(
        exact_sum(inc).cast("double").alias("increase"), F.count(F.lit(1)).alias("samples"))


def latency_quantile(log: DataFrame, q: float = 0.95, width: str = "5 minutes",
                     buckets: list[float] = LATENCY_BUCKETS) -> DataFrame:
    """L3: quantile from a cumulative ``le`` histogram per window, linear
    interpolation inside the bucket; in the +Inf bucket the highest finite
    bound is returned.  Histogram counts are a grouped aggregate; the
    cumulative pass runs on the small (window x bucket) table."""
    bounds = F.array(*[F.lit(float(b)) for b in buckets])
    nb = len(buckets)
    # 1-based index of the first bound >= latency (nb + 1 = +Inf): a CASE
    # chain over the fixed bounds stays in generated code (no per-row lambda)
    idx = F.when(F.col("latency") <= F.lit(float(buckets[0])), F.lit(1))
    for i, b in enumerate(buckets[1:], start=2):
        idx = idx.when(F.col("latency") <= F.lit(float(b)), F.lit(i))
    idx = idx.otherwise(F.lit(nb + 1))
    h = log.groupBy(_win("ts", width).alias("window_start"), idx.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("window_start").orderBy("bucket")
    h = h.withColumns({
        "cum": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(Window.partitionBy("window_start")),
    })
    h = h.withColumn("rank", F.col("total") * F.lit(q))
    hit = h.where(F.col("cum") >= F.col("rank"))
    first = hit.groupBy("window_start").agg(F.min_by(F.struct("bucket", "n", "cum", "rank"), F.col("bucket")).alias("b"))
    b = first.select("window_start", "b.*")
    upper = F.element_at(bounds, F.least(F.col("bucket"), F.lit(nb)))
    lower = F.when(F.col("bucket") == 1, F.lit(0.0)).otherwise(
        F.element_at(bounds, F.greatest(F.col("bucket") - 1, F.lit(1))))
    interp = lower + (upper - lower) * (F.col("rank") - (F.col("cum") - F.col("n"))) / F.col("n")
    val = F.when(F.col("bucket") > nb, F.element_at(bounds, F.lit(nb))).otherwise(interp)
    return b.select("window_start", val.alias(f"p{int(q * 100)}_latency_s"))


def error_ratio(log: DataFrame, width: str = "5 minutes") -> DataFrame:
    """L4: 5xx share of requests per window (null without requests)."""
    return log.groupBy(_win("ts", width).alias("window_start")).agg(
        F.count_if(F.col("status") >= 500).alias("errors"),
        F.count(F.lit(1)).alias("requests")).withColumn(
        "error_ratio", F.try_divide(F.col("errors").cast("double"), F.col("requests").cast("double")))


def status_breakdown(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """Request count by status per window."""
    return log.groupBy(_win("ts", width).alias("window_start"), "status").agg(
        F.count(F.lit(1)).alias("requests"))


def threshold_alert(series: DataFrame, value: str, threshold: float, for_steps: int,
                    step_seconds: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Alert intervals where ``value > threshold`` held for at least
    ``for_steps`` consecutive steps (gaps and islands; a missing step
    breaks the run)."""
    flagged = series.withColumn("_on", F.coalesce(F.col(value) > threshold, F.lit(False)))
    if not keys:
        flagged = flagged.withColumn("_series", F.lit("all"))
        keys = ("_series",)
    runs = islands(flagged, list(keys), "window_start", "_on", step_seconds)
    out = runs.where(F.col("steps") >= for_steps)
    return out.drop("_series") if "_series" in keys else out


def mean_latency(log: DataFrame, width: str = "5 minutes", digits: int = 9) -> DataFrame:
    """Summed duration / request count per window (exact decimal sum,
    rounded half-even at ``digits`` places: independent of row order)."""
    a = log.groupBy(_win("ts", width).alias("window_start")).agg(
        exact_sum("latency").alias("_s"), F.count("latency").alias("_n"))
    return a.select("window_start", half_even_quotient("_s", "_n", digits).alias("mean_latency_s"))


def anomaly_gauge(anoms: DataFrame) -> DataFrame:
    """Current anomalies by ISO and severity; green < 1, yellow >= 1,
    red >= 5."""
    g = anoms.groupBy("iso_code", "severity").agg(F.count(F.lit(1)).alias("anomalies"))
    return g.withColumn("color", F.when(F.col("anomalies") >= 5, "red")
                        .when(F.col("anomalies") >= 1, "yellow").otherwise("green"))
