"""Multi-method load anomaly detection (K3-K9, K13, E5, E6, D13/D14 input).

Per-ISO statistics (mean / std) and the (ISO, hour, weekday) profile are
grouped aggregates joined back by key (the planner broadcasts them by
size).  The previous-row change uses the bucketed window of
``ordered.previous_row`` so a hot ISO is split over time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ampere.functions.numeric import exact_mean_aggs, finish_mean
from ampere.functions.timecols import time_features
from ampere.operators.clean import min_history_gate  # noqa: F401  (re-exported)
from ampere.operators.ordered import top_k_per_key, with_change
from ampere.operators.attach import attach, small_side

# Fixed values of the reference detector.
Z_THRESHOLD = 3.0
RAPID_PCT = 20.0
PATTERN_K = 2.0
MIN_ROWS = 50
VOTES_NEEDED = 2
MAX_SEVERITY = 5


def key_stats(df: DataFrame, key: str = "iso_code", min_rows: int | None = None) -> DataFrame:
    """Per key: rows, exact mean and sample std of load; keys with fewer
    than ``min_rows`` rows dropped (the B15 gate and the K3 statistics in
    one pass)."""
    st = finish_mean(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *exact_mean_aggs("load_mw", "_mean"),
                                         F.stddev_samp("load_mw").alias("_std")), "_mean")
    return st.where(F.col("_n") >= min_rows) if min_rows else st


def zscore_flags(df: DataFrame, threshold: float = Z_THRESHOLD, key: str = "iso_code",
                 stats_attached: bool = False) -> DataFrame:
    """K3: z = |x - mean| / sample std per key; flag z > threshold.

    A constant series (std 0) or a single row gives null z, never a flag.
    With ``stats_attached`` the ``_mean`` / ``_std`` columns of
    ``key_stats`` are already on the rows."""
    j = df if stats_attached else attach(df, key_stats(df, key).select(key, "_mean", "_std"), key)
    z = F.abs(F.try_divide(F.col("load_mw") - F.col("_mean"), F.col("_std")))
    return j.withColumn("z_score", z) \
            .withColumn("is_statistical_outlier", F.coalesce(F.col("z_score") > threshold, F.lit(False))) \
            .drop("_mean", "_std")


def rapid_change_flags(df: DataFrame, pct: float = RAPID_PCT) -> DataFrame:
    """K4: |load_change_pct| > pct (the first row of a key never flags)."""
    return df.withColumn("is_rapid_change",
                         F.coalesce(F.abs(F.col("load_change_pct")) > pct, F.lit(False)))


def pattern_flags(df: DataFrame, k: float = PATTERN_K, key: str = "iso_code") -> DataFrame:
    """K5 (with C3): deviation from the (key, hour, weekday) profile mean
    beyond k sample standard deviations."""
    prof = df.groupBy(key, "hour_of_day", "day_of_week").agg(
        *exact_mean_aggs("load_mw", "expected_load"), F.stddev_samp("load_mw").alias("expected_std"))
    j = attach(df, finish_mean(prof, "expected_load"), [key, "hour_of_day", "day_of_week"], "left")
    dev = F.abs(F.col("load_mw") - F.col("expected_load"))
    return j.withColumn("deviation_from_expected", dev) \
            .withColumn("is_pattern_anomaly",
                        F.coalesce(dev > k * F.col("expected_std"), F.lit(False)))


def vote_and_classify(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """K7: count of method flags; anomaly at >= 2 votes; severity
    min(count, 5); type priority rapid > statistical > pattern > general."""
    flags = flags or ["is_statistical_outlier", "is_isolation_anomaly",
                      "is_rapid_change", "is_pattern_anomaly"]
    count = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    d = df.withColumn("anomaly_count", count)
    d = d.withColumns({"is_anomaly": F.col("anomaly_count") >= VOTES_NEEDED,
                       "severity": F.least(F.col("anomaly_count"), F.lit(MAX_SEVERITY))})
    typ = (F.when(~F.col("is_anomaly"), F.lit(None).cast("string"))
           .when(F.col("is_rapid_change"), "rapid_change")
           .when(F.col("is_statistical_outlier"), "statistical_outlier")
           .when(F.col("is_pattern_anomaly"), "pattern_deviation")
           .otherwise("general_anomaly"))
    return d.withColumn("anomaly_type", typ)


def score_rows(df: DataFrame, min_rows: int = MIN_ROWS, use_forest: bool = True,
               bucket_seconds: int = 3600, forest_kwargs: dict | None = None) -> DataFrame:
    """All rows of keys with enough history, with every method's flag.

    One per-key pass gives both the history gate and the z-score
    statistics; the inner join of that small table gates the rows."""
    st = small_side(key_stats(df, min_rows=min_rows).select("iso_code", "_n", "_mean", "_std"))
    g = df.join(st.select("iso_code", "_mean", "_std"), "iso_code")
    gf = time_features(g)
    t = with_change(gf, bucket_seconds=bucket_seconds)
    t = zscore_flags(t, stats_attached=True)
    t = rapid_change_flags(t)
    t = pattern_flags(t)
    if use_forest:
        from ampere.operators.forest import isolation_forest_flags
        # grown on the rows before the change window (same rows, no window
        # shuffle in the sampling pass), with the counts the gate already has
        kw = dict(forest_kwargs or {})
        kw.setdefault("fit_df", gf)
        kw.setdefault("counts", st.select("iso_code", "_n"))
        t = isolation_forest_flags(t, **kw)
    else:
        t = t.withColumn("is_isolation_anomaly", F.lit(False))
    return vote_and_classify(t)


OUTPUT_COLS = ["iso_code", "timestamp_utc", "load_mw", "temperature", "anomaly_type",
               "severity", "z_score", "load_change_pct", "deviation_from_expected",
               "expected_load"]


def detect_anomalies(df: DataFrame, as_of: Column | None = None, use_forest: bool = True,
                     min_rows: int = MIN_ROWS, forest_kwargs: dict | None = None) -> DataFrame:
    """K8: gate -> K3..K6 -> K7 -> anomalous rows, stamped ``detected_at``."""
    if "temperature" not in df.columns:
        df = df.withColumn("temperature", F.lit(None).cast("double"))
    scored = score_rows(df, min_rows=min_rows, use_forest=use_forest, forest_kwargs=forest_kwargs)
    if as_of is None:
        as_of = df.select(F.max("timestamp_utc")).scalar()
    return scored.where(F.col("is_anomaly")).select(*OUTPUT_COLS, as_of.alias("detected_at"))


def standardize(df: DataFrame, cols: list[str], key: str | None = "iso_code") -> DataFrame:
    """K9: fill nulls with the mean, then zero mean / unit population
    variance per key (a constant column maps to 0, as StandardScaler)."""
    if key:
        st = df.groupBy(key).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                 *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
        j = attach(df, st, key)
    else:  # global statistics, attached as scalar subqueries
        j = df.withColumns({f"_m_{c}": df.select(F.avg(c)).scalar() for c in cols}) \
              .withColumns({f"_s_{c}": df.select(F.stddev_pop(c)).scalar() for c in cols})
    out = {}
    for c in cols:
        filled = F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"))
        sd = F.col(f"_s_{c}")
        out[f"{c}_scaled"] = F.when(sd == 0, F.lit(0.0)).otherwise(F.try_divide(filled - F.col(f"_m_{c}"), sd))
    return j.withColumns(out).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def top_anomalies(anoms: DataFrame, k: int = 3) -> DataFrame:
    """E5: top k per ISO by severity, earliest first on ties."""
    return top_k_per_key(anoms, "iso_code", [F.col("severity").desc(), F.col("timestamp_utc").asc()], k)


def latest_critical(anoms: DataFrame, min_severity: int = 3) -> DataFrame:
    """Newest anomaly with severity >= 3 per ISO."""
    c = anoms.where(F.col("severity") >= min_severity)
    return top_k_per_key(c, "iso_code", [F.col("timestamp_utc").desc()], 1)


def alert_summary_lines(anoms: DataFrame) -> DataFrame:
    """The alert summary report (A12) as ordered text rows (iso_code,
    line_no, line): total, per ISO the count, counts per severity (highest
    first) and the newest critical anomaly.  Every part is a small grouped
    aggregate over the anomalies; no row is collected to the driver."""
    # The texts of the report's lines.
    total = anoms.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("").alias("iso_code"), F.lit(0).alias("line_no"),
        F.format_string("Total Anomalies: %d", "n").alias("line"))
    per = anoms.groupBy("iso_code").agg(F.count(F.lit(1)).alias("n"))
    head = per.select("iso_code", F.lit(1).alias("line_no"), F.format_string("%s:", "iso_code").alias("line")) \
        .unionByName(per.select("iso_code", F.lit(2).alias("line_no"),
                                F.format_string("  Anomalies: %d", "n").alias("line")))
    sev = anoms.groupBy("iso_code", "severity").agg(F.count(F.lit(1)).alias("n")).select(
        "iso_code", (F.lit(100) - F.col("severity")).alias("line_no"),
        F.format_string("    Severity %d: %d", "severity", "n").alias("line"))
    crit = latest_critical(anoms)
    crit_lines = crit.select("iso_code", F.explode(F.array(
        F.struct(F.lit(200).alias("line_no"), F.lit("  Most recent critical:").alias("line")),
        F.struct(F.lit(201).alias("line_no"),
                 F.format_string("    Time: %s", F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
                 .alias("line")),
        F.struct(F.lit(202).alias("line_no"), F.format_string("    Load: %.0f MW", "load_mw").alias("line")),
        F.struct(F.lit(203).alias("line_no"), F.format_string("    Type: %s", "anomaly_type").alias("line")),
    )).alias("x")).select("iso_code", "x.line_no", "x.line")
    return total.unionByName(head).unionByName(sev).unionByName(crit_lines)
