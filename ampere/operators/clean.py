"""Projection, coercion and cleaning operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Candidate column names, in the reference's order of preference.
GRID_TS_CANDIDATES = ["timestamp", "Time", "Interval End", "Interval Start", "time", "time_utc"]
GRID_LOAD_CANDIDATES = ["load", "Load", "value", "MW", "MWh"]
SANITIZE_TS_NAMES = {"timestamp", "time", "time_utc", "datetime", "begin", "interval", "x"}
SANITIZE_LOAD_NAMES = ["load", "value", "mw", "mwh", "y"]

# Cleaning bounds.
LOAD_MIN_EXCLUSIVE = 0.0
LOAD_MAX_EXCLUSIVE = 1_000_000.0
WEATHER_BOUNDS = {"temperature": (-50.0, 60.0), "humidity": (0.0, 100.0),
                  "wind_speed": (0.0, 200.0)}


def resolve_columns(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """B1: for each canonical name, rename the first present candidate.

    Decided from the schema alone (driver side, no data touched).
    Raises ``KeyError`` when no candidate is present.
    """
    present = set(df.columns)
    out = df
    for canonical, candidates in targets.items():
        hit = next((c for c in candidates if c in present), None)
        if hit is None:
            raise KeyError(f"none of {list(candidates)} in {df.columns}")
        if hit != canonical:
            out = out.withColumnRenamed(hit, canonical)
    return out


def try_timestamp(c: Column | str) -> Column:
    """Lenient text -> TIMESTAMP_NTZ; junk gives null (pandas coerce).
    A bare number is not a date (Spark would read "45293" as a year)."""
    c = F.col(c) if isinstance(c, str) else c
    txt = c.cast("string")
    numeric = txt.rlike(r"^\s*[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$")
    return F.when(~numeric, F.coalesce(
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(txt),
    )).cast("timestamp_ntz")


def coerce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """B2: cast with null on failure (``timestamp`` uses lenient parsing)."""
    cols = {}
    for name, t in types.items():
        if t in ("timestamp", "timestamp_ntz"):
            cols[name] = try_timestamp(name)
        else:
            cols[name] = F.col(name).try_cast(t)
    return df.withColumns(cols)


def clean_grid(df: DataFrame) -> DataFrame:
    """Iso present and non-empty, ts and load present, 0 < load < 1e6."""
    return df.where(
        F.col("iso_code").isNotNull() & (F.col("iso_code") != "")
        & F.col("timestamp_utc").isNotNull() & F.col("load_mw").isNotNull()
        & (F.col("load_mw") > LOAD_MIN_EXCLUSIVE) & (F.col("load_mw") < LOAD_MAX_EXCLUSIVE))


def clean_weather(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = WEATHER_BOUNDS) -> DataFrame:
    """Ts present; each bounded column null or inside its closed range."""
    cond = F.col("timestamp_utc").isNotNull()
    for c, (lo, hi) in bounds.items():
        cond = cond & (F.col(c).isNull() | F.col(c).between(lo, hi))
    return df.where(cond)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                keep: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order`` (explicit read order).

    A grouped ``min_by`` on a struct: partial aggregation on the map side
    drops most duplicates before the shuffle (vs. a full window sort).
    """
    rank = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in keep]), rank).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in keep])


def dedup_grid(df: DataFrame, order: Sequence[str] = ("seq", "id")) -> DataFrame:
    return dedup_first(df, ["iso_code", "timestamp_utc"], list(order), ["load_mw"])


def silver_grid(bronze: DataFrame) -> DataFrame:
    """bronze (iso_code, timestamp/load text, seq, id) -> silver grid_clean."""
    r = resolve_columns(bronze, {"timestamp_utc": GRID_TS_CANDIDATES,
                                 "load_mw": GRID_LOAD_CANDIDATES})
    c = coerce_types(r, {"timestamp_utc": "timestamp", "load_mw": "double"})
    return dedup_grid(clean_grid(c)).select("iso_code", "timestamp_utc", "load_mw")


def silver_weather(bronze: DataFrame) -> DataFrame:
    c = coerce_types(bronze.withColumnRenamed("timestamp", "timestamp_utc"),
                     {"timestamp_utc": "timestamp", "temperature": "double",
                      "wind_speed": "double", "humidity": "double"})
    return clean_weather(c).select("iso_code", "timestamp_utc", "temperature",
                                   "wind_speed", "humidity")


def dedup_weather_recent(df: DataFrame, as_of: Column, hours: int = 48,
                         order: Sequence[str] = ("station",)) -> DataFrame:
    """Last ``hours`` before ``as_of``; one row per (iso, ts) across
    stations, first station in ``order``."""
    recent = df.where(F.col("timestamp_utc") >= as_of - F.make_dt_interval(hours=F.lit(hours)))
    keep = [c for c in df.columns if c not in ("iso_code", "timestamp_utc")]
    return dedup_first(recent, ["iso_code", "timestamp_utc"], list(order), keep)


def quality_counters(raw: DataFrame, clean: DataFrame, feed: str) -> DataFrame:
    """Rows read / cleaned / dropped and the kept percentage (one row).

    Both inputs are tagged, unioned and counted in one global aggregate."""
    tagged = raw.select(F.lit(True).alias("_raw")).unionByName(
        clean.select(F.lit(False).alias("_raw")))
    j = tagged.agg(F.count_if(F.col("_raw")).alias("rows_read"),
                   F.count_if(~F.col("_raw")).alias("rows_cleaned"))
    return j.select(
        F.lit(feed).alias("feed"), "rows_read", "rows_cleaned",
        (F.col("rows_read") - F.col("rows_cleaned")).alias("rows_dropped"),
        F.try_divide(F.col("rows_cleaned") * 100.0, F.col("rows_read")).alias("quality_pct"))


def sanitize_timestamps(df: DataFrame) -> DataFrame:
    """Timestamp-named columns (or, if none, every timestamp-typed
    column) -> UTC text ``yyyy-MM-dd HH:mm:ss`` (junk -> null)."""
    names = [c for c in df.columns if c.lower() in SANITIZE_TS_NAMES]
    if not names:
        names = [f.name for f in df.schema.fields
                 if f.dataType.typeName() in ("timestamp", "timestamp_ntz")]
    return df.withColumns({c: F.date_format(try_timestamp(c), "yyyy-MM-dd HH:mm:ss") for c in names})


def sanitize_load(df: DataFrame) -> DataFrame:
    """The first of load/value/mw/mwh/y (case-insensitive) becomes the
    numeric ``load`` column; an existing ``load`` is just coerced."""
    hits = [c for c in df.columns if c.lower() in SANITIZE_LOAD_NAMES]
    if not hits:
        return df
    first = hits[0]
    if first != "load" and "load" not in df.columns:
        df = df.withColumnRenamed(first, "load")
    return df.withColumn("load", F.col("load").try_cast("double"))


def drop_missing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B13."""
    return df.dropna(subset=list(cols))


def require_weather(df: DataFrame, min_rows: int = 100) -> DataFrame:
    """Rows with all three weather values.  The row-count guard is an
    action, so it is a separate call (``assert_min_rows``)."""
    return df.where(F.col("temperature").isNotNull() & F.col("wind_speed").isNotNull()
                    & F.col("humidity").isNotNull())


def assert_min_rows(df: DataFrame, n: int) -> int:
    cnt = df.count()
    if cnt < n:
        raise ValueError(f"only {cnt} rows, need at least {n}")
    return cnt


def min_history_gate(df: DataFrame, n: int, key: str = "iso_code") -> DataFrame:
    """Keep keys with at least ``n`` rows (count per key, semi join)."""
    from ampere.operators.attach import attach
    ok = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n)
    return attach(df, ok.select("_k"), F.col(key) == F.col("_k"), "left_semi")
