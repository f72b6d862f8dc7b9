"""Trailing windows from block summaries against a plain loop over all pairs."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ampere.operators.rolling import block_hours, rolling_stats

START = datetime(2024, 3, 1)


def _plain(rows, hours):
    out = []
    for k, t, v, i in rows:
        if t is None:
            out.append((i, None, None, None, None))
            continue
        x = [w for a, b, w, _ in rows if a == k and b is not None and w is not None
             and t - timedelta(hours=hours) < b <= t]
        n = len(x)
        mean = math.fsum(x) / n if n else None
        std = math.sqrt(math.fsum((w - mean) ** 2 for w in x) / (n - 1)) if n > 1 else None
        out.append((i, mean, std, min(x, default=None), max(x, default=None)))
    return out


def _same(got, want):
    for g, w in zip(got, want, strict=True):
        if w is None or g is None:
            assert g is None and w is None
        else:
            assert g == pytest.approx(w, rel=1e-9, abs=1e-6)


def test_block_hours():
    assert [block_hours(h) for h in (1, 6, 24, 25, 29, 168, 720)] == [1, 6, 24, 5, 1, 24, 24]


@pytest.mark.parametrize("most", [24, 5])
def test_equals_plain_windows(spark, most):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        k = rnd.choice(["A", "A", "B", None])
        t = START + timedelta(minutes=30 * rnd.randrange(1200)) if rnd.random() > 0.02 else None
        if rnd.random() < 0.2:                     # far away, before the epoch too
            t = datetime(1969, 12, 30) + timedelta(hours=rnd.randrange(60))
        rows.append((k, t, None if rnd.random() < 0.1 else round(1e6 + 50 * rnd.random(), 2), i))
    rows += [("C", START, 5.0, 400), ("C", START, 7.0, 401), ("D", START, None, 402)]      # ties, a null alone
    windows = {"6h": 6, "24h": 24, "25h": 25, "7d": 168}
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double, n int")
    got = {r["n"]: r for r in rolling_stats(df, ["k"], "t", "v", windows, most).collect()}
    assert len(got) == len(rows)
    for label, hours in windows.items():
        for i, *want in _plain(rows, hours):
            _same([got[i][f"{s}_{label}"] for s in ("mean", "std", "min", "max")], want)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "k string, t timestamp_ntz, v double")
    assert rolling_stats(empty, ["k"], "t", "v", {"6h": 6, "7d": 168}).collect() == []
    twice = spark.createDataFrame([("A", START, 2.0)] * 3, "k string, t timestamp_ntz, v double")
    got = rolling_stats(twice, ["k"], "t", "v", {"7d": 168}).collect()
    assert [(r.mean_7d, r.std_7d) for r in got] == [(2.0, 0.0)] * 3


def test_no_window_by_key_alone_over_rows(spark):
    """Every window over rows is partitioned by the block too; only the block table is ordered by key."""
    df = spark.range(1000).select(F.lit("A").alias("k"), F.timestamp_seconds(F.col("id") * 3600).cast(
        "timestamp_ntz").alias("t"), F.col("id").cast("double").alias("v"))
    plan = rolling_stats(df, ["k"], "t", "v", {"24h": 24, "30d": 720})._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "Window [" in x]
    assert lines and all("_bk" in x.rpartition("], [")[0].rpartition("], [")[2] or "collect_list" in x for x in lines)
