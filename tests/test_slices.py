"""Row order inside hot buckets: equal to lag and brute force, and no task holds a hot bucket."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from ampere.operators import join, ordered

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def burst(spark):
    """One key with 3,000 rows in one hour (ties in time among them), others with a few."""
    rng = random.Random(5)
    rows = [("hot", T0 + timedelta(seconds=rng.randrange(900)), k, float(k * 7 % 101)) for k in range(3000)]
    rows += [(f"k{k % 4}", T0 + timedelta(minutes=37 * k), k, float(k)) for k in range(200)]
    rows += [("hot", T0 + timedelta(hours=k), 5000 + k, 1.0) for k in range(-3, 9)]
    return spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, id int, load_mw double").repartition(5)


@pytest.mark.parametrize("split_rows", [50, 700, 10 ** 6])
def test_previous_row_equals_lag(burst, split_rows):
    w = Window.partitionBy("iso_code").orderBy("timestamp_utc", "id")
    want = {(r.iso_code, r.id): (r.a, r.b) for r in burst.withColumns(
        {"a": F.lag("load_mw").over(w), "b": F.lag("id").over(w)}).collect()}
    got = ordered.previous_row(burst, "iso_code", "timestamp_utc", ["load_mw", "id"], ["id"], split_rows=split_rows).collect()
    assert len(got) == len(want)
    assert {(r.iso_code, r.id): (r.prev_load_mw, r.prev_id) for r in got} == want


def test_hot_bucket_is_spread(burst):
    b = burst.withColumn("_bk", ordered.time_bucket("timestamp_utc", 3600))
    cut, table = ordered.slices(b, ["iso_code", "_bk"], ["timestamp_utc", "id"], {}, split_rows=100)
    sizes = [r["count"] for r in cut.groupBy("iso_code", "_bk", "_sub").count().collect()]
    assert sum(sizes) == burst.count() and max(sizes) < 250
    assert sorted(r._n for r in table.collect()) == sorted(sizes)
    # without ties nothing can tell rows of one instant apart: they share a slice
    cut, _ = ordered.slices(b, ["iso_code", "_bk"], ["timestamp_utc"], {}, split_rows=100)
    assert cut.groupBy("iso_code", "timestamp_utc").agg(F.count_distinct("_sub").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("split_rows", [40, 10 ** 6])
def test_asof_in_hot_buckets_equals_brute_force(spark, burst, split_rows):
    rng = random.Random(6)
    right = [(rng.choice(["hot", "k0", "k1"]), T0 + timedelta(seconds=rng.randrange(-7200, 14400)), float(k)) for k in range(400)]
    r = spark.createDataFrame(right, "iso_code string, timestamp_utc timestamp_ntz, temperature double")
    got = join.asof_nearest(burst, r, tolerance_seconds=1800, split_rows=split_rows).collect()
    left = burst.collect()
    assert len(got) == len(left)
    found = {(x.iso_code, x.id): x.temperature for x in got}
    for x in left:
        near = sorted((abs((t - x.timestamp_utc).total_seconds()), t, v) for k, t, v in right if k == x.iso_code)
        want = near[0][2] if near and near[0][0] <= 1800 else None
        assert found[x.iso_code, x.id] == want


def test_asof_frames_end_before_or_at_the_row(spark, burst, monkeypatch):
    """A frame up to the end is computed anew for every row: quadratic in a bucket and in a key's slices."""
    plans, written = [], join.small_side

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    def seen(df):
        plans.append(plan(df))
        return written(df)
    monkeypatch.setattr(join, "small_side", seen)
    right = burst.select("iso_code", "timestamp_utc", F.col("load_mw").alias("temperature"))
    plans.append(plan(join.asof_nearest(burst, right, split_rows=100)))
    assert len(plans) == 2 and all("unboundedpreceding" in p for p in plans)
    assert not any("unboundedfollowing" in p for p in plans)


def test_asof_over_many_empty_slices_equals_brute_force(spark):
    """Readings several slices away, before and after, some slices without any."""
    left = [("a", T0 + timedelta(minutes=20 * k), k) for k in range(300)]
    right = [("a", T0 + timedelta(minutes=20 * k, seconds=7 * k % 61), float(k)) for k in range(0, 300, 9)]
    right.append(("b", T0, -1.0))
    got = join.asof_nearest(spark.createDataFrame(left, "iso_code string, timestamp_utc timestamp_ntz, id int"),
                            spark.createDataFrame(right, "iso_code string, timestamp_utc timestamp_ntz, t double"),
                            tolerance_seconds=4800).collect()
    found = {r.id: r.t for r in got}
    assert len(got) == len(found) == 300
    for _, at, k in left:
        near = sorted((abs((t - at).total_seconds()), t, v) for key, t, v in right if key == "a")
        assert found[k] == (near[0][2] if near[0][0] <= 4800 else None)


def test_asof_keeps_rows_without_key_or_time(spark):
    left = spark.createDataFrame([(None, T0, 1), ("a", None, 2), ("a", T0, 3)], "iso_code string, timestamp_utc timestamp_ntz, id int")
    right = spark.createDataFrame([("a", T0, 1.0), (None, T0, 2.0), ("a", None, 3.0)],
                                  "iso_code string, timestamp_utc timestamp_ntz, t double")
    assert {r.id: r.t for r in join.asof_nearest(left, right, split_rows=1).collect()} == {1: None, 2: None, 3: 1.0}


@pytest.mark.parametrize("bucket_steps", [1, 3, 4096])
def test_islands_over_bucket_edges(spark, bucket_steps):
    rng = random.Random(7)
    flags = {key: [rng.random() < 0.7 for _ in range(200)] for key in "ab"}
    rows = [(k, T0 + timedelta(minutes=5 * i), f) for k, fs in flags.items() for i, f in enumerate(fs)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, flag boolean").repartition(4)
    want = set()
    for k, fs in flags.items():
        i = 0
        while i < 200:
            j = i
            while j < 200 and fs[j]:
                j += 1
            if j > i:
                want.add((k, T0 + timedelta(minutes=5 * i), T0 + timedelta(minutes=5 * j), j - i))
            i = max(j, i + 1)
    got = ordered.islands(df, "k", "ts", "flag", 300, bucket_steps=bucket_steps).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
