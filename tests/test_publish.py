"""Latest snapshots swapped whole, compaction of stream batches, the forest without the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampere.operators import forest
from ampere.session import new_path
from ampere.sources import files as fl
from ampere.sources import sinks as sk
from ampere.streaming import incremental as inc


def test_readers_see_the_old_snapshot_whole(spark):
    path = new_path(spark, "latest")
    assert sk.read_latest(spark, path) is None
    sk.write_latest(spark.range(10), path)
    reader = sk.read_latest(spark, path)
    # a write that ends in the middle: files are there, the marker is not
    spark.range(5).write.parquet(f"{path}/version=00000002")
    assert sk.read_latest(spark, path).count() == 10
    sk.write_latest(spark.range(20), path)
    assert reader.count() == 10 and sk.read_latest(spark, path).count() == 20
    for n in (30, 40):
        sk.write_latest(spark.range(n), path)
    assert sk.read_latest(spark, path).count() == 40 and len(sk.published(spark, path)) == 2
    with pytest.raises(FileExistsError):
        fl.write_once(spark, f"{path}/_published-00000005", "x")


def total(df):
    return df.groupBy("k").agg(F.sum("v").alias("v"))


def test_compaction_bounds_what_a_read_opens(spark):
    out = new_path(spark, "log")
    want, opened = 0, []
    for n in range(12):
        total(spark.range(20).selectExpr("id % 3 as k", f"id + {n} as v")).write.parquet(f"{out}/batch={n}")
        want += sum(range(20)) + 20 * n
        inc.compact(spark, out, total, least=3)
        folder, batches = inc.live_folders(spark, out)
        opened.append(len(batches) + (folder is not None))
        assert inc.read_batches(spark, out).agg(F.sum("v")).first()[0] == want
    assert max(opened) <= 5
    assert len([c for c in fl.children(spark, out) if c.startswith("batch=")]) < 8


def test_compaction_killed_in_the_middle(spark, monkeypatch):
    out = new_path(spark, "log")
    for n in range(4):
        total(spark.range(9).selectExpr("id % 3 as k", "id as v")).write.parquet(f"{out}/batch={n}")
    def killed(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(fl, "write_once", killed)
        with pytest.raises(KeyboardInterrupt):
            inc.compact(spark, out, total)
    assert inc.live_folders(spark, out) == (None, [0, 1, 2, 3])
    assert inc.read_batches(spark, out).agg(F.sum("v")).first()[0] == 144
    assert inc.compact(spark, out, total) and inc.live_folders(spark, out)[1] == [3]
    assert inc.read_batches(spark, out).agg(F.sum("v")).first()[0] == 144
    # the newest batch is written again by a restart
    total(spark.range(9).selectExpr("id % 3 as k", "id as v")).write.mode("overwrite").parquet(f"{out}/batch=3")
    assert inc.read_batches(spark, out).agg(F.sum("v")).first()[0] == 144


def test_first_rows_survive_compaction(spark):
    out = new_path(spark, "dedup")
    df = spark.range(200).selectExpr("concat('i', id % 2) as iso_code", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 7) as timestamp_utc",
                                     "cast(id as double) as load_mw", "cast(id % 5 as int) as seq", "id")
    for n in range(5):
        inc.first_rows(df.where(f"id % 5 = {(3 * n) % 5}")).write.parquet(f"{out}/batch={n}")
    want = sorted(map(tuple, inc.first_rows(df).collect()))
    for _ in range(2):
        assert sorted(map(tuple, inc.first_rows(inc.read_batches(spark, out)).collect())) == want
        inc.compact(spark, out, inc.first_rows)


def test_forest_of_many_keys_stays_off_the_driver(spark, monkeypatch):
    df = spark.range(4000).selectExpr("concat('k', id % 400) as iso_code", "id as timestamp_utc", "cast(id * 7919 % 1000 as double) as load_mw")
    one = {(r.iso_code, r.timestamp_utc): r.anomaly_score
           for r in forest.isolation_scores(df, ["load_mw"], n_trees=10).collect()}
    monkeypatch.setattr(forest, "GROUP_ROWS", 3)
    q = forest.isolation_scores(df.repartition(7), ["load_mw"], n_trees=10)
    assert "FlatMapCoGroups" in q._jdf.queryExecution().executedPlan().toString()
    two = {(r.iso_code, r.timestamp_utc): r.anomaly_score for r in q.collect()}
    assert one == two and len(one) == 4000 and all(0 < s <= 1 for s in one.values())


def test_forest_rows_without_a_key(spark):
    df = spark.range(60).selectExpr("if(id < 50, 'a', null) as iso_code", "id as timestamp_utc", "cast(id as double) as load_mw")
    got = forest.isolation_scores(df, ["load_mw"], n_trees=5).collect()
    assert len(got) == 60 and sum(np.isnan(r.anomaly_score) for r in got) == 10
