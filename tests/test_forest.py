"""Isolation forest: parts of the model, missing features, and workers that start in another folder."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ampere.operators import forest

REPO = Path(__file__).resolve().parent.parent


def _rows(spark, keys, rows):
    return spark.range(keys * rows).select(
        F.concat(F.lit("K"), F.col("id") % keys).alias("iso_code"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("timestamp_utc"),
        ((F.col("id") * 7919) % 1009 + F.when(F.col("id") % 97 == 0, 5000).otherwise(0)).cast("double").alias("load_mw"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"), (F.col("id") % 7).cast("int").alias("day_of_week"))


def _flags(df, **kw):
    f = forest.isolation_forest_flags(df, n_trees=6, max_samples=16, **kw)
    return {(r.iso_code, r.timestamp_utc): (r.is_isolation_anomaly, round(r.anomaly_score, 12)) for r in f.collect()}


def test_model_in_parts_scores_the_same(spark, monkeypatch):
    df = _rows(spark, 200, 8)
    whole = _flags(df)
    monkeypatch.setattr(forest, "GROUP_ROWS", 3)
    assert _flags(df) == whole and len(whole) == 1600
    assert _flags(df.repartition(5, "timestamp_utc")) == whole


def test_rows_are_thinned_before_they_meet_the_trees(spark):
    """A key of many rows: about 2 psi rows a tree are chosen, whatever its size."""
    df = _rows(spark, 1, 20_000)
    nodes = forest.fit_forest(df, ["load_mw", "hour_of_day", "day_of_week"], "iso_code", ["timestamp_utc"],
                              n_trees=20, max_samples=16)
    root = nodes.where("node = 0").collect()
    assert len(root) == 20 and all(r["size"] == 16 for r in root)


def test_missing_features_take_the_mean(spark):
    df = _rows(spark, 2, 60)
    holes = df.withColumn("load_mw", F.when(F.col("hour_of_day") != 3, F.col("load_mw")))
    mean = holes.groupBy("iso_code").agg(F.avg("load_mw").alias("m"))
    filled = holes.join(mean, "iso_code").withColumn("load_mw", F.coalesce("load_mw", "m")).drop("m")
    assert _flags(holes) == _flags(filled)


def test_scores_equal_a_walk_of_the_trees():
    """Row by row and tree by tree, missing and infinite values too."""
    rng = np.random.default_rng(3)
    features = ["a", "b"]
    parts = []
    for tree in range(7):
        x = pd.DataFrame(rng.normal(size=(20, 2)), columns=features).assign(_key="K", _tree=tree, _psi=20)
        parts.append(forest._builder(features, 1)(x))
    nodes = pd.concat(parts)
    at = {(r.tree, r.node): r for r in nodes.itertuples()}
    rows = rng.normal(size=(1100, 2))
    rows[3, 0], rows[4, 1], rows[5, 0] = np.nan, np.inf, -np.inf
    want = []
    for row in rows:
        lengths = []
        for tree in range(7):
            r = at[tree, 0]
            while r.feature >= 0:
                r = at[tree, r.left if row[r.feature] <= r.threshold else r.right]
            lengths.append(r.depth + float(forest.c_factor(r.size)))
        want.append(2.0 ** (-np.mean(lengths) / float(forest.c_factor(20))))
    f, = forest._forest_arrays(nodes).values()
    assert np.allclose(forest.tree_scores(rows, f), want, rtol=1e-13, atol=0)


def test_the_two_deals_are_not_joined_row_by_row(spark, tmp_path):
    """Rows that share a key and a time are compared by their numbers: no join on the time."""
    from ampere.plans.catalog import all_queries
    spark.range(240).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.floor(F.col("id") / 4) * 60).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("user_id"), F.concat(F.lit("k"), F.col("id") % 2).alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit("{}").alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    found = all_queries()["k6b_forest_checks"].build(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any("timestamp_utc" in line for line in plan.splitlines() if "Join " in line)
    # 60 times of 2 rows a key: every row meets both of its time
    assert {r.iso_code: r.rows for r in found.collect()} == {"K0": 240, "K1": 240}


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {str(REPO)!r})\n"
            "from ampere.session import local_test_session\n"
            "s = local_test_session(2, 2)\n"
            "import __spark_entry__ as e\n"
            "print('ROWS', len(e.queries()['k6_isolation_forest'](s, '/root/testdata/sf0.001').collect()))\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 5" in done.stdout, done.stderr[-2000:]
