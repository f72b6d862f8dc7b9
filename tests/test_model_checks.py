"""A reloaded model against the fitted one: rows that share their keys are compared without pairs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ampere.plans.catalog import all_queries

KEYS = ["iso_code", "timestamp_utc", "id"]


def test_reloaded_and_fitted_rows_are_not_joined(spark, tmp_path, monkeypatch):
    """150 keys of which one has 30 rows, and rows without a key; the reloaded model errs on some rows."""
    from ampere.operators import model
    t0 = datetime(2024, 1, 1)
    rows = [(k, t0 + timedelta(minutes=k), 1, f"k{k % 2}", float(k), '{"k": 1}') for k in range(150)]
    rows += [(7, t0 + timedelta(minutes=7), 1, "k1", float(j), '{"k": 1}') for j in range(29)]
    rows += [(None, t0, 1, "k0", 3.0, '{"k": 1}')]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    scored, fitted = model.load_and_score, []

    def erring(path, df):
        right = scored(path, df)
        fitted.append(right.select(*KEYS, "load_mw", "prediction"))
        wrong = F.col("load_mw") % 3 == 0
        return right.withColumn("prediction", F.col("prediction") + wrong.cast("int"))
    monkeypatch.setattr(model, "load_and_score", erring)
    found = all_queries()["k12b_reload_equals_fitted"].build(spark, str(tmp_path))
    assert "Join " not in found._jdf.queryExecution().optimizedPlan().toString()
    right = [tuple(r) for r in fitted[0].collect()]
    pairs = [(a[4], b[4] + (b[3] % 3 == 0)) for a in right for b in right if a[:3] == b[:3] and None not in a[:3]]
    assert [tuple(r) for r in found.collect()] == [(len(pairs), sum(p != q for p, q in pairs))]
    assert len(pairs) > 30 * 30 and any(p != q for p, q in pairs)


def test_training_rows_are_dealt_into_bounded_tasks(spark, monkeypatch):
    """One partition of 4,000 training rows: no task of the forest holds more than about TASK_ROWS of them,
    none is lost, and a table whose partitions are small stays as it is."""
    from ampere.operators import model
    t0 = datetime(2024, 1, 1)
    rows = [(f"K{k % 3}", t0 + timedelta(minutes=k % 50), float(k), 1.0 * (k % 7), 1.0, 2.0, k) for k in range(5000)]
    df = spark.createDataFrame(rows, "iso_code string, timestamp_utc timestamp_ntz, load_mw double, temperature double, "
                                     "wind_speed double, humidity double, id long").coalesce(1)
    given, pipeline = [], model.forest_pipeline

    def watched(**forest):
        class Watched:
            def fit(self, train):
                given.append(train.groupBy(F.spark_partition_id()).count().collect())
                return pipeline(**forest).fit(train)
        return Watched()
    monkeypatch.setattr(model, "forest_pipeline", watched)
    _, whole = model.train_and_evaluate(df, num_trees=2, max_depth=2)
    monkeypatch.setattr(model, "TASK_ROWS", 300, raising=False)
    _, dealt = model.train_and_evaluate(df, num_trees=2, max_depth=2)
    assert [r["count"] for r in given[0]] == [4000]
    sizes = [r["count"] for r in given[1]]
    assert sum(sizes) == 4000 and len(sizes) == 14 and max(sizes) <= 330
    for m in (whole, dealt):
        r = m.first()
        assert (r.train_rows, r.test_rows) == (4000, 1000)
    assert model.dealt_evenly(df, task_rows=5000) is df and model.dealt_evenly(df.limit(0)).count() == 0
