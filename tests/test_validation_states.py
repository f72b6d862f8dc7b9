"""Incremental validation, freshness and component status: each answer can come out either way."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ampere.operators import validate as vl

CHECKS = [vl.Check("non_empty"), vl.Check("null_ratio", "temperature", 0.25),
          vl.Check("range", "temperature", lo=-40.0, hi=130.0)]


def _land(spark, folder, values):
    spark.createDataFrame([(v,) for v in values], "temperature double").coalesce(1).write.mode("append").parquet(folder)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_second_run_reads_new_files_only(spark, tmp_path):
    root, states = str(tmp_path / "in put"), str(tmp_path / "states")
    _land(spark, f"{root}/iso=A%20B", [1.0, None, 200.0])
    _land(spark, f"{root}/iso=C", [5.0])
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 2
    assert _rows(rep) == _rows(vl.check_table(spark.read.parquet(root), "t", CHECKS))
    _land(spark, f"{root}/iso=C", [7.0, None])
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 1
    want = _rows(vl.check_table(spark.read.parquet(root), "t", CHECKS))
    assert _rows(rep) == want and ("t", "range", "temperature", 1.0, 0.0, False) in want
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 0 and _rows(rep) == want


def test_replaced_removed_and_empty_files(spark, tmp_path):
    root, states = str(tmp_path / "in"), str(tmp_path / "states")
    assert _rows(vl.validate_new_files(spark, root, "t", CHECKS, states)[0])[0][1] == "non_empty"
    _land(spark, root, [])                               # a file without rows
    _land(spark, root, [500.0])
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 2 and [r.value for r in rep.collect() if r.check == "range"] == [1.0]
    assert vl.validate_new_files(spark, root, "t", CHECKS, states)[1] == 0
    bad = next(p for p in (tmp_path / "in").glob("*.parquet") if spark.read.parquet(str(p)).count())
    bad.unlink()
    (bad.parent / f".{bad.name}.crc").unlink()
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 0 and [r.passed for r in rep.collect() if r.check == "non_empty"] == [False]
    other = [*CHECKS[:2], vl.Check("range", "temperature", lo=0.0, hi=1.0)]
    assert vl.validate_new_files(spark, root, "t", other, states)[1] == 1       # another suite reads again


def test_run_that_dies_leaves_earlier_states(spark, tmp_path, monkeypatch):
    root, states = str(tmp_path / "in"), str(tmp_path / "states")
    _land(spark, root, [1.0])
    vl.validate_new_files(spark, root, "t", CHECKS, states)
    _land(spark, root, [2.0])
    with monkeypatch.context() as m:
        m.setattr("ampere.sources.sinks.fl.write_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            vl.validate_new_files(spark, root, "t", CHECKS, states)
    rep, read = vl.validate_new_files(spark, root, "t", CHECKS, states)
    assert read == 1 and [r.value for r in rep.collect() if r.check == "non_empty"] == [2.0]


def test_freshness_of_real_files(spark, tmp_path):
    root = str(tmp_path / "feed")
    _land(spark, root, [1.0])
    _land(spark, root, [2.0])
    old, new = sorted((tmp_path / "feed").glob("*.parquet"))
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_700_003_600, 1_700_003_600))
    now = F.lit(datetime.fromtimestamp(1_700_003_600 + 5400, timezone.utc))
    assert [tuple(r) for r in vl.freshness_status(vl.list_files(spark, root), now, 2.0).collect()] == [("healthy", 1.5, 2)]
    assert vl.freshness_status(vl.list_files(spark, root), now, 1.0).first().status == "stale"
    none = vl.list_files(spark, root).limit(0)
    assert vl.freshness_status(none, now, 2.0).first().status == "no_data"


def test_detector_that_has_not_run(spark, tmp_path):
    table = str(tmp_path / "anomalies")
    status, found = vl.detector_status(spark, table)
    assert found is None and status.first().status == "not_run"
    spark.range(2).write.parquet(table)
    status, found = vl.detector_status(spark, table)
    assert status.first().status == "healthy" and found.count() == 2
