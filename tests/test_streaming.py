"""Streaming semantics: a restarted stream resumes from its checkpoint, late rows count, and the
result does not depend on how the backlog is cut into micro-batches."""

import random
import tempfile
from collections import Counter
from datetime import datetime, timedelta

import pytest

from ampere.streaming import incremental as inc

T0 = datetime(2024, 1, 1)
COLS = ["iso_code", "timestamp_utc", "load_mw", "seq", "id"]


def _ts(h, m=0):
    return (T0 + timedelta(hours=h, minutes=m)).strftime("%Y-%m-%d %H:%M:%S")


def _land(spark, root, rows, name):
    df = spark.createDataFrame(rows, inc.BRONZE_GRID_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def _clean(spark, root, max_files=None):
    return inc.clean_stream(inc.bronze_stream(spark, root, max_files=max_files)).select(*COLS)


def test_late_rows_count(spark):
    base = tempfile.mkdtemp(prefix="ampere-test-stream-")
    root, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    # run 1: hours 0..5, two rows per hour
    _land(spark, root, [("A", _ts(h, m), "10", 0, h * 100 + m) for h in range(6) for m in (0, 30)], "b1")
    inc.run_batches(_clean(spark, root), inc.hourly_partials, out, ckpt)
    first = {r.hour: r.data_points for r in inc.hourly_rollup(inc.read_batches(spark, out)).collect()}
    # newest row 05:30, less 2 h: windows that ended by 03:30
    assert first == {T0 + timedelta(hours=h): 2 for h in range(3)}
    # run 2: a late row for hour 1 and new rows up to hour 9
    _land(spark, root, [("A", _ts(1, 45), "10", 0, 9991)] +
          [("A", _ts(h), "10", 0, 9000 + h) for h in range(6, 10)], "b2")
    inc.run_batches(_clean(spark, root), inc.hourly_partials, out, ckpt)
    rows = inc.hourly_rollup(inc.read_batches(spark, out)).collect()
    assert len(rows) == len({r.hour for r in rows})                        # each window once
    got = {r.hour: (r.data_points, r.parts) for r in rows}
    assert got[T0 + timedelta(hours=1)] == (3, 2)                          # the late row counts
    assert got[T0 + timedelta(hours=5)] == (2, 1) and got[T0 + timedelta(hours=6)] == (1, 1)


@pytest.mark.parametrize("max_files", [1, 4, None])
def test_any_cut_of_the_backlog_gives_the_batch_result(spark, max_files):
    """Files in random event order, re-sent copies, and a late original that comes after its copy."""
    rng = random.Random(4)
    rows = [("AB"[k % 2], _ts(rng.randrange(30), rng.randrange(6) * 10), str(rng.choice([5, 7.25, 0, -1])), k % 3, k)
            for k in range(240)]
    rows += [("A", _ts(1), "0", 0, 900), ("A", _ts(1), "33", 1, 901), ("A", _ts(29), "44", 0, 902)]
    base = tempfile.mkdtemp(prefix="ampere-test-stream-")
    for k in range(9):
        _land(spark, f"{base}/in", rows[k::9], f"f{k}")
    hours = inc.run_batches(_clean(spark, f"{base}/in", max_files), inc.hourly_partials, f"{base}/h", f"{base}/c1")
    dedup = inc.run_batches(_clean(spark, f"{base}/in", max_files), inc.first_rows, f"{base}/d", f"{base}/c2")
    kept = [(iso, datetime.strptime(ts, "%Y-%m-%d %H:%M:%S"), float(v), seq, i)
            for iso, ts, v, seq, i in rows if float(v) > 0]
    first = {}
    for r in sorted(kept, key=lambda r: r[3:], reverse=True):
        first[r[:2]] = r
    got = inc.first_rows(inc.read_batches(spark, dedup)).select(*COLS).collect()
    assert sorted(map(tuple, got)) == sorted(first.values())
    newest = max(r[1] for r in kept)
    want = Counter((r[0], r[1].replace(minute=0)) for r in kept)
    closed = {k: n for k, n in want.items() if k[1] + timedelta(hours=1) <= newest - timedelta(hours=2)}
    assert {(r.iso_code, r.hour): r.data_points for r in
            inc.hourly_rollup(inc.read_batches(spark, hours)).collect()} == closed
