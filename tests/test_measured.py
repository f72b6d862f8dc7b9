"""Independent measurements recorded in FIXTURES.md section 3 (sf0.01)."""

from pyspark.sql import functions as F

from ampere.operators import anomaly as an
from ampere.operators import aggregate as agg
from ampere.sources import fixtures as fx

from conftest import SF_CHECK


def _all_events(spark):
    e = fx.table(spark, SF_CHECK, "events")
    return e.select(F.col("event_type").alias("iso_code"), F.col("ts").cast("timestamp_ntz").alias("timestamp_utc"),
                    F.col("value").alias("load_mw"), F.col("event_id").alias("id"),
                    F.lit(None).cast("double").alias("temperature"))


def test_vote_split_on_all_events(spark):
    s = an.score_rows(_all_events(spark), use_forest=False)
    got = {r.anomaly_count: r["count"] for r in s.groupBy("anomaly_count").count().collect()}
    assert got == {0: 996, 1: 8477, 2: 377, 3: 150}


def test_hourly_groups_on_all_events(spark):
    e = _all_events(spark).withColumns({"wind_speed": F.lit(None).cast("double"),
                                        "humidity": F.lit(None).cast("double"),
                                        "hour": F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz")})
    h = agg.hourly_metrics(e)
    assert h.count() == 3385
    assert h.where(F.col("std_load_mw").isNull()).count() == 620


def test_asof_match_count(spark):
    from ampere.plans import medallion as md
    e = md.enriched(spark, SF_CHECK)
    assert e.count() == 10000
    assert e.where(F.col("temperature").isNotNull()).count() == 7009
