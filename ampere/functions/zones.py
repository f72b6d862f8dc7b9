"""Wall time of any zone to UTC by a table of the zone's transitions.

The transitions of a zone (instant, offset before, offset after) come from the
JVM's own zone rules, once a zone and session; per row they are looked up by the
year of the wall time, in an array literal of at most a few entries a year, so
the plan is a projection without Python or a join.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

FIRST_YEAR, LAST_YEAR = 1900, 2100        # outside, Spark's own conversion stands
_KNOWN: dict[str, list[tuple[int, int, int]]] = {}


def transitions(spark: SparkSession, tz: str) -> list[tuple[int, int, int]]:
    """(instant, offset before, offset after) in seconds of all transitions in the years covered."""
    if tz not in _KNOWN:
        jvm = spark.sparkContext._jvm
        rules = jvm.java.time.ZoneId.of(tz).getRules()
        at = jvm.java.time.Instant.parse(f"{FIRST_YEAR - 1}-12-30T00:00:00Z")
        end = jvm.java.time.Instant.parse(f"{LAST_YEAR + 1}-01-02T00:00:00Z").getEpochSecond()
        out = [(at.getEpochSecond(), rules.getOffset(at).getTotalSeconds(), rules.getOffset(at).getTotalSeconds())]
        while (t := rules.nextTransition(at)) is not None and t.toEpochSecond() < end:
            at = t.getInstant()
            out.append((t.toEpochSecond(), t.getOffsetBefore().getTotalSeconds(), t.getOffsetAfter().getTotalSeconds()))
        _KNOWN[tz] = out
    return _KNOWN[tz]


def _by_year(moves: list[tuple[int, int, int]]) -> Column:
    """Per year the offset it starts with and its transitions, as an array literal."""
    from datetime import datetime, timedelta, timezone
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    year_of = lambda s: (epoch + timedelta(seconds=s)).year                      # noqa: E731
    found: dict[int, list[tuple[int, int, int]]] = {}
    for t, before, after in moves[1:]:
        for y in {year_of(t + before), year_of(t + after), year_of(max(t + before, t + after) - 1)}:
            found.setdefault(y, []).append((t, before, after))
    cells, offset = [], moves[0][2]
    for y in range(FIRST_YEAR, LAST_YEAR + 1):
        own = found.get(y, [])
        start = own[0][1] if own else offset
        inner = ", ".join(f"named_struct('t', {t}L, 'b', {b}L, 'a', {a}L)" for t, b, a in own)
        inner = f"array({inner})" if own else "cast(array() as array<struct<t: bigint, b: bigint, a: bigint>>)"
        cells.append(f"named_struct('o', {start}L, 'm', {inner})")
        offset = own[-1][2] if own else offset
    return F.expr(f"array({', '.join(cells)})")


def to_utc(wall: Column, tz: str) -> Column:
    """Naive wall time -> naive UTC: a time in a gap moves to the transition, one in an overlap is null."""
    spark = SparkSession.active()
    us = F.unix_micros(wall.cast("timestamp"))
    year = F.get(_by_year(transitions(spark, tz)), F.year(wall) - FIRST_YEAR)
    million = F.lit(1_000_000)

    def step(so_far: Column, move: Column) -> Column:
        gap_or_overlap = (move["t"] + F.least(move["b"], move["a"])) * million
        done = (move["t"] + F.greatest(move["b"], move["a"])) * million
        return (F.when(us < gap_or_overlap, so_far)
                .when(us >= done, us - move["a"] * million)
                .when(move["a"] > move["b"], move["t"] * million))              # else ambiguous: null

    utc = F.aggregate(year["m"], us - year["o"] * million, step)
    own = F.timestamp_micros(utc).cast("timestamp_ntz")
    beyond = F.to_utc_timestamp(wall.cast("timestamp"), tz).cast("timestamp_ntz")
    covered = F.year(wall).between(FIRST_YEAR, LAST_YEAR)
    return F.when(wall.isNull(), F.lit(None)).when(covered, own).otherwise(beyond)
