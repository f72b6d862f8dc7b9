"""Times written as text: which forms a column holds, and their values.

A text is taken apart once by shape (native regular expressions, no format is
tried by failing): a date in one of five shapes, an optional clock time (24 or 12
hours, seconds and fractions optional) and an optional offset behind a clock
time.  The parts are put together as ISO text and cast, so a month 13 or an hour
25 is null and never an error.

=============== ===============================================================
shape           examples
=============== ===============================================================
iso             2025-01-10, 2025/1/10 05:00, 2025-01-10T05:00:00.5Z
compact         20250110, 20250110 05:00, 20250110T050000, 202501100500
month/day       01/10/2025 05:00:00 PM, 1-10-2025, 01.10.25 5:00
day/month       the same figures, where more values of the column fit this order
named month     Jan 10 2025 05:00, January 10th, 2025, 10-Jan-25, Fri 10 Jan 2025
=============== ===============================================================

Whether figures are month first or day first is a question to the whole column:
both are counted in one aggregate and the order that fits more values is taken
(month first when equal), for every value of the column alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# English month names, and the year from which two digits mean 19xx (POSIX).
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
CENTURY_FROM = 69

_CLOCK = r"(?:[T\s]+|,\s*)(\d{1,2}:\d{2}.*|\d{4}(?:\d{2})?|\d{1,2}\s*[AaPp]\.?[Mm]\.?)"
_WEEKDAY = r"(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?,?\s+)?"
_MONTH = r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec))[a-z]*\.?"
_YEAR = r"(\d{4}|\d{2})"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
# shape, pattern, and where year, month (or its name), day and clock stand in it
_SHAPES = [
    ("iso", rf"(?i)^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:{_CLOCK})?$", (1, 2, 3, 4)),
    ("compact", r"(?i)^((?:19|20)\d{2})(\d{2})(\d{2})(?:[T\s]*(\d{1,2}:\d{2}.*|\d{4}(?:\d{2})?))?$", (1, 2, 3, 4)),
    ("figures", rf"(?i)^(\d{{1,2}})[-/.](\d{{1,2}})[-/.]{_YEAR}(?:{_CLOCK})?$", (3, 1, 2, 4)),
    ("named month", rf"(?i)^{_WEEKDAY}{_MONTH}[\s-]+{_DAY},?[\s-]+{_YEAR}(?:{_CLOCK})?$", (3, 1, 2, 4)),
    ("named month", rf"(?i)^{_WEEKDAY}{_DAY}[\s-]+{_MONTH},?[\s-]+{_YEAR}(?:{_CLOCK})?$", (3, 2, 1, 4)),
]
# a clock time of digits alone, and one with colons or with AM / PM only
_DIGITS = r"^(\d{2})(\d{2})(\d{2})?$"
_HANDS = r"(?i)^(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?\s*(?:([ap])\.?m\.?)?$"
_PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"
_OFFSET = r"(?i)^(.*(?:\d{1,2}:\d{2}|T\d{4}).*?)\s*(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)$"
NUMBER = r"^\s*[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$"


def _let(x: Column, f) -> Column:
    """``f(x)`` with x computed once: a lambda's variable, so that the expression stays small."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _seconds(zone: Column) -> Column:
    """Seconds of an offset text; null for an empty one."""
    digits = F.rpad(F.regexp_replace(zone, "[^0-9]", ""), 4, "0")
    size = F.substring(digits, 1, 2).cast("int") * 3600 + F.substring(digits, 3, 2).cast("int") * 60
    return (F.when(F.upper(zone).isin("Z", "UTC", "GMT"), F.lit(0))
            .when(zone.startswith("-"), -size).when(zone.startswith("+"), size))


def _parts(t: Column) -> Column:
    """shape, year, month, day (as month-first figures), clock of a text without offset; else null."""
    out = F.lit(None).cast("array<string>")
    for name, pattern, places in reversed(_SHAPES):
        found = F.array(F.lit(name), *[F.regexp_extract(t, pattern, k) for k in places])
        out = F.when(t.rlike(pattern), found).otherwise(out)
    return out


def _taken(c: Column | str, f) -> Column:
    """``f(parts, offset)`` of a text."""
    text = F.trim(F.regexp_replace(_text(c), r"\s+", " "))
    cut = lambda t: F.struct(F.when(t.rlike(_OFFSET), F.regexp_extract(t, _OFFSET, 1)).otherwise(t).alias("t"),
                             F.regexp_extract(t, _OFFSET, 2).alias("zone"))
    return _let(text, lambda t: _let(cut(t), lambda b: _let(_parts(b["t"]), lambda p: f(p, b["zone"]))))


def _date(year: Column, month: Column, day: Column) -> Column:
    year = (F.when(F.length(year) == 4, year)
            .when(year.cast("int") >= CENTURY_FROM, F.concat(F.lit("19"), year))
            .otherwise(F.concat(F.lit("20"), year)))
    month = (F.when(month.rlike("^[A-Za-z]"), ((F.instr(F.lit(MONTHS), F.lower(month)) + 2) / 3).cast("int"))
             .otherwise(month.try_cast("int")))
    return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))


def _clock_text(clock: Column) -> Column:
    hand = lambda k: F.regexp_extract(clock, _HANDS, k)                                     # noqa: E731
    or_zero = lambda x: F.when(x == "", "00").otherwise(x)                                  # noqa: E731
    hour, half = hand(1).try_cast("int"), F.lower(hand(5))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    hands = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), or_zero(hand(2)), F.lit(":"), or_zero(hand(3)),
                     F.when(hand(4) == "", "").otherwise(F.concat(F.lit("."), F.substring(hand(4), 1, 6))))
    digits = F.concat(F.regexp_extract(clock, _DIGITS, 1), F.lit(":"), F.regexp_extract(clock, _DIGITS, 2),
                      F.lit(":"), or_zero(F.regexp_extract(clock, _DIGITS, 3)))
    return F.when(clock == "", "00:00:00").when(clock.rlike(_DIGITS), digits).when(clock.rlike(_HANDS), hands)


def _moment(p: Column, day_first: bool) -> Column:
    year, a, b, clock = (F.get(p, F.lit(k)) for k in range(1, 5))
    swap = F.get(p, F.lit(0)) == "figures"
    date = F.when(swap, _date(year, b, a)).otherwise(_date(year, a, b)) if day_first else _date(year, a, b)
    return F.concat(date, F.lit(" "), _let(F.trim(clock), _clock_text)).try_cast("timestamp_ntz")


def offset_seconds(c: Column | str) -> Column:
    """Seconds east of UTC that a text carries behind its clock time; null without an offset."""
    text = _text(c)
    return F.when(text.rlike(_PLAIN), F.lit(None).cast("int")).otherwise(_taken(text, lambda p, zone: _seconds(zone)))


def shape(c: Column | str) -> Column:
    """The shape of a text's date; null where it has none of them."""
    return _taken(c, lambda p, zone: F.get(p, F.lit(0)))


def wall_time(c: Column | str, day_first: bool = False) -> Column:
    """The time a text names, without its offset (TIMESTAMP_NTZ); null where it names none."""
    text = _text(c)
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz")).otherwise(    # as it is, the usual form
        _taken(text, lambda p, zone: _moment(p, day_first)))


def fits_as(c: Column | str) -> Column:
    """How a value parses: its shape (``month/day`` only, ``day/month`` only, or ``figures`` for
    both), ``number``, ``unparsed``, or null."""
    text = _text(c)

    def named(p: Column, zone: Column) -> Column:
        kind = F.get(p, F.lit(0))
        both = F.struct(_moment(p, False).alias("m"), F.when(kind == "figures", _moment(p, True)).alias("d"))
        return _let(both, lambda x: F.when((kind == "figures") & x["m"].isNotNull() & x["d"].isNotNull(), "figures")
                    .when((kind == "figures") & x["m"].isNotNull(), "month/day")
                    .when((kind == "figures") & x["d"].isNotNull(), "day/month")
                    .when((kind != "figures") & x["m"].isNotNull(), kind))

    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(text.rlike(_PLAIN) & text.try_cast("timestamp_ntz").isNotNull(), "iso")
            .otherwise(F.coalesce(_taken(text, named), F.when(text.rlike(NUMBER), "number").otherwise("unparsed"))))


def coverage(df: DataFrame, col: str) -> DataFrame:
    """``format``, ``rows``: how many values of the column fit each form (one grouped count)."""
    return df.groupBy(fits_as(F.col(f"`{col}`")).alias("format")).agg(F.count(F.lit(1)).alias("rows"))


def choose(df: DataFrame, col: str) -> dict:
    """The order of figures that fits more values, and how many values parse as text at all."""
    rows = {r["format"]: r["rows"] for r in coverage(df, col).collect()}          # one row a form
    day_first = rows.get("day/month", 0) > rows.get("month/day", 0)
    parsed = sum(n for f, n in rows.items() if f not in (None, "number", "unparsed"))
    lost = rows.get("month/day" if day_first else "day/month", 0)
    return {"day_first": day_first, "parsed": parsed - lost, "rows": rows}
