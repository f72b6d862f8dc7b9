"""SQL fragments shared by the DuckDB oracle queries.

These mirror the Spark operators expression for expression (rounding,
day-of-week convention, tie keys).  They are only used to check results.
"""

from __future__ import annotations


def r(expr: str, digits: int = 2) -> str:
    """numpy-style half-even rounding, as ``round_half_even`` in Spark."""
    s = f"{10 ** digits}.0"
    return f"(round_even(({expr}) * {s}, 0) / {s})"


def hq(sum_expr: str, n_expr: str | None, digits: int = 2) -> str:
    """Exact half-even rounding of sum / n (``half_even_quotient`` twin).
    ``sum_expr`` must be an exact DECIMAL(38,8) sum."""
    up, down = 10 ** max(0, digits - 8), 10 ** max(0, 8 - digits)
    num = f"CAST(abs({sum_expr}) * {10 ** 8 * up} AS HUGEINT)"
    nn = f"CAST({n_expr} AS HUGEINT)" if n_expr else "CAST(1 AS HUGEINT)"
    den = f"({nn} * {down})"
    q = f"({num} // {den})"
    rem = f"({num} - {q} * {den})"
    units = f"({q} + CASE WHEN 2 * {rem} > {den} THEN 1 WHEN 2 * {rem} = {den} THEN {q} % 2 ELSE 0 END)"
    return (f"(CASE WHEN ({sum_expr}) IS NULL OR {nn} = 0 THEN NULL "
            f"ELSE sign({sum_expr}) * {units} / {float(10 ** digits)} END)")


def xsum(col: str) -> str:
    return f"sum(CAST({col} AS DECIMAL(28,8)))"


def xavg(col: str, digits: int = 2) -> str:
    return hq(xsum(col), f"count({col})", digits)


def xmean(col: str) -> str:
    """Exact mean at 10 places (``finish_mean`` twin)."""
    return hq(xsum(col), f"count({col})", 10)


def hod(ts: str) -> str:
    return f"CAST(hour({ts}) AS INTEGER)"


def dow(ts: str) -> str:
    """Monday = 0."""
    return f"CAST(isodow({ts}) - 1 AS INTEGER)"


def weekend(ts: str) -> str:
    return f"CAST(CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS INTEGER)"


def div(a: str, b: str) -> str:
    """null on zero / null divisor (Spark ``try_divide``)."""
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def us(ts: str) -> str:
    return f"epoch_us({ts})"


# Nearest weather within 60 minutes, earlier row on ties, then values.
ENRICHED = """
    SELECT g.iso_code, g.timestamp_utc, g.load_mw, g.id,
           m.temperature, m.wind_speed, m.humidity,
           date_trunc('hour', g.timestamp_utc) AS hour,
           CAST(NULL AS DOUBLE) AS solar_irradiance_proxy
    FROM grid g LEFT JOIN (
      SELECT * FROM (
        SELECT g2.iso_code, g2.timestamp_utc, w.temperature, w.wind_speed, w.humidity,
               row_number() OVER (PARTITION BY g2.iso_code, g2.timestamp_utc
                 ORDER BY abs(epoch_us(w.timestamp_utc) - epoch_us(g2.timestamp_utc)),
                          w.timestamp_utc, w.temperature NULLS FIRST,
                          w.wind_speed NULLS FIRST, w.humidity NULLS FIRST) AS rn
        FROM grid g2 JOIN weather w
          ON g2.iso_code = w.iso_code
         AND w.timestamp_utc BETWEEN g2.timestamp_utc - INTERVAL 60 MINUTE
                                 AND g2.timestamp_utc + INTERVAL 60 MINUTE
      ) WHERE rn = 1
    ) m ON g.iso_code = m.iso_code AND g.timestamp_utc = m.timestamp_utc
"""


def load_weather_aggs(with_sum: bool = False) -> str:
    parts = [
        f"{xavg('load_mw')} AS avg_load_mw",
        f"{r('min(load_mw)')} AS min_load_mw",
        f"{r('max(load_mw)')} AS max_load_mw",
        f"{r('stddev_samp(load_mw)')} AS std_load_mw",
    ]
    if with_sum:
        parts.append(f"coalesce({hq(xsum('load_mw'), None)}, 0.0) AS total_load_mwh")
    parts += [
        "count(load_mw) AS data_points",
        f"{xavg('temperature')} AS avg_temperature",
        f"{r('min(temperature)')} AS min_temperature",
        f"{r('max(temperature)')} AS max_temperature",
        f"{xavg('wind_speed')} AS avg_wind_speed",
        f"{r('max(wind_speed)')} AS max_wind_speed",
        f"{xavg('humidity')} AS avg_humidity",
    ]
    return ",\n           ".join(parts)


HOURLY = f"""
    SELECT iso_code, hour, {load_weather_aggs()},
           {r(r(div('stddev_samp(load_mw)', 'avg(load_mw)') + ' * 100'))} AS load_variability,
           {hod('hour')} AS hour_of_day, {dow('hour')} AS day_of_week,
           {weekend('hour')} AS is_weekend
    FROM enriched GROUP BY iso_code, hour
"""

DAILY = f"""
    SELECT iso_code, CAST(CAST(timestamp_utc AS DATE) AS TIMESTAMP) AS date, {load_weather_aggs(True)},
           {r(r(div('max(load_mw)', 'avg(load_mw)')))} AS peak_to_avg_ratio,
           {r(r(div('avg(load_mw)', 'max(load_mw)') + ' * 100'))} AS load_factor,
           {dow('CAST(timestamp_utc AS DATE)')} AS day_of_week,
           {weekend('CAST(timestamp_utc AS DATE)')} AS is_weekend,
           dayname(CAST(timestamp_utc AS DATE)) AS day_name
    FROM enriched GROUP BY iso_code, CAST(timestamp_utc AS DATE)
"""

SUMMARY = f"""
    SELECT iso_code, data_start, data_end, total_observations,
           x_avg_load_mw AS avg_load_mw, {r('min_load_mw')} AS min_load_mw,
           {r('max_load_mw')} AS max_load_mw, {r('std_load_mw')} AS std_load_mw,
           x_avg_temperature AS avg_temperature, {r('min_temperature')} AS min_temperature,
           {r('max_temperature')} AS max_temperature, x_avg_wind_speed AS avg_wind_speed,
           x_avg_humidity AS avg_humidity,
           {r(r('with_temp / n_rows * 100'))} AS data_completeness,
           {r(r('(epoch_us(data_end) - epoch_us(data_start)) / 1e6 / 86400.0', 1))} AS data_span_days,
           {r(r('max_load_mw * 1.1', 0))} AS estimated_capacity_mw,
           {r(r(div('avg_load_mw', r('max_load_mw * 1.1', 0)) + ' * 100'))} AS avg_capacity_factor
    FROM (SELECT iso_code, min(timestamp_utc) AS data_start, max(timestamp_utc) AS data_end,
                 count(timestamp_utc) AS total_observations,
                 avg(load_mw) AS avg_load_mw, min(load_mw) AS min_load_mw,
                 max(load_mw) AS max_load_mw, stddev_samp(load_mw) AS std_load_mw,
                 avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
                 max(temperature) AS max_temperature, avg(wind_speed) AS avg_wind_speed,
                 avg(humidity) AS avg_humidity, count(temperature) AS with_temp,
                 {xavg('load_mw')} AS x_avg_load_mw, {xavg('temperature')} AS x_avg_temperature,
                 {xavg('wind_speed')} AS x_avg_wind_speed, {xavg('humidity')} AS x_avg_humidity,
                 count(*) AS n_rows
          FROM enriched GROUP BY iso_code) s
"""
