"""Scalar column helpers.  All are built-in Spark expressions (JVM side)."""

from ampere.functions.numeric import round_half_even, round_all  # noqa: F401
from ampere.functions.timecols import (  # noqa: F401
    epoch_us, floor_hour, to_ntz, hour_of_day, weekday_mon0, weekday_sun1,
    weekend_flag, time_features, day_name,
)
