"""Joining small per-key tables (statistics, profiles, thresholds) back
onto big row sets.

Spark's static estimate for an aggregate is a fraction of its input, so at
scale the planner would pick a sort-merge join and shuffle the big side by
the key - and one ISO may hold a third of all rows.  ``attach`` therefore
writes the small side once to the shared folder (survives executor loss and
keeps later plans flat).  The Parquet table has true statistics, so Spark's
own byte limit (``spark.sql.autoBroadcastJoinThreshold``) decides whether it
is broadcast; beyond it the join is a shuffle join, where AQE splits skewed
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ampere.session import materialize


def small_side(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a written table with its true size."""
    return materialize(df, "small_side")


def attach(big: DataFrame, small: DataFrame, on: str | Sequence[str] | Column,
           how: str = "inner") -> DataFrame:
    """``big.join(small, on, how)`` with the small side written first."""
    return big.join(small_side(small), on, how)
