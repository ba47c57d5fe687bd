"""Run-date slices and day counts (FLT1, FLT2, FLT9, AGG7).

Predicates compare typed columns with typed literals so Catalyst can push
them to the scan (``PushedFilters`` / ``PartitionFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.functions.dates import run_date


def partition_slice(df: DataFrame, d, part_col: str = "partition_date") -> DataFrame:
    """Rows of one date partition (prunes partitions on a partitioned table)."""
    return df.where(F.col(part_col) == F.lit(run_date(d)))


def event_slice(df: DataFrame, d, start_col: str = "start_time", stop_col: str = "stop_time") -> DataFrame:
    """Events that start or stop on ``d`` (an event spanning midnight
    belongs to both days' slices)."""
    day = F.lit(run_date(d))
    return df.where((F.to_date(start_col) == day) | (F.to_date(stop_col) == day))


def event_slices(df: DataFrame, start_col: str = "start_time", stop_col: str = "stop_time",
                 out_col: str = "slice_date") -> DataFrame:
    """Every day's slice at once: each event once per distinct day among
    its start and stop days.  Equals the union of :func:`event_slice` over
    all dates, in one pass with no join."""
    days = F.array_distinct(F.array(F.to_date(start_col), F.to_date(stop_col)))
    return (df.select("*", F.explode(F.filter(days, lambda x: x.isNotNull())).alias(out_col)))


def rows_on_day(df: DataFrame, ts_col: str, d) -> DataFrame:
    """Rows whose timestamp falls on calendar day ``d`` (FLT9)."""
    return df.where(F.to_date(ts_col) == F.lit(run_date(d)))


def day_counts(df: DataFrame, ts_col: str, out_col: str = "day") -> DataFrame:
    """Row count per calendar day of a timestamp column (AGG7, all days)."""
    return df.groupBy(F.to_date(ts_col).alias(out_col)).agg(F.count(F.lit(1)).alias("n_rows"))


def count_on_day(df: DataFrame, ts_col: str, d) -> int:
    """Row count of one day as a single value (the only thing collected)."""
    return rows_on_day(df, ts_col, d).agg(F.count(F.lit(1)).alias("n")).first()["n"]
