"""Bronze layer: raw files -> tables stamped with the run date (ING1, ING2)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import parse_timestamp, run_date
from laketide.sources.files import read_csv
from laketide.sources.schemas import raw_schema

PART_COL = "partition_date"

# Full snapshots and event files of the pipeline (table -> start/stop columns).
SNAPSHOT_TABLES = ("patients", "payers")
EVENT_TABLES = {"encounters": ("START", "STOP"), "procedures": ("START", "STOP")}


def stamp(df: DataFrame, d, part_col: str = PART_COL) -> DataFrame:
    """Add the run date as a typed date column (PRJ2)."""
    return df.withColumn(part_col, F.lit(run_date(d)))


def ingest_full(spark: SparkSession, path: str, table: str, d) -> DataFrame:
    """Whole snapshot file, stamped with the run date (ING1)."""
    return stamp(read_csv(spark, path, raw_schema(table)), d)


def ingest_events(spark: SparkSession, path: str, table: str, d) -> DataFrame:
    """Events that start or stop on the run date (ING2; FLT1).

    The raw times are parsed only for the filter; the row stays text.  An
    event spanning midnight lands in both days' slices; the fact layer
    keeps it once, on its stop date.

    Events whose start and stop both fail to parse belong to no day; they
    are kept (not dropped) in the undated partition (``partition_date``
    NULL), which every run rewrites with the file's current undatable rows
    in the same pass.
    """
    start, stop = EVENT_TABLES[table]
    day = F.lit(run_date(d))
    raw = read_csv(spark, path, raw_schema(table))
    s_day, e_day = F.to_date(parse_timestamp(start)), F.to_date(parse_timestamp(stop))
    undated = s_day.isNull() & e_day.isNull()
    sliced = raw.where((s_day == day) | (e_day == day) | undated)
    return sliced.withColumn(PART_COL, F.when(~undated, day))


def path_on(source, d) -> str:
    """File of a raw table on a day: one path, or {date: path}, each valid
    from its date on."""
    if isinstance(source, str):
        return source
    starts = {run_date(k): v for k, v in source.items()}
    known = [k for k in starts if k <= run_date(d)]
    if not known:
        raise ValueError(f"no file for {run_date(d)}, the first one starts on {min(starts)}")
    return starts[max(known)]


def periods(source, first, last) -> list[tuple]:
    """(first day, last day, path) of every file between two dates."""
    first, last = run_date(first), run_date(last)
    starts = [] if isinstance(source, str) else sorted(k for k in map(run_date, source) if first < k <= last)
    begins = [first, *starts]
    ends = [*[k - _dt.timedelta(days=1) for k in starts], last]
    return [(b, e, path_on(source, b)) for b, e in zip(begins, ends)]


def on_each_day(df: DataFrame, first, last) -> DataFrame:
    """All rows, once for every day between two dates.

    A product of the rows' splits and one-day partitions: every task holds
    one split on one day, so the copies come laid out by day and a write by
    day moves none of them."""
    n = (run_date(last) - run_date(first)).days + 1
    day = F.date_add(F.lit(run_date(first)), F.col("id").cast("int")).alias(PART_COL)
    days = df.sparkSession.range(0, n, 1, n).select(day)
    return df.crossJoin(days.hint("shuffle_replicate_nl"))


def ingest_full_range(spark: SparkSession, source, table: str, first, last,
                      once: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """:func:`ingest_full` of every day between two dates, laid out by day:
    the rows of each file fan out to the days on which it is valid.  Every
    day reads them anew; with an ``once`` that stores them, the file itself
    is scanned once."""
    out = None
    for begin, end, path in periods(source, first, last):
        part = on_each_day(once(read_csv(spark, path, raw_schema(table))), begin, end)
        out = part if out is None else out.unionByName(part)
    return out


def ingest_event_range(spark: SparkSession, path: str, table: str, first, last) -> DataFrame:
    """:func:`ingest_events` of every day between two dates from one scan: an
    event goes to the days of its start and its stop that lie between them,
    an event without any day to the undated partition."""
    start, stop = EVENT_TABLES[table]
    raw = read_csv(spark, path, raw_schema(table))
    days = F.array_distinct(F.array(F.to_date(parse_timestamp(start)), F.to_date(parse_timestamp(stop))))
    dated = F.filter(days, lambda x: x.isNotNull())
    inside = F.filter(dated, lambda x: x.between(F.lit(run_date(first)), F.lit(run_date(last))))
    slices = F.when(F.size(dated) == 0, F.array(F.lit(None).cast("date"))).otherwise(inside)
    return raw.withColumn(PART_COL, F.explode(slices))


def ingest(spark: SparkSession, path: str, table: str, d) -> DataFrame:
    if table in EVENT_TABLES:
        return ingest_events(spark, path, table, d)
    return ingest_full(spark, path, table, d)
