"""A slowly changing dimension as two ordinary tables (SCD4's state).

* ``open``: the complete set of open versions after each load, partitioned
  by load date;
* ``closed``: the versions that a load closed, partitioned by end date,
  which is that load's date.

A load reads the open versions of the load before it and replaces exactly
its own partition of both tables, so it can be run again with the same
result, and the history, which grows with every change ever made, is never
read or rewritten.  Closed versions are written first; they count only up
to the date of the last load in ``open``, so a load that dies half way has
no effect, and the next load clears what it left.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators.scd2 import DimSpec, scd2_apply, scd2_continue, scd2_from_snapshots
from laketide.sinks.write import overwrite_partition, overwrite_range
from laketide.sources.tables import read_table, table_exists

LOAD_DATE = "load_date"


class DimensionTables:
    """The tables ``open`` and ``closed`` of one dimension, below ``base``."""

    def __init__(self, spark: SparkSession, base: str, spec: DimSpec):
        self.spark, self.spec = spark, spec
        self.open_table = f"{base.rstrip('/')}/open"
        self.closed_table = f"{base.rstrip('/')}/closed"

    def last_load(self, before=None) -> _dt.date | None:
        """Date of the last finished load (before a date); one value reaches
        the driver."""
        if not table_exists(self.spark, self.open_table):
            return None
        loads = read_table(self.spark, self.open_table).select(LOAD_DATE)
        if before is not None:
            loads = loads.where(F.col(LOAD_DATE) < F.lit(run_date(before)))
        return loads.agg(F.max(LOAD_DATE).alias("m")).first()["m"]

    def active(self, before=None) -> DataFrame | None:
        """Open versions after the last load (before a date)."""
        last = self.last_load(before)
        if last is None:
            return None
        return (read_table(self.spark, self.open_table).where(F.col(LOAD_DATE) == F.lit(last))
                .select(*self.spec.columns))

    def history(self) -> DataFrame | None:
        """Closed versions."""
        last = self.last_load()
        if last is None or not table_exists(self.spark, self.closed_table):
            return None
        return (read_table(self.spark, self.closed_table).where(F.col(self.spec.end_col) <= F.lit(last))
                .select(*self.spec.columns))

    def read(self) -> DataFrame | None:
        """The whole dimension."""
        a, h = self.active(), self.history()
        return a if a is None or h is None else h.unionByName(a)

    def too_late(self, d) -> bool:
        """Whether ``d`` is too late to load: a later load is there."""
        last = self.last_load()
        return last is not None and run_date(d) < last

    def step(self, snapshot: DataFrame, d) -> DataFrame:
        """Open versions after the load of ``d`` and the versions that it
        closes; nothing is written."""
        return scd2_apply(self.active(before=d), snapshot, self.spec, d, check_gate=False)

    def store(self, step: DataFrame, d) -> None:
        """Store :meth:`step`, which both writes read, so hand over a stored
        copy of it."""
        d = run_date(d)
        end, active = self.spec.end_col, F.col(self.spec.active_col)
        none = step.limit(0)
        # run again: the load is undone first, so that no reader and no later
        # load ever sees the parts of two runs
        if self.last_load() == d:
            overwrite_partition(none, self.open_table, LOAD_DATE, d)
        if table_exists(self.spark, self.closed_table):
            closed = read_table(self.spark, self.closed_table)
            last = self.last_load(before=d)
            left = closed.where(F.col(end) != F.lit(d))
            if last is not None:
                left = left.where(F.col(end) > F.lit(last))
            for r in left.select(end).distinct().collect():     # dates of loads that died
                overwrite_partition(none, self.closed_table, end, r[0])
        overwrite_partition(step.where(~active), self.closed_table, end, d)
        overwrite_partition(step.where(active), self.open_table, LOAD_DATE, d)

    def step_range(self, snapshots: DataFrame, first, date_col: str) -> tuple[DataFrame, DataFrame | None]:
        """What the loads of many days, all from ``first`` on, change (see
        :func:`scd2_continue`), and the open versions that they start from;
        nothing is written."""
        before = self.active(before=first)
        if before is None:
            return scd2_from_snapshots(snapshots, self.spec, date_col), None
        return scd2_continue(before, snapshots, self.spec, date_col), before

    def store_range(self, changed: DataFrame, before: DataFrame | None, last, first=None) -> None:
        """Store :meth:`step_range` (``changed`` a stored copy) as one load of
        the date ``last``: the versions that it closes by their end dates,
        then, in one partition, the open ones.  Like :meth:`store` it can be
        run again, and has no effect when it dies half way.  ``first`` is not
        needed here: the set of open versions is complete."""
        last = run_date(last)
        spec, active = self.spec, F.col(self.spec.active_col)
        opened = changed.where(active)
        if before is not None:
            opened = before.join(changed.select(spec.surrogate_key), spec.surrogate_key, "left_anti").unionByName(opened)
        if self.last_load() == last:
            overwrite_partition(changed.limit(0), self.open_table, LOAD_DATE, last)
        finished = self.last_load()
        begin = None if finished is None else finished + _dt.timedelta(days=1)
        # dates behind the last finished load belong to this one or to one that died
        overwrite_range(changed.where(~active), self.closed_table, spec.end_col, begin, None)
        overwrite_partition(opened.select(*spec.columns), self.open_table, LOAD_DATE, last)

    def create_views(self, database: str, name: str) -> str:
        """Catalog tables ``<name>_open`` and ``<name>_closed`` over the
        files, and the view ``<name>`` of the whole dimension; returns the
        view's name."""
        spark = self.spark
        full = f"`{database}`.`{name}`"
        catalog_table(spark, self.open_table, database, f"{name}_open", LOAD_DATE)
        catalog_table(spark, self.closed_table, database, f"{name}_closed", self.spec.end_col)
        cols = ", ".join(f"`{c}`" for c in self.spec.columns)
        last = f"(SELECT max(`{LOAD_DATE}`) FROM `{database}`.`{name}_open`)"
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS "
                  f"SELECT {cols} FROM `{database}`.`{name}_open` WHERE `{LOAD_DATE}` = {last} UNION ALL "
                  f"SELECT {cols} FROM `{database}`.`{name}_closed` WHERE `{self.spec.end_col}` <= {last}")
        return full


def catalog_table(spark: SparkSession, path: str, database: str, name: str, part_col: str) -> str:
    """External catalog table over a path table, with all its partitions
    (SNK8); returns its name.  The files stay where they are, and creating
    it again picks up new partitions."""
    full = f"`{database}`.`{name}`"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_table(spark, path).schema.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"CREATE TABLE {full} ({fields}) USING parquet PARTITIONED BY (`{part_col}`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {full}")
    return full
