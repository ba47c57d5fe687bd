"""A slowly changing dimension whose loads write only what they change.

:class:`DimensionTables` keeps a full copy of the open versions for every
load.  Here a load adds the versions that it opens, and the open versions are
put together on read:

* ``opened``: the versions that a load opens, partitioned by load date;
* ``closed``: the versions that a load closes, partitioned by end date;
* ``loads``: one row a finished load, written last;
* ``base``, ``bases``: complete sets of open versions, written by a
  compaction, and one row for each finished one.

The open versions after a load are, for every key, the version opened last
since the newest base, and that base's rows of all other keys.  (A key never
loses its open version without a new one: a key that a snapshot lacks stays
open.)  The rows opened since the base are reduced to one a key; the base is
only probed with their keys, so where these are small Spark broadcasts them
and the base is not shuffled.

A load that dies before its row in ``loads`` has no effect, and the next load
clears what it left.  A compaction changes no result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators.scd2 import DimSpec
from laketide.sinks.dimension import LOAD_DATE, DimensionTables, catalog_table
from laketide.sinks.write import overwrite_partition, overwrite_partitions
from laketide.sources.tables import delete_path, partition_values, read_table, table_exists


class DimensionLog(DimensionTables):
    """One dimension below the folder ``base``; used like
    :class:`DimensionTables`."""

    def __init__(self, spark: SparkSession, base: str, spec: DimSpec):
        super().__init__(spark, base, spec)
        root = base.rstrip("/")
        self.opened_table, self.loads_table = f"{root}/opened", f"{root}/loads"
        self.base_table, self.bases_table = f"{root}/base", f"{root}/bases"

    # ---------------------------------------------------------------- register
    def _register(self, table: str, d, n_rows: int) -> None:
        row = self.spark.range(1).select(F.lit(n_rows).cast("long").alias("n_rows"))
        overwrite_partition(row, table, LOAD_DATE, d)

    def _registered(self, table: str) -> dict[_dt.date, int]:
        """Date to number of rows: one row a load reaches the driver."""
        if not table_exists(self.spark, table):
            return {}
        return {r[LOAD_DATE]: r["n_rows"] for r in read_table(self.spark, table).collect()}

    def loads(self) -> dict[_dt.date, int]:
        """Finished loads and the numbers of versions that they opened."""
        return self._registered(self.loads_table)

    def bases(self) -> dict[_dt.date, int]:
        """Loads with a finished base, and the numbers of its rows."""
        return self._registered(self.bases_table)

    def last_load(self, before=None) -> _dt.date | None:
        return max((d for d in self.loads() if before is None or d < run_date(before)), default=None)

    # -------------------------------------------------------------------- read
    def active(self, before=None) -> DataFrame | None:
        """Open versions after the last load (before a date).  Raises where
        :meth:`compact` has dropped what that state was made of."""
        last = self.last_load(before)
        if last is None:
            return None
        base = max((d for d in self.bases() if d <= last), default=None)
        since = [d for d in self.loads() if d <= last and (base is None or d > base)]
        kept = partition_values(self.spark, self.opened_table, LOAD_DATE)
        bases = partition_values(self.spark, self.base_table, LOAD_DATE)
        if any(d.isoformat() not in kept for d in since) or (base and base.isoformat() not in bases):
            raise ValueError(f"a compaction has dropped the open versions of {last}")
        spec, when = self.spec, F.col(LOAD_DATE)
        span = when.between(F.lit(min(since)), F.lit(last)) if since else F.lit(False)
        newest = (read_table(self.spark, self.opened_table).where(span)
                  .groupBy(F.col(spec.natural_key).alias("_key"))
                  .agg(F.max_by(F.struct(*spec.columns), F.struct(when, F.col(spec.start_col))).alias("row"))
                  .select("row.*"))
        if base is None:
            return newest
        rows = read_table(self.spark, self.base_table).where(when == F.lit(base)).select(*spec.columns)
        if not since:
            return rows
        return (rows.join(newest.select(spec.natural_key), spec.natural_key, "left_anti")
                .select(*spec.columns).unionByName(newest))

    # ------------------------------------------------------------------- write
    def _drop(self, table: str, col: str, which) -> None:
        """Delete the date partitions for which ``which`` holds, the last one
        first, so that a reader finds the state after some load at any time."""
        for v in sorted(partition_values(self.spark, table, col), reverse=True):
            if which(run_date(v)):
                delete_path(self.spark, f"{table}/{col}={v}")

    def _undo(self, first) -> None:
        """Undo the loads from ``first`` on, and drop what they, or loads that
        died, left."""
        self._drop(self.bases_table, LOAD_DATE, lambda x: x >= first)
        self._drop(self.loads_table, LOAD_DATE, lambda x: x >= first)
        last = self.last_load() or _dt.date.min
        for table, col in ((self.opened_table, LOAD_DATE), (self.base_table, LOAD_DATE),
                           (self.closed_table, self.spec.end_col)):
            self._drop(table, col, lambda x: x > last)

    def store(self, step: DataFrame, d) -> None:
        """Store :meth:`step` (hand over a stored copy of it): only the
        versions that the load opens or closes are written."""
        d = run_date(d)
        self._undo(d)
        active = F.col(self.spec.active_col)
        overwrite_partition(step.where(~active), self.closed_table, self.spec.end_col, d)
        self._finish(step.where(active & (F.col(self.spec.start_col) == F.lit(d))), d)

    def store_range(self, changed: DataFrame, before: DataFrame | None, last, first=None) -> None:
        """Store :meth:`step_range` as one load of the date ``last``.  The
        loads from ``first`` on (its first day; ``last`` where not given) are
        undone."""
        last = run_date(last)
        self._undo(run_date(first or last))
        active = F.col(self.spec.active_col)
        overwrite_partitions(changed.where(~active), self.closed_table, self.spec.end_col)
        self._finish(changed.where(active), last)

    def _finish(self, opened: DataFrame, d) -> None:
        overwrite_partition(opened.select(*self.spec.columns), self.opened_table, LOAD_DATE, d)
        written = read_table(self.spark, self.opened_table).where(F.col(LOAD_DATE) == F.lit(d))
        self._register(self.loads_table, d, written.count())

    # -------------------------------------------------------------- compaction
    def compact(self, *, keep_previous: bool = True) -> _dt.date | None:
        """Write the open versions after the last load as a base and drop what
        it replaces; returns its date (None without loads).

        With ``keep_previous`` the base before and the loads since then stay,
        so that these can be run again; earlier states are gone.  A compaction
        that dies is finished by the next.
        """
        last = self.last_load()
        if last is None:
            return None
        if last not in self.bases():
            overwrite_partition(self.active(), self.base_table, LOAD_DATE, last)
            written = read_table(self.spark, self.base_table).where(F.col(LOAD_DATE) == F.lit(last))
            self._register(self.bases_table, last, written.count())
        edge = max((d for d in self.bases() if d < last), default=None) if keep_previous else last
        if edge is not None:
            self._drop(self.opened_table, LOAD_DATE, lambda x: x <= edge)
            self._drop(self.base_table, LOAD_DATE, lambda x: x < edge)
        return last

    def compaction_due(self, share: float = 0.3) -> bool:
        """Whether the versions opened since the last base are more than
        ``share`` of it, or there are loads behind the first and no base."""
        loads, bases = self.loads(), self.bases()
        if not bases:
            return len(loads) > 1
        base = max(bases)
        return sum(n for d, n in loads.items() if d > base) > share * bases[base]

    # ------------------------------------------------------------------ readers
    def create_views(self, database: str, name: str) -> str:
        """Catalog tables over the files, and the view ``name`` of the whole
        dimension; returns the view's name.  Run it again after a load."""
        spec, full = self.spec, f"`{database}`.`{name}`"
        if not self.bases():    # the view reads a base in any case
            self.compact()
        for part, path, col in (("opened", self.opened_table, LOAD_DATE), ("closed", self.closed_table, spec.end_col),
                                ("base", self.base_table, LOAD_DATE), ("loads", self.loads_table, LOAD_DATE),
                                ("bases", self.bases_table, LOAD_DATE)):
            catalog_table(self.spark, path, database, f"{name}_{part}", col)
        cols = ", ".join(f"`{c}`" for c in spec.columns)
        key, load = f"`{spec.natural_key}`", f"`{LOAD_DATE}`"

        def table(part):
            return f"`{database}`.`{name}_{part}`"
        last, base = (f"(SELECT max({load}) FROM {table(part)})" for part in ("loads", "bases"))
        self.spark.sql(f"""
CREATE OR REPLACE VIEW {full} AS
WITH newest AS (
  SELECT row.* FROM (
    SELECT max_by(struct({cols}), struct({load}, `{spec.start_col}`)) AS row FROM {table("opened")}
    WHERE {load} > {base} AND {load} <= {last} GROUP BY {key}))
SELECT {cols} FROM newest
UNION ALL
SELECT {cols} FROM {table("base")} b LEFT ANTI JOIN newest n ON b.{key} = n.{key}
WHERE b.{load} = {base}
UNION ALL
SELECT {cols} FROM {table("closed")} WHERE `{spec.end_col}` <= {last}""")
        return full
