"""Write, audit, publish: loads that readers never see half done (SNK1,
SNK3, DQ4).

The table is a partitioned Parquet table in the session's catalog.  A load is
written to a folder of its own, ``<base>/<load id>/<part_col>=<date>``, which
no reader looks at; rules are counted on what was written; publishing points
the catalog's partitions at the load's folders.  No file of a published date
is ever changed or deleted by a load, so a load that fails or dies before it
is published leaves every reader on the old rows, and a date's partition moves
from the old rows to the new ones in one catalog call.  A load of many dates
is published date by date; run again, it ends in the same state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators import quality as DQ
from laketide.sinks.write import cluster_for_write
from laketide.sources.tables import delete_path, partition_values


@dataclass(frozen=True)
class StagedLoad:
    """A written load that is not published: its folder, the dates it
    replaces and the dates it holds rows for."""

    folder: str
    first: str
    last: str
    dates: tuple[str, ...]


class PublishedTable:
    """The catalog table ``name``, partitioned by the date column
    ``part_col``, its loads below the shared folder ``base``."""

    def __init__(self, spark: SparkSession, name: str, base: str, part_col: str = "date"):
        self.spark, self.name, self.base, self.part_col = spark, name, base.rstrip("/"), part_col

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def stage(self, df: DataFrame, first, last=None) -> StagedLoad:
        """Write ``df``, which replaces the dates from ``first`` to ``last``
        (or ``first`` alone).  The table is created if missing, empty.  Rows
        of other dates, or columns that differ from the table's, raise.  A
        NULL date belongs to no load and raises as well."""
        first, last = run_date(first), run_date(last or first)
        if not self.spark.catalog.tableExists(self.name):
            self._create(df)
        names = set(self.read().columns)
        if names != set(df.columns):
            raise ValueError(f"columns differ from {self.name}: {sorted(names ^ set(df.columns))}")
        types = {f.name: f.dataType for f in self.read().schema.fields}
        out = df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
        folder = f"{self.base}/{uuid.uuid4().hex}"
        cluster_for_write(out, self.part_col).write.partitionBy(self.part_col).parquet(folder)
        dates = sorted(partition_values(self.spark, folder, self.part_col))
        outside = [d for d in dates if not first.isoformat() <= d <= last.isoformat()]
        if outside:
            delete_path(self.spark, folder)
            raise ValueError(f"rows outside {first} to {last}: {outside[:5]}")
        return StagedLoad(folder, first.isoformat(), last.isoformat(), tuple(dates))

    def staged_rows(self, load: StagedLoad) -> DataFrame:
        """The rows of a staged load."""
        return self.spark.read.schema(self.read().schema).parquet(load.folder)

    def audit(self, load: StagedLoad, rules: Sequence[DQ.Rule], unique: Sequence[Sequence[str]] = ()) -> dict[str, int]:
        """Failed rows per rule, and keys that the load holds more than once,
        counted on the files that publishing would show."""
        rows = self.staged_rows(load)
        counts = {r["rule"]: int(r["failed_rows"]) for r in DQ.quality_counts(rows, rules).collect()} if rules else {}
        for keys in unique:
            counts[f"{'+'.join(keys)}:unique"] = DQ.unique_violations(rows, keys).count()
        return counts

    def publish(self, load: StagedLoad) -> None:
        """Point the load's dates at its folders; dates of its range without
        rows any more leave the table.  Catalog calls only."""
        held = self._dates()
        new = [f"PARTITION {self._spec(d)} LOCATION '{load.folder}/{self.part_col}={d}'"
               for d in load.dates if d not in held]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD {' '.join(new)}")
        for d in load.dates:
            if d in held:
                self.spark.sql(f"ALTER TABLE {self.name} PARTITION {self._spec(d)} "
                               f"SET LOCATION '{load.folder}/{self.part_col}={d}'")
        gone = [d for d in held if load.first <= d <= load.last and d not in load.dates]
        if gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP {', '.join(f'PARTITION {self._spec(d)}' for d in gone)}")

    def discard(self, load: StagedLoad) -> None:
        """Delete a load that will not be published."""
        delete_path(self.spark, load.folder)

    def load(self, df: DataFrame, first, last=None, rules: Sequence[DQ.Rule] = (),
             unique: Sequence[Sequence[str]] = (), policy: str = "fail") -> dict[str, int]:
        """Stage, audit, publish.  Under ``fail`` a load that fails a rule is
        deleted and raises; the table is as before."""
        load = self.stage(df, first, last)
        counts = self.audit(load, rules, unique)
        try:
            DQ.check(counts, policy)
        except DQ.QualityError:
            self.discard(load)
            raise
        self.publish(load)
        return counts

    def unpublished(self) -> list[str]:
        """Load folders that no partition points at: replaced loads, and
        loads that died.  Delete them (``delete_path``) when no query that
        started before the last publish is running and no load is under way."""
        used = {where.rstrip("/").rsplit("/", 2)[-2] for where in self._locations().values()}
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        return sorted(f"{self.base}/{n}" for n in (f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())
                      if n not in used and n != "table")

    def _create(self, df: DataFrame) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        self.spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet PARTITIONED BY (`{self.part_col}`) "
                       f"LOCATION '{self.base}/table'")

    def _spec(self, d: str) -> str:
        return f"(`{self.part_col}` = DATE'{d}')"

    def _dates(self) -> set[str]:
        """Published dates, from the catalog."""
        return {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def _locations(self) -> dict[str, str]:
        """{date: folder} of the published partitions, from the catalog."""
        out = {}
        for d in self._dates():
            rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} PARTITION {self._spec(d)}").collect()
            out[d] = next(r["data_type"] for r in rows if r["col_name"] == "Location")
        return out
