"""Table-wide uniqueness of keys under incremental loads (DQ5, DQ6).

A key index is a table beside a fact table: one row per (date, key) with the
number of the fact's rows, partitioned by date like the fact.  A load counts
its own keys, looks them up among the other dates' entries and replaces its
own dates in the index, so a key that comes back after years is found without
reading any old fact.

The index is read in full by every load, keys and counts only.  Entries are
already reduced to one a key and date, a hot key is one row a date, and the
entries of keys that the load does not touch leave in the semi join, which
Spark makes a broadcast of the load's keys where these are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.sinks.write import NULL_PARTITION, overwrite_partition, overwrite_partitions, overwrite_range
from laketide.sources.tables import partition_values, read_table, table_exists


class KeyIndex:
    """Index of ``keys`` of a fact table partitioned by ``part_col``, at the
    path ``target``."""

    def __init__(self, spark: SparkSession, target: str, keys: Sequence[str], part_col: str = "date"):
        self.spark, self.target, self.keys, self.part_col = spark, target, list(keys), part_col

    def entries(self, rows: DataFrame) -> DataFrame:
        """One row per date and key.  A key with a NULL in it is no key (the
        not-null rules count it)."""
        return (rows.dropna(subset=[*self.keys, self.part_col]).groupBy(*self.keys, self.part_col)
                .agg(F.count(F.lit(1)).alias("n_rows")))

    def _others(self, first, last) -> DataFrame | None:
        if not table_exists(self.spark, self.target):
            return None
        return read_table(self.spark, self.target).where(
            ~F.col(self.part_col).between(F.lit(run_date(first)), F.lit(run_date(last))))

    def violations(self, rows: DataFrame, first, last=None) -> DataFrame:
        """Keys among ``rows``, which replace the dates from ``first`` to
        ``last`` (or ``first`` alone), that the table then holds more than
        once: the keys, n_rows, n_dates, first_date, last_date.  Nothing is
        written."""
        new = self.entries(rows)
        old = self._others(first, last or first)
        found = new
        if old is not None:
            found = new.unionByName(old.join(new.select(*self.keys), self.keys, "left_semi"))
        return (found.groupBy(*self.keys)
                .agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_dates"),
                     F.min(self.part_col).alias("first_date"), F.max(self.part_col).alias("last_date"))
                .where(F.col("n_rows") > 1))

    def store(self, rows: DataFrame, first, last=None) -> None:
        """The index of the dates from ``first`` to ``last`` ends up as that
        of ``rows``; other dates stay."""
        overwrite_range(self.entries(rows), self.target, self.part_col, first, last or first)

    def catch_up(self, fact: str, first, last=None) -> list[str]:
        """Index the dates of the path table ``fact`` that the index lacks (a
        load died before its index was written, or the table is older than
        its index), but for those from ``first`` to ``last``, which the caller
        is about to store.  Folder names tell which; only missing dates are
        read.  Returns them."""
        skip = (run_date(first).isoformat(), run_date(last or first).isoformat())
        lacking = partition_values(self.spark, fact, self.part_col) - self._indexed() - {NULL_PARTITION}
        lacking = sorted(d for d in lacking if not skip[0] <= d <= skip[1])
        if lacking:
            rows = read_table(self.spark, fact).where(F.col(self.part_col).isin([run_date(d) for d in lacking]))
            entries = self.entries(rows)
            overwrite_partitions(entries, self.target, self.part_col)
            for d in sorted(set(lacking) - self._indexed()):    # dates without rows
                overwrite_partition(entries.limit(0), self.target, self.part_col, d)
        return lacking

    def _indexed(self) -> set[str]:
        return partition_values(self.spark, self.target, self.part_col)
