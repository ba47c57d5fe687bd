"""Idempotent writes by date partition (SNK1-SNK7, MAT1).

Re-running a day rewrites exactly that day's partition and leaves every
other partition alone (dynamic partition overwrite), so a retried or
repeated run converges to the same table.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.sources.tables import is_path, read_table, save_schema, table_exists


# Codec of the path tables: a table that holds a snapshot a day is mostly
# repeated text, and zstd about halves what snappy leaves of it.
CODEC = "zstd"
# Partitions that a task keeps open while it writes rows laid out by
# partition: as many files as Spark packs into one split (128 MB, 4 MB each).
OPEN_PARTITIONS = 32


def _dynamic(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def _ordered_for(df: DataFrame, target: str, part_col: str | None) -> DataFrame:
    """Columns by name in the target table's order and types, the partition
    column last (``insertInto`` matches by position).  A column that the
    table lacks, or that the rows lack, raises instead of going missing."""
    types = {f.name: f.dataType for f in read_table(df.sparkSession, target).schema.fields}
    if set(types) != set(df.columns):
        raise ValueError(f"columns differ from {target}: only in the rows {sorted(set(df.columns) - set(types))}, "
                         f"only in the table {sorted(set(types) - set(df.columns))}")
    cols = [c for c in types if c != part_col] + ([part_col] if part_col else [])
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in cols])


@contextlib.contextmanager
def unsorted_write(spark):
    """Writes in the block do not sort a task's rows by partition first (and
    so do not spill them); a task with more than ``OPEN_PARTITIONS``
    partitions sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, OPEN_PARTITIONS)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def cluster_for_write(df: DataFrame, part_col: str) -> DataFrame:
    """Rebalance rows by the partition column before a partitioned write
    (the ``REBALANCE`` hint).

    Rows of one date meet in one shuffle partition, so a backfill over many
    dates writes about one file per date instead of one per date per task;
    AQE then splits any partition above the advisory size (one big date: a
    daily load, or a hot day) over several tasks and coalesces small ones.
    No sampling pass over the input is needed (a range repartition would
    scan it twice).
    """
    return df.hint("rebalance", part_col)


def overwrite_partitions(df: DataFrame, target: str, part_col: str, *, clustered: bool = False,
                         table_format: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (SNK1).

    The first write creates the partitioned table.  ``clustered=True``
    when the caller already applied :func:`cluster_for_write` (e.g. to put
    an ``observe`` above the exchange, so the range-sampling job does not
    run it).
    """
    data = df if clustered else cluster_for_write(df, part_col)
    if not table_exists(df.sparkSession, target):
        create_table_as(data, target, part_col, clustered=True, table_format=table_format)
        return
    if table_format != "parquet" and not is_path(target):
        _ordered_for(data, target, part_col).writeTo(target).overwritePartitions()
    elif is_path(target):
        (_ordered_for(data, target, part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", CODEC).partitionBy(part_col).parquet(target))
    else:
        _dynamic(df)
        _ordered_for(data, target, part_col).write.insertInto(target, overwrite=True)


def create_table_as(df: DataFrame, target: str, part_col: str | None = None,
                    *, clustered: bool = False, table_format: str = "parquet") -> None:
    """Create the table from the query's result (SNK2).

    ``table_format`` other than parquet (e.g. ``iceberg``, when its runtime
    is on the classpath) creates a catalog table through the v2 writer.
    """
    if part_col and not clustered:
        df = cluster_for_write(df, part_col)
    if table_format != "parquet" and not is_path(target):
        v2 = df.writeTo(target).using(table_format)
        if part_col:
            v2 = v2.partitionedBy(F.col(part_col))
        v2.create()
        return
    # a folder without a committed table is what a failed create left behind
    retry = is_path(target) and not table_exists(df.sparkSession, target)
    w = df.write.mode("errorifexists")
    if retry:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if part_col:
        w = w.partitionBy(part_col)
    if is_path(target):
        w.option("compression", CODEC).parquet(target)
        save_schema(df.sparkSession, target, df.schema)
    else:
        w.format(table_format).saveAsTable(target)


# folder name Spark gives a NULL partition value
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def overwrite_partition(df: DataFrame, target: str, part_col: str, d, *,
                        table_format: str = "parquet") -> None:
    """Static overwrite of one partition (SNK3): the partition ``d`` ends up
    holding exactly the rows of ``df`` (each stamped with ``d``, whatever
    partition value it had) - also when ``df`` is empty, so re-running a
    day whose source lost its rows clears the day instead of keeping stale
    rows (a dynamic overwrite only replaces partitions present in the
    output).  Other partitions are untouched.

    Path tables: the rows are written straight into the partition folder.
    Catalog tables: ``INSERT OVERWRITE ... PARTITION (col = d)``.
    ``d=None`` (path tables only) is the NULL partition.
    """
    spark = df.sparkSession
    day = None if d is None else run_date(d)
    stamped = df.drop(part_col).withColumn(part_col, F.lit(day).cast("date") if day else F.lit(None).cast("date"))
    if not table_exists(spark, target):
        create_table_as(stamped, target, part_col, table_format=table_format)
        return
    stamped = _ordered_for(stamped, target, part_col)
    cols = [c for c in stamped.columns if c != part_col]
    if is_path(target):
        folder = day.isoformat() if day else NULL_PARTITION
        # no partition column inside the folder; rebalance sizes the files
        (stamped.select(*cols).hint("rebalance").write.mode("overwrite").option("compression", CODEC)
         .parquet(f"{target.rstrip('/')}/{part_col}={folder}"))
    elif table_format != "parquet":
        stamped.select(*cols, part_col).writeTo(target).overwrite(F.col(part_col) == F.lit(day))
    else:
        view = f"_laketide_{abs(hash((target, day.isoformat())))}"
        stamped.select(*cols).createOrReplaceTempView(view)
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION (`{part_col}` = DATE'{day.isoformat()}') "
                  f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}")
        spark.catalog.dropTempView(view)


def overwrite_range(df: DataFrame, target: str, part_col: str, first, last, *, undated: bool = False,
                    clustered: bool = False) -> int:
    """All date partitions from ``first`` to ``last`` (with ``undated`` also
    the NULL partition) of a path table end up holding exactly the rows of
    ``df``, which has no others; returns the number of rows.  A bound that is
    None is open.

    One dynamic overwrite writes the days that have rows, and the days that
    have none any more are cleared behind it.  The dates written come from
    the write itself (``observe``); only dates reach the driver.

    ``clustered=True`` when the rows come laid out by day (a task holds few
    days): they are written where they are, without an exchange or a sort.
    """
    spark = df.sparkSession
    held = set()
    between = F.col(part_col).isNotNull()
    if first is not None:
        between = between & (F.col(part_col) >= F.lit(run_date(first)))
    if last is not None:
        between = between & (F.col(part_col) <= F.lit(run_date(last)))
    if table_exists(spark, target):
        some = between | F.col(part_col).isNull() if undated else between
        held = {r[0] for r in read_table(spark, target).where(some).select(part_col).distinct().collect()}
    obs = Observation()
    day = F.coalesce(F.col(part_col).cast("string"), F.lit(NULL_PARTITION))
    seen = (df if clustered else cluster_for_write(df, part_col)).observe(
        obs, F.collect_set(day).alias("days"), F.count(F.lit(1)).alias("n"))
    with unsorted_write(spark) if clustered else contextlib.nullcontext():
        overwrite_partitions(seen, target, part_col, clustered=True)
    written = {None if x == NULL_PARTITION else run_date(x) for x in obs.get["days"]}
    empty = read_table(spark, target).limit(0)
    for d in held - written:
        overwrite_partition(empty, target, part_col, d)
    return int(obs.get["n"])


def append(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> None:
    """Append rows (SNK4); with ``columns``, only those columns (SNK5)."""
    if columns:
        df = df.select(*columns)
    if not table_exists(df.sparkSession, target):
        create_table_as(df, target)
    elif is_path(target):
        _ordered_for(df, target, None).write.mode("append").parquet(target)
    else:
        _ordered_for(df, target, None).write.insertInto(target, overwrite=False)


def materialize(df: DataFrame, target: str, partition_by: str | None = None, d=None,
                *, before: Callable[[], None] | None = None,
                after: Callable[[], None] | None = None, table_format: str = "parquet") -> str:
    """Incremental materialization (MAT1; SNK6, SNK7).

    * table missing            -> create it from the query (partitioned
      when ``partition_by`` is given);
    * partitioned, ``d`` given -> overwrite the partition ``d`` only, the
      query's rows stamped with ``d``;
    * partitioned, no ``d``    -> overwrite the partitions the query has;
    * not partitioned          -> append.

    ``before`` / ``after`` run around the write; ``table_format`` picks the
    catalog table format (v2 writer for formats other than parquet).
    Returns the action taken.
    """
    if before:
        before()
    if not table_exists(df.sparkSession, target):
        create_table_as(df if d is None or not partition_by
                        else df.drop(partition_by).withColumn(partition_by, F.lit(run_date(d))),
                        target, partition_by, table_format=table_format)
        action = "create"
    elif partition_by and d is not None:
        overwrite_partition(df, target, partition_by, d, table_format=table_format)
        action = "overwrite_partition"
    elif partition_by:
        overwrite_partitions(df, target, partition_by, table_format=table_format)
        action = "overwrite_partitions"
    else:
        append(df, target)
        action = "append"
    if after:
        after()
    return action
