"""Table scans, existence checks and session settings (SRC2-SRC11).

A target is a catalog table name (``db.table``) or a storage path
(anything with a ``/``).  Path tables are read as partitioned Parquet, so
the partition column comes back typed and filters on it prune
directories.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laketide.functions.dates import run_date


def is_path(target: str) -> bool:
    return "/" in target or "://" in target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the Hadoop FileSystem of the
    session's configuration (any scheme the cluster supports).  Without a
    JVM gateway (Spark Connect) it falls back to resolving the path."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
    try:
        spark.read.text(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there, through the Hadoop FileSystem."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partition_values(spark: SparkSession, target: str, part_col: str) -> set[str]:
    """Values of a path table's first partition column, as text, from its
    folder names: no file is opened.  A missing table has none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return set()
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{part_col}=")}


def table_exists(spark: SparkSession, target: str) -> bool:
    """Catalog lookup for names; for paths, whether a committed write is
    there: the ``_SUCCESS`` marker every successful Spark write job leaves
    at the table root.  Looking up that one file costs the same for 1 or
    10,000 partitions (resolving the table itself would list them all)."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    return path_exists(spark, f"{target.rstrip('/')}/_SUCCESS")


SCHEMA_FILE = "_schema"  # hidden from Spark's reader (leading underscore)


def save_schema(spark: SparkSession, target: str, schema: T.StructType) -> None:
    """Keep a path table's schema next to its data, written at creation:
    a table whose partitions are all empty (a day without events) has no
    data file to infer it from."""
    path = f"{target.rstrip('/')}/{SCHEMA_FILE}"
    spark.createDataFrame([(schema.json(),)], "s string").coalesce(1).write.mode("overwrite").text(path)


def table_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """Schema kept by :func:`save_schema`, read without a Spark job (every
    read of a path table asks for it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{SCHEMA_FILE}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    for f in fs.listStatus(p):
        if f.getPath().getName().startswith("part-"):
            stream = fs.open(f.getPath())
            try:
                return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
    return None


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """Whole table (SRC3).  Path tables are read with the schema saved at
    creation (no footer inference; empty tables read as empty)."""
    if not is_path(target):
        return spark.table(target)
    schema = table_schema(spark, target)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(target)


def read_slice(spark: SparkSession, target: str, d, part_col: str = "partition_date") -> DataFrame:
    """One run-date partition (SRC2): typed equality on the partition
    column, pruned at planning time."""
    return read_table(spark, target).where(F.col(part_col) == F.lit(run_date(d)))


def columns_except(spark: SparkSession, target: str, exclude: Iterable[str]) -> list[str]:
    """Column names of a table minus some (e.g. the partition column)."""
    skip = set(exclude)
    return [c for c in read_table(spark, target).columns if c not in skip]


def schema_from_dict(schema: Mapping[str, str], exclude_keys: Iterable[str] = ()) -> T.StructType:
    """{'name': 'SQL type'} -> StructType, minus excluded names
    (SRC10, SRC11).  Types use Spark DDL names."""
    skip = set(exclude_keys)
    ddl = ", ".join(f"`{k}` {v}" for k, v in schema.items() if k not in skip)
    return T.StructType.fromDDL(ddl)


def object_store_conf(endpoint: str, *, access_key_env: str, secret_key_env: str,
                      region: str | None = None, path_style: bool = True,
                      ssl: bool = True) -> dict[str, str]:
    """S3A settings for an S3-compatible store (SRC4).  Credentials come
    from environment variables the caller names; they never appear in
    code or in a job's arguments."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.access.key": os.environ.get(access_key_env, ""),
        "spark.hadoop.fs.s3a.secret.key": os.environ.get(secret_key_env, ""),
    }
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


def catalog_conf(name: str, warehouse: str, kind: str = "hadoop") -> dict[str, str]:
    """Settings of an Iceberg catalog (SRC5).  Only useful when the
    Iceberg runtime jar is on the classpath; without it the pipeline
    writes partitioned Parquet."""
    return {
        f"spark.sql.catalog.{name}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{name}.type": kind,
        f"spark.sql.catalog.{name}.warehouse": warehouse,
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    }
