"""Raw file scans (SRC1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Sequence[str]) -> T.StructType:
    """All-text schema: raw files are read as text, typed in silver."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | Sequence[str],
             **options) -> DataFrame:
    """CSV with a header row; columns are found by their header names, in
    any order.  Those of ``schema`` come first, cast to its types (a value
    that does not fit is NULL); further columns of the file follow as text.
    A missing column is an error, and so is a file whose header differs from
    the first file's.  No inference pass; splittable, so a large file is
    read by many tasks."""
    if not isinstance(schema, T.StructType):
        schema = string_schema(schema)
    opts = {"header": "true", "mode": "PERMISSIVE", "multiLine": "false", "enforceSchema": "false"}
    opts.update({k: str(v) for k, v in options.items()})
    raw = spark.read.options(**opts).csv(path)
    missing = [c for c in schema.names if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    wanted = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*wanted, *[F.col(f"`{c}`") for c in raw.columns if c not in schema.names])
