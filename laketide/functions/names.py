"""Column-name normalisation and export recasts (PRJ8, PRJ9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_name(name: str) -> str:
    """Lower-case; blank and dash become underscore."""
    return name.lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column in a single projection."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def recast_for_export(df: DataFrame) -> DataFrame:
    """Type-driven recast in one select: timestamps -> epoch seconds (long),
    dates -> ISO text, decimals -> double; other columns unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_timestamp(c).cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
