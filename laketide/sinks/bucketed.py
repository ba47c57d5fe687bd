"""Bucketed catalog tables: joins and groupings on the bucket columns read
them without an exchange (JN5, SCD4).

A table that is joined on the same key every day pays its shuffle once, when
it is written.  Two bucketed tables meet bucket by bucket where both have the
same columns and number of buckets; against any other side only that side is
shuffled, into the table's buckets.

``buckets`` should be at least ``spark.sql.shuffle.partitions`` of the jobs
that read the table, and such that a bucket of the largest table is some
hundred MB.  Buckets are fixed by the key's hash: a hot key stays in one
bucket, and rows with NULL keys share one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, *,
                   path: str | None = None) -> DataFrame:
    """Write ``df`` as the catalog table ``name`` (replacing it), bucketed and
    sorted by ``keys``, one file a bucket; returns the table.  With ``path``
    the files go there and stay when the table is dropped."""
    if not keys:
        raise ValueError("a bucketed table needs a key")
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
