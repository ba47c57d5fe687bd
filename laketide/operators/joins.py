"""Join helpers: spreading of NULL keys and salting of hot keys.

Whether a side is broadcast is left to Spark's byte threshold and AQE,
which know its size; nothing here counts rows to decide on a plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.session import cut_lineage

NULL_SPREAD_BUCKETS = 1024


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns ``xxhash64`` accepts (anything without a map inside)."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def null_spread(key: Column, row_cols: Sequence[str], buckets: int = NULL_SPREAD_BUCKETS) -> Column:
    """Extra join column for the probe side of an outer join: a row hash in
    [0, buckets) when the key is NULL, -1 otherwise (the build side uses
    -1).  NULL keys never match, so results are unchanged, but their rows
    are spread over the shuffle instead of all hashing to one task."""
    return F.when(key.isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in row_cols]), F.lit(buckets))) \
        .otherwise(F.lit(-1)).cast("long")


def salted_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     extra_condition=None, *, salt_buckets: int = 32,
                     hot_share: float = 0.001,
                     salt_from: Sequence[str] | None = None,
                     hot_keys: DataFrame | None = None,
                     hot_rows: int | None = None) -> DataFrame:
    """Left join that splits hot keys of the left side over ``salt_buckets``
    tasks and copies the matching right rows to each bucket.

    Hot keys are found with a partial-aggregated count (map-side combine, no
    group is ever collected), written once: a key is hot when it holds more
    than ``hot_share`` of the left rows.  The list is joined like any other
    table, whatever its length.
    Cold keys keep salt 0 and are joined exactly as a plain join would.
    ``extra_condition(l, r)`` may add a residual predicate (e.g. a date
    range); it is evaluated on the renamed right columns.  ``hot_keys``
    (key columns only) skips the detection passes when the caller already
    knows them, e.g. from the previous load's statistics.  ``hot_rows``
    (an absolute row count) replaces ``hot_share`` and saves the count of
    the left side.
    """
    keys = list(keys)
    if hot_keys is None:
        counts = cut_lineage(left.groupBy(*keys).count(), "key_counts")
        threshold = hot_rows if hot_rows else max(1, int((counts.agg(F.sum("count")).first()[0] or 0) * hot_share))
        hot_keys = counts.where(F.col("count") > threshold)
    else:  # caller's list: de-duplicated once, not per use
        hot_keys = cut_lineage(hot_keys.select(*keys).distinct(), "hot_keys")
    hot = hot_keys.select(*keys).withColumn("_hot", F.lit(True))
    salt_src = [F.col(c) for c in (salt_from or hashable_columns(left))]
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # hot keys and NULL keys (which never match, but would all hash to one
    # task) are spread over the salt buckets
    lsalt = (left.join(hot, keys, "left")
             .withColumn("_salt", F.when(F.col("_hot") | any_null,
                                         F.pmod(F.xxhash64(*salt_src), F.lit(salt_buckets)))
                         .otherwise(F.lit(0)))
             .drop("_hot"))
    rsalt = (right.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                                            .otherwise(F.array(F.lit(0)))))
             .drop("_hot"))
    r_ren = rsalt.select(*[F.col(c).alias(f"_r_{c}") for c in rsalt.columns])
    cond: Column = F.lit(True)
    for k in keys + ["_salt"]:
        cond = cond & (lsalt[k] == r_ren[f"_r_{k}"])
    if extra_condition is not None:
        cond = cond & extra_condition(lsalt, r_ren)
    # salting is for a right side too big to broadcast: keep the shuffle
    # join on (key, salt) even when size statistics would broadcast it
    joined = lsalt.join(r_ren.hint("merge"), cond, "left")
    right_cols = [c for c in right.columns if c not in keys]
    return joined.select(*[lsalt[c] for c in left.columns],
                         *[F.col(f"_r_{c}").alias(c) for c in right_cols])
