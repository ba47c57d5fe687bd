"""Point-in-time dimension lookup (PIT1; joins JN1-JN4).

A fact row gets the surrogate key of the dimension version valid on a date:
``start_date <= date < end_date`` (open end = still valid).  The date is
either one run date for the whole input (daily load) or a column of the
fact (many dates in one load).  Facts without a valid version keep a NULL
key (left outer join), so no fact row is ever lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators.joins import hashable_columns, null_spread, salted_left_join
from laketide.operators.scd2 import DimSpec, valid_on


def lookup_asof(fact: DataFrame, dim: DataFrame, spec: DimSpec, fact_key: str,
                as_of, *, out_key: str | None = None,
                salt_buckets: int | None = None) -> DataFrame:
    """Add ``out_key`` (default: the dimension's surrogate key name) to
    ``fact``: the key of the version of ``fact[fact_key]`` valid on
    ``as_of``.

    ``as_of`` is a date (or ISO text) for a daily load, or the name of a
    date column of ``fact``.

    Plan:
    * date literal: versions valid on that date are filtered first (at most
      one per key), then a plain equi left join.
    * date column: equi join on the key with the interval as a residual
      predicate, evaluated per (fact, version-of-the-same-key) pair; a key
      has one version per change, so pairs stay bounded.
    * Spark's byte threshold and AQE decide whether the dimension side is
      broadcast.  Otherwise both sides are shuffled; a skewed key is split by
      AQE's skew join, or explicitly by salting (``salt_buckets``, always
      done when given), which spreads a hot key over that many tasks and
      copies its few versions to each.
    """
    out_key = out_key or spec.surrogate_key
    if isinstance(as_of, str) and as_of in fact.columns:
        versions = dim.select(F.col(spec.natural_key).alias("_dk"),
                              F.col(spec.surrogate_key).alias("_sk"),
                              F.col(spec.start_col).alias("_ds"),
                              F.col(spec.end_col).alias("_de"))
        day = F.col(as_of).cast("date")
        if salt_buckets:
            def rng(l, r):
                return ((r["_r__ds"] <= l[as_of].cast("date")) &
                        (r["_r__de"].isNull() | (r["_r__de"] > l[as_of].cast("date"))))
            v = versions.withColumnRenamed("_dk", fact_key)
            joined = salted_left_join(fact, v, [fact_key], rng, salt_buckets=salt_buckets)
            return joined.drop("_ds", "_de").withColumnRenamed("_sk", out_key)
        # Fact rows without a key can never match, but
        # hashing NULL would send all of them to one task: a second join
        # column spreads them (row hash for NULL keys, constant otherwise).
        f = fact.withColumn("_nk", null_spread(F.col(fact_key), hashable_columns(fact)))
        v = versions.withColumn("_nk", F.lit(-1))
        cond = ((f[fact_key] == v["_dk"]) & (f["_nk"] == v["_nk"]) & (v["_ds"] <= day) &
                (v["_de"].isNull() | (v["_de"] > day)))
        joined = f.join(v, cond, "left")
        return joined.select(*[f[c] for c in fact.columns], F.col("_sk").alias(out_key))

    d = run_date(as_of)
    versions = valid_on(dim, spec, d).select(F.col(spec.natural_key).alias("_dk"),
                                             F.col(spec.surrogate_key).alias(out_key))
    if salt_buckets:
        v = versions.withColumnRenamed("_dk", fact_key)
        return salted_left_join(fact, v, [fact_key], salt_buckets=salt_buckets)
    f = fact.withColumn("_nk", null_spread(F.col(fact_key), hashable_columns(fact)))
    v = versions.withColumn("_nk", F.lit(-1))
    joined = f.join(v, (f[fact_key] == v["_dk"]) & (f["_nk"] == v["_nk"]), "left")
    return joined.select(*[f[c] for c in fact.columns], F.col(out_key))


def lookup_asof_merge(fact: DataFrame, dim: DataFrame, spec: DimSpec, fact_key: str, as_of: str, *,
                      out_key: str | None = None, salt_buckets: int = 1) -> DataFrame:
    """:func:`lookup_asof` for a date column, by merging instead of joining.

    Facts and versions are united and sorted by (key, date), and the last
    version that has started is carried forward to the facts behind it; it
    counts if it has not ended by the fact's date.  The work is linear in
    facts and versions, where the join forms every (fact, version of its key)
    pair first: use it when keys have many versions.  Versions of a key do
    not overlap.

    A key's rows are sorted in one task (and spill); ``salt_buckets`` deals
    the facts of every key over that many tasks, each with a copy of the
    key's versions.  Facts without a key match nothing; they are dealt by a
    hash of the row, not gathered.  A fact without a date has no version.
    """
    out_key = out_key or spec.surrogate_key
    cols = fact.columns
    row_hash_ = F.xxhash64(*[F.col(c) for c in hashable_columns(fact)])
    # null keys: any bucket at all, since no version has a null key
    salt = F.when(F.col(fact_key).isNull(), row_hash_).otherwise(F.pmod(row_hash_, F.lit(salt_buckets)))
    key_type = fact.schema[fact_key].dataType
    f = fact.select(F.col(fact_key).alias("_key"), salt.alias("_salt"), F.col(as_of).cast("date").alias("_day"),
                    F.lit(1).alias("_kind"), F.struct(*cols).alias("_fact"))
    carried = F.struct(F.col(spec.surrogate_key).alias("sk"), F.col(spec.end_col).alias("end"))
    v = dim.where(F.col(spec.natural_key).isNotNull()).select(
        F.col(spec.natural_key).cast(key_type).alias("_key"), F.col(spec.start_col).cast("date").alias("_day"),
        F.lit(0).alias("_kind"), carried.alias("_version"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))).alias("_salt"))
    w = (Window.partitionBy("_key", "_salt").orderBy("_day", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = (f.unionByName(v, allowMissingColumns=True)
              .withColumn("_last", F.last("_version", ignorenulls=True).over(w)).where("_kind = 1"))
    last = F.col("_last")
    valid = F.col("_day").isNotNull() & (last["end"].isNull() | (last["end"] > F.col("_day")))
    return merged.select(*[F.col("_fact")[c].alias(c) for c in cols], F.when(valid, last["sk"]).alias(out_key))
