"""Continued history, late snapshots and the merge lookup, on random tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from laketide.operators import scd2 as S
from laketide.operators.asof import lookup_asof, lookup_asof_merge

SPEC = S.DimSpec("k", ("a", "b"), surrogate_key="sk")
ROW = "k string, a string, b int, snapshot_date date"
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]


def day(i):
    return DAYS[i]


def random_snapshots(rnd, n_keys, days, values=2):
    """Keys come, go and come back; values often repeat."""
    rows = []
    for d in days:
        for k in range(n_keys):
            if rnd.random() < 0.65:
                rows.append((f"k{k}", rnd.choice([None, "x", "y"][:values + 1]), rnd.randrange(values), d))
    return rows


def versions(df):
    return sorted([tuple(r) for r in df.select(*SPEC.columns).collect()], key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_continued_equals_steps(spark, seed):
    rnd = random.Random(seed)
    rows = random_snapshots(rnd, 40, DAYS[:7])
    rows.append((None, "x", 1, day(5)))
    df = spark.createDataFrame(rows, ROW)
    first = df.where(F.col("snapshot_date") < F.lit(day(3)))
    later = df.where(F.col("snapshot_date") >= F.lit(day(3)))
    stored = S.scd2_from_snapshots(first, SPEC)
    delta = S.scd2_continue(stored, later, SPEC)
    assert versions(S.replace_versions(stored, delta, SPEC)) == versions(S.scd2_from_snapshots(df, SPEC))
    # only closed and new versions leave
    kept = {r[0] for r in versions(stored.where("is_active"))}
    assert all(r["sk"] not in kept or r["end_date"] is not None for r in delta.collect())
    # nothing new: nothing leaves; nothing stored: all of it does
    assert versions(S.scd2_continue(stored, later.limit(0), SPEC)) == []
    assert versions(S.scd2_continue(stored.limit(0), df, SPEC)) == versions(S.scd2_from_snapshots(df, SPEC))


@pytest.mark.parametrize("seed, at", [(1, 3), (2, 0), (3, 6), (4, 2), (5, 5), (6, 1)])
def test_late_snapshot_equals_rebuild(spark, seed, at):
    rnd = random.Random(seed)
    rows = random_snapshots(rnd, 120, DAYS[:7], values=1 + seed % 2)
    df = spark.createDataFrame(rows, ROW)
    late = F.col("snapshot_date") == F.lit(day(at))
    known = df.where(~late)
    dim = S.scd2_from_snapshots(known, SPEC)
    spliced = S.scd2_splice(dim, df.where(late), known, SPEC, day(at))
    assert versions(spliced) == versions(S.scd2_from_snapshots(df, SPEC))


def test_late_snapshots_one_after_another(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame(random_snapshots(rnd, 60, DAYS[:6]), ROW)
    order = [4, 1, 3]
    known = df.where(~F.col("snapshot_date").isin([day(i) for i in order]))
    dim = S.scd2_from_snapshots(known, SPEC)
    for i in order:
        own = df.where(F.col("snapshot_date") == F.lit(day(i)))
        dim = spark.createDataFrame(S.scd2_splice(dim, own, known, SPEC, day(i)).collect(), dim.schema)
        known = known.unionByName(own)
    assert versions(dim) == versions(S.scd2_from_snapshots(df, SPEC))


def test_late_snapshot_edges(spark):
    df = spark.createDataFrame([("a", "x", 1, day(0)), ("a", "x", 1, day(4)), (None, "x", 1, day(2))], ROW)
    known = df.where(F.col("snapshot_date") != F.lit(day(2)))
    dim = S.scd2_from_snapshots(known, SPEC)
    same = S.scd2_splice(dim, df.where(F.col("k").isNull()), known, SPEC, day(2))     # null keys form no version
    assert versions(same) == versions(dim)
    with pytest.raises(ValueError, match="loaded already"):
        S.scd2_splice(dim, df, known, SPEC, day(0))
    into_nothing = S.scd2_splice(dim.limit(0), df.where(F.col("snapshot_date") == F.lit(day(4))), known.limit(0), SPEC, day(4))
    assert [r[1:] for r in versions(into_nothing)] == [("a", "x", 1, day(4), None, True)]


@pytest.mark.parametrize("salt", [1, 5])
def test_merge_lookup_equals_join(spark, salt):
    rnd = random.Random(salt)
    df = spark.createDataFrame(random_snapshots(rnd, 12, DAYS[1:9]), ROW)
    dim = S.scd2_from_snapshots(df, SPEC)
    dim = dim.where("end_date is null or dayofmonth(end_date) <> 5")        # gaps
    facts = [(i, rnd.choice(["k0", "k1", "k2", "k3", "none", None]), rnd.choice([*DAYS, None])) for i in range(400)]
    facts += facts[:9]
    fact = spark.createDataFrame(facts, "id int, k string, day date").withColumn("_salt", F.lit("clash"))
    got = lookup_asof_merge(fact, dim, SPEC, "k", "day", salt_buckets=salt)
    want = lookup_asof(fact, dim, SPEC, "k", "day")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    stored = spark.createDataFrame(dim.collect(), dim.schema)
    plan = lookup_asof_merge(fact, stored, SPEC, "k", "day")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert lookup_asof_merge(fact.limit(0), dim, SPEC, "k", "day").count() == 0
    assert lookup_asof_merge(fact, dim.limit(0), SPEC, "k", "day").where("sk is not null").count() == 0
