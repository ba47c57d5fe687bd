"""Mergeable distinct counts, bucketed tables, encounters without an id."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laketide.operators.rollup import daily_rollup, daily_rollup_joined
from laketide.operators.scd2 import DimSpec, scd2_apply
from laketide.operators.sketches import DistinctRollup, relative_error
from laketide.sinks.bucketed import write_bucketed

D = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2025, 2, 1)]
ROLLUP = DistinctRollup(("c",), {"patients": "p", "payers": "y"})
FACT = "date date, c string, p string, y long"


def counted(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_sketches_merge_exactly_when_small(spark):
    rows = [(D[i % 4], "ab"[i % 2], f"p{i % 60}" if i % 7 else None, None if i % 4 == 1 else i % 5) for i in range(400)]
    fact = spark.createDataFrame(rows + rows[:50], FACT)
    daily = ROLLUP.daily(fact)
    distinct = [F.count_distinct("p").alias("patients"), F.count_distinct("y").alias("payers")]
    assert counted(ROLLUP.estimates(daily)) == counted(fact.groupBy("date", "c").agg(*distinct))
    months = ROLLUP.merged(daily, "month")
    want = fact.groupBy(F.trunc("date", "month").alias("date"), "c").agg(*distinct)
    assert counted(ROLLUP.estimates(months)) == counted(want)
    # merged again: months to years without the class, and to one row
    years = ROLLUP.merged(months, "year", [])
    assert counted(ROLLUP.estimates(years)) == counted(fact.groupBy(F.trunc("date", "year").alias("date")).agg(*distinct))
    assert counted(ROLLUP.estimates(ROLLUP.merged(years, grain=[]))) == counted(fact.agg(*distinct))
    # one day alone, and one day replaced
    day = ROLLUP.daily(fact, D[0])
    assert counted(ROLLUP.estimates(day)) == counted(fact.where(F.col("date") == F.lit(D[0])).groupBy("date", "c").agg(*distinct))
    redone = daily.where(F.col("date") != F.lit(D[0])).unionByName(ROLLUP.daily(fact.limit(0)))
    assert counted(ROLLUP.estimates(ROLLUP.merged(redone, "year", []))) == counted(
        fact.where(F.col("date") != F.lit(D[0])).groupBy(F.trunc("date", "year").alias("date")).agg(*distinct))


def test_sketches_of_nothing(spark):
    assert ROLLUP.daily(spark.createDataFrame([], FACT)).count() == 0
    nulls = spark.createDataFrame([(D[0], None, None, None), (None, "a", "x", 1)], FACT)
    assert counted(ROLLUP.estimates(ROLLUP.merged(ROLLUP.daily(nulls), "month"))) == [
        (None, "a", 1, 1), (dt.date(2024, 1, 1), None, 0, 0)]


def test_large_sketches_stay_within_their_error(spark):
    n = 200_000
    fact = spark.range(n).select(
        F.date_add(F.lit(D[0]), (F.col("id") % 20).cast("int")).alias("date"), F.lit("a").alias("c"),
        F.concat(F.lit("p"), F.col("id") % 50_000).alias("p"), F.col("id").alias("y"))
    got = ROLLUP.estimates(ROLLUP.merged(ROLLUP.daily(fact), grain=["c"])).first()
    for value, exact in ((got["patients"], 50_000), (got["payers"], n)):
        assert abs(value - exact) <= 4 * relative_error() * exact
    assert relative_error(14) == pytest.approx(relative_error(12) / 2)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.sql("DROP DATABASE IF EXISTS laketide_buckets CASCADE")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


ENC = ("encounter_id long, date date, dim_patient_key string, dim_payer_key string, encounter_class string, "
       "reason_description string, description string, claim_amount double, coverage_amount double, "
       "patient_pay_amount double")


def facts(spark):
    enc = [(i if i % 5 else None, D[i % 2], f"k{i % 3}", "y", "A", None, f"d{i % 2}", 2.0, 1.0, 1.0) for i in range(60)]
    proc = [(i % 60 if i % 5 else None, D[i % 2], "c" if i % 3 else None) for i in range(300)]
    return (spark.createDataFrame(enc, ENC),
            spark.createDataFrame(proc, "encounter_id long, date date, code string"))


def test_rollup_on_buckets_has_no_exchange_before_the_groups(spark, no_broadcast, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS laketide_buckets")
    fe, fp = facts(spark)
    keys = ["encounter_id", "date"]
    be = write_bucketed(fe, "laketide_buckets.enc", keys, 16, path=f"{scratch}/enc")
    bp = write_bucketed(fp, "laketide_buckets.proc", keys, 16, path=f"{scratch}/proc")
    on_buckets = daily_rollup(be, bp, spread_nulls=False)
    # left: the distinct count's grouping and its final one
    assert exchanges(on_buckets) == exchanges(daily_rollup(fe, fp)) - 2 <= 2
    assert counted(on_buckets) == counted(daily_rollup(fe, fp))
    # written again: replaced
    assert write_bucketed(fe.limit(0), "laketide_buckets.enc", keys, 16, path=f"{scratch}/enc2").count() == 0
    with pytest.raises(ValueError):
        write_bucketed(fe, "laketide_buckets.enc", [], 16)


def test_dimension_step_shuffles_only_the_snapshot(spark, no_broadcast, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS laketide_buckets")
    spec = DimSpec("id", ("city",), surrogate_key="sk")
    one = spark.createDataFrame([(i, "a") for i in range(50)], "id long, city string")
    two = spark.createDataFrame([(i, "b" if i % 9 == 0 else "a") for i in range(55)], "id long, city string")
    dim = scd2_apply(None, one, spec, D[0])
    stored = write_bucketed(dim, "laketide_buckets.dim", ["id"], 16, path=f"{scratch}/dim")
    step = scd2_apply(stored, two, spec, D[1], check_gate=False)
    assert exchanges(step) == 1
    assert counted(step) == counted(scd2_apply(dim, two, spec, D[1], check_gate=False))


def test_encounters_without_an_id(spark):
    fe, fp = facts(spark)
    rows = {(r["date"], r["dim_patient_key"], r["purpose"]): r for r in daily_rollup(fe, fp).collect()}
    joined = {(r["date"], r["dim_patient_key"], r["purpose"]): r for r in daily_rollup_joined(fe, fp).collect()}
    assert set(rows) == set(joined) and len(rows) == 6
    # amounts count, ids that are missing do not, and they match no procedure
    assert sum(r["total_claim_amount"] for r in rows.values()) == 120.0
    assert sum(r["total_encounter_num"] for r in rows.values()) == 48
    assert sum(r["total_procedure_num"] for r in rows.values()) == 240
    assert sum(r["total_procedure_num"] for r in joined.values()) == 240
